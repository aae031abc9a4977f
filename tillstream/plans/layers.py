"""Bronze to silver to gold, with the quality checks in between."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions.money import with_revenue
from tillstream.functions.stamps import with_order_date
from tillstream.operators.dedup import dedup
from tillstream.operators.quality import (
    observe_rows,
    observe_values,
    run_all,
    run_observed,
    verdicts,
)
from tillstream.operators.rollups import category_metrics, daily_revenue
from tillstream.operators.validate import positive_only
from tillstream.settings import Lake
from tillstream.sources import lake, releases

log = logging.getLogger(__name__)

# Replayed events are dropped by design, so lost rows are reported but do not stop a run.
GATES = ("null_check", "dup_check")


class QualityGateFailed(RuntimeError):
    """Silver is written, gold is left as it was."""


def to_silver(bronze: DataFrame, only_positive: bool = False) -> DataFrame:
    """The last event per order, with revenue and order date."""
    unique = dedup(bronze, "order_id", "ingestion_timestamp")
    if only_positive:
        unique = positive_only(unique)
    return with_order_date(with_revenue(unique))


def silver_of(
    spark: SparkSession,
    paths: Lake,
    first: date | None = None,
    last: date | None = None,
    only_positive: bool = False,
) -> DataFrame:
    """Silver from bronze, or the part of it whose order date lies in a range."""
    bronze = lake.read_bronze(spark, paths.bronze_tables)
    if first is None and last is None:
        return to_silver(bronze, only_positive)
    ids = lake.read_bronze(spark, paths.bronze_tables, first, last).select("order_id").distinct()
    silver = to_silver(bronze.join(ids, "order_id", "left_semi"), only_positive)
    if first is not None:
        silver = silver.filter(F.col("order_date") >= F.lit(first))
    if last is not None:
        silver = silver.filter(F.col("order_date") <= F.lit(last))
    return silver.select(*schemas.SILVER.names)


def run_layers(
    spark: SparkSession,
    paths: Lake,
    first: date | None = None,
    last: date | None = None,
    target: Lake | None = None,
    gates: tuple[str, ...] = GATES,
    only_positive: bool = False,
) -> dict[str, str]:
    """Write silver, check it, write gold; returns the paths written.

    Gold and the checks read the silver that was written, so bronze is deduplicated once and all
    tables agree. Gold reads only the columns it sums, and no order ids once they passed the check.

    A range of order dates gives the rows that the whole silver has in it: an order sent again for
    another day counts on the day of its last copy, so copies of the orders in range are looked up
    on all days. The tables hold nothing else, so they need a ``target`` with a root of their own.
    """
    if (first or last) and (target is None or target.root == paths.root):
        raise ValueError("a range of dates would replace the whole silver; give another target")
    target = target or paths
    bronze = lake.read_bronze(spark, paths.bronze_tables, first, last)
    if first or last or only_positive:
        lake.overwrite(silver_of(spark, paths, first, last, only_positive), target.silver)
        silver = lake.read_table(spark, target.silver, schemas.SILVER)
        # Dedup loses no key; only the filter after it can, so only then are bronze keys compared.
        checks = run_all(bronze, silver, key_drift=only_positive)
    else:
        counted, bronze_rows = observe_rows(bronze, "bronze")
        written, silver_values = observe_values(to_silver(counted), "silver")
        lake.overwrite(written, target.silver)
        silver = lake.read_table(spark, target.silver, schemas.SILVER)
        checks = run_observed(bronze_rows, silver_values, silver)
    lake.overwrite(checks, target.quality)
    passed = verdicts(lake.read_table(spark, target.quality, schemas.CHECKS))
    for name, fine in passed.items():
        log.log(
            logging.INFO if fine else logging.WARNING, "%s %s", name, "passed" if fine else "failed"
        )
    failed = [name for name in gates if not passed[name]]
    if failed:
        raise QualityGateFailed(", ".join(failed))

    ids_present = passed["null_check"]
    lake.overwrite(daily_revenue(silver, ids_present), target.daily_revenue)
    lake.overwrite(category_metrics(silver, ids_present), target.category_metrics)
    return {
        "silver": target.silver,
        "quality": target.quality,
        "daily_revenue": target.daily_revenue,
        "category_metrics": target.category_metrics,
    }


def release_layers(
    spark: SparkSession,
    paths: Lake,
    gates: tuple[str, ...] = GATES,
    only_positive: bool = False,
) -> releases.Release:
    """Run the layers into folders of their own, and make silver, checks and gold visible together.

    Until the last of them is written, and for good where the gate or anything else stops the run,
    readers of the current release see the tables of the run before.
    """
    before = releases.current(spark, paths.releases)
    target = Lake(releases.new_folder(paths.releases))
    written = run_layers(spark, paths, target=target, gates=gates, only_positive=only_positive)
    tables = {name: {releases.WHOLE: path} for name, path in written.items()}
    return releases.publish(spark, paths.releases, before, tables)


RELEASED = {
    "silver": schemas.SILVER,
    "quality": schemas.CHECKS,
    "daily_revenue": schemas.DAILY_REVENUE,
    "category_metrics": schemas.CATEGORY_METRICS,
}


def read_released(spark: SparkSession, paths: Lake) -> dict[str, DataFrame]:
    """The tables of the current release, all of one run."""
    release = releases.current(spark, paths.releases)
    return {name: releases.read(spark, release, name, schema) for name, schema in RELEASED.items()}
