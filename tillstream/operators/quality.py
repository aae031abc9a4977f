"""Data-quality checks as rows of ``check, column, value, threshold, passed``.

Every check is one aggregate; what comes to the driver, if anything, is a row per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tillstream import settings

_ROWS = "_rows"


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN where the type can hold one."""
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        missing = missing | F.isnan(column)
    return missing


def _percent(part: Column, whole: Column) -> Column:
    """Percentage that is 0 for an empty whole."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(share * 100, F.lit(0.0))


def _result(check: str, column: str, value: Column, threshold: float) -> Column:
    """One result; the check passes up to and including the threshold."""
    value = value.cast("double")
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        value.alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(value <= threshold, F.lit(False)).alias("passed"),
    )


def _report(one_row: DataFrame, results: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*results)))


def _one_row(*frames: DataFrame) -> DataFrame:
    """Side by side what are single rows of different columns."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _drift(source: Column, target: Column) -> Column:
    return _percent(source - target, source)


def row_count_drift(
    source: DataFrame,
    target: DataFrame,
    layer: str = "bronze to silver",
    tolerance: float = settings.ROW_COUNT_TOLERANCE,
) -> DataFrame:
    """Percentage of rows lost between layers. Growth, and an empty source, pass."""
    both = _one_row(
        source.agg(F.count(F.lit(1)).alias("source_rows")),
        target.agg(F.count(F.lit(1)).alias("target_rows")),
    )
    lost = _drift(F.col("source_rows"), F.col("target_rows"))
    return _report(both, [_result("count_check", layer, lost, tolerance * 100)])


def null_profile(
    df: DataFrame,
    columns: Sequence[str] = settings.CHECKED_COLUMNS,
    max_ratio: float = 0.0,
) -> DataFrame:
    """Percentage of missing values per column, all columns in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias(_ROWS),
        *[F.count_if(is_missing(df, name)).alias(name) for name in columns],
    )
    return _report(
        counted,
        [
            _result("null_check", name, _percent(F.col(name), F.col(_ROWS)), max_ratio * 100)
            for name in columns
        ],
    )


def positive_profile(
    df: DataFrame, columns: Sequence[str] = settings.POSITIVE_COLUMNS
) -> DataFrame:
    """Number of values per column that are zero or below."""
    counted = df.agg(*[F.count_if(F.col(name) <= 0).alias(name) for name in columns])
    return _report(
        counted, [_result("positive_check", name, F.col(name), 0) for name in columns]
    )


def _age_hours(newest: Column, as_of: datetime | Column) -> Column:
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))
    return micros / 3_600_000_000


def _until(column: str, as_of: datetime | Column) -> Column:
    """The moments up to ``as_of``; later ones, as from a wrong clock, say nothing of age."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.when(F.col(column) <= now, F.col(column))


def freshness(
    df: DataFrame,
    as_of: datetime | Column,
    column: str = "order_ts",
    max_age_hours: float = settings.MAX_AGE_HOURS,
) -> DataFrame:
    """Hours from the newest row to ``as_of``, a column or a datetime with a zone.

    A table without rows is not fresh. Rows dated after ``as_of`` do not make it so.
    """
    newest = df.agg(F.max(_until(column, as_of)).alias("newest"))
    age = _age_hours(F.col("newest"), as_of)
    return _report(newest, [_result("freshness_check", column, age, max_age_hours)])


def duplicate_keys(df: DataFrame, keys: str | Sequence[str] = "order_id") -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def key_profile(
    df: DataFrame,
    key: str,
    columns: Sequence[str] = (),
    positive: Sequence[str] = (),
    newest: Column | None = None,
) -> DataFrame:
    """One row: rows, keys, duplicated keys and more on the given columns, in one pass.

    Counts missing values in ``missing_*`` and values of zero or below in ``low_*``; ``newest`` is
    the largest value of that expression. Counting per key first keeps a hot key to one row per task
    in the only large shuffle.
    """
    counts = {f"missing_{name}": F.count_if(is_missing(df, name)) for name in columns}
    counts |= {f"low_{name}": F.count_if(F.col(name) <= 0) for name in positive}
    latest = [F.max(newest).alias("newest")] if newest is not None else []
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias(_ROWS),
        *[count.alias(name) for name, count in counts.items()],
        *latest,
    )
    return per_key.agg(
        F.coalesce(F.sum(_ROWS), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col(_ROWS) > 1).alias("duplicated"),
        *([F.max("newest").alias("newest")] if latest else []),
    )


def duplicate_check(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Number of duplicated keys; any fails."""
    return _report(
        key_profile(df, key), [_result("dup_check", key, F.col("duplicated"), 0)]
    )


def duplicate_ratio(
    df: DataFrame, key: str = "order_id", max_ratio: float = settings.MAX_DUPLICATE_RATIO
) -> DataFrame:
    """Percentage of rows that are surplus copies of a key."""
    surplus = _percent(F.col("rows") - F.col("keys"), F.col("rows"))
    return _report(
        key_profile(df, key), [_result("duplicate_ratio_check", key, surplus, max_ratio * 100)]
    )


def run_all(
    bronze: DataFrame,
    silver: DataFrame,
    key: str = "order_id",
    columns: Sequence[str] = settings.CHECKED_COLUMNS,
    tolerance: float = settings.ROW_COUNT_TOLERANCE,
    key_drift: bool = True,
) -> DataFrame:
    """Row drift, missing values and duplicates after silver, with one scan of each layer.

    Row drift counts replayed copies as lost, so ``key_check`` also reports the keys lost. That
    shuffles the keys of bronze; ``key_drift=False`` only counts its rows.
    """
    if key_drift:
        before = key_profile(bronze, key).select(
            F.col("rows").alias("source_rows"), F.col("keys").alias("source_keys")
        )
    else:
        before = bronze.agg(F.count(F.lit(1)).alias("source_rows"))
    both = _one_row(before, key_profile(silver, key, columns))
    return _report(both, _layer_results(key, columns, tolerance, key_drift))


def _layer_results(
    key: str, columns: Sequence[str], tolerance: float, key_drift: bool
) -> list[Column]:
    """Results over one row with the counts of both layers."""
    rows_lost = _drift(F.col("source_rows"), F.col("rows"))
    results = [_result("count_check", "bronze to silver", rows_lost, tolerance * 100)]
    if key_drift:
        keys_lost = _drift(F.col("source_keys"), F.col("keys"))
        results.append(_result("key_check", key, keys_lost, tolerance * 100))
    for name in columns:
        missing = _percent(F.col(f"missing_{name}"), F.col("rows"))
        results.append(_result("null_check", name, missing, 0))
    results.append(_result("dup_check", key, F.col("duplicated"), 0))
    return results


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted by whatever action runs over them."""
    counted = Observation(name)
    return df.observe(counted, F.count(F.lit(1)).alias("rows")), counted


def observe_values(
    df: DataFrame,
    name: str,
    columns: Sequence[str] = settings.CHECKED_COLUMNS,
    positive: Sequence[str] = settings.POSITIVE_COLUMNS,
) -> tuple[DataFrame, Observation]:
    """The same rows, whose missing values, and values of zero or below, are counted on the way."""
    counted = Observation(name)
    missing = [F.count_if(is_missing(df, c)).alias(f"missing_{c}") for c in columns]
    low = [F.count_if(F.col(c) <= 0).alias(f"low_{c}") for c in positive]
    return df.observe(counted, F.count(F.lit(1)).alias("rows"), *missing, *low), counted


def run_observed(
    bronze_rows: Observation,
    silver_values: Observation,
    silver: DataFrame,
    key: str = "order_id",
    columns: Sequence[str] = settings.CHECKED_COLUMNS,
    positive: Sequence[str] = settings.POSITIVE_COLUMNS,
    tolerance: float = settings.ROW_COUNT_TOLERANCE,
) -> DataFrame:
    """``run_all`` without drift of keys, and the amounts of zero or below.

    Bronze rows and silver values were counted while silver was written, so bronze is not read again
    and of silver only the key is. Values are counted where silver leaves its last stage, once per
    partition. Bronze rows are counted before the shuffle: map tasks run again for a lost executor count
    twice, which can only show more rows as lost than there are.
    """
    before, after = bronze_rows.get["rows"], silver_values.get
    counts = {f"missing_{name}": F.lit(after[f"missing_{name}"]) for name in columns}
    counts |= {f"low_{name}": F.lit(after[f"low_{name}"]) for name in positive}
    both = key_profile(silver, key).withColumns({"source_rows": F.lit(before), **counts})
    results = _layer_results(key, columns, tolerance, key_drift=False)
    results += [_result("positive_check", name, F.col(f"low_{name}"), 0) for name in positive]
    return _report(both, results)


def run_thresholds(
    df: DataFrame,
    as_of: datetime | Column,
    key: str = "order_id",
    columns: Sequence[str] = settings.CRITICAL_COLUMNS,
    positive: Sequence[str] = settings.POSITIVE_COLUMNS,
    event_time: str = "order_ts",
) -> DataFrame:
    """The checks with a configured tolerance, on one table in one scan.

    Missing values in the critical columns, surplus copies, amounts of zero or below, and age.
    """
    profile = key_profile(df, key, columns, positive, _until(event_time, as_of))
    rows = F.col("rows")
    results = []
    for name in columns:
        missing = _percent(F.col(f"missing_{name}"), rows)
        results.append(_result("null_check", name, missing, settings.MAX_NULL_RATIO * 100))
    surplus, limit = _percent(rows - F.col("keys"), rows), settings.MAX_DUPLICATE_RATIO * 100
    results.append(_result("duplicate_ratio_check", key, surplus, limit))
    results += [_result("positive_check", name, F.col(f"low_{name}"), 0) for name in positive]
    age = _age_hours(F.col("newest"), as_of)
    results.append(_result("freshness_check", event_time, age, settings.MAX_AGE_HOURS))
    return _report(profile, results)


def reject_count(rejects: DataFrame, table: str) -> DataFrame:
    """Number of rows that a load set apart; any fails the check, none stops the load."""
    counted = rejects.agg(F.count(F.lit(1)).alias(_ROWS))
    return _report(counted, [_result("reject_check", table, F.col(_ROWS), 0)])


def constraint_profile(
    df: DataFrame,
    primary_key: str,
    required: Sequence[str],
    text_limits: dict[str, int],
) -> DataFrame:
    """Violations of key, NOT NULL and text length in one pass; a table may load if all are 0."""
    limited = [name for name in text_limits if name in df.columns]
    flagged = df.select(
        primary_key,
        *[F.col(name).isNull().cast("int").alias(f"null_{name}") for name in required],
        *[
            F.coalesce(F.length(name) > text_limits[name], F.lit(False))
            .cast("int")
            .alias(f"long_{name}")
            for name in limited
        ],
    )
    flags = flagged.columns[1:]
    per_key = flagged.groupBy(primary_key).agg(
        F.count(F.lit(1)).alias(_ROWS), *[F.sum(flag).alias(flag) for flag in flags]
    )
    counted = per_key.agg(
        F.count_if(F.col(_ROWS) > 1).alias(_ROWS),
        *[F.coalesce(F.sum(flag), F.lit(0)).alias(flag) for flag in flags],
    )
    return _report(
        counted,
        [
            _result("primary_key", primary_key, F.col(_ROWS), 0),
            *[_result("not_null", name, F.col(f"null_{name}"), 0) for name in required],
            *[_result("text_length", name, F.col(f"long_{name}"), 0) for name in limited],
        ],
    )


def verdicts(results: DataFrame) -> dict[str, bool]:
    """Check name to whether all its columns passed; collects a row per check."""
    passed = results.groupBy("check").agg(F.every("passed").alias("passed"))
    return {row["check"]: row["passed"] for row in passed.collect()}
