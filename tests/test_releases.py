from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_layers import bronze_of

from tillstream import schemas
from tillstream.operators import quality
from tillstream.plans import increments, layers, star
from tillstream.settings import Lake
from tillstream.sources import lake, releases


@pytest.fixture
def paths(tmp_path):
    return Lake(str(tmp_path / "lake"))


def changed(silver, **columns):
    return silver.withColumns({name: F.lit(value) for name, value in columns.items()})


def moved(events, day):
    moment = F.to_timestamp(F.lit(f"{day} 10:00:00"))
    return events.withColumns(
        {"order_ts": moment, "year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
    )


def test_a_run_that_ends_halfway_changes_nothing_for_readers(spark, paths, silver, monkeypatch):
    assert releases.current(spark, paths.releases).number == 0
    assert layers.read_released(spark, paths)["silver"].count() == 0
    lake.write_bronze(bronze_of(silver), paths.bronze_batches)
    assert layers.release_layers(spark, paths).number == 1
    before = {name: rows(df) for name, df in layers.read_released(spark, paths).items()}
    assert len(before["silver"]) == 6

    lake.write_bronze(bronze_of(changed(silver, price=1.0), hours=1), paths.bronze_batches)
    write = lake.overwrite

    def stop_at_gold(df, path, *rest):
        if path.endswith("category_metrics"):
            raise RuntimeError("killed")
        write(df, path, *rest)

    monkeypatch.setattr(lake, "overwrite", stop_at_gold)
    with pytest.raises(RuntimeError, match="killed"):
        layers.release_layers(spark, paths)
    assert {name: rows(df) for name, df in layers.read_released(spark, paths).items()} == before

    monkeypatch.undo()
    reader = layers.read_released(spark, paths)
    assert layers.release_layers(spark, paths).number == 2
    after = {name: rows(df) for name, df in layers.read_released(spark, paths).items()}
    assert after["category_metrics"] == [("Electronics", 2.0, 2), ("Footwear", 3.0, 2), ("Home", 4.0, 2)]
    # Who began with the release before still reads it whole.
    assert {name: rows(df) for name, df in reader.items()} == before


def test_a_failed_gate_publishes_nothing(spark, paths, silver):
    lost = bronze_of(silver).withColumn("customer_id", F.lit(None).cast("string"))
    lake.write_bronze(lost, paths.bronze_batches)
    with pytest.raises(layers.QualityGateFailed, match="null_check"):
        layers.release_layers(spark, paths)
    assert releases.current(spark, paths.releases).number == 0


def test_a_second_writer_is_refused(spark, tmp_path):
    root = str(tmp_path / "r")
    first = releases.publish(spark, root, releases.Release(), {"t": {"": "a"}}, {"s": 3})
    with pytest.raises(releases.ReleaseConflict):
        releases.publish(spark, root, releases.Release(), {"t": {"": "b"}})
    second = releases.publish(spark, root, first, {"u": {"": "c"}})
    assert releases.current(spark, root) == second == releases.Release(2, {"t": {"": "a"}, "u": {"": "c"}}, {"s": 3})
    assert sorted(x.name for x in (tmp_path / "r").glob("*") if "draft" in x.name) == []
    text = json.loads((tmp_path / "r" / f"{2:012d}.json").read_text())
    assert text["number"] == 2


def test_old_releases_are_forgotten_with_what_they_alone_name(spark, tmp_path):
    root, data = str(tmp_path / "r"), spark.range(3).toDF("n")
    schema, release = schemas.schema(n="long"), releases.Release()
    for k in range(4):
        parts = releases.write_whole(data, f"{root}/runs/{k}")
        tables = {"t": parts, "fixed": parts} if k == 0 else {"t": parts}
        release = releases.publish(spark, root, release, tables)
    releases.forget(spark, root, keep=2)
    assert [x.name for x in sorted((tmp_path / "r" / "runs").iterdir())] == ["0", "2", "3"]
    now = releases.current(spark, root)
    assert now == release
    assert releases.read(spark, now, "t", schema).count() == releases.read(spark, now, "fixed", schema).count() == 3


def merged(spark, paths):
    return rows(star.read_merged(spark, paths))


def test_merge_equals_full_load_and_leaves_other_days_alone(spark, paths, silver):
    base = silver
    release = star.merge_fact(spark, base, paths)
    assert merged(spark, paths) == rows(star.fact_sales(base))
    files = set(star.read_merged(spark, paths).inputFiles())
    # One order changes its price, one its day, one is new.
    cheaper = changed(base.where("order_id = 'O-1'"), revenue=1.0, price=1.0)
    later = base.where("order_id = 'O-4'").withColumns(
        {"order_ts": F.to_timestamp(F.lit("2024-02-02 07:00:00")), "order_date": F.lit(date(2024, 2, 2))}
    )
    new = changed(base.where("order_id = 'O-6'"), order_id="O-7")
    changes = cheaper.unionByName(later).unionByName(new)
    star.merge_fact(spark, changes, paths)
    whole = base.where("order_id NOT IN ('O-1', 'O-4')").unionByName(changes)
    assert merged(spark, paths) == rows(star.fact_sales(whole))

    parts = releases.current(spark, paths.warehouse("fact_releases")).tables["fact_sales"]
    before = release.tables["fact_sales"]
    same = {day for day in before if parts.get(day) == before[day]}
    assert same == {"2024-01-16"} and "2024-02-01" not in parts
    kept = {x for x in files if "2024-01-16" in x}
    assert kept and kept == set(star.read_merged(spark, paths).inputFiles()) & files
    day = releases.read(spark, releases.current(spark, paths.warehouse("fact_releases")), "fact_sales",
                        schemas.FACT_SALES, [date(2024, 2, 2)])
    assert rows(day.select("order_id")) == [("O-4",), ("O-5",)]
    assert [r.order_id for r in day.collect()] == ["O-4", "O-5"]


def test_merged_orders_that_do_not_fit_leave_the_fact(spark, paths, silver):
    star.merge_fact(spark, silver, paths)
    huge = changed(silver.where("order_id = 'O-2'"), price=1e12, revenue=1e12)
    release = star.merge_fact(spark, huge, paths)
    assert merged(spark, paths) == rows(star.fact_sales(silver.where("order_id <> 'O-2'")))
    checks = releases.read(spark, release, "load_checks", schemas.CHECKS)
    assert rows(checks.select("value", "passed")) == [(1.0, False)]


def test_increments_equal_one_run_and_read_new_files_alone(spark, paths, silver, tmp_path):
    first = bronze_of(silver)
    lake.write_bronze(first, paths.bronze_batches)
    assert increments.take_up(spark, paths).number == 1
    # A newer copy for another day, an older copy that changes nothing, and a new order.
    newer = moved(bronze_of(silver, hours=2).where("order_id = 'O-1'"), "2024-02-02")
    older = changed(bronze_of(silver, hours=-2).where("order_id = 'O-5'"), price=1.0)
    new = changed(bronze_of(silver).where("order_id = 'O-3'"), order_id="O-9")
    second = newer.unionByName(older).unionByName(new)
    lake.write_bronze(second, paths.bronze_batches)

    seen = []
    write = increments.batch_writer

    def watched(lake_paths, stream):
        inner = write(lake_paths, stream)

        def count(batch, batch_id):
            seen.append(rows(batch.select("order_id")))
            inner(batch, batch_id)

        return count

    increments.batch_writer = watched
    try:
        release = increments.take_up(spark, paths)
    finally:
        increments.batch_writer = write
    assert seen == [[("O-1",), ("O-5",), ("O-9",)]]

    whole = Lake(str(tmp_path / "whole"))
    lake.write_bronze(first.unionByName(second), whole.bronze_batches)
    layers.run_layers(spark, whole)
    got = increments.read_increments(spark, paths)
    assert rows(got["silver"]) == rows(lake.read_table(spark, whole.silver, schemas.SILVER))
    assert rows(got["daily_revenue"]) == rows(lake.read_table(spark, whole.daily_revenue, schemas.DAILY_REVENUE))
    gold = lake.read_table(spark, whole.category_metrics, schemas.CATEGORY_METRICS)
    assert rows(got["category_metrics"]) == rows(gold)

    # A batch that is run again, and a run without new files, change nothing.
    increments.batch_writer(paths, "batches")(second, 1)
    assert increments.take_up(spark, paths) == release


def test_increments_from_both_bronze_tables(spark, paths, silver, tmp_path):
    events = bronze_of(silver)
    lake.write_bronze(events.where("order_id < 'O-4'"), paths.bronze_batches)
    source = str(tmp_path / "source")
    events.where("order_id >= 'O-4'").write.parquet(source)
    arriving = spark.readStream.schema(schemas.BRONZE).parquet(source)
    writer = arriving.writeStream.format("parquet").partitionBy("year", "month", "day")
    writer = writer.option("checkpointLocation", paths.checkpoint("bronze")).trigger(availableNow=True)
    writer.start(paths.bronze).awaitTermination()
    release = increments.take_up(spark, paths)
    assert release.marks == {"stream": 0, "batches": 0}
    assert increments.read_increments(spark, paths)["silver"].count() == 6


def test_a_batch_that_fails_its_checks_publishes_nothing(spark, paths, silver):
    lost = bronze_of(silver).withColumn("customer_id", F.lit(None).cast("string"))
    with pytest.raises(layers.QualityGateFailed):
        increments.batch_writer(paths, "batches")(lost, 0)
    assert releases.current(spark, paths.increments).number == 0


def test_checks_of_the_write_pass_are_those_of_a_scan(spark, paths, silver, monkeypatch):
    twice = bronze_of(silver).unionByName(bronze_of(silver, hours=1))
    lake.write_bronze(twice, paths.bronze_batches)
    read = []
    monkeypatch.setattr(
        lake, "read_bronze", lambda *a, f=lake.read_bronze, **k: read.append(1) or f(*a, **k)
    )
    layers.run_layers(spark, paths)
    written = lake.read_table(spark, paths.silver, schemas.SILVER)
    bronze = lake.read_tables(spark, paths.bronze_tables, schemas.BRONZE)
    scanned = quality.run_all(bronze, written, key_drift=False)
    scanned = scanned.unionByName(quality.positive_profile(written))
    assert rows(lake.read_table(spark, paths.quality, schemas.CHECKS)) == rows(scanned)
    assert read == [1]


def test_checks_of_an_empty_bronze(spark, paths, silver):
    lake.write_bronze(bronze_of(silver).limit(0), paths.bronze_batches)
    layers.run_layers(spark, paths)
    checks = lake.read_table(spark, paths.quality, schemas.CHECKS)
    assert checks.where("NOT passed").isEmpty() and checks.count() == 7
