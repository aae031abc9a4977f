"""Jobs from the command line, for spark-submit or ``python -m tillstream``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import functions as F

from tillstream import schemas, settings
from tillstream.functions.codec import with_event_defaults
from tillstream.functions.money import with_revenue
from tillstream.functions.stamps import with_order_time_now
from tillstream.operators.quality import run_all, run_thresholds
from tillstream.plans.increments import take_up
from tillstream.plans.layers import release_layers, run_layers
from tillstream.plans.star import load_star, merge_fact, write_answers
from tillstream.session import build_session, input_size, sized_for
from tillstream.settings import Lake
from tillstream.sources import lake, releases, topics
from tillstream.streaming import bronze
from tillstream.streaming.metrics import start_state_windows, start_windows


def _messages(spark, args):
    options = topics.subscribe_options(
        args.servers,
        args.topic,
        max_offsets_per_trigger=args.max_offsets or None,
        min_partitions=args.min_partitions,
        security=dict(pair.split("=", 1) for pair in args.security),
    )
    return topics.subscribe(spark, options)


def ingest(spark, args) -> None:
    paths = Lake(args.root)
    messages = _messages(spark, args)
    trigger = bronze.AVAILABLE_NOW if args.once else bronze.INTERVAL
    start = {"trigger": trigger, "strict": args.strict}
    if args.unique_within:
        unique = start | {"unique_within": args.unique_within}
        landing = bronze.start_unique_bronze(
            messages, paths.bronze_batches, paths.checkpoint("unique_bronze"), **unique
        )
    else:
        landing = bronze.start_bronze(
            messages, paths.bronze, paths.checkpoint("bronze"), **start
        )
    running = [
        landing,
        bronze.start_dead_letters(
            messages, paths.dead_letters, paths.checkpoint("dead_letters"), **start
        ),
    ]
    if not args.once:
        spark.streams.awaitAnyTermination()
    for query in running:
        query.awaitTermination() if args.once else query.stop()


def backfill(spark, args) -> None:
    paths = Lake(args.root)
    bronze.start_split(
        _messages(spark, args),
        paths.bronze_batches,
        paths.dead_letter_batches,
        paths.checkpoint("backfill"),
        bronze.AVAILABLE_NOW,
        args.strict,
        compact=True,
    ).awaitTermination()


def metrics(spark, args) -> None:
    paths = Lake(args.root)
    accepted, _ = bronze.bronze_and_rejects(_messages(spark, args))
    start, options = start_windows, {"watermark": args.watermark}
    if args.in_order:
        start = start_state_windows
        options = {"watermark": args.watermark or settings.WATERMARK_DELAY}
    start(
        with_revenue(accepted),
        paths.windowed_metrics,
        paths.checkpoint("windowed_metrics"),
        bronze.INTERVAL,
        **options,
    ).awaitTermination()


def publish(spark, args) -> None:
    orders = lake.read_csv_orders(spark, args.csv)
    if not args.keep_times:
        orders = with_order_time_now(orders)
    events = with_event_defaults(orders)
    topics.publish(events, topics.publish_options(args.servers, args.topic))


def layers(spark, args) -> None:
    target = args.target and Lake(args.target)
    run_layers(
        spark, Lake(args.root), args.first, args.last, target, only_positive=args.only_positive
    )


def release(spark, args) -> None:
    """The layers into folders of their own, visible together at the end."""
    release_layers(spark, Lake(args.root), only_positive=args.only_positive)
    releases.forget(spark, Lake(args.root).releases, args.keep)


def increments(spark, args) -> None:
    """What came to bronze since the last time, into silver and gold."""
    take_up(spark, Lake(args.root))
    releases.forget(spark, Lake(args.root).increments, args.keep)


def merge(spark, args) -> None:
    """The orders of a lake's silver into the fact of another."""
    silver = lake.read_table(spark, Lake(args.changes).silver, schemas.SILVER)
    merge_fact(spark, silver, Lake(args.root))


def compact(spark, args) -> None:
    """Bronze with few files per day, in a lake of its own."""
    if args.root.rstrip("/") == args.target.rstrip("/"):
        raise ValueError("compact into another root; bronze is read meanwhile")
    source = lake.read_bronze(spark, Lake(args.root).bronze_tables)
    lake.write_bronze(source, Lake(args.target).bronze_batches, mode="overwrite")


def star(spark, args) -> None:
    load_star(spark, Lake(args.root), args.previous and Lake(args.previous))


def questions(spark, args) -> None:
    for name, path in write_answers(spark, Lake(args.root)).items():
        print(name, path)


def check(spark, args) -> None:
    paths = Lake(args.root)
    silver = lake.read_table(spark, paths.silver, schemas.SILVER)
    for report in (
        run_all(lake.read_bronze(spark, paths.bronze_tables), silver),
        run_thresholds(silver, F.current_timestamp()),
    ):
        for row in report.collect():  # a row per check
            print(*row)


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillstream")
    parser.add_argument(
        "--input-bytes", type=int, help="size of the largest input; found from the files if left out"
    )
    jobs = parser.add_subparsers(required=True)

    def job(run, *needs: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(run.__name__)
        added.set_defaults(run=run)
        for need in needs:
            added.add_argument(f"--{need}", required=True)
        return added

    stream = job(ingest, "root", "servers")
    stream.add_argument("--once", action="store_true", help="stop when all is read")
    history = job(backfill, "root", "servers")
    windows = job(metrics, "root", "servers")
    windows.add_argument("--watermark", help="delay after which a window is final")
    windows.add_argument(
        "--in-order", action="store_true", help="final windows alone, kept in the stream's state"
    )
    stream.add_argument("--unique-within", help="leave out copies of an order within this time")
    rate = settings.MAX_OFFSETS_PER_TRIGGER
    for reader, most in ((stream, rate), (windows, rate), (history, 1_000_000_000)):
        reader.add_argument("--topic", default=settings.TOPIC)
        reader.add_argument(
            "--max-offsets", type=int, default=most, help="messages per batch, 0 for all there are"
        )
        reader.add_argument("--min-partitions", type=int, help="tasks to read the topic with")
        reader.add_argument("--security", action="append", default=[], metavar="NAME=VALUE")
    for reader in (stream, history):
        reader.add_argument("--strict", action="store_true")
    send = job(publish, "csv", "servers")
    send.add_argument("--topic", default=settings.TOPIC)
    send.add_argument("--keep-times", action="store_true", help="do not set order times to now")
    batch = job(layers, "root")
    batch.add_argument("--first", type=date.fromisoformat)
    batch.add_argument("--last", type=date.fromisoformat)
    batch.add_argument("--target", help="root to write to, needed with a range of dates")
    batch.add_argument("--only-positive", action="store_true")
    whole = job(release, "root")
    whole.add_argument("--only-positive", action="store_true")
    for history in (whole, job(increments, "root")):
        history.add_argument("--keep", type=int, default=10, help="releases that stay readable")
    job(merge, "root", "changes")
    job(compact, "root", "target")
    job(star, "root").add_argument("--previous", help="root whose dimension keys are kept")
    job(questions, "root")
    job(check, "root")

    args = parser.parse_args()
    spark = build_session(input_bytes=args.input_bytes or 0)
    if args.input_bytes is None and "root" in args:
        paths = Lake(args.root)
        size = max(input_size(spark, *paths.bronze_tables), input_size(spark, paths.silver))
        for name, value in sized_for(size).items():
            spark.conf.set(name, value)
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
