"""Command line of the jobs.

    spark-submit --py-files tidemill.zip run_job.py daily-mean \
        --bootstrap-servers broker:9092 --in-topic weather-osaka \
        --out-topic daily-means --checkpoint /shared/checkpoints/daily-osaka
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions import (
    daily_mean_line,
    moving_mean_line,
    rain_run_line,
)
from tidemill.operators import (
    clean_observations,
    parse_weather,
    passthrough,
    watermark_per_source,
)
from tidemill.operators.eventtime import DEFAULT_DELAY, NO_DELAY, SESSION_DELAY
from tidemill.plans import (
    COMPLETE_DAILY_MEANS,
    COMPLETE_MOVING_MEANS,
    COMPLETE_RAIN_RUNS,
    daily_means,
    json_lines,
    moving_means,
    non_negative_lines,
    rain_runs,
    refreshing_mean_lines,
    start_stretch_job,
    temperatures,
    timed_readings,
)
from tidemill.schema import FILE
from tidemill.session import build_session
from tidemill.sources import (
    KafkaSource,
    common_root,
    message_lines,
    read_kafka,
    read_raw_observations,
    read_weather_tsv,
    start_file_sink,
    start_kafka_sink,
    start_tsv_sink,
    to_topic_messages,
    to_value_messages,
    write_parquet,
    write_tsv,
)
from tidemill.streaming import (
    LateRows,
    accepted_stream,
    rejected_stream,
    start_pane_means,
    start_split,
    timer_pane_means,
    write_numbered,
)

PARTITION = ("topic", "partition")

# Jobs without windows: messages -> rows.
STATELESS = {
    "passthrough": lambda messages, rules: passthrough(messages),
    "json-lines": lambda messages, rules: json_lines(messages, **rules),
    "non-negative": lambda messages, rules: non_negative_lines(messages, **rules),
}
# Windowed jobs: readings -> windows, and the line of a window.
WINDOWED: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[], Column]]] = {
    "daily-mean": (daily_means, lambda: daily_mean_line(F.col("window_start"), F.col("mean"))),
    "moving-mean": (moving_means, lambda: moving_mean_line(F.col("window_start"), F.col("mean"))),
    "rain-runs": (rain_runs, lambda: rain_run_line(F.col("window_end"), F.col("hours"))),
}
# The same on stretches of time that all partitions have passed.
STRETCHES = {
    "daily-mean": COMPLETE_DAILY_MEANS,
    "moving-mean": COMPLETE_MOVING_MEANS,
    "rain-runs": COMPLETE_RAIN_RUNS,
}
REFRESHING = "refreshing-mean"
STREAM_JOBS = (*STATELESS, *WINDOWED, REFRESHING)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run_job.py")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in STREAM_JOBS:
        job = jobs.add_parser(name)
        job.add_argument("--source", choices=("kafka", "files"), default="kafka")
        job.add_argument("--bootstrap-servers")
        job.add_argument("--in-topic", action="append", default=[], help="may be repeated")
        job.add_argument("--starting-offsets", default="latest")
        job.add_argument("--max-offsets-per-trigger", type=int)
        job.add_argument("--in-path", help="<path>/<topic>/<files with one message per line>")
        job.add_argument("--max-files-per-trigger", type=int)
        job.add_argument("--sink", choices=("kafka", "files"), default="kafka")
        job.add_argument("--out-topic")
        job.add_argument("--out-path")
        job.add_argument("--checkpoint", required=True, help="shared folder, one per job")
        job.add_argument("--trigger", help='such as "10 seconds"')
        job.add_argument("--available-now", action="store_true", help="stop at the end of the data")
        if name != "passthrough":
            job.add_argument("--on-malformed", choices=("fail", "quarantine"), default="fail")
            job.add_argument("--quarantine-path", help="folder for malformed records")
            job.add_argument("--on-missing", choices=("zero", "null"), default="zero")
            job.add_argument("--on-unknown", choices=("ignore", "fail"), default="ignore")
        if name == REFRESHING:
            job.add_argument(
                "--panes", choices=("batch", "timer"), default="batch",
                help="a pane is a micro-batch, or closes a second after its first arrival",
            )
        if name in WINDOWED:
            job.add_argument(
                "--watermark", choices=("merged", "per-topic", "per-partition"), default="merged",
                help="per-topic: the slowest topic holds the watermark back; one source for each "
                "topic, so for tens of them, not thousands; per-partition: the slowest partition "
                "of all topics, with late rows kept below the checkpoint",
            )
            job.add_argument(
                "--partitions", type=int, metavar="N",
                help="per-partition: so many of each topic hold the watermark back from the start",
            )
            job.add_argument(
                "--idle", type=float, metavar="SECONDS",
                help="per-partition: one that brings nothing for so long holds back no longer",
            )
            job.add_argument(
                "--delay", type=float, metavar="SECONDS",
                help="lateness allowed, two hours by default; 0 only for one ordered partition",
            )
            job.add_argument(
                "--fail-on-late", action="store_true", help="stop when a late row is dropped"
            )
    clean = jobs.add_parser("clean", help="raw observation CSV -> hourly TSV")
    clean.add_argument("--in-path", nargs="+", required=True)
    clean.add_argument("--out-path", required=True)
    clean.add_argument("--encoding", default="ISO-8859-1")
    clean.add_argument(
        "--checkpoint", help="shared folder that lists the files cleaned: a later run takes new ones only"
    )
    clean.add_argument("--trigger", help="with --checkpoint: go on as files arrive, so often")
    load = jobs.add_parser("load", help="hourly TSV files -> one labelled Parquet table")
    load.add_argument("--in-path", nargs="+", required=True)
    load.add_argument("--out-path", required=True)
    return parser


def _check(parser: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    def need(value, option: str, why: str) -> None:
        if not value:
            parser.error(f"{why} needs {option}")

    if args.source == "kafka":
        need(args.bootstrap_servers, "--bootstrap-servers", "a Kafka source")
        need(args.in_topic, "--in-topic", "a Kafka source")
    else:
        need(args.in_path, "--in-path", "a file source")
    if args.sink == "kafka":
        need(args.bootstrap_servers, "--bootstrap-servers", "a Kafka sink")
        need(args.out_topic, "--out-topic", "a Kafka sink")
    else:
        need(args.out_path, "--out-path", "a file sink")
    if getattr(args, "on_malformed", None) == "quarantine":
        need(args.quarantine_path, "--quarantine-path", "quarantine")
        if getattr(args, "watermark", None) == "per-topic":
            parser.error("quarantine reads all topics as one: use another --watermark")
    if getattr(args, "panes", None) == "timer" and args.available_now:
        parser.error("panes closed by a timer have no end: leave out --available-now")
    if getattr(args, "watermark", None) == "per-topic":
        need(args.in_topic, "--in-topic", "a watermark per topic")
    if getattr(args, "watermark", None) == "per-partition":
        if args.partitions:
            need(args.in_topic, "--in-topic", "a number of partitions")
        if args.fail_on_late:
            parser.error("a watermark per partition keeps late rows: leave out --fail-on-late")
    elif getattr(args, "partitions", None) or getattr(args, "idle", None):
        parser.error("--partitions and --idle need --watermark per-partition")


def _messages(spark: SparkSession, args: argparse.Namespace, topics: Sequence[str]) -> DataFrame:
    partitions = getattr(args, "watermark", None) == "per-partition"
    if args.source == "files":
        limit = {"maxFilesPerTrigger": args.max_files_per_trigger} if args.max_files_per_trigger else {}
        lines = message_lines(spark, args.in_path, partitions=partitions, **limit)
        return lines.filter(F.col("topic").isin(*topics)) if topics else lines
    source = KafkaSource(
        args.bootstrap_servers,
        tuple(topics),
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
    )
    return read_kafka(spark, source, partitions=partitions)


def _delay(args: argparse.Namespace) -> timedelta:
    least = SESSION_DELAY if args.job == "rain-runs" else NO_DELAY
    if args.delay is not None:
        return max(least, timedelta(seconds=args.delay))
    return DEFAULT_DELAY


def _windowed(
    spark: SparkSession, args: argparse.Namespace, rules: dict, records: DataFrame | None
) -> DataFrame:
    groups = [[t] for t in args.in_topic] if args.watermark == "per-topic" else [args.in_topic]
    inputs = [records] if records is not None else [_messages(spark, args, g) for g in groups]
    sources = [timed_readings(messages, delay=None, **rules) for messages in inputs]
    windows, line = WINDOWED[args.job]
    return windows(watermark_per_source(sources, _delay(args))).select("topic", line().alias("value"))


def _records(args: argparse.Namespace, lines: DataFrame) -> DataFrame:
    """One station needs no key; of several, each record names its own."""
    return to_value_messages(lines) if len(args.in_topic) == 1 else to_topic_messages(lines)


def _start_sink(args: argparse.Namespace, rows: DataFrame) -> StreamingQuery:
    how = {"trigger": args.trigger, "available_now": args.available_now}
    checkpoint = f"{args.checkpoint}/output"
    if args.sink == "files":
        return start_file_sink(rows, args.out_path, checkpoint, **how)
    records = rows if args.job == "passthrough" else _records(args, rows)
    return start_kafka_sink(records, args.bootstrap_servers, args.out_topic, checkpoint, **how)


def _write_batch(args: argparse.Namespace, lines: DataFrame, number: int) -> None:
    """The lines of a micro-batch. Files are overwritten if it is run again."""
    if args.sink == "files":
        write_numbered(lines, args.out_path, number)
    else:
        _records(args, lines).write.format("kafka").option(
            "kafka.bootstrap.servers", args.bootstrap_servers
        ).option("topic", args.out_topic).save()


def _start_stretches(args: argparse.Namespace, messages: DataFrame, rules: dict) -> StreamingQuery:
    readings = timed_readings(messages, delay=None, carry=PARTITION, **rules)
    line = WINDOWED[args.job][1]

    def write(windows: DataFrame, number: int) -> None:
        _write_batch(args, windows.select("topic", line().alias("value")), number)

    return start_stretch_job(
        STRETCHES[args.job], readings, write, f"{args.checkpoint}/stretches",
        expected=[(t, i) for t in args.in_topic for i in range(args.partitions or 0)],
        delay=timedelta(seconds=args.delay or 0), idle=timedelta(seconds=args.idle) if args.idle else None,
        trigger=args.trigger, available_now=args.available_now,
    )


def _start_refreshing(args: argparse.Namespace, readings: DataFrame) -> StreamingQuery:
    if args.panes == "timer":
        panes = timer_pane_means(readings, "reading", key="topic")
        return _start_sink(args, refreshing_mean_lines(panes.withColumnRenamed("pane_key", "topic")))

    def write(means: DataFrame, number: int) -> None:
        _write_batch(args, refreshing_mean_lines(means), number)

    return start_pane_means(
        readings,
        "reading",
        write,
        f"{args.checkpoint}/output",
        keys=("topic",),
        trigger=args.trigger or "1 second",
        available_now=args.available_now,
    )


def _clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Each file into a folder of its name, or of its path below what all inputs share."""
    how = {"encoding": args.encoding, "root": common_root(args.in_path)}
    if not args.checkpoint:
        raw = read_raw_observations(spark, args.in_path, **how)
        write_tsv(clean_observations(raw, keep_file=True), args.out_path, folders=FILE)
        return
    raw = read_raw_observations(spark, args.in_path[0], stream=True, **how)
    start_tsv_sink(
        clean_observations(raw, keep_file=True), args.out_path, args.checkpoint, folders=FILE,
        trigger=args.trigger, available_now=not args.trigger,
    ).awaitTermination()


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start the queries of a streaming job."""
    rules = {
        name: getattr(args, name)
        for name in ("on_malformed", "on_missing", "on_unknown")
        if hasattr(args, name)
    }
    queries, messages = [], None
    how = {"trigger": args.trigger, "available_now": args.available_now}
    if rules.get("on_malformed") == "quarantine":
        # The source is read and parsed once; both kinds of records go on from there.
        carry = PARTITION if getattr(args, "watermark", None) == "per-partition" else PARTITION[:1]
        parsed = parse_weather(
            _messages(spark, args, args.in_topic), timed=args.job not in STATELESS, carry=carry, **rules
        )
        folder = f"{args.checkpoint}/records"
        queries.append(start_split(parsed, folder, f"{args.checkpoint}/split", **how))
        if args.available_now:
            queries[0].awaitTermination()
        messages = accepted_stream(spark, folder, parsed.schema)
        bad = rejected_stream(spark, folder, parsed.schema, "topic")
        queries.append(start_file_sink(bad, args.quarantine_path, f"{args.checkpoint}/quarantine", **how))
    if args.job in WINDOWED and args.watermark != "per-partition":
        queries.append(_start_sink(args, _windowed(spark, args, rules, messages)))
        return queries
    if messages is None:
        messages = _messages(spark, args, args.in_topic)
    if args.job in STATELESS:
        queries.append(_start_sink(args, STATELESS[args.job](messages, rules)))
    elif args.job in WINDOWED:
        queries.append(_start_stretches(args, messages, rules))
    else:
        queries.append(_start_refreshing(args, temperatures(messages, **rules)))
    return queries


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job in STREAM_JOBS:
        _check(parser, args)
    if args.job == "clean" and args.checkpoint and len(args.in_path) > 1:
        parser.error("cleaning with a checkpoint takes one path: a folder or a pattern")
    spark = spark or build_session(f"tidemill {args.job}")
    if args.job == "clean":
        _clean(spark, args)
    elif args.job == "load":
        write_parquet(read_weather_tsv(spark, args.in_path), args.out_path)
    else:
        # All queries of a job stand or fall together.
        queries = start(spark, args)
        late = [LateRows(q, fail=getattr(args, "fail_on_late", False)) for q in queries]
        try:
            # Without --available-now the first query to end, ends the job.
            enough = all if args.available_now else any
            while not enough([query.awaitTermination(1) for query in queries]):
                for rows in late:
                    rows.update()
            for rows in late:
                rows.update()
        finally:
            for query in queries:
                query.stop()
