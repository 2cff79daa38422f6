"""The flows as jobs: ``python -m tickloom <job> ...``, or the same through ``spark-submit``.

Catalogs and connector jars come with the Spark configuration of the submission.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from tickloom.config import (
    MAX_OFFSETS_PER_TRIGGER,
    SYMBOLS,
    TOPIC,
    WATERMARK_DELAY,
    WINDOW_WIDTH,
    WRITERS_PER_PARTITION,
    JdbcTarget,
    KafkaSink,
    KafkaSource,
    TradeFlow,
    parse_symbol_list,
)
from tickloom.plans import await_all, await_any, bootstrap, run_ingest, run_serving_flow, run_trade_flow
from tickloom.session import build_session
from tickloom.sources import read_wire_files, read_wire_stream


def parser() -> argparse.ArgumentParser:
    flow = argparse.ArgumentParser(add_help=False)
    flow.add_argument("--checkpoints", required=True, help="folder shared by all executors")
    flow.add_argument("--watermark", default=WATERMARK_DELAY)
    flow.add_argument("--window", default=WINDOW_WIDTH, help="width of the aggregate's windows")
    flow.add_argument("--copy-fanout", type=int, default=1, help="groups in which copies of one trade go first")
    flow.add_argument("--writers", type=int, default=WRITERS_PER_PARTITION, help="writer tasks per date and symbol")
    flow.add_argument("--once", action="store_true", help="process what is there, then stop")

    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--brokers")
    source.add_argument("--topic", default=TOPIC)
    source.add_argument("--starting-offsets", default="latest")
    source.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    source.add_argument("--min-partitions", type=int, help="more read tasks than the topic has partitions")
    source.add_argument("--fail-on-data-loss", action="store_true", help="stop when offsets have expired")
    source.add_argument("--files", help="folder of JSON-lines files instead of a topic")

    jobs = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    commands = jobs.add_subparsers(dest="job", required=True)

    tables = commands.add_parser("bootstrap", help="create the namespace and both tables")
    tables.add_argument("--namespace", required=True)
    tables.add_argument("--provider", default="iceberg")

    stream = commands.add_parser("stream", parents=[flow, source], help="trade stream to both tables")
    stream.add_argument("--raw", required=True, help="catalog table or path")
    stream.add_argument("--aggregated", required=True, help="catalog table or path")

    stream.add_argument("--rejected", help="catalog table or path for rejected rows")

    serve = commands.add_parser("serve", parents=[flow, source], help="trade stream to a serving database")
    serve.add_argument("--url", required=True, help="JDBC URL")
    serve.add_argument("--user", required=True)
    serve.add_argument("--connections", type=int, default=8, help="open connections at most")
    serve.add_argument("--password-variable", default="JDBC_PASSWORD", help="environment variable with the password")

    ingest = commands.add_parser("ingest", parents=[flow], help="vendor messages in files to a topic of trades")
    ingest.add_argument("--messages", required=True, help="folder of vendor messages, one per line")
    ingest.add_argument("--source", required=True, help="value of the source column")
    ingest.add_argument("--symbols", default=SYMBOLS)
    ingest.add_argument("--brokers", required=True)
    ingest.add_argument("--topic", default=TOPIC)
    ingest.add_argument("--rejects-topic", help="topic for dead letters")
    return jobs


def wire_source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return read_wire_files(spark, args.files)
    if not args.brokers:
        raise SystemExit("name a source: --brokers or --files")
    offsets = args.max_offsets if args.max_offsets > 0 else None
    source = KafkaSource(
        args.brokers,
        args.topic,
        args.starting_offsets,
        args.fail_on_data_loss,
        max_offsets_per_trigger=offsets,
        min_partitions=args.min_partitions,
    )
    return read_wire_stream(spark, source)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    started_here = SparkSession.getActiveSession() is None
    spark = build_session(f"tickloom-{args.job}")
    if args.job == "bootstrap":
        bootstrap(spark, args.namespace, args.provider)
        return
    trigger = {"availableNow": True} if args.once else None
    flow = TradeFlow(
        args.checkpoints,
        watermark_delay=args.watermark,
        window_width=args.window,
        copy_fanout=args.copy_fanout,
        writers_per_partition=args.writers,
        trigger=trigger,
    )
    if args.job == "stream":
        queries = run_trade_flow(wire_source(spark, args), args.raw, args.aggregated, flow, args.rejected)
    elif args.job == "serve":
        password = os.environ[args.password_variable]
        database = JdbcTarget(args.url, args.user, password, connections=args.connections)
        queries = run_serving_flow(wire_source(spark, args), database, flow)
    else:
        rejects = KafkaSink(args.brokers, args.rejects_topic) if args.rejects_topic else None
        messages = spark.readStream.text(args.messages)
        symbols = parse_symbol_list(args.symbols)
        queries = run_ingest(messages, args.source, KafkaSink(args.brokers, args.topic), flow, symbols, rejects)
    try:
        if args.once:
            await_all(queries)
        else:
            await_any(spark, queries)
    finally:
        if started_here:
            spark.stop()


if __name__ == "__main__":
    main()
