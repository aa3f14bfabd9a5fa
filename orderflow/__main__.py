"""Command line: ``spark-submit`` or ``python -m orderflow <job> ...``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from orderflow.operators import audit, dimension, fraud, history, items, validate
from orderflow.plans import restaurant_reports as reports
from orderflow.sinks import streams as sinks
from orderflow.sinks import tables
from orderflow.sources import files, streams
from orderflow.streaming import jobs
from orderflow.streaming.monitor import ProgressLog

WINDOWS = {"documented": fraud.DOCUMENTED, "as-coded": fraud.AS_CODED}


def session() -> SparkSession:
    """Master, memory and connectors come from ``spark-submit``."""
    builder = SparkSession.builder.appName("orderflow")
    return builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def show(title: str, df: DataFrame, rows: int = 20) -> None:
    print(f"\n{title}")
    df.show(rows, truncate=False)


def report(title: str, df: DataFrame, output: str | None) -> None:
    """A report in full to a folder of its own, if there is one; its first rows on the console."""
    if output:
        path = f"{output.rstrip('/')}/{title.lower().replace(' ', '-')}"
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    show(title, df)


def run_history(spark: SparkSession, args: argparse.Namespace) -> None:
    """Seven reports over the order history."""
    orders = files.read_orders(spark, args.input, None) if args.infer else files.read_history(spark, args.input)
    if args.parquet:
        orders = tables.land(orders, args.parquet)
    print(f"lines that did not parse: {files.unparsed_lines(orders)}")
    if args.only_valid:
        # Items that are not of the type of an order's make it invalid.
        orders = orders if args.infer else orders.filter("item_values is null or items is not null")
        orders = validate.only_valid(orders)
    sold = items.resolve_items(orders, "items" if args.infer else "item_values")
    hours = history.hourly_pattern(orders, densify=args.all_hours)
    report("Most sold items", history.top_items(sold), args.output)
    report("Restaurants by revenue", history.top_revenue_restaurants(orders), args.output)
    report("Online and dine-in orders", history.channel_leaders(orders), args.output)
    report("Orders per hour", hours, args.output)
    report("Busiest and quietest hour", history.peak_hours(hours), args.output)
    report("Revenue per city", history.city_revenue(orders), args.output)
    report("Favourite items per city", history.regional_favorites(sold), args.output)


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    """Listing to locations, restaurants and metrics."""
    staging = tables.land(files.read_listing_ranges(spark, args.csv), f"{args.root}/staging/{args.run_id}")
    show("Audit", audit.load_audit(staging))
    result = tables.load_listing(staging, args.root, args.run_id, args.match)
    for table, rows in result.rows.items():
        print(f"{table}: {rows} new rows")


def run_reports(spark: SparkSession, args: argparse.Namespace) -> None:
    """Four reports over the loaded tables."""
    star = [tables.read_table(spark, args.root, t) for t in ("metrics", "restaurants", "locations")]
    report("Delivery restaurants", reports.delivery_summary(star[0]), args.output)
    report("Online ordering by city", reports.online_order_by_city(*star), args.output)
    top = reports.top_neighborhoods(*star, args.min_rating, args.min_restaurants)
    report("Top neighbourhoods", top, args.output)
    report("Price tiers", reports.pricing_tiers(*star), args.output)


def run_dimension(spark: SparkSession, args: argparse.Namespace) -> None:
    """Typed restaurant dimension as Parquet."""
    listing = files.read_listing_by_header(spark, args.csv)
    dimension.restaurant_dimension(listing).write.mode("overwrite").parquet(args.output)


def _messages(spark: SparkSession, args: argparse.Namespace, offsets: str) -> DataFrame:
    if args.servers:
        return streams.kafka_messages(spark, args.servers, args.source, offsets)
    # A validator that has not written yet cannot be told from an empty folder of texts: --routed says so.
    if hasattr(args, "routed") and (args.routed or streams.is_routed(spark, args.source)):
        return streams.valid_messages(spark, args.source, args.max_files)
    return streams.text_messages(spark, args.source, args.max_files)


def run_validate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Order messages to valid, error and malformed outputs."""
    spark.streams.addListener(ProgressLog())
    routed = jobs.route_orders(_messages(spark, args, "earliest"))
    if args.servers:
        output = jobs.to_topics(routed)
        writer = sinks.kafka_output(
            output, args.servers, args.checkpoint, available_now=args.available_now
        )
    else:
        writer = sinks.file_output(
            routed, args.target, args.checkpoint, "route", args.available_now
        )
    writer.start().awaitTermination()


def run_fraud(spark: SparkSession, args: argparse.Namespace) -> None:
    """Valid order messages to fraud alerts."""
    spark.streams.addListener(ProgressLog())
    spark.streams.resetTerminated()
    alerts = jobs.detect_fraud(_messages(spark, args, "latest"), WINDOWS[args.windows])
    if args.console and args.servers:
        sinks.console_output(fraud.alert_messages(alerts)).start()
    if args.servers:
        messages = fraud.alert_messages(alerts, args.with_window)
        writer = sinks.kafka_output(
            messages, args.servers, args.checkpoint, args.target, "update", args.available_now
        )
    elif args.console:
        shown = sinks.to_console(fraud.alert_messages)
        writer = sinks.update_outputs(alerts, args.target, args.checkpoint, shown, args.available_now)
    else:
        writer = sinks.update_output(alerts, args.target, args.checkpoint, args.available_now)
    writer.start()
    # Whichever query ends first ends the job, with its error if it failed.
    spark.streams.awaitAnyTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orderflow", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name, run):
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        return sub

    sub = command("history", run_history)
    sub.add_argument("input", help="order history, JSON lines")
    sub.add_argument("--infer", action="store_true", help="infer the schema")
    sub.add_argument("--parquet", help="convert the history once, to this folder")
    sub.add_argument("--only-valid", action="store_true", help="leave out orders that break a rule")
    sub.add_argument("--output", help="folder for the reports in full")
    sub.add_argument("--all-hours", action="store_true", help="show hours without orders")

    sub = command("load", run_load)
    sub.add_argument("csv")
    sub.add_argument("root", help="folder of the tables")
    sub.add_argument("run_id", help="name of this load")
    sub.add_argument("--match", choices=["venue", "exact"], default="venue")

    sub = command("reports", run_reports)
    sub.add_argument("root")
    sub.add_argument("--output", help="folder for the reports in full")
    sub.add_argument("--min-rating", default=reports.TOP_RATING)
    sub.add_argument("--min-restaurants", type=int, default=reports.TOP_MIN_RESTAURANTS)

    sub = command("dimension", run_dimension)
    sub.add_argument("csv")
    sub.add_argument("output")

    for name, run in (("validate", run_validate), ("fraud", run_fraud)):
        sub = command(name, run)
        sub.add_argument("source", help="folder of text files, or topic with --servers")
        sub.add_argument("target", help="output folder, or alert topic with --servers")
        sub.add_argument("checkpoint")
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--max-files", type=int, help="files per micro-batch")
        sub.add_argument("--available-now", action="store_true", help="stop at the input's end")
        if name == "fraud":
            sub.add_argument("--windows", choices=WINDOWS, default="documented")
            sub.add_argument("--with-window", action="store_true", help="send window bounds")
            sub.add_argument("--routed", action="store_true", help="source is the output of validate")
            sub.add_argument("--console", action="store_true", help="print the alerts as well")
    return top


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    args.run(session(), args)


if __name__ == "__main__":
    main()
