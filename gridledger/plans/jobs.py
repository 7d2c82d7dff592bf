"""Command line: read text inputs, run one operator, write its text report.

    spark-submit run_job.py spatial-join <points> <rectangles> <out> [x1 y1 x2 y2]

Inputs are headerless comma-separated files or folders. Outputs are folders of part files.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import operators as op
from ..functions.artefacts import artefacts
from ..session import build_session
from ..sources import generators, sinks, text

Job = Callable[[SparkSession, argparse.Namespace], None]


def _customer_report(
    function: Callable[..., DataFrame],
    lines: Callable[[DataFrame], DataFrame] | None,
    keys: tuple[str, ...],
    malformed: str,
    **options: object,
) -> Job:
    def job(spark: SparkSession, args: argparse.Namespace) -> None:
        report = function(
            text.read_customers(spark, args.customers, malformed),
            text.read_transactions(spark, args.transactions, malformed),
            **options,
        )
        _write(report, lines, keys, args)

    return job


def _write(
    report: DataFrame, lines: Callable[[DataFrame], DataFrame] | None, keys: tuple[str, ...], args: argparse.Namespace
) -> None:
    if args.ordered:
        report = sinks.in_key_order(report, *keys)
    if lines is None:
        sinks.write_csv(report, args.out)
    else:
        sinks.write_lines(lines(report), args.out)


def _mixed_summary(spark: SparkSession, args: argparse.Namespace) -> None:
    with artefacts(spark):
        customers, transactions, _ = text.split_mixed(spark, args.records)
        summary = op.customer_txn_summary(customers, transactions)
        _write(summary, sinks.customer_txn_summary_lines, ("ID",), args)


def _country_size(spark: SparkSession, args: argparse.Namespace) -> None:
    customers = text.read_customers(spark, args.customers, "null")
    _write(op.country_size_outliers(customers, args.hi, args.lo), None, ("CountryCode",), args)


def _spatial_join(spark: SparkSession, args: argparse.Namespace) -> None:
    if len(args.window) not in (0, 4):
        raise SystemExit("the window takes four numbers: x1 y1 x2 y2")
    matches = op.spatial_join(
        text.read_points(spark, args.points, "drop"),
        text.read_rectangles(spark, args.rectangles, "drop"),
        window=tuple(args.window) or None,
    )
    sinks.write_lines(sinks.spatial_join_lines(matches), args.out)


def _distance_outliers(spark: SparkSession, args: argparse.Namespace) -> None:
    outliers = op.distance_outliers(text.read_points(spark, args.points, "drop"), args.r, args.k)
    sinks.write_lines(sinks.distance_outliers_lines(outliers), args.out)


def _neighbours(spark: SparkSession, args: argparse.Namespace) -> None:
    with artefacts(spark):
        sinks.write_csv(op.neighbour_counts(text.read_points(spark, args.points, "drop"), args.r), args.out)


def _assign(spark: SparkSession, args: argparse.Namespace) -> None:
    points, centres = text.read_points(spark, args.points, "drop"), text.read_centres(spark, args.centres)
    with artefacts(spark):
        sinks.write_csv(op.assign_centres(points, centres), args.out)


def _kmeans(spark: SparkSession, args: argparse.Namespace) -> None:
    history = op.kmeans(
        text.read_points(spark, args.points, "drop"),
        text.read_centres(spark, args.seeds),
        max_iter=args.max_iter,
        history=True,
    )
    sinks.write_kmeans_rounds(history, args.out)


def _spending(spark: SparkSession, args: argparse.Namespace) -> None:
    transactions = text.read_transactions(spark, args.transactions, "drop")
    out = args.out.rstrip("/")
    sinks.write_csv(op.filter_min_total(transactions, 200), f"{out}/high_value_txns")
    sinks.write_csv(op.filter_min_total(transactions, 600), f"{out}/very_high_value_txns")
    sinks.write_csv(op.items_spend_stats(transactions, 200), f"{out}/items_spend_stats")
    # The three reports by customer come from one aggregate, a row for each customer.
    counts = op.customer_count_pair(transactions, 200, 600).persist()
    least, most = "customerId", "transaction_count_T5"
    sinks.write_csv(counts.where("lo_rows > 0").select(least, "transaction_count_T3"), f"{out}/customer_counts_200")
    sinks.write_csv(counts.where("hi_rows > 0").select(least, most), f"{out}/customer_counts_600")
    sinks.write_csv(op.rare_of_counts(counts), f"{out}/rare_big_spenders")
    counts.unpersist()


def _density(spark: SparkSession, args: argparse.Namespace) -> None:
    points = text.read_points(spark, args.points, "drop")
    # One row for each occupied cell, kept for both outputs so that points are read once.
    density = op.relative_density(points, args.cell, args.extent).persist()
    out = args.out.rstrip("/")
    sinks.write_csv(density.select("cell_id", "cell_count"), f"{out}/grid_cell_counts")
    sinks.write_csv(density, f"{out}/relative_density")
    with artefacts(spark):
        sinks.write_csv(op.rank_cells(density), f"{out}/cell_ranks")
    sinks.write_csv(op.top_dense_cells(density, args.k), f"{out}/top_dense_cells")
    sinks.write_csv(
        op.top_dense_neighbors(density, args.k, args.cell, args.extent), f"{out}/top_dense_neighbors"
    )
    density.unpersist()


def _generate(spark: SparkSession, args: argparse.Namespace) -> None:
    makers: dict[str, Callable[..., DataFrame]] = {
        "customers": generators.gen_customers,
        "transactions": generators.gen_transactions,
        "points": generators.gen_points,
        "rectangles": generators.gen_rectangles,
        "seeds": generators.gen_seeds,
    }
    rows = makers[args.dataset](spark, args.rows)
    if args.dataset == "seeds":
        # Read back by line number, so k rows go to one file in order.
        rows = rows.orderBy("idx").coalesce(1).select("x", "y")
    sinks.write_csv(rows, args.out)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run_job.py", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name: str, job: Job, *arguments: tuple[str, dict]) -> None:
        sub = jobs.add_parser(name)
        for argument, options in arguments:
            sub.add_argument(argument, **options)
        if name in ordered:
            sub.add_argument("--ordered", action="store_true", help="sort the report by its key")
        sub.set_defaults(run=job)

    ordered = {"customer-summary", "customer-summary-mixed", "country-report", "age-gender", "age-gender-columns", "least-active", "country-size"}

    path: dict = {}
    whole = {"type": int}
    both = (("customers", path), ("transactions", path), ("out", path))
    # The reports of the first kind leave out lines that do not fit; those of the second keep them, with nulls.
    add("customer-summary", _customer_report(op.customer_txn_summary, sinks.customer_txn_summary_lines, ("ID",), "drop"), *both)
    add("customer-summary-mixed", _mixed_summary, ("records", path), ("out", path))
    add("country-report", _customer_report(op.country_txn_report, sinks.country_txn_report_lines, ("CountryCode",), "drop"), *both)
    add("age-gender", _customer_report(op.age_gender_spend, sinks.age_gender_spend_lines, ("AgeGender",), "drop"), *both)
    by_column = _customer_report(op.age_gender_spend, None, ("AgeRange", "Gender"), "null", combined_key=False)
    add("age-gender-columns", by_column, *both)
    add("least-active", _customer_report(op.least_active_customers, None, ("Name",), "null"), *both)
    add(
        "country-size",
        _country_size,
        ("customers", path),
        ("out", path),
        ("--hi", {"type": int, "default": 5000}),
        ("--lo", {"type": int, "default": 2000}),
    )
    add(
        "spatial-join",
        _spatial_join,
        ("points", path),
        ("rectangles", path),
        ("out", path),
        ("window", {"type": int, "nargs": "*"}),
    )
    add("outliers", _distance_outliers, ("points", path), ("out", path), ("r", whole), ("k", whole))
    add("neighbours", _neighbours, ("points", path), ("out", path), ("r", whole))
    add("assign", _assign, ("points", path), ("centres", path), ("out", path))
    add(
        "kmeans",
        _kmeans,
        ("points", path),
        ("seeds", path),
        ("out", path),
        ("--max-iter", {"type": int, "default": 6}),
    )
    add("spending", _spending, ("transactions", path), ("out", path))
    add(
        "density",
        _density,
        ("points", path),
        ("out", path),
        ("--cell", {"type": int, "default": 20}),
        ("--extent", {"type": int, "default": 10000}),
        ("--k", {"type": int, "default": 50}),
    )
    add(
        "generate",
        _generate,
        ("dataset", {"choices": ["customers", "transactions", "points", "rectangles", "seeds"]}),
        ("rows", whole),
        ("out", path),
    )
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(build_session(f"gridledger {args.job}"), args)
