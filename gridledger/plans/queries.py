"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import operators as op
from .. import schemas
from ..functions.artefacts import new_path
from ..sources import generators, per_key, read_window, sinks, text, write_keyed, write_points
from .fixtures import fixture, generator_ids, record_lines

Query = Callable[[SparkSession, str], DataFrame]

# Parameters fitted to the size of the given tables; all others are the operators' defaults.
COUNTRY_HI, COUNTRY_LO = 180, 105
QUERY_WINDOW = (2000, 1000, 6000, 7000)
OUTLIER_R, OUTLIER_K = 50, 3
WIDE_R, WIDE_K = 400, 150


def _on(function: Callable[..., DataFrame], *names: str, **options: object) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(*[fixture(spark, sf_dir, name) for name in names], **options)

    return query


def _generated(function: Callable[..., DataFrame], name: str) -> Query:
    return lambda spark, sf_dir: function(generator_ids(spark, sf_dir, name))


def _parsed(name: str, schema: StructType) -> Query:
    return lambda spark, sf_dir: text.parse_records(record_lines(spark, sf_dir, name), schema)


def _split(kind: str) -> Query:
    """One kind of record out of lines of customers and transactions mixed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = record_lines(spark, sf_dir, "customers").unionByName(record_lines(spark, sf_dir, "transactions"))
        return text.split_records(lines, {"customers": schemas.CUSTOMERS, "transactions": schemas.TRANSACTIONS})[kind]

    return query


def _written_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "points-in-order")
    write_points(fixture(spark, sf_dir, "points"), path)
    return read_window(spark, path, QUERY_WINDOW)


def _keyed(function: Callable[..., DataFrame], **options: object) -> Query:
    """A report by customer from both tables written by customer ID."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_path(spark, "by-customer")
        customers, transactions = (fixture(spark, sf_dir, name) for name in ("customers", "transactions"))
        write_keyed({"customers": (customers, "ID"), "transactions": (transactions, "CustID")}, path, **options)
        return per_key(spark, path, function, "customers", "transactions")

    return query


def _then(query: Query, function: Callable[..., DataFrame], **options: object) -> Query:
    return lambda spark, sf_dir: function(query(spark, sf_dir), **options)


def build_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "customer_txn_summary": _on(op.customer_txn_summary, "customers", "transactions"),
        "country_txn_report": _on(op.country_txn_report, "customers", "transactions"),
        "age_gender_spend": _on(op.age_gender_spend, "customers", "transactions"),
        "age_gender_spend_cols": _on(
            op.age_gender_spend, "customers", "transactions", combined_key=False
        ),
        "least_active_customers": _on(op.least_active_customers, "customers", "transactions"),
        "country_size_outliers": _on(
            op.country_size_outliers, "customers", hi=COUNTRY_HI, lo=COUNTRY_LO
        ),
        "spatial_join": _on(op.spatial_join, "points", "rectangles"),
        "spatial_join_window": _on(op.spatial_join, "points", "rectangles", window=QUERY_WINDOW),
        "distance_outliers": _on(op.distance_outliers, "points", r=OUTLIER_R, k=OUTLIER_K),
        "kmeans": _on(op.kmeans, "points", "seeds"),
        "kmeans_history": _on(op.kmeans, "points", "seeds", history=True),
        "high_value_txns": _on(op.filter_min_total, "transactions", min_total=200),
        "items_spend_stats": _on(op.items_spend_stats, "transactions", min_total=200),
        "customer_counts_200": _on(
            op.customer_txn_counts, "transactions", min_total=200, count_name="transaction_count_T3"
        ),
        "very_high_value_txns": _on(op.filter_min_total, "transactions", min_total=600),
        "customer_counts_600": _on(
            op.customer_txn_counts, "transactions", min_total=600, count_name="transaction_count_T5"
        ),
        "rare_big_spenders": _on(op.rare_big_spenders, "transactions"),
        "grid_cell_counts": _on(op.grid_cell_counts, "points"),
        "relative_density": _on(op.relative_density, "points"),
        "gen_customers": _generated(generators.customers_from_ids, "gen_customers"),
        "gen_transactions": _generated(generators.transactions_from_ids, "gen_transactions"),
        "gen_points": _generated(generators.points_from_ids, "gen_points"),
        "gen_rectangles": _generated(generators.rectangles_from_ids, "gen_rectangles"),
        "gen_seeds": _generated(generators.seeds_from_ids, "gen_seeds"),
    }
    # Where tables are small the plans meant for large ones are not taken by themselves.
    named |= {
        "country_txn_report_shuffled": _on(
            op.country_txn_report, "customers", "transactions", broadcast_bytes=0
        ),
        "age_gender_spend_shuffled": _on(
            op.age_gender_spend, "customers", "transactions", broadcast_bytes=0
        ),
        "spatial_join_shuffled": _on(op.spatial_join, "points", "rectangles", broadcast_bytes=0),
        "spatial_join_mixed": _on(op.spatial_join, "points", "mixed_rectangles"),
        "spatial_join_mixed_shuffled": _on(
            op.spatial_join, "points", "mixed_rectangles", broadcast_bytes=0
        ),
        "distance_outliers_wide": _on(op.distance_outliers, "points", r=WIDE_R, k=WIDE_K),
        "distance_outliers_crowded": _on(
            op.distance_outliers, "points", r=WIDE_R, k=WIDE_K, crowd=0
        ),
        "distance_outliers_rare": _on(
            op.distance_outliers, "piled_points", r=OUTLIER_R, k=OUTLIER_K
        ),
        "neighbour_counts": _on(op.neighbour_counts, "points", r=OUTLIER_R),
        "neighbour_counts_wide": _on(op.neighbour_counts, "points", r=WIDE_R, pairs=256),
        "neighbour_counts_piled": _on(op.neighbour_counts, "piled_points", r=OUTLIER_R),
        "assigned_points": _on(op.assign_centres, "points", "seeds"),
        "assigned_points_many": _on(op.assign_centres, "points", "many_seeds", literal_centres=0),
        "kmeans_reusing_cells": _on(op.kmeans, "points", "seeds", reuse_points=0),
        "kmeans_many": _on(op.kmeans, "points", "many_seeds"),
        "kmeans_many_by_cells": _on(op.kmeans, "points", "many_seeds", literal_centres=0),
        "text_customers": _parsed("customers", schemas.CUSTOMERS),
        "text_transactions": _parsed("transactions", schemas.TRANSACTIONS),
    }
    named |= {f"split_{kind}": _split(kind) for kind in ("customers", "transactions", text.BAD)}
    named["customer_txn_summary_keyed"] = _keyed(op.customer_txn_summary)
    # Every customer with more than one in 400 rows counts as hot.
    named["customer_txn_summary_keyed_hot"] = _keyed(op.customer_txn_summary, hot_share=400)
    named["window_of_written_points"] = _written_window
    density = named["relative_density"]
    named["cell_ranks"] = _then(density, op.rank_cells)
    named["top_dense_cells"] = _then(density, op.top_dense_cells)
    named["top_dense_neighbors"] = _then(density, op.top_dense_neighbors)

    # The report lines the text sinks write.
    for name, lines in {
        "customer_txn_summary": sinks.customer_txn_summary_lines,
        "country_txn_report": sinks.country_txn_report_lines,
        "age_gender_spend": sinks.age_gender_spend_lines,
        "spatial_join": sinks.spatial_join_lines,
        "distance_outliers": sinks.distance_outliers_lines,
        "kmeans": sinks.kmeans_lines,
    }.items():
        named[f"{name}_lines"] = _then(named[name], lines)
    return named
