"""Filters and per-key reports over one transactions table.

Every report is a single pass with map-side partial aggregation, so a customer or item count that
holds a large share of all rows shrinks to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import MONEY_DIGITS, money_aggregates, money_total


def filter_min_total(transactions: DataFrame, min_total: float) -> DataFrame:
    """Transactions whose total is at least ``min_total``."""
    return transactions.where(f"TransTotal >= {float(min_total)}D")


def items_spend_stats(
    transactions: DataFrame, min_total: float = 200, money_digits: int | None = MONEY_DIGITS
) -> DataFrame:
    """Sum, average, minimum and maximum total for each number of items, from ``min_total`` up.

    Sums are exact, whatever the order of rows, for amounts of up to ``money_digits`` decimals; where a
    group has others, or with None, the doubles are added up as they are.
    """
    total = money_total(money_aggregates("TransTotal", money_digits), money_digits)
    return (
        filter_min_total(transactions, min_total)
        .groupBy(F.expr("TransNumItems as transNumItems"))
        .agg(
            F.expr(f"{total} as sum_transTotal"),
            F.expr(f"({total}) / count(TransTotal) as avg_transTotal"),
            F.expr("min(TransTotal) as min_transTotal"),
            F.expr("max(TransTotal) as max_transTotal"),
        )
    )


def customer_txn_counts(
    transactions: DataFrame, min_total: float, count_name: str = "transaction_count"
) -> DataFrame:
    """Number of transactions of at least ``min_total`` for each customer having one."""
    return (
        filter_min_total(transactions, min_total)
        .groupBy(F.expr("CustID as customerId"))
        .agg(F.expr(f"count(TransID) as {count_name}"))
    )


def rare_big_spenders(
    transactions: DataFrame, lo: float = 200, hi: float = 600, ratio: int = 5
) -> DataFrame:
    """Customers with some totals >= ``hi``, but fewer than 1/``ratio`` of those >= ``lo``.

    The two counts come from one conditional aggregate: one scan and one shuffle instead of two
    of each and a join.
    """
    return rare_of_counts(customer_count_pair(transactions.where("CustID is not null"), lo, hi), ratio)


def customer_count_pair(transactions: DataFrame, lo: float = 200, hi: float = 600) -> DataFrame:
    """For each customer the transactions of at least ``lo`` (transaction_count_T3) and of at least ``hi``
    (transaction_count_T5), and how many rows of either kind there are (lo_rows, hi_rows)."""
    least, most = f"TransTotal >= {float(lo)}D", f"TransTotal >= {float(hi)}D"
    return (
        filter_min_total(transactions, min(lo, hi))
        .groupBy(F.expr("CustID as customerId"))
        .agg(
            F.expr(f"count(if({most}, TransID, null)) as transaction_count_T5"),
            F.expr(f"count(if({least}, TransID, null)) as transaction_count_T3"),
            F.expr(f"count_if({least}) as lo_rows"),
            F.expr(f"count_if({most}) as hi_rows"),
        )
    )


def rare_of_counts(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """``rare_big_spenders`` from what ``customer_count_pair`` gives."""
    return counts.where(
        f"customerId is not null and hi_rows > 0 and transaction_count_T5 * {int(ratio)} < transaction_count_T3"
    ).drop("lo_rows", "hi_rows")
