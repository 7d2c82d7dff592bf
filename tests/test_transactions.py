from __future__ import annotations

import pytest

from gridledger import schemas
from gridledger.operators import (
    customer_txn_counts,
    filter_min_total,
    items_spend_stats,
    rare_big_spenders,
)


@pytest.fixture()
def transactions(spark):
    data = [(i, 1, 250.0, 1, "") for i in range(5)] + [
        (10, 1, 600.0, 2, ""),
        (11, 2, 199.99, 2, ""),
        (12, 2, 200.0, 2, ""),
        (13, 3, 700.0, 3, ""),
        (None, 3, 300.0, 3, "no id"),
        (15, None, 900.0, 3, "no customer"),
    ]
    return spark.createDataFrame(data, schemas.TRANSACTIONS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def test_filter_is_inclusive(transactions):
    assert filter_min_total(transactions, 200).count() == 10
    assert {r.TransTotal for r in filter_min_total(transactions, 600).collect()} == {600.0, 700.0, 900.0}


def test_items_stats(transactions):
    assert rows(items_spend_stats(transactions)) == [
        (1, 1250.0, 250.0, 250.0, 250.0),
        (2, 800.0, 400.0, 200.0, 600.0),
        (3, 1900.0, 1900.0 / 3, 300.0, 900.0),
    ]


def test_counts_skip_null_ids_and_keep_the_null_customer(transactions):
    assert rows(customer_txn_counts(transactions, 200)) == [(None, 1), (1, 6), (2, 1), (3, 1)]


def test_rare_big_spenders_equals_the_join_of_counts(spark, transactions):
    def by_join(df, lo, hi, ratio):
        high = customer_txn_counts(df, hi, "transaction_count_T5")
        low = customer_txn_counts(df, lo, "transaction_count_T3")
        return high.join(low, "customerId").where(
            f"transaction_count_T5 * {ratio} < transaction_count_T3"
        )

    for lo, hi, ratio in [(200, 600, 5), (200, 600, 0), (200, 250, 5), (600, 200, 0)]:
        got = rows(rare_big_spenders(transactions, lo, hi, ratio))
        assert got == rows(by_join(transactions, lo, hi, ratio)), (lo, hi, ratio)
    assert rows(rare_big_spenders(transactions)) == [(1, 1, 6)]
