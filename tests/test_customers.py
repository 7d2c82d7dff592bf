from __future__ import annotations

import pytest

from gridledger import schemas
from gridledger.functions import age_band
from gridledger.operators import (
    age_gender_spend,
    country_size_outliers,
    country_txn_report,
    customer_txn_summary,
    least_active_customers,
)

CUSTOMERS = [
    (1, "ann", 10, "female", 1, 100.0),
    (2, "bob", 19, "male", 1, 200.0),
    (3, "cid", 20, "male", 2, 300.0),
    (4, "dot", 70, "female", 3, 400.0),
]
TRANSACTIONS = [
    (1, 1, 10.1, 3, "a"),
    (2, 1, 10.2, 1, "b"),
    (3, 2, 99.9, 2, "c"),
    (4, 3, 1000.0, 5, "d"),
    (5, 9, 1.0, 7, "no such customer"),
]


@pytest.fixture()
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)


@pytest.fixture()
def transactions(spark):
    return spark.createDataFrame(TRANSACTIONS, schemas.TRANSACTIONS)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_summary_keeps_both_sides(customers, transactions):
    assert rows(customer_txn_summary(customers, transactions)) == [
        (1, "ann", 100.0, 2, 20.3, 1),
        (2, "bob", 200.0, 1, 99.9, 2),
        (3, "cid", 300.0, 1, 1000.0, 5),
        (4, "dot", 400.0, 0, 0.0, 0),
        (9, "", 0.0, 1, 1.0, 7),
    ]


def test_summary_counts_once_for_a_repeated_customer(spark, customers, transactions):
    again = spark.createDataFrame([(1, "zoe", 10, "female", 1, 5.0)], schemas.CUSTOMERS)
    got = {r[0]: r for r in rows(customer_txn_summary(customers.union(again), transactions))}
    assert got[1] == (1, "zoe", 5.0, 2, 20.3, 1)
    assert len(got) == 5


def test_summary_leaves_out_rows_without_id(spark, customers, transactions):
    nobody = spark.createDataFrame([(None, "x", 10, "male", 1, 5.0)], schemas.CUSTOMERS)
    lost = spark.createDataFrame([(8, None, 5.0, 1, "x")], schemas.TRANSACTIONS)
    got = customer_txn_summary(customers.union(nobody), transactions.union(lost))
    assert [r[0] for r in rows(got)] == [1, 2, 3, 4, 9]


def test_summary_total_is_exact_and_raw_doubles_can_be_asked_for(spark, customers):
    many = spark.createDataFrame([(i, 1, 0.1, 1, "") for i in range(1000)], schemas.TRANSACTIONS)
    exact = {r[0]: r[4] for r in rows(customer_txn_summary(customers, many))}
    raw = {r[0]: r[4] for r in rows(customer_txn_summary(customers, many, money_digits=None))}
    assert exact[1] == 100.0
    assert raw[1] == pytest.approx(100.0)
    fine = spark.createDataFrame([(1, 1, 0.125, 1, ""), (2, 1, 0.125, 1, "")], schemas.TRANSACTIONS)
    assert {r[0]: r[4] for r in rows(customer_txn_summary(customers, fine, None))}[1] == 0.25


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_country_report(customers, transactions, limit):
    assert rows(country_txn_report(customers, transactions, limit)) == [
        (1, 2, 10.1, 99.9),
        (2, 1, 1000.0, 1000.0),
        (3, 1, 0.0, 0.0),
    ]


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_country_report_with_repeated_customer_and_negative_totals(spark, limit):
    customers = spark.createDataFrame(
        [(1, "a", 20, "male", 1, 1.0), (1, "a", 20, "male", 2, 1.0)], schemas.CUSTOMERS
    )
    transactions = spark.createDataFrame([(1, 1, -5.0, 1, ""), (2, 1, -7.0, 1, "")], schemas.TRANSACTIONS)
    assert rows(country_txn_report(customers, transactions, limit)) == [
        (1, 1, 0.0, 0.0),
        (2, 1, -7.0, -5.0),
    ]


@pytest.mark.parametrize(
    ("age", "label"),
    [
        (9, "UNKNOWN"),
        (10, "[10,20)"),
        (19, "[10,20)"),
        (20, "[20,30)"),
        (59, "[50,60)"),
        (60, "[60,70]"),
        (70, "[60,70]"),
        (71, "UNKNOWN"),
        (None, None),
    ],
)
def test_age_bands(spark, age, label):
    frame = spark.createDataFrame([(age,)], "age int")
    assert frame.selectExpr(age_band("age")).first()[0] == label


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_age_gender_forms(customers, transactions, limit):
    assert rows(age_gender_spend(customers, transactions, broadcast_bytes=limit)) == [
        ("[10,20) female", 10.1, 10.2, 10.15),
        ("[10,20) male", 99.9, 99.9, 99.9),
        ("[20,30) male", 1000.0, 1000.0, 1000.0),
    ]
    split = age_gender_spend(customers, transactions, combined_key=False, broadcast_bytes=limit)
    assert ("[10,20)", "female", 10.1, 10.2, 10.15) in rows(split)


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_age_gender_with_repeated_customer(spark, customers, transactions, limit):
    again = spark.createDataFrame([(1, "ann", 80, "female", 1, 1.0)], schemas.CUSTOMERS)
    twice = customers.union(again)
    combined = rows(age_gender_spend(twice, transactions, broadcast_bytes=limit))
    assert [r[0] for r in combined] == ["Unknown female", "[10,20) male", "[20,30) male"]
    split = rows(age_gender_spend(twice, transactions, combined_key=False, broadcast_bytes=limit))
    assert [r[:2] for r in split] == [
        ("UNKNOWN", "female"),
        ("[10,20)", "female"),
        ("[10,20)", "male"),
        ("[20,30)", "male"),
    ]


def test_least_active_keeps_ties_and_lets_orphans_lower_the_minimum(spark, customers, transactions):
    assert rows(least_active_customers(customers, transactions)) == [("bob", 1), ("cid", 1)]
    more = spark.createDataFrame(
        [(i, c, 5.0, 1, "") for i, c in enumerate([1, 2, 3])], schemas.TRANSACTIONS
    )
    assert rows(least_active_customers(customers, transactions.union(more))) == []


def test_country_sizes(customers):
    assert rows(country_size_outliers(customers, hi=1, lo=1)) == [(1, 2)]
    assert rows(country_size_outliers(customers, hi=5, lo=2)) == [(2, 1), (3, 1)]
    assert len(rows(country_size_outliers(customers))) == 3


def test_a_customer_with_most_transactions_gives_the_same_on_both_routes(spark, customers):
    hot = spark.range(0, 30_000, numPartitions=6).selectExpr(
        "cast(id as int) as TransID",
        "cast(if(id % 3 = 0, 1, 1 + id % 4) as int) as CustID",
        "cast(1000 + id % 777 as double) / 100 as TransTotal",
        "1 as TransNumItems",
        "'' as TransDesc",
    )
    for report in (
        lambda limit: country_txn_report(customers, hot, limit),
        lambda limit: age_gender_spend(customers, hot, False, broadcast_bytes=limit),
    ):
        assert rows(report(0)) == rows(report(1 << 20))


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
@pytest.mark.parametrize(
    ("amounts", "total"),
    [
        ([0.004] * 1000, 4.0),
        ([0.125, 0.00001], 0.12501),
        ([1e18, 1e18, 0.5], 2e18),
        ([9e9] * 3, 27e9),
        ([None, 2.5], 2.5),
        ([float("inf"), 1.0], float("inf")),
    ],
)
def test_totals_are_those_of_the_doubles(spark, customers, limit, amounts, total):
    many = spark.createDataFrame([(i, 1, a, 1, "") for i, a in enumerate(amounts)], schemas.TRANSACTIONS)
    summary = {r[0]: r[4] for r in rows(customer_txn_summary(customers, many))}
    assert summary[1] == pytest.approx(total)
    n = sum(a is not None for a in amounts)
    for combined in (True, False):
        report = age_gender_spend(customers, many, combined_key=combined, broadcast_bytes=limit).collect()
        assert [r["AvgTransTotal"] for r in report] == pytest.approx([total / n])


def test_nan_and_overflow_give_the_plain_sum(spark, customers):
    import math

    odd = spark.createDataFrame([(1, 1, float("nan"), 1, ""), (2, 2, 5.0, 1, "")], schemas.TRANSACTIONS)
    got = {r[0]: r[4] for r in customer_txn_summary(customers, odd).collect()}
    assert math.isnan(got[1]) and got[2] == 5.0
    # Sums of units beyond a BIGINT: 10,000 times 9.9e9 at 4 decimals is 9.9e17, a hundred times that overflows.
    large = spark.range(1_000_000).selectExpr("id as TransID", "1L as CustID", "9.9e9D as TransTotal", "1 as TransNumItems", "'' as TransDesc")
    for limit in (0, 1 << 20):
        report = age_gender_spend(customers, large, broadcast_bytes=limit).collect()
        assert [r["AvgTransTotal"] for r in report] == pytest.approx([9.9e9])


@pytest.mark.parametrize("limit", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_unknown_age_and_gender_have_one_labelled_row(spark, transactions, limit):
    people = [(1, "a", None, "male", 1, 1.0), (2, "b", 5, "male", 1, 1.0), (3, "c", 20, None, 1, 1.0), (9, "d", None, None, 1, 1.0)]
    report = age_gender_spend(spark.createDataFrame(people, schemas.CUSTOMERS), transactions, broadcast_bytes=limit)
    assert [r[0] for r in rows(report)] == ["Unknown male", "Unknown unknown", "[20,30) unknown"]
    columns = age_gender_spend(spark.createDataFrame(people, schemas.CUSTOMERS), transactions, combined_key=False, broadcast_bytes=limit)
    assert columns.count() == 4
