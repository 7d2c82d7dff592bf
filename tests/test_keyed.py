"""Tables written by a common key: equal rows, no shuffle, hot keys and missing keys beside the buckets."""

from __future__ import annotations

import pytest

from gridledger import schemas
from gridledger.functions.artefacts import artefacts
from gridledger.operators import customer_txn_summary
from gridledger.sources import per_key, read_keyed, write_keyed


def people(spark, n: int = 300):
    return spark.range(-5, n).selectExpr(
        "if(id < 0, null, id) as ID", "concat('n', id) as Name", "30 as Age", "'male' as Gender", "1 as CountryCode",
        "cast(id as double) as Salary",
    )


def payments(spark, n: int = 3000):
    # Every third one is customer 7's, every tenth nobody's.
    customer = "case when id % 10 = 1 then null when id % 3 = 0 then 7 else id % 400 end"
    return spark.range(n).selectExpr(
        "id as TransID", f"{customer} as CustID", "cast(id % 50 as double) as TransTotal",
        "cast(1 + id % 9 as int) as TransNumItems", "'d' as TransDesc",
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def written(spark, folder, customers, transactions, **options):
    path = f"{folder}/by-customer"
    write_keyed({"customers": (customers, "ID"), "transactions": (transactions, "CustID")}, path, **options)
    return path


def test_summary_equals_that_of_plain_tables(spark):
    customers, transactions = people(spark), payments(spark)
    want = rows_of(customer_txn_summary(customers, transactions))
    with artefacts(spark) as folder:
        for i, hot_share in enumerate((2, 10, 1 << 16)):
            path = written(spark, f"{folder}/{i}", customers, transactions, buckets=5, hot_share=hot_share)
            assert rows_of(per_key(spark, path, customer_txn_summary, "customers", "transactions")) == want


def test_rows_in_buckets_move_through_no_shuffle(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    with artefacts(spark) as folder:
        path = written(spark, folder, people(spark), payments(spark), buckets=5)
        tables = read_keyed(spark, path)
        for key in keys:
            spark.conf.set(key, "-1")
        summary = customer_txn_summary(tables["customers"][0], tables["transactions"][0])
        summary.collect()
        plan = summary._jdf.queryExecution().executedPlan().toString()
        for key in keys:
            spark.conf.unset(key)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 5 out of 5" in plan


def test_hot_and_missing_keys_lie_beside_the_buckets(spark):
    transactions = payments(spark)
    with artefacts(spark) as folder:
        path = written(spark, folder, people(spark), transactions, buckets=5, hot_share=10)
        tables = read_keyed(spark, path)
        assert {r[0] for r in tables["transactions"][1].select("CustID").collect()} == {7, None}
        # Hot among transactions, so beside the buckets among customers too.
        assert {r[0] for r in tables["customers"][1].select("ID").collect()} == {7, None}
        for name, rows in (("transactions", transactions), ("customers", people(spark))):
            both = tables[name][0].unionByName(tables[name][1])
            assert sorted(map(str, both.collect())) == sorted(map(str, rows.collect()))


def test_another_session_finds_the_buckets(spark):
    with artefacts(spark) as folder:
        path = written(spark, folder, people(spark), payments(spark), buckets=3)
        want = rows_of(per_key(spark, path, customer_txn_summary, "customers", "transactions"))
        for table in spark.catalog.listTables():
            if table.name.startswith("gridledger_"):
                spark.sql(f"drop table {table.name}")
        tables = read_keyed(spark, path)
        assert "SelectedBucketsCount: 3 out of 3" in tables["customers"][0].groupBy("ID").count()._jdf.queryExecution().toString()
        assert rows_of(per_key(spark, path, customer_txn_summary, "customers", "transactions")) == want


def test_empty_tables(spark):
    empty = [spark.createDataFrame([], schema) for schema in (schemas.CUSTOMERS, schemas.TRANSACTIONS)]
    with artefacts(spark) as folder:
        path = written(spark, folder, *empty, buckets=2)
        assert per_key(spark, path, customer_txn_summary, "customers", "transactions").count() == 0


def test_bad_arguments(spark):
    ids = spark.range(3)
    with artefacts(spark) as folder:
        with pytest.raises(ValueError):
            write_keyed({}, f"{folder}/a")
        with pytest.raises(ValueError):
            write_keyed({"a": (ids, "id"), "b": (ids.selectExpr("cast(id as int) as id"), "id")}, f"{folder}/b")
        with pytest.raises(ValueError):
            write_keyed({"a": (ids, "id")}, f"{folder}/c", buckets=0)
        write_keyed({"a": (ids, "id")}, f"{folder}/d", buckets=2)
        with pytest.raises(ValueError):
            per_key(spark, f"{folder}/d", lambda a, b: a, "a", "b")
