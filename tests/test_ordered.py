from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gridledger.functions.artefacts import artefacts, new_path, stored
from gridledger.functions.groups import join_groups
from gridledger.functions.ordered import running_totals, with_rank
from gridledger.operators import kmeans, rank_cells


def ranks(spark, df, descending=True):
    df.createOrReplaceTempView("to_rank")
    order = "desc" if descending else "asc"
    return spark.sql(f"select *, rank() over (order by v {order} nulls last) as rank from to_rank")


def same(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


@pytest.mark.parametrize("broadcast", [0, 1 << 20], ids=["shuffle", "broadcast"])
@pytest.mark.parametrize("parts", [1, 7])
def test_rank_equals_the_window(spark, parts, broadcast):
    rng = random.Random(parts)
    values = [rng.randint(-30, 30) / 4 for _ in range(500)] + [2.25] * 300 + [None] * 20
    values += [float("inf"), float("-inf"), float("nan"), float("nan"), 0.0, -0.0]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v double").repartition(5)
    for descending in (True, False):
        got = with_rank(df, "v", descending=descending, parts=parts, broadcast_bytes=broadcast)
        same(got, ranks(spark, df, descending))


def test_rank_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([], "id bigint, v double")
    assert with_rank(df, "v").collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None)], "id bigint, v double")
    assert {r["rank"] for r in with_rank(nulls, "v").collect()} == {1}


def test_rank_needs_no_single_task_window(spark):
    # A window without partitions is planned as an exchange to one partition.
    df = spark.range(3000).selectExpr("id as cell_id", "cast(id % 700 as double) as I_X")
    plan = rank_cells(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_running_totals_of_a_key_in_many_ranges(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}", i, rng.randrange(100)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at bigint, w bigint").withColumn("one", F.lit(1))
    got = running_totals(df.repartition(4), ["k"], [F.col("at")], {"nth": "one", "upto": "w"}, parts=6)
    want, seen = [], {}
    for k, at, w in sorted(rows, key=lambda r: r[1]):
        n, total = seen.get(k, (0, 0))
        seen[k] = (n + 1, total + w)
        want.append((k, at, w, *seen[k]))
    assert sorted(tuple(r) for r in got.drop("one").collect()) == sorted(want)


@pytest.mark.parametrize("broadcast", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_hot_and_other_groups(spark, broadcast):
    rows = spark.range(900).selectExpr("id", "if(id % 3 = 0, -1, id div 10) as g", "cast(null as int) as extra")
    rows = rows.unionByName(spark.createDataFrame([(9999, None, 1)], rows.schema))
    groups = stored(rows.where("g is not null").groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("least")), "groups")
    got = join_groups(rows, groups, ["g"], broadcast_bytes=broadcast, hot_share=9)
    want = rows.join(groups, "g")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.count() == 900


def listing(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(entry.getPath().getName()) for entry in files.listStatus(path)] if files.exists(path) else []


@pytest.fixture
def shared(tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    monkeypatch.setattr("gridledger.functions.artefacts.shared_folder", lambda spark: folder)
    return folder


def test_a_scope_leaves_nothing(spark, shared):
    with artefacts(spark) as folder:
        kept = stored(spark.range(10).selectExpr("id", "id * 2 as twice"), "ten", by=["id"])
        assert kept.where("id = 3").count() == 1 and len(listing(spark, folder)) == 1
        with artefacts(spark) as inner:
            stored(kept, "again")
            assert listing(spark, inner)
        assert not listing(spark, inner) and kept.count() == 10
    assert listing(spark, shared) == []
    with pytest.raises(ZeroDivisionError), artefacts(spark):
        stored(spark.range(3), "three")
        assert listing(spark, shared)
        1 / 0
    assert listing(spark, shared) == []


def test_rank_and_kmeans_leave_nothing(spark, shared):
    points = spark.range(300).selectExpr("cast(id % 17 as int) as x", "cast(id % 23 as int) as y")
    seeds = spark.range(9).selectExpr("cast(id as int) as idx", "cast(id as int) as x", "cast(2 * id as int) as y")
    with artefacts(spark):
        density = points.selectExpr("x as cell_id", "cast(y as double) as I_X")
        assert rank_cells(density).count() == 300
        assert kmeans(points, seeds, max_iter=2, literal_centres=3).count() <= 9
        assert listing(spark, shared)
    assert listing(spark, shared) == []
    assert kmeans(points, seeds, max_iter=2).count() <= 9
    assert listing(spark, shared) == []


def test_paths_differ(spark, shared):
    assert new_path(spark, "a") != new_path(spark, "a")
