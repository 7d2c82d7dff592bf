from __future__ import annotations

import pytest

from gridledger import schemas
from gridledger.operators import kmeans
from gridledger.functions.artefacts import artefacts
from gridledger.sources import (
    gen_customers,
    gen_points,
    gen_rectangles,
    gen_seeds,
    gen_transactions,
    read_centres,
    read_customers,
    read_mixed,
    read_points,
    read_rectangles,
    read_transactions,
    read_window,
    sinks,
    split_mixed,
    write_points,
)
from gridledger.sources.text import tag_records

CUSTOMER_LINE = "1,ann,30,female,4,1234.50"
TRANSACTION_LINE = "7,1,99.90,3,some words"


def lines_of(path):
    return sorted(
        line for part in path.glob("part-*") for line in part.read_text().splitlines()
    )


def test_typed_reads(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CUSTOMER_LINE + "\nx,bob,old,male,2,1.0\n")
    path = str(tmp_path / "c.csv")
    kept = read_customers(spark, path)
    assert kept.schema == schemas.CUSTOMERS
    assert [tuple(r) for r in kept.collect()] == [
        (1, "ann", 30, "female", 4, 1234.5),
        (None, "bob", None, "male", 2, 1.0),
    ]
    assert [r.ID for r in read_customers(spark, path, "drop").collect()] == [1]


def test_dropped_lines_do_not_depend_on_the_columns(spark, tmp_path):
    from itertools import combinations

    good = [CUSTOMER_LINE, "5,eve,,male,2,1.0", "6,,30,,2,", " 7 ,x,30,male, 2 ,1e3"]
    bad = ["2,bob,old,male,2,1.0", "3,too,30,male,4,1.0,more", "4,few,30", "x,y,30,male,1,1.0", "8,b,30,male,1,1.0.0", ""]
    (tmp_path / "c.csv").write_text("\n".join(good + bad) + "\n")
    (tmp_path / "t.csv").write_text(TRANSACTION_LINE + "\n9,1,oops,3,w\n")
    df = read_customers(spark, str(tmp_path / "c.csv"), "drop")
    names = schemas.CUSTOMERS.fieldNames()
    assert df.count() == 4
    for n in (1, 3):
        for chosen in combinations(names, n):
            assert df.select(*chosen).count() == 4 and len(df.select(*chosen).collect()) == 4
    assert sorted(r.ID for r in df.collect()) == [1, 5, 6, 7]
    mixed = read_mixed(spark, str(tmp_path))
    assert sorted(mixed[0].collect(), key=str) == sorted(df.collect(), key=str)
    assert mixed[1].collect() == read_transactions(spark, str(tmp_path / "t.csv"), "drop").collect()
    with pytest.raises(ValueError):
        read_customers(spark, str(tmp_path / "c.csv"), "other")


def test_centres_of_a_file_in_several_parts(spark, tmp_path):
    (tmp_path / "k.csv").write_text("".join(f"{i},{-i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = read_centres(spark, str(tmp_path / "k.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(tuple(r) for r in rows) == [(i, i, -i) for i in range(5000)]


def test_two_kinds_of_record_from_one_scan(spark, tmp_path):
    bad = ["1,2", "", "x,1,99.90,3,some words", f"{CUSTOMER_LINE},"]
    good = [CUSTOMER_LINE, TRANSACTION_LINE, ",,,,,", "8,,,,"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(good + bad[:2]) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\n".join(bad[2:] + good) + "\n")
    customers, transactions = read_mixed(spark, str(tmp_path / "in"))
    with artefacts(spark):
        found = split_mixed(spark, str(tmp_path / "in"))
        assert sorted(found[0].collect(), key=str) == sorted(customers.collect(), key=str) and found[0].schema == customers.schema
        assert sorted(found[1].collect(), key=str) == sorted(transactions.collect(), key=str) and found[1].schema == transactions.schema
        assert sorted(r.value for r in found[2].collect()) == sorted(bad)
        # Each result reads the folder of its kind.
        for df, kind in zip(found, ("customers", "transactions", "bad")):
            assert f"PartitionFilters: [isnotnull(kind" in (plan := df._jdf.queryExecution().executedPlan().toString()) and kind in plan
    tagged = tag_records(spark.read.text(str(tmp_path / "in")), {"customers": schemas.CUSTOMERS, "transactions": schemas.TRANSACTIONS})
    assert tagged._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert {r["kind"]: r["count"] for r in tagged.groupBy("kind").count().collect()} == {"customers": 4, "transactions": 4, "bad": 4}


def scan_bytes(spark, path, window):
    from gridledger.sources.placed import KEY

    df = read_window(spark, path, window)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({KEY}," in plan or f"EqualTo({KEY}," in plan
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return rows, leaf.metrics().apply("numOutputRows").value()


def test_a_window_reads_the_part_of_the_files_near_it(spark, tmp_path):
    points = spark.range(60_000).selectExpr(
        "cast(id * 7919 % 10007 - 3000 as int) as x", "cast(id * 104729 % 9973 as int) as y", "id as tag"
    )
    points = points.unionByName(spark.range(5000).selectExpr("cast(77 as int) as x", "cast(88 as int) as y", "id as tag"))
    path = str(tmp_path / "placed")
    write_points(points.unionByName(points.limit(1).selectExpr("cast(null as int) as x", "y", "tag")), path, parts=32, group_bytes=4096)
    read = []
    for window in [(-(10**10), -(10**10), 10**10, 10**10), (-3000, 0, 2000, 5000), (0, 0, 900, 900), (77, 88, 77, 88), (6000, 9000, 6100, 9050), (5, 5, 4, 9)]:
        x1, y1, x2, y2 = window
        if x1 > x2:
            assert read_window(spark, path, window).collect() == []
            continue
        got, scanned = scan_bytes(spark, path, window)
        want = points.where(f"x between {x1}L and {x2}L and y between {y1}L and {y2}L")
        assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
        read.append(scanned)
    assert read[0] == 65_000 and read[1] < 40_000 and read[2] < 20_000 and read[4] < 6_000
    for bad in ({"side": 1}, {}):
        with pytest.raises(ValueError):
            write_points(points.withColumn("_z_cell", points["x"]) if not bad else points, path, **bad)


def test_window_ranges_hold_every_cell_and_little_more():
    from gridledger.sources.placed import _interleaved, window_ranges

    window = (-37, 5, 410, 77)
    ranges = window_ranges(window, 16)
    cells = {_interleaved((x + 2**31) // 16, (y + 2**31) // 16) for x in range(-37, 411) for y in range(5, 78)}
    assert len(ranges) <= 64 and all(any(a <= c <= b for a, b in ranges) for c in cells)
    assert sum(b - a + 1 for a, b in ranges) < 2 * len(cells)
    assert len(window_ranges((-(2**31), -(2**31), 2**31 - 1, 2**31 - 1), 16)) == 1


def test_numbers_compare_as_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,1,99.90,1,a\n2,1,1000.00,1,b\n")
    df = read_transactions(spark, str(tmp_path / "t.csv"))
    assert df.agg({"TransTotal": "max"}).first()[0] == 1000.0


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{CUSTOMER_LINE}\n{TRANSACTION_LINE}\n1,2\n")
    (tmp_path / "b.csv").write_text("8,zzz,5.00,1,bad key\n")
    customers, transactions = read_mixed(spark, str(tmp_path))
    assert customers.schema == schemas.CUSTOMERS and transactions.schema == schemas.TRANSACTIONS
    assert [tuple(r) for r in customers.collect()] == [(1, "ann", 30, "female", 4, 1234.5)]
    assert [(r.TransID, r.CustID) for r in transactions.collect()] == [(7, 1)]


def test_centres_by_line(spark, tmp_path):
    (tmp_path / "k.csv").write_text("5,6\r\n-7,8 - CHANGED\n9,-10 - UNCHANGED\n\n")
    got = read_centres(spark, str(tmp_path / "k.csv"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 5, 6), (1, -7, 8), (2, 9, -10)]
    (tmp_path / "more.csv").write_text("1,1\n")
    with pytest.raises(ValueError):
        read_centres(spark, str(tmp_path))


def test_report_lines(spark):
    def only(df):
        return df.first()[0]

    summary = spark.createDataFrame(
        [(3, "ann", 12.5, 2, 20.3, 1)],
        "ID int, Name string, Salary double, NumTransactions bigint, TotalSum double, MinItems int",
    )
    assert only(sinks.customer_txn_summary_lines(summary)) == "3\tann,12.5,2,20.30,1"
    country = spark.createDataFrame(
        [(4, 10, 0.0, 7.25)],
        "CountryCode int, CustomerCount bigint, MinTransTotal double, MaxTransTotal double",
    )
    assert only(sinks.country_txn_report_lines(country)) == "4\t10,0.0,7.25"
    ages = spark.createDataFrame(
        [("[10,20) male", 1.0, 2.0, 1.125)],
        "AgeGender string, MinTransTotal double, MaxTransTotal double, AvgTransTotal double",
    )
    assert only(sinks.age_gender_spend_lines(ages)) == "[10,20) male\t1.00,2.00,1.13"
    match = spark.createDataFrame([("r1", 3, -4)], "rectId string, x int, y int")
    assert only(sinks.spatial_join_lines(match)) == "r1\t(3,-4)"
    point = spark.createDataFrame([(3, -4)], schemas.POINTS)
    assert only(sinks.distance_outliers_lines(point)) == "3,-4"
    centre = spark.createDataFrame([(0, 3, 4, "CHANGED")], "idx int, x int, y int, status string")
    assert only(sinks.kmeans_lines(centre)) == "3,4 - CHANGED"


def test_csv_round_trip(spark, tmp_path):
    makers = {
        "customers": (gen_customers, read_customers),
        "transactions": (gen_transactions, read_transactions),
        "points": (gen_points, read_points),
        "rectangles": (gen_rectangles, read_rectangles),
    }
    for name, (make, read) in makers.items():
        made = make(spark, 500)
        sinks.write_csv(made, str(tmp_path / name))
        assert sorted(read(spark, str(tmp_path / name)).collect()) == sorted(made.collect())


def test_rounds_replace_what_was_there(spark, tmp_path):
    points, seeds = gen_points(spark, 400), gen_seeds(spark, 4)
    history = kmeans(points, seeds, history=True, max_iter=2)
    for _ in range(2):
        sinks.write_kmeans_rounds(history, str(tmp_path / "out"))
    folders = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert folders == ["iteration_0", "iteration_1"]
    back = read_centres(spark, str(tmp_path / "out" / "iteration_1"))
    last = history.where("iteration = 1").orderBy("idx").select("x", "y").collect()
    assert [(r.x, r.y) for r in back.orderBy("idx").collect()] == [tuple(r) for r in last]


def test_generated_domains(spark):
    c = gen_customers(spark, 20_000).selectExpr(
        "min(ID) = 1 and max(ID) = 20000 and count(distinct ID) = 20000",
        "min(Age) = 10 and max(Age) = 70 and count(distinct Age) = 61",
        "count(distinct Gender) = 2 and abs(avg(if(Gender = 'male', 1, 0)) - 0.5) < 0.02",
        "min(CountryCode) = 1 and max(CountryCode) = 10",
        "min(Salary) >= 100 and max(Salary) < 10000 and abs(avg(Salary) - 5050) < 100",
        "min(length(Name)) = 10 and max(length(Name)) = 20",
        "min(if(Name rlike '^[a-z]+$', 1, 0)) = 1",
    ).first()
    assert all(c), c
    t = gen_transactions(spark, 100_000).selectExpr(
        "min(CustID) >= 1 and max(CustID) <= 50000 and count(distinct CustID) > 40000",
        "min(TransTotal) >= 10 and max(TransTotal) < 1000 and abs(avg(TransTotal) - 505) < 10",
        "min(TransNumItems) = 1 and max(TransNumItems) = 10",
        "min(length(TransDesc)) = 20 and max(length(TransDesc)) = 50",
    ).first()
    assert all(t), t
    p = gen_points(spark, 200_000).selectExpr(
        "min(x) = 1 and max(x) = 10000 and count(distinct x) = 10000",
        "min(y) = 1 and max(y) = 10000 and count(distinct y) = 10000",
        "abs(corr(x, y)) < 0.02",
    ).first()
    assert all(p), p
    r = gen_rectangles(spark, 100_000).selectExpr(
        "min(w) = 1 and max(w) = 7", "min(h) = 1 and max(h) = 20", "abs(corr(x, y)) < 0.02",
        "min(x) = 1 and max(y) = 10000",
    ).first()
    assert all(r), r
    assert [s.idx for s in gen_seeds(spark, 5).collect()] == [0, 1, 2, 3, 4]


def test_generated_rows_do_not_depend_on_partitioning_and_ids_may_be_large(spark):
    from gridledger.sources.generators import points_from_ids

    start = 10**13
    one = points_from_ids(spark.range(start, start + 1000, numPartitions=1)).collect()
    many = points_from_ids(spark.range(start, start + 1000, numPartitions=9)).collect()
    assert one == many
    assert all(1 <= r.x <= 10_000 and 1 <= r.y <= 10_000 for r in one)
