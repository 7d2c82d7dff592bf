"""The command line, end to end on small text files."""

from __future__ import annotations

from gridledger.plans.jobs import main


def lines(path):
    return sorted(line for part in path.glob("part-*") for line in part.read_text().splitlines())


def test_reports(spark, tmp_path):
    (tmp_path / "records").mkdir()
    customers, transactions = tmp_path / "records" / "c.csv", tmp_path / "records" / "t.csv"
    customers.write_text("1,ann,10,female,1,100.00\n2,bob,25,male,2,50.50\n3,cid,30,male,2,70.00\n")
    transactions.write_text("1,1,10.10,3,a\n2,1,10.20,1,b\n3,2,99.90,2,c\n4,9,1.00,7,d\n")
    both = [str(customers), str(transactions)]

    def out(name, *arguments):
        main([name, *arguments, str(tmp_path / name)])
        return lines(tmp_path / name)

    summary = ["1\tann,100.0,2,20.30,1", "2\tbob,50.5,1,99.90,2", "3\tcid,70.0,0,0.00,0", "9\t,0.0,1,1.00,7"]
    assert out("customer-summary", *both) == summary
    assert out("customer-summary-mixed", str(tmp_path / "records")) == summary
    assert out("country-report", *both) == ["1\t1,10.1,10.2", "2\t2,99.9,99.9"]
    assert out("age-gender", *both) == ["[10,20) female\t10.10,10.20,10.15", "[20,30) male\t99.90,99.90,99.90"]
    assert out("age-gender-columns", *both) == ['"[10,20)",female,10.1,10.2,10.15', '"[20,30)",male,99.9,99.9,99.9']
    assert out("least-active", *both) == ["bob,1"]
    assert out("country-size", str(customers)) == ["1,1", "2,2"]


def test_spatial_clustering_and_density(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    main(["generate", "points", "3000", path("points")])
    main(["generate", "rectangles", "2000", path("rects")])
    main(["generate", "seeds", "4", path("seeds")])
    main(["generate", "customers", "10", path("customers")])
    main(["generate", "transactions", "200", path("transactions")])
    assert len(lines(tmp_path / "customers")) == 10

    main(["spatial-join", path("points"), path("rects"), path("all")])
    main(["spatial-join", path("points"), path("rects"), path("window"), "1", "1", "5000", "10000"])
    everything, window = lines(tmp_path / "all"), lines(tmp_path / "window")
    assert everything and set(window) <= set(everything)
    assert window == [m for m in everything if int(m.split("(")[1].split(",")[0]) <= 5000]

    main(["neighbours", path("points"), path("neighbours"), "50"])
    counted = [list(map(int, line.split(","))) for line in lines(tmp_path / "neighbours")]
    assert sum(row[2] for row in counted) == 3000
    main(["assign", path("points"), path("seeds"), path("assigned")])
    assert len(lines(tmp_path / "assigned")) == 3000
    main(["outliers", path("points"), path("outliers"), "50", "1"])
    assert len(lines(tmp_path / "outliers")) == sum(row[2] for row in counted if row[3] < 1)
    assert all(len(line.split(",")) == 2 for line in lines(tmp_path / "outliers"))
    main(["kmeans", path("points"), path("seeds"), path("kmeans"), "--max-iter", "2"])
    assert len(lines(tmp_path / "kmeans" / "iteration_1")) == 4
    main(["density", path("points"), path("density")])
    assert lines(tmp_path / "density" / "top_dense_cells")
    assert lines(tmp_path / "density" / "top_dense_neighbors")
    main(["spending", path("transactions"), path("spending")])
    assert len(lines(tmp_path / "spending" / "items_spend_stats")) == 10
