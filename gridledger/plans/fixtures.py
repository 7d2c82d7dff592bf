"""The five input datasets, derived from the given parquet tables.

Each is one whole table with computed columns and no filter, so work grows with the table. The
expressions run unchanged on Spark and on the checking engine. A tenth of the customers get no
transaction because the orders of theirs are given a negative, unknown customer ID; both kinds of
unmatched row therefore occur while every row is kept. Some customers have no age or no gender, and every
ninth amount has three decimals. Three more views of the same tables bring what plans for large data
have to meet: rectangles of very different shapes, points piled up in one corner, and more seeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIXTURES: dict[str, tuple[str, list[str]]] = {
    "customers": (
        "customer",
        [
            "c_custkey as ID",
            "c_name as Name",
            "case when c_custkey%50=7 then null else cast(10+(c_custkey*37)%61 as int) end as Age",
            "case when c_custkey%70=9 then null when c_custkey%2=1 then 'male' else 'female' end as Gender",
            "cast(1+c_nationkey%10 as int) as CountryCode",
            "c_acctbal as Salary",
        ],
    ),
    "transactions": (
        "orders",
        [
            "o_orderkey as TransID",
            "case when o_custkey%10=3 then -1-o_custkey else o_custkey end as CustID",
            "case when o_orderkey%9=4 then cast((cast(round(o_totalprice*100) as bigint)%990011+10000) as double)/1000 "
            "else cast((cast(round(o_totalprice*100) as bigint)%99001+1000) as double)/100 end as TransTotal",
            "cast(1+o_orderkey%10 as int) as TransNumItems",
            "o_orderpriority as TransDesc",
        ],
    ),
    "points": (
        "lineitem",
        [
            "cast(1+(l_partkey*7919+l_orderkey*31+l_linenumber*104729)%10000 as int) as x",
            "cast(1+(l_suppkey*6271+l_orderkey*97+l_linenumber*3571)%10000 as int) as y",
        ],
    ),
    "rectangles": (
        "orders",
        [
            "concat('r',cast(o_orderkey as string)) as rectId",
            "cast(1+(o_orderkey*7907)%10000 as int) as x",
            "cast(1+(o_custkey*6277+o_orderkey*13)%10000 as int) as y",
            "cast(1+o_orderkey%7 as int) as w",
            "cast(1+o_orderkey%20 as int) as h",
        ],
    ),
    # Small boxes, and in their midst thin, tall and large ones.
    "mixed_rectangles": (
        "orders",
        [
            "concat('r',cast(o_orderkey as string)) as rectId",
            "cast(1+(o_orderkey*7907)%10000 as int) as x",
            "cast(1+(o_custkey*6277+o_orderkey*13)%10000 as int) as y",
            "cast(case o_orderkey%9 when 0 then 100 when 1 then 900 else 1+o_orderkey%7 end as int) as w",
            "cast(case o_orderkey%9 when 0 then 100 when 2 then 900 else 1+o_orderkey%20 end as int) as h",
        ],
    ),
    # All but about one in a thousand lie close together.
    "piled_points": (
        "lineitem",
        [
            "cast(case when l_orderkey%997=5 then 1+(l_orderkey*7919+l_linenumber*104729)%10000 "
            "else 1+(l_partkey*31+l_linenumber*7)%200 end as int) as x",
            "cast(case when l_orderkey%997=5 then 1+(l_orderkey*6271+l_linenumber*3571)%10000 "
            "else 1+(l_suppkey*97+l_orderkey)%200 end as int) as y",
        ],
    ),
    "many_seeds": (
        "supplier",
        [
            "cast(s_suppkey as int) as idx",
            "cast(1+(s_suppkey*2741+1213)%10000 as int) as x",
            "cast(1+(s_suppkey*6131+3557)%10000 as int) as y",
        ],
    ),
    "seeds": (
        "nation",
        [
            "cast(n_nationkey as int) as idx",
            "cast(1+(n_nationkey*2741+1213)%10000 as int) as x",
            "cast(1+(n_nationkey*6131+3557)%10000 as int) as y",
        ],
    ),
}

#: Every so many keys the first three have a line that does not fit.
BAD_LINES = 11

# Row ids for the generators: the keys of whole tables.
ID_SOURCES: dict[str, tuple[str, str]] = {
    "gen_customers": ("customer", "cast(c_custkey+1 as bigint) as id"),
    "gen_transactions": ("orders", "cast(o_orderkey+1 as bigint) as id"),
    "gen_points": ("lineitem", "cast(l_orderkey*10+l_linenumber as bigint) as id"),
    "gen_rectangles": ("orders", "cast(o_orderkey+1 as bigint) as id"),
    "gen_seeds": ("nation", "cast(n_nationkey+1 as bigint) as id"),
}


def _load(spark: SparkSession, sf_dir: str, table: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").selectExpr(*columns)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = FIXTURES[name]
    return _load(spark, sf_dir, table, columns)


def record_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dataset as lines of text. Of eleven keys, one has a line that is a field short, one a line with a
    field too many, and one a line whose numbers are words."""
    rows = fixture(spark, sf_dir, name)
    key, *others = rows.columns
    kind = f"pmod({key}, {BAD_LINES})"
    fields = [f"if({kind} = 2, 'none', cast({key} as string))"] + [f"coalesce(cast({c} as string), '')" for c in others]
    whole = f"concat_ws(',', {', '.join(fields)})"
    short = f"concat_ws(',', {', '.join(fields[1:])})"
    return rows.selectExpr(f"case {kind} when 0 then {short} when 1 then concat({whole}, ',') else {whole} end as value")


def generator_ids(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, column = ID_SOURCES[name]
    return _load(spark, sf_dir, table, [column])
