"""SQL that computes the same results another way, for an independent engine.

Where there is a choice the SQL follows a different route from the operators: join first and
aggregate after, plain self-joins, brute range conditions, ``rank()``, unrolled iterations.
"""

from __future__ import annotations

from ..functions.synthetic import MODULUS, STREAMS
from .fixtures import BAD_LINES, FIXTURES, ID_SOURCES
from .queries import COUNTRY_HI, COUNTRY_LO, OUTLIER_K, OUTLIER_R, QUERY_WINDOW, WIDE_K, WIDE_R


def _with(names: list[str], body: str, more: list[tuple[str, str]] | None = None) -> str:
    parts = []
    for name in names:
        table, columns = FIXTURES[name]
        parts.append(f"{name} as (select {', '.join(columns)} from {table})")
    parts += [f"{name} as materialized ({sql})" for name, sql in more or []]
    return f"with {', '.join(parts)} {body}"


# Wide enough for every decimal that an amount has, so nothing is rounded before it is added.
_MONEY = "cast(sum(cast(TransTotal as decimal(18,5))) as double)"

_BANDS = (
    "case when Age is null then null when Age between 10 and 19 then '[10,20)' "
    "when Age between 20 and 29 then '[20,30)' when Age between 30 and 39 then '[30,40)' "
    "when Age between 40 and 49 then '[40,50)' when Age between 50 and 59 then '[50,60)' "
    "when Age between 60 and 70 then '[60,70]' else '{other}' end"
)


def _bad(name: str, key: str) -> str:
    """The lines of a dataset that do not fit: a field short, a field too many, or a word for a number."""
    others = [c.rsplit(" as ", 1)[1] for c in FIXTURES[name][1][1:]]
    values = [f"coalesce(cast({c} as varchar), '')" for c in others]
    rest = " || ',' || ".join(values)
    return f"""select case {key} % {BAD_LINES} when 0 then {rest} when 1 then cast({key} as varchar) || ',' || {rest} || ','
        else 'none,' || {rest} end as value from {name} where {key} % {BAD_LINES} <= 2"""


def _summary() -> str:
    return _with(
        ["customers", "transactions"],
        f"""select coalesce(c.ID, t.CustID) as ID, coalesce(max(c.Name), '') as Name,
            coalesce(max(c.Salary), 0.0) as Salary, count(t.TransID) as NumTransactions,
            coalesce({_MONEY}, 0.0) as TotalSum, coalesce(min(t.TransNumItems), 0) as MinItems
        from customers c full outer join transactions t on c.ID = t.CustID
        group by coalesce(c.ID, t.CustID)""",
    )


def _country() -> str:
    return _with(
        ["customers", "transactions"],
        """select c.CountryCode, count(distinct c.ID) as CustomerCount,
            coalesce(min(t.TransTotal), 0.0) as MinTransTotal,
            coalesce(max(t.TransTotal), 0.0) as MaxTransTotal
        from customers c left join transactions t on c.ID = t.CustID group by c.CountryCode""",
    )


def _age_gender(combined: bool) -> str:
    band = _BANDS.format(other="Unknown" if combined else "UNKNOWN")
    named = f"coalesce({band}, 'Unknown') || ' ' || coalesce(Gender, 'unknown') as AgeGender"
    key = named if combined else f"{band} as AgeRange, Gender"
    return _with(
        ["customers", "transactions"],
        f"""select {key}, min(TransTotal) as MinTransTotal, max(TransTotal) as MaxTransTotal,
            {_MONEY} / count(TransTotal) as AvgTransTotal
        from transactions join customers on CustID = ID group by {'1' if combined else '1, 2'}""",
    )


def _least_active() -> str:
    return _with(
        ["customers", "transactions"],
        """, n as (select CustID, count(TransID) as TransCount from transactions group by CustID)
        select Name, TransCount from customers join n on ID = CustID
        where TransCount = (select min(TransCount) from n)""".lstrip(),
    )


def _spatial(window: tuple[int, int, int, int] | None, rectangles: str = "rectangles") -> str:
    extra = ""
    if window is not None:
        left, low, right, high = window
        extra = f" where p.x between {left} and {right} and p.y between {low} and {high}"
    return _with(
        ["points", rectangles],
        f"""select r.rectId, p.x, p.y from points p join {rectangles} r
            on p.x between r.x and r.x + r.w and p.y between r.y and r.y + r.h{extra}""",
    )


def _outliers(r: int = OUTLIER_R, k: int = OUTLIER_K, points: str = "points") -> str:
    # Rows, not collapsed positions, on cells of side r.
    return _with(
        [points],
        f"""select a.x, a.y from near n join ids a on a.i = n.i where n.others < {k}""",
        [
            ("ids", f"select row_number() over () as i, x, y from {points}"),
            ("cells", f"select i, x, y, x // {r} as cx, y // {r} as cy from ids"),
            ("shift", "select unnest([-1, 0, 1]) as d"),
            (
                "asked",
                "select i, x, y, cx + a.d as cx, cy + b.d as cy from cells, shift a, shift b",
            ),
            (
                "near",
                f"""select a.i, count(*) filter (where o.i <> a.i and
                    (a.x-o.x)*(a.x-o.x)+(a.y-o.y)*(a.y-o.y) <= {r * r}) as others
                from asked a join cells o on a.cx = o.cx and a.cy = o.cy group by a.i""",
            ),
        ],
    )


def _neighbours(r: int, points: str = "points") -> str:
    # Every position with all of those in the cells of side r around it.
    return _with(
        [points],
        f"""select a.x, a.y, any_value(a.m) as copies, cast(sum(o.m) - 1 as bigint) as neighbours
            from asked a join spots o on a.cx = o.cx and a.cy = o.cy
                and (a.x-o.x)*(a.x-o.x)+(a.y-o.y)*(a.y-o.y) <= {r * r} group by a.x, a.y""",
        [
            ("spots", f"select x, y, x // {r} as cx, y // {r} as cy, count(*) as m from {points} group by x, y"),
            ("shift", "select unnest([-1, 0, 1]) as d"),
            ("asked", "select x, y, m, cx + a.d as cx, cy + b.d as cy from spots, shift a, shift b"),
        ],
    )


def _kmeans(history: bool, rounds: int = 6, seeds: str = "seeds") -> str:
    steps = [
        ("weighted", "select x, y, count(*) as n from points group by x, y"),
        ("h0", f"select -1 as iteration, idx, x, y, 'CHANGED' as status from {seeds}"),
    ]
    for i in range(rounds):
        steps += [
            (
                f"a{i}",
                f"""select p.x, p.y, p.n, min(((p.x-c.x)*(p.x-c.x)+(p.y-c.y)*(p.y-c.y))
                    * cast(1000000 as bigint) + c.idx) % 1000000 as idx
                from weighted p, h{i} c
                where exists (select 1 from h{i} where status = 'CHANGED')
                group by p.x, p.y, p.n""",
            ),
            (
                f"m{i}",
                f"""select idx, cast(sum(x*n) // sum(n) as int) as x,
                    cast(sum(y*n) // sum(n) as int) as y from a{i} group by idx""",
            ),
            (
                f"h{i + 1}",
                f"""select {i} as iteration, m.idx, m.x, m.y,
                    case when m.x = c.x and m.y = c.y then 'UNCHANGED' else 'CHANGED' end as status
                from m{i} m join h{i} c on m.idx = c.idx""",
            ),
        ]
    rows = " union all ".join(f"select * from h{i + 1}" for i in range(rounds))
    steps.append(("states", rows))
    typed = "cast(idx as int) as idx, x, y, status from states"
    body = (
        f"select cast(iteration as int) as iteration, {typed}"
        if history
        else f"select {typed} where iteration = (select max(iteration) from states)"
    )
    return _with(["points", seeds], body, steps)


def _assigned(seeds: str) -> str:
    return _with(
        ["points", seeds],
        """select p.x, p.y, n.idx, n.dist2 from points p join nearest n on p.x = n.x and p.y = n.y""",
        [
            (
                "nearest",
                f"""select p.x, p.y, arg_min(c.idx, (d, c.idx)) as idx, min(d) as dist2
                from (select distinct x, y from points) p, {seeds} c,
                    lateral (select cast((p.x-c.x)*(p.x-c.x)+(p.y-c.y)*(p.y-c.y) as bigint) as d)
                group by p.x, p.y""",
            )
        ],
    )


_CELLS = (
    "cells",
    """select cast((y-1)//20 as bigint) as r, cast((x-1)//20 as bigint) as c,
        count(*) as cell_count from points where x between 1 and 10000 and y between 1 and 10000
    group by 1, 2""",
)

_DENSITY = [
    _CELLS,
    (
        "offsets",
        """select a.d as dr, b.d as dc from (select unnest([-1, 0, 1]) as d) a,
            (select unnest([-1, 0, 1]) as d) b where a.d <> 0 or b.d <> 0""",
    ),
    (
        "density",
        """select a.r, a.c, a.r*500+a.c as cell_id, a.cell_count, avg(b.cell_count) as neighbor_avg,
            a.cell_count / avg(b.cell_count) as I_X
        from cells a cross join offsets o
            left join cells b on b.r = a.r + o.dr and b.c = a.c + o.dc
        group by a.r, a.c, a.cell_count""",
    ),
    ("ranked", "select *, rank() over (order by I_X desc nulls last) as place from density"),
    ("top", "select * from ranked where place <= 50"),
]


def _uniform(low: int, high: int, stream: int) -> str:
    a, c, b = STREAMS[stream]
    u = f"(((id % {MODULUS}) * {a} + (id // {MODULUS}) * {c} + {b}) % {MODULUS})"
    v = f"(((({u} * {u}) % {MODULUS}) * {a} + {u}) % {MODULUS})"
    return f"({low} + ({v} * {high - low + 1}) // {MODULUS})"


def _letters(low: int, high: int, stream: int) -> str:
    digests = " || ".join(
        f"substring(base64(unhex(md5('{stream}/{part}/' || cast(id as varchar)))), 1, 22)"
        for part in range(-(-high // 22))
    )
    return (
        f"substring(translate(lower({digests}), '0123456789+/', 'bdfhjlnprtvx'), 1, "
        f"cast({_uniform(low, high, stream)} as int))"
    )


def _generated(name: str, columns: list[str]) -> str:
    table, key = ID_SOURCES[name]
    return f"with ids as (select {key} from {table}) select {', '.join(columns)} from ids"


def _ints(**columns: tuple[int, int, int]) -> list[str]:
    return [f"cast({_uniform(*args)} as int) as {name}" for name, args in columns.items()]


def _two_decimals(column: str) -> str:
    # Halves of the decimal value go up, as in the reports.
    return f"cast(cast(round(cast({column} as decimal(18,6)), 2) as decimal(18,2)) as varchar)"


def _lines(query: str, line: str) -> str:
    return f"select {line} as value from ({query}) q"


def build_oracles() -> dict[str, str]:
    sql = {
        "customer_txn_summary": _summary(),
        "customer_txn_summary_keyed": _summary(),
        "customer_txn_summary_keyed_hot": _summary(),
        "country_txn_report": _country(),
        "age_gender_spend": _age_gender(True),
        "age_gender_spend_cols": _age_gender(False),
        "least_active_customers": _least_active(),
        "country_size_outliers": _with(
            ["customers"],
            f"""select CountryCode, count(*) as NumCustomers from customers group by CountryCode
            having count(*) > {COUNTRY_HI} or count(*) < {COUNTRY_LO}""",
        ),
        "spatial_join": _spatial(None),
        "spatial_join_window": _spatial(QUERY_WINDOW),
        "distance_outliers": _outliers(),
        "kmeans": _kmeans(False),
        "kmeans_history": _kmeans(True),
        "high_value_txns": _with(["transactions"], "select * from transactions where TransTotal >= 200"),
        "items_spend_stats": _with(
            ["transactions"],
            f"""select TransNumItems as transNumItems, {_MONEY} as sum_transTotal,
                {_MONEY} / count(TransTotal) as avg_transTotal, min(TransTotal) as min_transTotal,
                max(TransTotal) as max_transTotal
            from transactions where TransTotal >= 200 group by TransNumItems""",
        ),
        "customer_counts_200": _with(
            ["transactions"],
            """select CustID as customerId, count(TransID) as transaction_count_T3
            from transactions where TransTotal >= 200 group by CustID""",
        ),
        "very_high_value_txns": _with(
            ["transactions"], "select * from transactions where TransTotal >= 600"
        ),
        "customer_counts_600": _with(
            ["transactions"],
            """select CustID as customerId, count(TransID) as transaction_count_T5
            from transactions where TransTotal >= 600 group by CustID""",
        ),
        "rare_big_spenders": _with(
            ["transactions"],
            """, t3 as (select CustID, count(TransID) as n3 from transactions
                where TransTotal >= 200 group by CustID),
            t5 as (select CustID, count(TransID) as n5 from transactions
                where TransTotal >= 600 group by CustID)
            select CustID as customerId, n5 as transaction_count_T5, n3 as transaction_count_T3
            from t5 join t3 using (CustID) where n5 * 5 < n3""".lstrip(),
        ),
        "grid_cell_counts": _with(
            ["points"],
            'select r*500+c as cell_id, r as "row", c as "col", cell_count from cells',
            [_CELLS],
        ),
        "relative_density": _with(
            ["points"], "select cell_id, cell_count, neighbor_avg, I_X from density", _DENSITY
        ),
        "cell_ranks": _with(["points"], "select cell_id, I_X, place as rank from ranked", _DENSITY),
        "top_dense_cells": _with(["points"], "select cell_id, I_X from top", _DENSITY),
        "top_dense_neighbors": _with(
            ["points"],
            """select t.cell_id as top_cell_id, t.I_X as top_cell_I_X,
                (t.r+o.dr)*500+t.c+o.dc as neighbor_cell_id, d.I_X as neighbor_I_X
            from top t cross join offsets o
                left join density d on d.r = t.r + o.dr and d.c = t.c + o.dc
            where t.r+o.dr between 0 and 499 and t.c+o.dc between 0 and 499""",
            _DENSITY,
        ),
        "gen_customers": _generated(
            "gen_customers",
            [
                "id as ID",
                f"{_letters(10, 20, 0)} as Name",
                *_ints(Age=(10, 70, 1)),
                f"case when {_uniform(0, 1, 2)} = 1 then 'male' else 'female' end as Gender",
                *_ints(CountryCode=(1, 10, 3)),
                f"cast({_uniform(10000, 999999, 4)} as double) / 100 as Salary",
            ],
        ),
        "gen_transactions": _generated(
            "gen_transactions",
            [
                "id as TransID",
                f"cast({_uniform(1, 50000, 5)} as bigint) as CustID",
                f"cast({_uniform(1000, 99999, 6)} as double) / 100 as TransTotal",
                *_ints(TransNumItems=(1, 10, 7)),
                f"{_letters(20, 50, 0)} as TransDesc",
            ],
        ),
        "gen_points": _generated("gen_points", _ints(x=(1, 10000, 0), y=(1, 10000, 1))),
        "gen_rectangles": _generated(
            "gen_rectangles",
            [
                "'r' || cast(id as varchar) as rectId",
                *_ints(x=(1, 10000, 2), y=(1, 10000, 3), w=(1, 7, 4), h=(1, 20, 5)),
            ],
        ),
        "gen_seeds": _generated(
            "gen_seeds",
            ["cast(id - 1 as int) as idx", *_ints(x=(1, 10000, 6), y=(1, 10000, 7))],
        ),
    }
    sql |= {
        "country_txn_report_shuffled": _country(),
        "age_gender_spend_shuffled": _age_gender(True),
        "spatial_join_shuffled": _spatial(None),
        "spatial_join_mixed": _spatial(None, "mixed_rectangles"),
        "spatial_join_mixed_shuffled": _spatial(None, "mixed_rectangles"),
        "distance_outliers_wide": _outliers(WIDE_R, WIDE_K),
        "distance_outliers_crowded": _outliers(WIDE_R, WIDE_K),
        "distance_outliers_rare": _outliers(points="piled_points"),
        "neighbour_counts": _neighbours(OUTLIER_R),
        "neighbour_counts_wide": _neighbours(WIDE_R),
        "neighbour_counts_piled": _neighbours(OUTLIER_R, "piled_points"),
        "assigned_points": _assigned("seeds"),
        "assigned_points_many": _assigned("many_seeds"),
        "kmeans_reusing_cells": _kmeans(False),
        "kmeans_many": _kmeans(False, seeds="many_seeds"),
        "kmeans_many_by_cells": _kmeans(False, seeds="many_seeds"),
        # The rows whose line fits.
        "text_customers": _with(["customers"], f"select * from customers where ID % {BAD_LINES} > 2"),
        "text_transactions": _with(["transactions"], f"select * from transactions where TransID % {BAD_LINES} > 2"),
    }
    sql["split_customers"], sql["split_transactions"] = sql["text_customers"], sql["text_transactions"]
    sql["split_bad"] = _with(["customers", "transactions"], f"{_bad('customers', 'ID')} union all {_bad('transactions', 'TransID')}")
    left, low, right, high = QUERY_WINDOW
    sql["window_of_written_points"] = _with(["points"], f"select x, y from points where x between {left} and {right} and y between {low} and {high}")
    tab = "chr(9)"
    lines = {
        "customer_txn_summary": f"cast(ID as varchar) || {tab} || Name || ',' || cast(Salary as varchar)"
        f" || ',' || cast(NumTransactions as varchar) || ',' || {_two_decimals('TotalSum')}"
        " || ',' || cast(MinItems as varchar)",
        "country_txn_report": f"cast(CountryCode as varchar) || {tab} || cast(CustomerCount as varchar)"
        " || ',' || cast(MinTransTotal as varchar) || ',' || cast(MaxTransTotal as varchar)",
        "age_gender_spend": f"AgeGender || {tab} || {_two_decimals('MinTransTotal')} || ',' || "
        f"{_two_decimals('MaxTransTotal')} || ',' || {_two_decimals('AvgTransTotal')}",
        "spatial_join": f"rectId || {tab} || '(' || cast(x as varchar) || ',' || cast(y as varchar) || ')'",
        "distance_outliers": "cast(x as varchar) || ',' || cast(y as varchar)",
        "kmeans": "cast(x as varchar) || ',' || cast(y as varchar) || ' - ' || status",
    }
    sql.update({f"{name}_lines": _lines(sql[name], line) for name, line in lines.items()})
    return sql
