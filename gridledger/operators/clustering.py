"""k-means from given seeds, with integer-truncated centres."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.artefacts import artefacts, new_path, stored
from ..functions.grid import merged_ranges, z_order
from ..functions.sizing import BROADCAST_BYTES, ROW_OVERHEAD

# Up to this many centres they travel as literals inside the plan; more are a table, looked up by cell.
LITERAL_CENTRES = 1000

# Candidates that a cell may keep before it is cut into four.
_LEAF = 16

# Rows of candidates up to which several cuts into four are made at once.
_CUT_ROWS = 1 << 22

# Rows of candidates for a task.
_TASK_ROWS = 1 << 14

# Extent, in bits, up to which the costs of a cell's candidates and their places fit a BIGINT.
_EXACT_BITS = 27

# Up to this many centres the nearest one is a flat expression, compiled into the scan's stage.
# Beyond it the generated method would pass the 8000 bytecodes up to which the JVM compiles one.
_FLAT_CENTRES = 32

# From so many points on, k-means sums up cells once; a round then reads the points of border cells only.
REUSE_POINTS = 1 << 21

# Points of a cell, were they spread evenly.
_CELL_POINTS = 256

# Squares of cells, at most, that the driver is told to lie on a border; and ranges of them in a filter.
_TILES = 1 << 12
_RANGES = 64

# Bytes of a row group of the placed points: what a filter can skip.
_GROUP_BYTES = 1 << 20

_STATES = T.StructType(
    [
        T.StructField("iteration", T.IntegerType(), False),
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("x", T.IntegerType(), False),
        T.StructField("y", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)


def nearest_centre(x: str, y: str, centres: Sequence[Row]) -> Column:
    """Place, in the sequence, of the centre nearest to the INT columns x, y; the first on ties.

    The squared distance less the point's own square is c.x^2 + c.y^2 - 2(x c.x + y c.y). Times k,
    plus the place, it is one whole number for each centre whose least value names the winner and
    settles ties: two multiplications for a centre and no square root. All of it is exact; doubles
    are used only where every value stays within their 53 bits.
    """
    k = len(centres)
    if k == 1:
        return F.lit(0)
    rows = [
        (k * (c["x"] ** 2 + c["y"] ** 2) + place, 2 * k * c["x"], 2 * k * c["y"])
        for place, c in enumerate(centres)
    ]
    widest = max(abs(fixed) + 2**31 * (abs(fx) + abs(fy)) for fixed, fx, fy in rows)
    if widest < 2**53:
        number, coordinate = "{}D", "cast({} as double)"
    elif widest < 2**63:
        number, coordinate = "{}L", "cast({} as bigint)"
    else:
        number, coordinate = "cast({} as decimal(27,0))", "cast({} as decimal(10,0))"
    px, py = coordinate.format(x), coordinate.format(y)
    table = [[number.format(value) for value in row] for row in rows]
    # Text, not Column operators: one call into the JVM for each round instead of hundreds.
    if k <= _FLAT_CENTRES and widest < 2**63:
        costs = ", ".join(f"{fixed} - {px} * {fx} - {py} * {fy}" for fixed, fx, fy in table)
        best = f"least({costs})"
    else:
        structs = ", ".join(f"named_struct('f', {f}, 'fx', {fx}, 'fy', {fy})" for f, fx, fy in table)
        best = f"array_min(transform(array({structs}), c -> c.f - {px} * c.fx - {py} * c.fy))"
    return F.expr(f"cast(pmod(cast({best} as decimal(38,0)), {k}) as int)"
                  if widest >= 2**63 else f"cast(pmod(cast({best} as bigint), {k}) as int)")


class PlacedPoints:
    """Points in the order of a grid's cells, and what each cell adds up to.

    Voronoi regions are convex, with ties going to the first centre as well: if the four corners of the box
    around a cell's points are nearest to one centre, so are all points in it. Such a cell counts as
    its sums; only the points of the others, on borders between centres, are looked at one by one.
    """

    def __init__(self, points: DataFrame, cell_points: int = _CELL_POINTS) -> None:
        ends = [f"{f}({c}) as {f}{c}" for f in ("min", "max") for c in "xy"]
        box = points.selectExpr(*ends, "count(*) as n").first()
        span = max(box["maxx"] - box["minx"], box["maxy"] - box["miny"]) + 1 if box["n"] else 1
        across = max(1, min(span, math.isqrt(box["n"] // cell_points)))
        side = -(-span // across)
        cx, cy = (f"((cast({c} as bigint) - {box['min' + c] or 0}L) div {side}L)" for c in "xy")
        parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.points = stored(
            # By x and y too, so that a cell with any share of the points is split.
            points.selectExpr("x", "y", f"{z_order(cx, cy)} as cell").repartitionByRange(parts, "cell", "x", "y").sortWithinPartitions("cell"),
            "placed-points", parquet__block__size=str(_GROUP_BYTES),
        )
        self.cells = stored(
            self.points.groupBy("cell").agg(
                F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.count("*").alias("n"),
                F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"),
            ),
            "cell-sums",
        )
        # Keys have two bits for each doubling of the cells across.
        self.tile_bits = max(0, 2 * (across - 1).bit_length() - (_TILES - 1).bit_length())

    def border(self, centres: Sequence[Row], broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
        """(place, sx, sy, n) of the cells that one centre owns, and the points of all others."""
        corners = [nearest_centre(x, y, centres).alias(f"c{n}") for n, (x, y) in enumerate([("x1", "y1"), ("x1", "y2"), ("x2", "y1"), ("x2", "y2")])]
        told = self.cells.select("cell", "sx", "sy", "n", *corners)
        own = "c0 = c1 and c0 = c2 and c0 = c3"
        shared = told.where(f"not ({own})").select("cell")
        tiles = shared.groupBy(F.expr(f"cell >> {self.tile_bits}").alias("tile")).agg(F.count("*").alias("cells")).collect()
        ranges = merged_ranges([row["tile"] for row in tiles], _RANGES)
        bits = self.tile_bits
        skip = " or ".join(f"cell between {a << bits}L and {((b + 1) << bits) - 1}L" for a, b in ranges) or "false"
        if sum(row["cells"] for row in tiles) * (ROW_OVERHEAD + 8) <= broadcast_bytes:
            shared = F.broadcast(shared)
        return told.where(own).selectExpr("c0 as place", "sx", "sy", "n"), self.points.where(skip).join(shared, "cell", "left_semi")


def _sums(points: DataFrame | PlacedPoints, centres: Sequence[Row], broadcast_bytes: int) -> DataFrame:
    """(place, sx, sy, n): sums of the points nearest to each centre."""
    if isinstance(points, DataFrame):
        return points.groupBy(nearest_centre("x", "y", centres).alias("place")).agg(
            F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.count("*").alias("n")
        )
    owned, rest = points.border(centres, broadcast_bytes)
    single = rest.select(nearest_centre("x", "y", centres).alias("place"), F.col("x").cast("long"), F.col("y").cast("long"), F.lit(1).cast("long"))
    return owned.union(single).groupBy("place").agg(F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), F.sum("n").alias("n"))


def _step(
    points: DataFrame | PlacedPoints, centres: Sequence[Row], tol: int, iteration: int, broadcast_bytes: int = BROADCAST_BYTES
) -> list[Row]:
    """One round; brings back one row for each centre that has points."""
    sums = _sums(points, centres, broadcast_bytes).selectExpr("place", "cast(sx div n as int) as x", "cast(sy div n as int) as y").collect()
    states = []
    for new in sorted(sums, key=lambda row: row["place"]):
        old = centres[new["place"]]
        moved = (new["x"] - old["x"]) ** 2 + (new["y"] - old["y"]) ** 2 >= tol * tol
        states.append(
            Row(iteration=iteration, idx=old["idx"], x=new["x"], y=new["y"],
                status="CHANGED" if moved else "UNCHANGED")
        )
    return states


def candidate_cells(centres: DataFrame, low: tuple[int, int], bits: int, leaf: int = _LEAF) -> DataFrame:
    """Cells (level, cx, cy) that tile a square, each with the centres that can be nearest within it.

    The square starts at ``low`` and is 2**bits wide. A cell keeps a centre if its nearest point of the
    cell is no farther than the farthest point of the cell is from some other centre. Cells with more
    than ``leaf`` candidates are cut into four, all of a level together: a level is one aggregate and
    one join over the candidates that are left. Where cells have many times that, several cuts are made at once.
    """
    open_cells = centres.groupBy("x", "y").agg(F.min("idx").alias("idx")).selectExpr("0L as cx", "0L as cy", "idx", "x", "y")
    most_tasks = int(centres.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = []
    level = 0
    while True:
        size = 1 << (bits - level)
        left, top = f"(cx * {size}L + {low[0]}L)", f"(cy * {size}L + {low[1]}L)"

        def near(c: str, start: str) -> str:
            return f"cast(greatest({start} - {c}, {c} - ({start} + {size - 1}L), 0) as double)"

        def far(c: str, start: str) -> str:
            return f"cast(greatest(abs({c} - {start}), abs({c} - ({start} + {size - 1}L))) as double)"

        measured = open_cells.selectExpr(
            "*",
            f"pow({near('x', left)}, 2) + pow({near('y', top)}, 2) as near",
            f"pow({far('x', left)}, 2) + pow({far('y', top)}, 2) as far",
        )
        # Distances are doubles here, so a hair is left on both sides; the choice itself is exact.
        bounds = measured.groupBy("cx", "cy").agg(F.expr("min(far) * (1 + 1e-9D) as bound"))
        kept = measured.join(bounds, ["cx", "cy"]).where("near <= bound").drop("near", "far", "bound")
        counts = kept.groupBy("cx", "cy").agg(F.expr("count(*) as n"))
        kept = stored(kept.join(counts, ["cx", "cy"]), "open-cells")
        full = f"n > {leaf}" if level < bits else "false"
        done.append(
            kept.where(f"not ({full})")
            .groupBy("cx", "cy")
            .agg(F.expr("collect_list(struct(x, y, idx)) as near_centres"))
            .selectExpr(f"{level} as level", f"{size}L as size", "cx", "cy", "near_centres")
        )
        rest = kept.where(full)
        left_over = rest.agg(F.expr("count(*) as n"), F.expr("sum(1D / n) as cells")).first()
        if not left_over["n"]:
            break
        # Levels at which hardly any cell would be done are passed over, while that makes few rows.
        cuts = 1
        while (
            level + cuts < bits
            and left_over["n"] / left_over["cells"] >= leaf * 4 ** (cuts + 1)
            and left_over["n"] * 4 ** (cuts + 1) <= _CUT_ROWS
        ):
            cuts += 1
        within = f"explode(sequence(0L, {2**cuts - 1}L))"
        open_cells = (
            rest.selectExpr(f"{within} as a", "*").selectExpr(f"{within} as b", "*")
            .selectExpr(f"cx * {2**cuts} + a as cx", f"cy * {2**cuts} + b as cy", "idx", "x", "y")
        )
        # An explicit number: AQE would leave a level's few bytes, and all the next ones, to one task.
        tasks = min(most_tasks, left_over["n"] * 4**cuts // _TASK_ROWS)
        if tasks > 1:
            open_cells = open_cells.repartition(tasks, "cx", "cy")
        level += cuts
    return reduce(DataFrame.unionByName, done)


def _assigned(points: DataFrame, cells: DataFrame, low: tuple[int, int], extent: int, broadcast_bytes: int) -> DataFrame:
    """All columns of the points (x, y and others), with ``idx`` of the nearest centre, the lowest on ties, and
    ``dist2``, the square of its distance.

    Cells of up to ``_LEAF`` candidates have a column for each, so that the least cost (see ``nearest_centre``,
    coordinates counted from ``low``) is one flat expression; other cells go through their lists.
    """
    sizes = cells.groupBy("level").agg(F.first("size").alias("size"), F.expr("sum(size(near_centres) + 4) as entries"), F.expr("max(size(near_centres)) as most")).collect()
    if extent.bit_length() > _EXACT_BITS:
        return _assigned_by_lists(points, cells, sizes, low, extent >= 1 << 30, broadcast_bytes)
    listed = [row for row in sizes if row["most"] > _LEAF]
    flat = cells.where(f"size(near_centres) <= {_LEAF}")
    sorted_cells = flat.selectExpr("level", "cx", "cy", "sort_array(transform(near_centres, c -> struct(c.idx, c.x - {}L as x, c.y - {}L as y))) as c".format(*low))
    # Costs are compared times _LEAF, plus the place, which settles ties.
    columns = [
        f"{value} as {name}{k}"
        for k in range(_LEAF)
        for name, value in (
            ("f", f"{_LEAF} * (get(c, {k}).x * get(c, {k}).x + get(c, {k}).y * get(c, {k}).y) + {k}L"),
            ("fx", f"{2 * _LEAF}L * get(c, {k}).x"),
            ("fy", f"{2 * _LEAF}L * get(c, {k}).y"),
        )
    ]
    told = sorted_cells.selectExpr("level", "cx", "cy", "c.idx as ids", *columns)
    if sum(row["entries"] for row in sizes) * 32 + cells.count() * (24 * _LEAF + ROW_OVERHEAD) <= broadcast_bytes:
        told = F.broadcast(told)
    costs = ", ".join(f"f{k} - px * fx{k} - py * fy{k}" for k in range(_LEAF))
    names = [f"`{c}`" for c in points.columns]
    levels = ", ".join(f"struct({row['level']} as level, {row['size']}L as size)" for row in sizes)
    placed = points.select(F.struct(*[F.col(c) for c in names]).alias("p"), F.expr(f"x - {low[0]}L as px"), F.expr(f"y - {low[1]}L as py"))
    found = (
        placed.selectExpr("*", f"explode(array({levels})) as l")
        .selectExpr("p", "px", "py", "l.level", "px div l.size as cx", "py div l.size as cy")
        .join(told, ["level", "cx", "cy"])
        .selectExpr("p", "px", "py", "ids", f"least({costs}) as least_cost")
        .selectExpr(
            "p.*", f"ids[cast(pmod(least_cost, {_LEAF}L) as int)] as idx",
            f"px * px + py * py + (least_cost - pmod(least_cost, {_LEAF}L)) div {_LEAF}L as dist2",
        )
    )
    if not listed:
        return found
    many = cells.where(f"size(near_centres) > {_LEAF}")
    return found.unionByName(_assigned_by_lists(points, many, listed, low, False, broadcast_bytes))


def _assigned_by_lists(
    points: DataFrame, cells: DataFrame, sizes: list[Row], low: tuple[int, int], wide: bool, broadcast_bytes: int
) -> DataFrame:
    levels = ", ".join(f"struct({row['level']} as level, {row['size']}L as size)" for row in sizes)
    if sum(row["entries"] for row in sizes) * 32 <= broadcast_bytes:
        cells = F.broadcast(cells)
    number = "decimal(38,0)" if wide else "bigint"
    dx, dy = (f"(cast(p.{c} as {number}) - cast(c.{c} as {number}))" for c in "xy")
    return (
        points.select(F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("p"), F.expr(f"explode(array({levels})) as l"))
        .selectExpr("p", "l.level", f"(p.x - {low[0]}L) div l.size as cx", f"(p.y - {low[1]}L) div l.size as cy")
        .join(cells, ["level", "cx", "cy"])
        .selectExpr("p", f"array_min(transform(near_centres, c -> struct({dx} * {dx} + {dy} * {dy} as d, c.idx as idx))) as best")
        .selectExpr("p.*", "best.idx as idx", "best.d as dist2")
    )


def _checked_table(centres: DataFrame) -> DataFrame:
    """The centres, stored, once they are seen to be sound."""
    centres = stored(centres.selectExpr("cast(idx as int) as idx", "cast(x as int) as x", "cast(y as int) as y"), "seeds")
    checked = centres.agg(
        F.expr("count(*) as n"), F.expr("count(distinct idx) as ids"), F.expr("count_if(x is null or y is null or idx is null) as nulls")
    ).first()
    if checked["nulls"]:
        raise ValueError("a seed has a null idx, x or y")
    if checked["ids"] < checked["n"]:
        raise ValueError("seeds share an idx")
    return centres


def _checked_literals(given: Sequence[Row]) -> Sequence[Row]:
    if any(value is None for seed in given for value in seed):
        raise ValueError("a seed has a null idx, x or y")
    centres = sorted(given, key=lambda seed: seed["idx"])
    if len({seed["idx"] for seed in centres}) < len(centres):
        raise ValueError("seeds share an idx")
    return centres


def _bounds(points: DataFrame, centres: DataFrame) -> tuple[tuple[int, int], int]:
    """Corner and extent of the square that holds points and centres."""
    ends = [f"{f}({c}) as {f}{c}" for f in ("min", "max") for c in "xy"]
    box = points.select("x", "y").unionByName(centres.select("x", "y")).selectExpr(*ends).first()
    return (box["minx"], box["miny"]), max(box["maxx"] - box["minx"], box["maxy"] - box["miny"])


def assign_centres(
    points: DataFrame, centres: DataFrame, literal_centres: int = LITERAL_CENTRES, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every point, with all its columns, ``idx`` of its nearest centre and ``dist2``, the square of the distance.

    Ties go to the lowest idx. Both are exact; a square beyond 63 bits is an error. Points without a coordinate
    are left out, and columns named idx or dist2 are refused.

    Up to ``literal_centres`` centres are part of the plan: points stream through without a shuffle. More of them
    are a table looked up by the cell of the point, which holds the few centres that can be nearest there;
    it is broadcast if measured small and joined by shuffle else. Their number has no limit.
    """
    if clash := {"idx", "dist2"} & set(points.columns):
        raise ValueError(f"points have columns {sorted(clash)}")
    placed = points.where("x is not null and y is not null").withColumns({c: F.col(c).cast("int") for c in "xy"})
    given = centres.select("idx", "x", "y").limit(literal_centres + 1).collect()
    if not given:
        raise ValueError("no centres")
    if len(given) <= literal_centres:
        rows = _checked_literals(given)
        lists = {c: f"array({', '.join(str(row[c]) for row in rows)})" for c in ("idx", "x", "y")}
        place = "_place_of_centre"
        gap = {c: f"(cast({c} as bigint) - {lists[c]}[{place}])" for c in "xy"}
        return (
            placed.withColumn(place, nearest_centre("x", "y", rows))
            .selectExpr("*", f"{lists['idx']}[{place}] as idx", f"{gap['x']} * {gap['x']} + {gap['y']} * {gap['y']} as dist2")
            .drop(place)
        )
    table = _checked_table(centres)
    low, extent = _bounds(placed, table)
    cells = stored(candidate_cells(table, low, max(1, extent.bit_length())), "cells")
    return _assigned(placed, cells, low, extent, broadcast_bytes).withColumn("dist2", F.col("dist2").cast("long"))


def _kmeans_by_cells(
    points: DataFrame, seeds: DataFrame, max_iter: int, tol: int, history: bool, broadcast_bytes: int
) -> DataFrame:
    """``kmeans`` with the centres in a table: neither the driver nor the plan's text grows with them."""
    centres = _checked_table(seeds)
    low, extent = _bounds(points, centres)
    bits = max(1, extent.bit_length())
    rounds = []
    for iteration in range(max_iter):
        path = new_path(points.sparkSession, "centres")
        # What a round looks up is gone after it; only its centres stay.
        with artefacts(points.sparkSession):
            cells = stored(candidate_cells(centres, low, bits), "cells")
            # Stored: a join straight on it would push a test for nulls, and with it the whole search, below again.
            sums = stored(
                _assigned(points, cells, low, extent, broadcast_bytes)
                .groupBy("idx")
                .agg(F.expr("sum(x) as sx"), F.expr("sum(y) as sy"), F.expr("count(*) as n")),
                "sums",
            )
            moved = sums.selectExpr("idx", "cast(sx div n as int) as x", "cast(sy div n as int) as y").join(
                centres.selectExpr("idx", "x as ox", "y as oy"), "idx"
            )
            gap = " + ".join(f"pow(cast({c} as double) - o{c}, 2)" for c in "xy")
            states = stored(
                moved.selectExpr(f"{iteration} as iteration", "idx", "x", "y", f"if({gap} >= {float(tol) ** 2}D, 'CHANGED', 'UNCHANGED') as status"),
                "centres", path=path,
            )
        rounds.append(states)
        if states.where("status = 'CHANGED'").isEmpty():
            break
        centres = states.select("idx", "x", "y")
    return reduce(DataFrame.unionByName, rounds) if history else rounds[-1].drop("iteration")


def kmeans(
    points: DataFrame,
    seeds: DataFrame,
    max_iter: int = 6,
    tol: int = 1,
    history: bool = False,
    literal_centres: int = LITERAL_CENTRES,
    broadcast_bytes: int = BROADCAST_BYTES,
    reuse_points: int = REUSE_POINTS,
) -> DataFrame:
    """Lloyd's iterations from ``seeds`` (idx, x, y) to final centres (idx, x, y, status).

    A point goes to its nearest centre, the lowest idx on ties; a new centre is the mean of its
    points truncated to integers. A centre left without points disappears. It ends when no centre
    moved by ``tol`` or more, or after ``max_iter`` rounds. ``history=True`` returns the centres
    of every round, with its number from 0.

    A round is one scan with a map-side aggregate to k rows. Up to ``literal_centres`` centres are
    literals: points are never shuffled, only k rows pass through the driver, lineage does not grow,
    and a lost executor costs its tasks only. With more of them the centres are a checkpointed table;
    a point meets only those that can be nearest to it, through a grid of cells that is broadcast
    if it is measured small and joined by shuffle otherwise. The rows are the same either way, for any
    number of seeds.

    From ``reuse_points`` points on, and with literal centres, they are written once in the order of a grid's
    cells, with the sums of each cell (``PlacedPoints``). A round then adds up cells that one centre
    owns and reads the points of the others, which lie on borders; the files are gone when it ends. The input
    is evaluated three times in all, whatever the number of rounds. Fewer points are scanned once a round.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    given = seeds.select("idx", "x", "y").limit(literal_centres + 1).collect()
    if not given:
        raise ValueError("no seeds")
    if len(given) > literal_centres:
        placed = points.where("x is not null and y is not null").selectExpr("cast(x as int) as x", "cast(y as int) as y")
        return _kmeans_by_cells(placed, seeds, max_iter, tol, history, broadcast_bytes)
    centres = _checked_literals(given)
    placed = points.where("x is not null and y is not null").selectExpr(
        "cast(x as int) as x", "cast(y as int) as y"
    )
    spark: SparkSession = points.sparkSession
    rounds: list[list[Row]] = []
    with artefacts(spark):
        reuse = max_iter > 1 and points.count() >= reuse_points
        source = PlacedPoints(placed) if reuse else placed
        for iteration in range(max_iter):
            states = _step(source, centres, tol, iteration, broadcast_bytes)
            rounds.append(states)
            if not any(state["status"] == "CHANGED" for state in states):
                break
            centres = states

    kept = [state for states in (rounds if history else rounds[-1:]) for state in states]
    result = spark.createDataFrame([tuple(state) for state in kept], _STATES)
    return result if history else result.drop("iteration")
