"""Nearest neighbours by inner product: a robust-pruned directed graph for each shard, beam search."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
#: How much nearer a kept neighbour must be to a candidate than the point itself, to make it needless.
RELAX = 1.2
_FAR = np.float32(np.inf)
#: Points of a beam that one step expands, and queries that walk together.
_STRIDE = 8
_WALKERS = 256
#: Powers of two that the longest components of a shard's vectors span.
_BAND = 16


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that makes all norms equal, so that the nearest by distance
    are those with the largest inner product with a query. Their largest component becomes 1 before
    anything is squared, so that no value overflows."""
    vectors = vectors / np.abs(vectors).max()
    squares = np.einsum("nd,nd->n", vectors, vectors, dtype=np.float64)
    last = np.sqrt(np.maximum(squares.max() - squares, 0.0))
    return np.column_stack([vectors, last]).astype(np.float32)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` points found nearest to each query, nearest first: indices (-1 where fewer) and squared distances."""
    norms = np.einsum("nd,nd->n", points, points)
    parts = [_walk(points, norms, edges, entry, queries[at : at + _WALKERS], beam) for at in range(0, max(len(queries), 1), _WALKERS)]
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([far for _, far in parts])


def _walk(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """``beam_search`` for some queries that walk together. Each step expands, for every query, the nearest
    points of its beam that are not expanded yet, ``_STRIDE`` at a time; a query is done when its whole beam is.
    """
    count = len(queries)
    own = np.einsum("nd,nd->n", queries, queries)
    # Beams in order of distance, the empty places last.
    ids = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), _FAR)
    done = np.ones((count, beam), bool)
    # A point that was met once is not measured again, whether it is still in the beam or not.
    met = np.zeros((count, len(points)), bool)
    met[:, entry] = True
    last = np.empty((count, len(points)), np.int32)
    ids[:, 0] = entry
    far[:, 0] = norms[entry] + own - 2 * (queries @ points[entry])
    done[:, 0] = False
    active = np.arange(count)
    while len(active):
        unseen = ~done[active]
        row, column = np.nonzero(unseen & (np.cumsum(unseen, axis=1, dtype=np.int32) <= _STRIDE))
        asking = active[row]
        done[asking, column] = True
        near = edges[ids[asking, column]]
        asking = np.broadcast_to(asking[:, None], near.shape)
        fresh = (near >= 0) & ~met[asking, np.maximum(near, 0)]
        asking, near = asking[fresh], near[fresh]
        # Of a point that several expanded ones lead to, one is kept.
        turn = np.arange(len(near), dtype=np.int32)
        last[asking, near] = turn
        once = last[asking, near] == turn
        asking, near = asking[once], near[once]
        met[asking, near] = True
        reach = norms[near] + own[asking] - 2 * np.einsum("nd,nd->n", points[near], queries[asking])
        better = reach < far[asking, -1]
        asking, near, reach = asking[better], near[better], reach[better]
        if len(near):
            movers, row, counts = np.unique(asking, return_inverse=True, return_counts=True)
            column = beam + np.arange(len(near)) - np.repeat(np.cumsum(counts) - counts, counts)
            width = beam + int(counts.max())
            all_ids = np.full((len(movers), width), -1, np.int64)
            all_far = np.full((len(movers), width), _FAR)
            all_done = np.ones((len(movers), width), bool)
            all_ids[:, :beam], all_far[:, :beam], all_done[:, :beam] = ids[movers], far[movers], done[movers]
            all_ids[row, column], all_far[row, column], all_done[row, column] = near, reach, False
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[movers] = np.take_along_axis(all_ids, best, 1)
            far[movers] = np.take_along_axis(all_far, best, 1)
            done[movers] = np.take_along_axis(all_done, best, 1)
        active = active[~done[active].all(axis=1)]
    return ids, far


def robust_prune(points: np.ndarray, nodes: np.ndarray, options: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` neighbours for each node out of its row of ``options`` (-1 for none).

    The nearest option is kept, and every option that is nearer to it, by the factor ``relax``, than
    to the node is dropped; and so on with what is left.
    """
    options = np.sort(options, axis=1)
    options[:, 1:][options[:, 1:] == options[:, :-1]] = -1
    options[options == nodes[:, None]] = -1
    # Seen from the node, so that distances between its options keep their digits.
    given = points[np.maximum(options, 0)] - points[nodes][:, None]
    to_node = np.einsum("nod,nod->no", given, given)
    to_node[options < 0] = _FAR
    order = np.argsort(to_node, axis=1, kind="stable")
    options, to_node = np.take_along_axis(options, order, 1), np.take_along_axis(to_node, order, 1)
    given = np.take_along_axis(given, order[:, :, None], 1)
    kept = np.full((len(nodes), degree), -1, np.int64)
    open_far = to_node.copy()
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = open_far.argmin(axis=1)
        found = open_far[rows, first] < _FAR
        if not found.any():
            break
        kept[found, k] = options[rows, first][found]
        dots = np.matmul(given, given[rows, first][:, :, None])[:, :, 0]
        between = to_node + to_node[rows, first][:, None] - 2 * dots
        needless = relax * relax * between <= to_node
        needless[rows, first] = True
        open_far[needless & found[:, None]] = _FAR
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """Edges (n x degree or a little more, -1 for none) of a robust-pruned graph, and the point that searches enter at.

    Points join in random order, in batches that double: each searches the graph so far, and prunes what
    it met; its neighbours get an edge back, and prune when they are full.
    """
    count = len(points)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((count, degree), -1, np.int64)
    order = np.random.default_rng(7).permutation(count)
    order = np.concatenate([[entry], order[order != entry]])
    begin, size = 1, 1
    while begin < count:
        batch = order[begin : begin + size]
        met, _ = beam_search(points, edges, entry, points[batch], beam)
        options = met if begin > 1 or len(batch) == 1 else np.concatenate([met, batch[None, :].repeat(len(batch), 0)], axis=1)
        edges[batch] = robust_prune(points, batch, options.copy(), degree, relax)
        ends = edges[batch]
        src = np.repeat(batch, degree)[ends.ravel() >= 0]
        dst = ends.ravel()[ends.ravel() >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        nodes, firsts, counts = np.unique(dst, return_index=True, return_counts=True)
        # Back edges of one node, in rows as wide as the most that any node got, a bounded part at a time.
        for part in np.array_split(np.argsort(counts, kind="stable"), max(1, len(nodes) // 512)):
            if not len(part):
                continue
            width = int(counts[part].max())
            at = firsts[part][:, None] + np.arange(width)
            added = np.where(np.arange(width) < counts[part][:, None], src[np.minimum(at, len(src) - 1)], -1)
            edges[nodes[part]] = robust_prune(points, nodes[part], np.concatenate([edges[nodes[part]], added], axis=1), degree, relax)
        begin += len(batch)
        size = min(2 * size, max(64, begin // 8))
    return all_reached(points, edges, entry), entry


def all_reached(points: np.ndarray, edges: np.ndarray, entry: int) -> np.ndarray:
    """``edges`` with one more from a point's nearest reached one wherever pruning left no way to it, in
    columns of their own."""
    reached = np.zeros(len(points), bool)

    def spread(front: np.ndarray) -> None:
        reached[front] = True
        while len(front):
            near = np.unique(edges[front])
            front = near[(near >= 0) & ~reached[near]]
            reached[front] = True

    spread(np.array([entry]))
    more: dict[int, list[int]] = {}
    for node in np.flatnonzero(~reached):
        if reached[node]:
            continue
        gaps = np.where(reached, ((points - points[node]) ** 2).sum(axis=1), _FAR)
        more.setdefault(int(gaps.argmin()), []).append(int(node))
        spread(np.array([node]))
    if not more:
        return edges
    added = np.full((len(edges), max(map(len, more.values()))), -1, edges.dtype)
    for node, ends in more.items():
        added[node, : len(ends)] = ends
    return np.concatenate([edges, added], axis=1)


def _usable(column: str) -> str:
    return (
        f"{column} is not null and size({column}) > 0 and forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) "
        f"and exists({column}, x -> x <> 0)"
    )


def nearest_neighbours(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_step: int = 20,
    k: int = 20,
    shards: int = 8,
    shard_rows: int = 8192,
    query_rows: int = 8192,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """For each row whose id is divisible by ``query_step``, the ``k`` other rows with the largest
    inner product that the graphs find: query_id, rank (from 1), vec_id, score.

    Equal vectors become one point, for which the ``k + 1`` smallest ids are kept, so copies neither
    crowd the graph nor meet in one task. Points are dealt by hash over ``shards`` shards, or as many
    more as keep a shard at about ``shard_rows``. A graph is built for each shard, written to the
    shared folder with its vectors, and searched by the queries in blocks of ``query_rows``. Scores are
    inner products of the original vectors in double precision; ties go to the smaller id.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows
    without an id. All others must have one length. Repeated rows (one id, one vector) count once. An empty table
    gives no rows. Other columns are not read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = stored(rows.where(f"id is not null and {_usable('v')}").withColumn("key", F.xxhash64("v")), "vectors")
    first = F.row_number().over(Window.partitionBy("key", "v").orderBy("id"))
    copies = rows.distinct().withColumn("n", first).where(F.col("n") <= k + 1)
    points = copies.groupBy("key", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = stored(points, "points")
    # Lengths of one shard are within some powers of two, which single precision can hold side by side.
    points = points.withColumn("band", F.floor(F.log2(F.array_max(F.transform("v", F.abs))) / _BAND))
    sizes = {row["band"]: row["count"] for row in points.groupBy("band").count().collect()}
    firsts, n_shards = {}, 0
    for band in sorted(sizes):
        firsts[band] = n_shards, max(math.ceil(shards * sizes[band] / sum(sizes.values())), math.ceil(sizes[band] / shard_rows))
        n_shards += firsts[band][1]
    # At most one entry for each power that a double can have.
    bands = F.create_map(*[x for band, (first, n) in firsts.items() for x in (F.lit(band).cast("long"), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n")))]) if firsts else None
    queries = rows.where(F.col("id") % query_step == 0).select(F.col("id").alias("query_id"), "v").distinct()
    n_blocks = max(1, math.ceil(queries.count() / query_rows))

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(shard["v"].to_numpy()).astype(np.float64)
        edges, entry = build_graph(_lifted(matrix))
        return pd.DataFrame(
            {"shard": shard["shard"], "node": np.arange(len(shard)), "entry": entry, "v": shard["v"], "ids": shard["ids"], "edges": list(edges)}
        )

    graph = stored(
        points.withColumn("_of", bands[F.col("band")] if firsts else F.struct(F.lit(0).alias("first"), F.lit(1).alias("n")))
        .select("v", "ids", (F.col("_of.first") + F.pmod("key", F.col("_of.n"))).cast("int").alias("shard"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, node int, entry int, v array<double>, ids array<long>, edges array<int>"),
        "graph",
    )

    def search(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(nodes) or not len(asked):
            return pd.DataFrame({c: [] for c in columns})
        nodes = nodes.sort_values("node")
        matrix = np.stack(nodes["v"].to_numpy()).astype(np.float64)
        edges = np.stack(nodes["edges"].to_numpy()).astype(np.int64)
        ids = nodes["ids"].to_numpy()
        smallest = np.array([own[0] for own in ids])
        points, entry = _lifted(matrix), int(nodes["entry"].iloc[0])
        out = []
        query_ids = asked["query_id"].to_numpy()
        wanted = np.stack(asked["v"].to_numpy()).astype(np.float64)
        for at in range(0, len(asked), 1024):
            part = wanted[at : at + 1024]
            found, _ = beam_search(points, edges, entry, np.column_stack([part / np.abs(part).max(axis=1, keepdims=True), np.zeros(len(part))]).astype(np.float32), max(beam, k + 1))
            for query, vector, hits in zip(query_ids[at : at + 1024], part, found):
                hits = hits[hits >= 0]
                scores = matrix[hits] @ vector
                hits, scores = hits[~np.isnan(scores)], scores[~np.isnan(scores)]
                order = np.lexsort((smallest[hits], -scores))[: k + 1]
                for hit, score in zip(hits[order], scores[order]):
                    out += [(query, other, score) for other in ids[hit] if other != query]
        return pd.DataFrame(out, columns=columns)

    spread = graph.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(max(n_shards, 1) - 1)))
    )
    found = (
        spread.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(search, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
