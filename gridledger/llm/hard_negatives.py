"""Hard negatives: rows of another label that score close below an anchor's positives.

Anchors lie in blocks, each with a minimum spanning tree. What a candidate scores at an anchor is bounded
by what it scores at the anchor's parent: the two differ by at most the edge's length times the candidate's
norm. Only candidates whose bounds meet a window that an anchor still asks for are scored there.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.artefacts import stored

#: Anchors of one tree.
BLOCK = 512
#: Candidates that a tree is walked with at a time: bounds the memory of a walk.
SLICE = 2048
#: Bytes of anchors that are broadcast at once; more are further passes over the candidates.
CHUNK_BYTES = 16 << 20

_INT64 = np.iinfo(np.int64)
# Sums of whole numbers are exact in doubles up to here.
_EXACT = float(1 << 53)
_BLOCKS = T.StructType([T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType())])
_HITS = T.StructType([T.StructField(name, T.LongType()) for name in ("anchor", "window", "vec_id", "score")])


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the rows, the place of each one's parent in that order (-1 first), and the edge's length."""
    n = len(vectors)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    best, via = np.full(n, np.inf), np.zeros(n, int)
    order, place = np.empty(n, int), np.empty(n, int)
    parent, edge = np.full(n, -1), np.zeros(n)
    outside = np.ones(n, bool)
    now = 0
    for step in range(n):
        order[step], place[now], outside[now] = now, step, False
        if step:
            parent[step] = place[via[now]]
            edge[step] = np.linalg.norm(vectors[now] - vectors[via[now]])
        gaps = np.maximum(squares + squares[now] - 2 * (vectors @ vectors[now]), 0)
        closer = outside & (gaps < best)
        best[closer], via[closer] = gaps[closer], now
        now = int(np.argmin(np.where(outside, best, np.inf))) if step + 1 < n else now
        if step + 1 < n and not outside[now]:  # all that is left is infinitely far
            now = int(np.argmax(outside))
    return order, parent, edge


def _scores(vectors: np.ndarray, norms: np.ndarray, anchor: np.ndarray, norm: float) -> np.ndarray:
    """Whole-number inner products; those beyond 64 bits are held at the ends of the range."""
    if not len(norms) or norms.max() * norm < _EXACT:
        return (vectors @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    exact = [sum(int(x) * y for x, y in zip(row, whole)) for row in vectors]
    return np.array([min(max(s, _INT64.min), _INT64.max) for s in exact], np.int64)


class AnchorBlock:
    """The anchors of one tree, in its order, and the best candidates that each window has met.

    ``windows`` lists (low, high) for each anchor; ``same`` says whether candidates share the anchor's
    label. A window keeps the first ``top`` candidates by falling score, then id. ``scored`` counts the pairs
    that were scored, of ``pairs`` met.
    """

    def __init__(self, keys, ids, labels, vectors, windows, same: bool, top: int) -> None:
        order, self.parent, self.edge = spanning_tree(vectors)
        self.keys, self.ids, self.labels, self.vectors = keys[order], ids[order], labels[order], vectors[order]
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.windows = [windows[i] for i in order]
        self.same, self.top = same, top
        empty = np.empty(0, np.int64)
        self.best = [[(empty, empty) for _ in spans] for spans in self.windows]
        self.scored = self.pairs = 0

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        for start in range(0, len(ids), SLICE):
            part = slice(start, start + SLICE)
            self._walk(ids[part], labels[part], vectors[part], norms[part])

    def _walk(self, ids, labels, vectors, norms) -> None:
        low = np.empty((len(self.ids), len(ids)))
        high = np.empty_like(low)
        self.pairs += low.size
        for a, parent in enumerate(self.parent):
            if parent < 0:
                wanted = np.arange(len(ids))
            else:
                # A little more than the bound, for what doubles round.
                reach = norms * (self.edge[a] * (1 + 1e-9)) + 1 + 1e-9 * np.abs(low[parent])
                np.subtract(low[parent], reach, out=low[a])
                np.add(high[parent], reach, out=high[a])
                asked = self._asked(a)
                if asked is None:
                    continue
                fits = (labels == self.labels[a]) if self.same else (labels != self.labels[a])
                wanted = np.flatnonzero(fits & (high[a] >= asked[0]) & (low[a] <= asked[1]))
            scores = _scores(vectors[wanted], norms[wanted], self.vectors[a], self.norms[a])
            low[a, wanted] = high[a, wanted] = scores
            self.scored += len(wanted)
            fits = ((labels[wanted] == self.labels[a]) == self.same) & (ids[wanted] != self.ids[a])
            self._keep(a, ids[wanted][fits], scores[fits])

    def _floor(self, a: int, w: int) -> int:
        """The least score that can still get into a window."""
        scores = self.best[a][w][1]
        low = self.windows[a][w][0]
        return max(low, int(scores[-1])) if len(scores) == self.top else low

    def _asked(self, a: int) -> tuple[float, float] | None:
        spans = [(self._floor(a, w), high) for w, (_, high) in enumerate(self.windows[a]) if high >= self._floor(a, w)]
        if not spans:
            return None
        # Doubles are coarser than whole numbers beyond 2**53.
        least, most = float(min(s[0] for s in spans)), float(max(s[1] for s in spans))
        return least - abs(least) * 1e-15, most + abs(most) * 1e-15

    def _keep(self, a: int, ids: np.ndarray, scores: np.ndarray) -> None:
        for w, (_, high) in enumerate(self.windows[a]):
            inside = (scores >= self._floor(a, w)) & (scores <= high)
            if not inside.any():
                continue
            all_ids = np.concatenate([self.best[a][w][0], ids[inside]])
            all_scores = np.concatenate([self.best[a][w][1], scores[inside]])
            # ~s falls as s rises, without the overflow of -s.
            first = np.lexsort((all_ids, ~all_scores))[: self.top]
            self.best[a][w] = all_ids[first], all_scores[first]

    def found(self) -> Iterator[tuple[int, int, int, int]]:
        for key, spans in zip(self.keys, self.best):
            for w, (ids, scores) in enumerate(spans):
                for i, s in zip(ids, scores):
                    yield int(key), w, int(i), int(s)


def _matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch, scaled to whole numbers, by length: (rows, matrix)."""
    lists = batch.column(column)
    sizes = np.asarray(pc.list_value_length(lists))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        flat = pc.list_flatten(lists.take(pa.array(rows)))
        matrix = np.asarray(flat).astype(np.float64).reshape(len(rows), size)
        yield rows, np.floor(256.0 * matrix)


def scaled_rows(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, v): rows that take part, labels as the search sees them, written once.

    A null id, label or vector, or a null or non-finite component, keeps a row out.
    """
    sound = "forall(v, x -> x is not null and not isnan(x) and abs(x) < float('infinity'))"
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    vector = "embedding" if kind in ("float", "double") else "cast(embedding as array<double>)"
    return stored(
        vectors.selectExpr("monotonically_increasing_id() as row", "vec_id", "cast(label as bigint) as label", f"{vector} as v")
        .where(f"vec_id is not null and label is not null and v is not null and {sound}")
        .withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")),
        "scaled-vectors",
    )


def _blocks(anchors: DataFrame, block: int, same: bool, top: int) -> DataFrame:
    """Anchors (row, vec_id, label, v, positives) as blocks of like ones, each with its tree.

    Rows are dealt to ranges of (length, label, sum of components) that hold a few blocks each, and ordered by
    their strongest direction there, so that neighbours in a tree are close.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 4 * block):
                piece = batch.slice(start, 4 * block)
                for rows, matrix in _matrices(piece, 3):
                    # A slice can have only so many anchors, so the direction is a small matter.
                    lead = matrix[:, 0] if matrix.shape[1] else np.zeros(len(rows))
                    if matrix.shape[1] > 1:
                        lead = matrix @ np.linalg.svd(matrix - matrix.mean(0), full_matrices=False)[2][0]
                    keys, ids, labels = (np.asarray(piece.column(c)).astype(np.int64)[rows] for c in range(3))
                    spans = [piece.column(4)[int(r)].as_py() for r in rows]
                    spans = [[(-(-4 * p // 5), p) for p in s] if s is not None else [(_INT64.min, _INT64.max)] for s in spans]
                    order = np.lexsort((lead, labels))
                    for first in range(0, len(order), block):
                        own = order[first : first + block]
                        made = AnchorBlock(keys[own], ids[own], labels[own], matrix[own], [spans[i] for i in own], same, top)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(keys[own].min())]), pa.array([pickle.dumps(made)], pa.binary())], ["block", "payload"]
                        )

    ranges = max(1, anchors.count() // (4 * block))
    placed = anchors.select("row", "vec_id", "label", "v", "positives").repartitionByRange(
        ranges, F.size("v"), "label", F.aggregate("v", F.lit(0.0), lambda total, x: total + x), "row"
    )
    return stored(placed.mapInArrow(run, _BLOCKS), "anchor-blocks")


def _search(rows: DataFrame, anchors: DataFrame, same: bool, top: int, block: int, chunk_bytes: int) -> DataFrame:
    """(anchor, window, vec_id, score): the first ``top`` candidates of each window of each anchor.

    Each task walks every tree of the chunk with its candidates and hands on the best it met; blocks of
    anchors meet all rows, a chunk of bounded size at a time. The driver sees the sizes of all blocks
    and the anchors of one chunk, never candidates or results.
    """
    spark = rows.sparkSession
    blocks = _blocks(anchors, block, same, top)
    chunks: list[list[int]] = []
    room = 0
    for row in blocks.select("block", F.octet_length("payload").alias("bytes")).orderBy("block").collect():
        if not chunks or room < row["bytes"]:
            chunks.append([])
            room = chunk_bytes
        chunks[-1].append(row["block"])
        room -= row["bytes"]

    def scan(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = [pickle.loads(payload) for payload in shared.value]
            for batch in batches:
                ids, labels = (np.asarray(batch.column(c)).astype(np.int64) for c in (0, 1))
                for own, matrix in _matrices(batch, 2):
                    for tree in trees:
                        if tree.vectors.shape[1] == matrix.shape[1]:
                            tree.meet(ids[own], labels[own], matrix)
            for tree in trees:
                hits = np.array(list(tree.found()), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in hits.T], _HITS.names)

        return rows.select("vec_id", "label", "v").mapInArrow(run, _HITS)

    hits = None
    for chunk in chunks:
        payloads = [bytes(r["payload"]) for r in blocks.where(F.col("block").between(chunk[0], chunk[-1])).collect()]
        shared = spark.sparkContext.broadcast(payloads)
        part = stored(scan(shared), "hits")
        shared.unpersist()
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = spark.createDataFrame([], _HITS)
    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(first)).where(f"rank <= {top}")


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, block: int = BLOCK, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """For each anchor and positive the nearest rows of another label with 0.8 to 1 times its score.

    Components are floor(256 x), scores whole inner products. Anchors are rows whose ``vec_id`` is
    divisible by ``every``; positives are an anchor's first rows of the same label. Both searches walk
    the same trees: the first with one open window for each anchor, whose lower end rises with what it
    has found, the second with a window for each positive. Bounds only spare scores, so results are exact.

    Rows without vec_id, label or vector, or with a component that is null or not finite, take no part. Vectors
    of different length have no score. Repeated rows count as often as they occur, as anchors too, but rows that
    share an id are not partners. Scores beyond 64 bits are held at the ends of that range. An empty
    table, or one without anchors, gives no rows.
    """
    rows = scaled_rows(vectors)
    anchors = rows.where(f"vec_id % {every} = 0")
    open_window = anchors.withColumn("positives", F.lit(None).cast("array<bigint>"))
    found = stored(_search(rows, open_window, True, positives, block, chunk_bytes), "positives")
    wanted = found.groupBy("anchor").agg(F.expr("transform(array_sort(collect_list(struct(rank, score))), p -> p.score) as positives"))
    asking = anchors.join(wanted, anchors["row"] == wanted["anchor"]).drop("anchor")
    hits = _search(rows, asking, False, negatives, block, chunk_bytes)
    named = found.select("anchor", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        hits.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score")
        .join(named, ["anchor", "window"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
