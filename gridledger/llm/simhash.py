"""SimHash near-duplicates: exact linking of fingerprints by tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import add_columns, join_marks, small, stored

BITS = 64
#: Rows and columns of a compared tile.
TILE = 512
#: Fingerprints of one unit of comparison, unless a unit pairs two tiles of a large bucket.
UNIT = 4096
_AT_ONCE = 1 << 16


def fingerprint(raw: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash over the word shingles of a text's UTF-8 bytes, as a signed long."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [end + i for i, end in enumerate(accumulate(map(len, words)))]
    starts = [0, *(end + 1 for end in ends[:-1])]
    spans = list(zip(starts, ends[min(shingle, len(words)) - 1 :]))
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(spans), _AT_ONCE):
        hashes = b"".join([digest(joined[a:b], 42) for a, b in spans[at : at + _AT_ONCE]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """The carried columns and ``fp``, the fingerprint of the text (BIGINT)."""
    carry = docs.columns if carry is None else carry
    return add_columns(
        docs, text_col, carry, [("fp", pa.int64(), T.LongType())],
        lambda texts: [[fingerprint(raw, shingle) for raw in texts]],
    )


def linked(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the position of a representative of its linked set among ``fps``.

    ``fps`` (uint64) is in order of population count. Tiles are compared by exclusive-or and bit
    count; a pair of tiles whose population counts differ by more than ``radius`` is skipped.
    """
    root = np.arange(len(fps))
    pops = np.bitwise_count(fps).astype(np.int64)
    for i in range(0, len(fps), TILE):
        top = pops[min(i + TILE, len(fps)) - 1]
        for j in range(i, len(fps), TILE):
            if pops[j] - top > radius:
                break
            a, b = np.nonzero(np.bitwise_count(fps[i : i + TILE, None] ^ fps[None, j : j + TILE]) <= radius)
            a, b = a + i, b + j
            while True:
                ra, rb = root[a], root[b]
                apart = ra != rb
                if not apart.any():
                    break
                a, b = a[apart], b[apart]
                to = np.arange(len(fps))
                np.minimum.at(to, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
                while not np.array_equal(to, to[to]):
                    to = to[to]
                root = to[root]
    return root


def _link_units(radius: int):
    """Reads (unit, fp) in order of unit and population count; yields links (fp, other) that connect
    what each unit holds: one less than it has members at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((0, 4), np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            at = np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))[0] + 1
            left, right = [], []
            for begin, end in zip([0, *at.tolist()], [*at.tolist(), len(rows)]):
                if end - begin == 1:
                    continue
                signed = rows[begin:end, 3]
                if end - begin == 2:
                    if (int(signed[0]) ^ int(signed[1])) & (2**BITS - 1) and (
                        (int(signed[0]) ^ int(signed[1])) & (2**BITS - 1)
                    ).bit_count() <= radius:
                        left.append(signed[1:])
                        right.append(signed[:1])
                    continue
                root = linked(signed.view(np.uint64), radius)
                moved = np.nonzero(root != np.arange(len(root)))[0]
                left.append(signed[moved])
                right.append(signed[root[moved]])
            columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["fp", "other"])

        for batch in batches:
            rows = np.concatenate([rest, np.column_stack([c.to_numpy() for c in batch.columns])])
            # The last unit may go on in the next batch.
            cut = np.nonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))[0]
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if cut:
                yield links(np.ascontiguousarray(rows[:cut]))
            rest = rows[cut:]
        if len(rest):
            yield links(np.ascontiguousarray(rest))

    return run


def fingerprint_links(fps: DataFrame, radius: int = 2, unit: int = UNIT) -> DataFrame:
    """Links (fp, other) that connect exactly the distinct ``fp`` within ``radius`` bits of each other.

    Two fingerprints within ``radius`` agree on one of ``radius + 1`` blocks of bits, so only those
    that share a block's value (a bucket) are compared. A bucket of at most ``unit`` members is one
    unit of work. A larger one is cut by population count, and counts with many members into slices;
    a unit is then a pair of slices whose counts differ by ``radius`` at most, so a hot bucket is
    spread over many tasks. Links are not all pairs: each unit gives a spanning set.
    """
    width = BITS // (radius + 1)
    cuts = [i * width for i in range(radius + 1)] + [BITS]
    blocks = [
        F.struct(
            F.lit(b).cast("long").alias("block"),
            (F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))).alias("value"),
        )
        for b, (low, high) in enumerate(zip(cuts, cuts[1:]))
    ]
    members = fps.select("fp", F.bit_count("fp").alias("pop"), F.explode(F.array(*blocks)).alias("bucket")).select(
        "fp", "pop", ((F.col("bucket.block") * F.lit(1 << 58)) + F.col("bucket.value")).alias("bucket")
    )
    buckets = (
        members.groupBy("bucket", "pop")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.sum("n").alias("total"), F.collect_list(F.struct("pop", "n")).alias("pops"))
        .where("total > 1")
    )
    # A tile is a population count and a slice of those that have it: pop * 2^32 + slice.
    slices = f"transform(sequence(0L, ceil(x.n / {unit}) - 1), s -> x.pop * 4294967296L + s)"
    near = f"flatten(transform(filter(pops, x -> abs(x.pop - pop) <= {radius}), x -> {slices}))"
    own_n = "element_at(filter(pops, x -> x.pop = pop), 1).n"
    tiled = (
        members.join(buckets, "bucket")
        .withColumn("own", F.expr(f"pop * 4294967296L + pmod(xxhash64(fp), cast(ceil({own_n} / {unit}) as bigint))"))
        .withColumn(
            "units",
            F.expr(
                f"if(total <= {unit}, array(struct(0L as low, 0L as high)), "
                f"transform({near}, t -> struct(least(own, t) as low, greatest(own, t) as high)))"
            ),
        )
    )
    units = tiled.select("bucket", "pop", "fp", F.explode("units").alias("unit")).select(
        "bucket", F.col("unit.low").alias("low"), F.col("unit.high").alias("high"), "pop", "fp"
    )
    return (
        units.repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high", "pop")
        .select("bucket", "low", "high", "fp")
        .mapInArrow(_link_units(radius), "fp long, other long")
    )


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (fp, other): root is the least node it can reach.

    Rounds of large and small stars, each a grouping and a join, until every link points at a root.
    Each round is written to the shared folder, so lineage does not grow and nothing is gathered.
    """
    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    current = stored(tidy(links.select(F.col("fp").alias("a"), F.col("other").alias("b"))), "links")
    while True:
        # Large star: each node hands its larger neighbours to the least node around it.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = tidy(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # Small star: each node hands its smaller neighbours, and itself, to the least of them.
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = stored(tidy(moved.unionByName(lower.withColumnRenamed("m", "b"))), "links")
        # Done when no node has two targets and none is both a target and a source.
        sources = following.select(F.col("b").alias("a"), F.lit(0).alias("out"))
        targets = sources.unionByName(following.select("a", F.lit(1).alias("out")))
        unfinished = targets.groupBy("a").agg(F.sum("out").alias("outs"), F.min("out").alias("least")).where(
            "outs > 1 or (outs = 1 and least = 0)"
        )
        current = following
        if unfinished.isEmpty():
            break
    roots = current.select(F.col("b").alias("a")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("root"))
    )


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, unit: int = UNIT
) -> DataFrame:
    """One row for each document: doc_id, fp and component_id.

    ASCII letters are lower-cased, words are separated by ASCII white space, and a text of fewer
    words than a shingle is one shingle; without a word the fingerprint is zero. Documents whose
    fingerprints differ in at most ``radius`` bits are linked, and ``component_id`` is the smallest
    doc_id that links lead to (null if all of them are null). Null and empty texts share fingerprint
    zero and link like any other. Repeated rows each give a row; an empty table none. Other columns
    are not read.
    """
    return _rooted(docs, id_col, text_col, shingle, radius, unit).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, unit: int = UNIT) -> DataFrame:
    """``simhash_components`` with ``root``, the fingerprint that names the component."""
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = stored(fingerprints(ids, "text", ["doc_id"], shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    linked_fps = connected(fingerprint_links(distinct, radius, unit))
    rooted = distinct.join(linked_fps, distinct["fp"] == linked_fps["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted-fingerprints")
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(first, "root").select("fp", "root", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``docs`` with one document of each linked set: the one with the smallest id.

    All columns come through. Rows are told apart by id and linked set: different texts under one id each
    stay or go with their own set, and of several rows of a set that have its smallest id one stays (which, if
    they differ, is not stated). Rows without an id cannot be named and stay, unless they are linked to a row
    with one.
    """
    found = stored(_rooted(docs, id_col, text_col, shingle, radius), "components")
    by_id = stored(
        found.where("doc_id is not null")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.count("*").alias("_rows"), F.expr("bool_or(doc_id <> component_id)").alias("_gone")),
        "components-by-id",
    )
    odd = by_id.where("_rows > 1").select("_id")
    gone = by_id.where("_rows > 1 or _gone").withColumn("_out", F.lit(True))
    id_ = F.col(f"`{id_col}`")
    # The row goes along as one value, so that its columns cannot be taken for those used here.
    keyed = docs.where(id_.isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), id_.alias("_id"))
    plain = join_marks(keyed, gone, "_id", "_out", "_rows", 64).where("_out is null")
    plain = plain.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    n_odd = odd.count()
    if not n_odd and found.where("doc_id is null").isEmpty():
        return plain
    # Ids that do not name one row: their sets are found by the fingerprint of their text.
    whole = docs.select(id_.alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    repeated = whole.join(small(odd, n_odd, 64), whole["id"] == F.col("_id"), "left_semi")
    sets = found.select("fp", "root", "component_id").distinct()
    marked = fingerprints(repeated.unionByName(whole.where("id is null")), "text", ["id", "row"], shingle).join(sets, "fp")
    named = marked.where("id = component_id").dropDuplicates(["root"]).select("row.*")
    return plain.unionByName(named).unionByName(marked.where("id is null and component_id is null").select("row.*"))
