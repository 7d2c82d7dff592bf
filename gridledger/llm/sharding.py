"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Bytes that each document takes besides its text.
ROW_OVERHEAD = 16


def differencing(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (one a row, one column for each shard) into a single one.

    The two with the largest spread are added, one ordered downwards and the other upwards, until
    one is left. Returns its sums, and for each input row the column of the result that each of its
    columns went to.
    """
    count, k = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, axis=1))
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums[first] + sums[second][::-1]
        down = np.argsort(-total, kind="stable")
        to = np.empty(k, np.int64)
        to[down] = np.arange(k)
        joined.append((first, second, to))
        sums[first] = sums[second] = None
        sums.append(total[down])
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    place: list[np.ndarray] = [None] * len(sums)
    place[-1] = np.arange(k)
    for node in range(len(sums) - 1, count - 1, -1):
        first, second, to = joined[node - count]
        place[first] = place[node][to]
        place[second] = place[node][to[::-1]]
        place[node] = None
    slots = np.empty((count, k), np.int64)
    for i in range(count):
        slots[i, order[i]] = place[i]
    return sums[-1], slots


def assign_groups(groups: DataFrame, n_shards: int = 40, chunk_groups: int = 2000, fan_in: int = 64) -> DataFrame:
    """Give each row of ``groups`` (key, bytes; keys distinct) a shard: returns (key, shard).

    Chunks of about ``chunk_groups`` groups, chosen by the key's hash, are the leaves of a tree of nodes with
    ``fan_in`` children. A group is differenced at the highest node where it weighs more than one in
    ``n_shards * fan_in`` parts of what the node holds, so a node has few of them whatever their sizes. What the
    shards then differ by is handed on to the children, in proportion to their chunks, as a partial partition that
    each child differences with its own groups: large groups are levelled by the small ones of all chunks. Two
    chunks wait until all others are done, and level what little these leave. No task holds more than two
    chunks, or the large groups of one node.
    """
    groups = stored(groups.select("key", "bytes"), "shard-groups")
    seen = groups.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    chunks = max(1, math.ceil(seen["n"] / chunk_groups))
    depth = 0
    while fan_in**depth < chunks:
        depth += 1
    widths = [math.ceil(chunks / fan_in ** (depth - level)) for level in range(depth + 1)]
    at = F.lit(depth)
    for level in range(depth - 1, -1, -1):
        at = F.when(F.col("bytes") > seen["bytes"] / (n_shards * fan_in * widths[level]), level).otherwise(at)
    placed = stored(groups.select("key", "bytes", at.alias("level"), F.pmod(F.xxhash64("key"), F.lit(chunks)).alias("leaf")), "shard-leaves")

    def level_off(items: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "key"], ascending=False, kind="stable")
        parts = np.zeros((len(items) + 1, n_shards), np.int64)
        parts[0] = given["sums"].iloc[0]
        parts[1:, 0] = items["bytes"]
        total, slots = differencing(parts)
        # What was handed down belongs to shards by number; they name the columns of the result.
        shard = np.empty(n_shards, np.int32)
        shard[slots[0]] = np.arange(n_shards)
        node = given["node"].iloc[0]
        return pd.DataFrame(
            {
                "node": node,
                "key": [*items["key"], None],
                "shard": [*shard[slots[1:, 0]], -1],
                "sums": [*[None] * len(items), total[slots[0]]],
            }
        )

    schema = f"node long, key {groups.schema['key'].dataType.simpleString()}, shard int, sums array<long>"
    given = groups.sparkSession.createDataFrame([(0, [0] * n_shards)], "node long, sums array<long>")
    assigned = None

    def run(mine: DataFrame, given: DataFrame) -> DataFrame:
        return stored(mine.groupBy("node").cogroup(given.groupBy("node")).applyInPandas(level_off, schema), "shard-level")

    for level in range(depth + 1):
        below = fan_in ** (depth - level)
        mine = placed.where(F.col("level") == level).select("key", "bytes", F.floor(F.col("leaf") / below).alias("node"))
        if level == depth and depth:
            last, waiting = mine.where("node < 2").withColumn("node", F.lit(0).cast("long")), given.where("node < 2")
            mine, given = mine.where("node >= 2"), given.where("node >= 2")
        done = run(mine, given)
        found = done.where("sums is null").select("key", "shard")
        assigned = found if assigned is None else assigned.unionByName(found)
        if level < depth:
            step = below // fan_in
            parts = done.where("sums is not null").selectExpr(
                f"explode(sequence(node * {fan_in}L, least((node + 1) * {fan_in}L, {widths[level + 1]}L) - 1)) as child",
                f"least({below}L, {chunks}L - node * {below}L) as of", f"node * {below}L as start",
                "transform(sums, s -> s - array_min(sums)) as sums",
            ).selectExpr("child", "of", f"child * {step}L - start as x", f"least((child + 1) * {step}L, {chunks}L) - start as y", "sums")
            share = "(s div of) * (y - x) + ((s % of) * y) div of - ((s % of) * x) div of"
            given = parts.selectExpr("child as node", f"transform(sums, s -> {share}) as sums")
    if depth:
        # One number for each shard.
        so_far = done.where("sums is not null").select("sums").unionByName(waiting.select("sums"))
        total = so_far.select(F.posexplode("sums").alias("shard", "bytes")).groupBy("shard").agg(F.sum("bytes").alias("bytes"))
        sums = [row["bytes"] for row in sorted(total.collect(), key=lambda row: row["shard"])]
        rest = groups.sparkSession.createDataFrame([(0, sums)], "node long, sums array<long>")
        assigned = assigned.unionByName(run(last, rest).where("sums is null").select("key", "shard"))
    return assigned


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_groups: int = 2000,
    block_rows: int = 5000,
) -> DataFrame:
    """Put every row into a shard so that shards hold nearly equal bytes and equal texts stay together.

    Returns doc_id, size (UTF-8 bytes of the text plus ``ROW_OVERHEAD``), text_crc32, shard and slot
    (0, 1, ... within the shard). A null text counts as the empty one. Repeated rows each get a slot
    of their own, ties being broken by equal rows; null ids come first. An empty table gives no rows.
    Other columns are not read. Slots are numbered in blocks of about ``block_rows`` rows, so that no
    task ever holds a shard.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    n_rows = rows.count()
    shards = assign_groups(rows.groupBy("key").agg(F.sum("size").alias("bytes")), n_shards, chunk_groups)
    blocks = max(1, math.ceil(n_rows / (n_shards * block_rows)))
    placed = stored(
        rows.join(shards, "key").select(
            "doc_id", "size", "text_crc32", "shard",
            F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        ),
        "shard-placed",
    )
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        placed.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", F.coalesce(before, F.lit(0)).alias("first"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32"))
    return (
        placed.withColumn("number", number)
        .join(starts, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("number") - 1).alias("slot"))
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, text_col: str = "text") -> None:
    """Write all columns of ``docs`` as Parquet, one folder ``shard=<n>`` for each shard.

    A folder gets several files: rows are written by the tasks that read them.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.unhex(F.md5(text.cast("binary")))
    sizes = docs.select(key.alias("key"), (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"))
    shards = assign_groups(sizes.groupBy("key").agg(F.sum("size").alias("bytes")), n_shards)
    named = shards.select(F.col("key").alias("_key"), F.col("shard").alias("shard"))
    kept = docs.drop("shard")
    kept.withColumn("_key", key).join(named, "_key").drop("_key").write.partitionBy("shard").parquet(path)
