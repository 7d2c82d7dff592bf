"""Conversation prefix trie by truncation peeling.

Conversations that end at the greatest depth are nodes; their last turn is stripped, those left with
the same turns become one node, conversations that end there join it, and so on up to the root. Each
node is found and summed up at once, from its children alone.

All of it runs on narrow rows: a sequence of turns is known by a 128-bit key, texts are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.artefacts import stored
from ..functions.groups import join_groups
from ..functions.ordered import running_totals

#: Conversations whose id leaves this remainder of ``FAMILY`` lend their first turns.
FAMILY = 5
#: At most one less turn is lent.
LENT = 9

_PIECES = ("a", "b", "c", "d")
_GROUP_BYTES = 96


def _key(depth: str, pieces: list[str]) -> str:
    """A sequence of turns as 16 bytes, from its length and the sums of its turns' hashes."""
    return f"unhex(md5(concat_ws(',', {depth}, {', '.join(pieces)})))"


_ROOT = _key("0", ["0"] * len(_PIECES))


def numbered_turns(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv, at, turn, bytes): turns numbered from 1 by ``turn``, null first, then by their hash.

    ``turn`` is a hash of role and text, ``bytes`` the length of the text. A conversation may have any
    share of all rows: it is numbered in ranges.
    """
    role, text = (f"coalesce(cast(`{c}` as string), '')" for c in ("role", "text"))
    narrow = turns.where("conv_id is not null").selectExpr(
        "cast(conv_id as bigint) as conv",
        "turn is not null as given",
        "coalesce(turn, 0) as place",
        f"unhex(md5(concat_ws(':', octet_length({role}), {role}, {text}))) as turn",
        f"cast(octet_length({text}) as bigint) as bytes",
        "monotonically_increasing_id() as row",
        "1L as one",
    )
    order = [F.col(c) for c in ("given", "place", "turn", "row")]
    return running_totals(narrow, ["conv"], order, {"at": "one"}, parts).select("conv", "at", "turn", "bytes")


def rebuilt_turns(numbered: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: their turns, and one row (conv, turns) for each of them.

    Conversation c is the first h turns of conversation c - c % 5, where h is crc32 of its decimal id % 9, and
    then its own turns after its first h.
    """
    own = stored(
        numbered.groupBy("conv").agg(F.count("*").alias("n")).selectExpr(
            "conv", "n", f"conv - conv % {FAMILY} as lender", f"crc32(cast(cast(conv as string) as binary)) % {LENT} as h"
        ),
        "conversations",
    )
    lenders = own.selectExpr("conv as lender", "n as lender_n")
    convs = stored(
        own.join(lenders, "lender", "left").selectExpr(
            "conv", "n", "h", "lender", "least(h, coalesce(lender_n, 0)) as lent", "least(h, coalesce(lender_n, 0)) + greatest(n - h, 0) as turns"
        ),
        "rebuilt",
    )
    # At most eight turns of a conversation are lent, to at most nine others.
    heads = numbered.where(f"conv % {FAMILY} = 0 and at < {LENT}").selectExpr("conv as lender", "at", "turn", "bytes")
    lent = convs.where("lent > 0").select("conv", "lender", "lent").join(heads, "lender").where("at <= lent")
    rest = join_groups(numbered, convs.select("conv", "n", "h", "lent"), ["conv"], "n", _GROUP_BYTES).where("at > h")
    turns = lent.select("conv", "at", "turn", "bytes").unionByName(rest.selectExpr("conv", "at - h + lent as at", "turn", "bytes"))
    return turns, convs.select("conv", "turns")


def prefixes(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv, depth, key, parent, bytes, upto): each first d turns of each conversation.

    A key hashes the sum of the hashes of (place, turn) over the first d turns. Sums can be taken in
    ranges, so a long conversation is shared by several tasks; ``upto`` adds up the bytes.
    """
    placed = turns.selectExpr("conv", "at", "bytes", "md5(concat_ws(':', at, hex(turn))) as mark").selectExpr(
        "conv", "at", "bytes", *[f"cast(conv(substr(mark, {8 * i + 1}, 8), 16, 10) as bigint) as {p}" for i, p in enumerate(_PIECES)]
    )
    totals = {f"s{p}": p for p in _PIECES} | {"upto": "bytes"}
    summed = running_totals(placed, ["conv"], [F.col("at")], totals, parts)
    own = [f"s{p}" for p in _PIECES]
    before = [f"s{p} - {p}" for p in _PIECES]
    return summed.selectExpr("conv", "at as depth", f"{_key('at', own)} as key", f"{_key('at - 1', before)} as parent", "bytes", "upto")


def _ends_digest(ended: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ids that end at a node, ascending and comma-joined.

    A hash takes its input in order, so the ids of a node pass through one task. They do so as a sorted
    stream: a task holds one batch, whatever the number of ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, digests = [], []
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        digests.append(digest.hexdigest())
                    key, digest = k, hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])

    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ends", T.StringType())])
    return ended.select("key", "conv").repartition("key").sortWithinPartitions("key", "conv").mapInArrow(run, schema)


def _peeled(entering: DataFrame, shared: DataFrame, deepest: int) -> DataFrame:
    """Nodes that several different conversations pass, peeled from ``deepest`` to the root.

    ``entering`` has what comes into a node from outside the peeling: conversations that end there, and the
    tails stripped down to it. ``shared`` holds parent and bytes of the nodes. Both are stored by depth,
    so a round reads its own depth only.
    """
    sums = [F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]]
    levels = []
    above = None
    for depth in range(deepest, -1, -1):
        rows = entering.where(f"depth = {depth}").select("key", "conv", "n", "children", "leaves", "saved")
        if above is not None:
            rows = rows.unionByName(above)
        merged = rows.groupBy("key").agg(*sums).join(shared.where(f"depth = {depth}").drop("depth"), "key")
        nodes = stored(
            merged.selectExpr(
                "key", "parent", f"{depth} as depth", "conv", "n", "children",
                "if(children = 0, 1L, leaves) as leaves", "saved + (n - 1) * bytes as saved",
            ),
            "level",
        )
        levels.append(nodes)
        above = nodes.selectExpr("parent as key", "conv", "n", "1L as children", "leaves", "saved")
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return nodes


def prefix_trie(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations.

    ``turns`` has conv_id, turn, role and text; other columns are not read. Returns conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    * Turns are numbered, and prefixes keyed, by running totals over ranges: a conversation with a
      third of all rows is shared by tasks.
    * Conversations of the same turns enter as one, with their number. Below the deepest node that
      others pass as well, each is a bare tail: its nodes follow from its bytes alone, and it enters the
      peeling already stripped to that node. So the rounds are as many as the deepest shared prefix
      has turns, not as the longest conversation has.
    * A round is one aggregate, combined on the map side: any number of conversations may meet in
      a node. It reads the rows of its own depth and writes its nodes to the shared folder.

    Nulls and odd cases: rows without conv_id are left out; null role or text counts as empty; turns
    with the same number are ordered by a hash of role and text, and repeated rows count as often as they
    occur. An empty table has no conversations and gives no rows, not even a root.
    """
    rebuilt, convs = rebuilt_turns(stored(numbered_turns(turns, parts), "numbered"), parts)
    convs = stored(convs, "lengths")
    paths = stored(prefixes(rebuilt, parts), "prefixes")

    # Conversations by the node they end at.
    last = join_groups(paths, convs, ["conv"], "turns", _GROUP_BYTES).where("depth = turns").select("key", "conv", "depth", "upto")
    ended = stored(last.unionByName(convs.where("turns = 0").selectExpr(f"{_ROOT} as key", "conv", "0L as depth", "0L as upto")), "ended")
    ends = stored(_ends_digest(ended), "ends")
    groups = stored(
        ended.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("m"), F.min("depth").alias("turns"), F.min("upto").alias("total")), "end-groups"
    )

    # One path for each group of equal conversations; nodes on several of them are shared.
    path = stored(
        join_groups(paths, groups.drop("key"), ["conv"], "turns", _GROUP_BYTES).select("conv", "depth", "key", "parent", "bytes", "upto", "m", "turns", "total"), "paths"
    )
    passed = path.groupBy("key").agg(
        F.count("*").alias("paths"), F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("bytes").alias("bytes")
    )
    shared = stored(passed.where("paths > 1"), "shared")
    root = groups.limit(1).selectExpr(f"{_ROOT} as key", "1L as paths", "cast(null as binary) as parent", "0L as depth", "0L as bytes")
    on_shared = join_groups(path.select("conv", "depth", "key"), shared.select("key", "paths"), ["key"], "paths", _GROUP_BYTES)
    split = on_shared.groupBy("conv").agg(F.max("depth").alias("common"))
    known = stored(groups.join(split, "conv", "left").withColumn("common", F.coalesce("common", F.lit(0))), "known")

    # The tails: m members all the way, one child each but the last, and bytes saved from there on.
    tails = stored(
        join_groups(path, known.select("conv", "common", F.col("turns").alias("of")), ["conv"], "of", _GROUP_BYTES)
        .where("depth > common")
        .selectExpr(
            "key", "parent", "depth", "conv", "m as n", "if(depth < turns, 1L, 0L) as children", "1L as leaves",
            "(m - 1) * (total - upto + bytes) as saved", "depth = common + 1 as top",
        ),
        "tails",
    )
    stripped = tails.where("top").selectExpr("parent as key", "depth - 1 as depth", "conv", "n", "1L as children", "leaves", "saved")
    ending = known.where("turns = common").selectExpr("key", "turns as depth", "conv", "m as n", "0L as children", "0L as leaves", "0L as saved")
    entering = stored(stripped.unionByName(ending), "entering", by=["depth"])
    info = stored(shared.unionByName(root).select("key", "parent", "bytes", "depth"), "node-info", by=["depth"])
    deepest = entering.agg(F.max("depth")).first()[0]
    if deepest is None:
        peeled = tails.where("false").drop("top")
    else:
        peeled = _peeled(entering, info, deepest)

    # Parents: of a tail's lower nodes the tail itself, of all others the node they were stripped to.
    peeled = stored(peeled.select("key", "parent", "depth", "conv", "n", "children", "leaves", "saved"), "peeled")
    owners = peeled.where("children > 0").selectExpr("key as parent", "conv as parent_conv", "children")
    lower = peeled.unionByName(tails.where("top").drop("top"))
    below = join_groups(lower.where("depth > 0"), stored(owners, "owners"), ["parent"], "children", _GROUP_BYTES).drop("children")
    children = lower.select("key", F.col("children").alias("n_children"))
    named = (
        below.join(children, "key")
        .unionByName(peeled.where("depth = 0").selectExpr("*", "cast(null as bigint) as parent_conv", "children as n_children").drop("children"))
        .unionByName(tails.where("not top").selectExpr("*", "conv as parent_conv", "children as n_children").drop("top", "children"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return named.join(ends, "key", "left").selectExpr(
        "conv as conv_id", "cast(depth as bigint) as depth", "parent_conv as parent_conv_id", "n as n_convs",
        "n_children", "leaves as n_leaves", "saved as saved_tokens", f"coalesce(ends, '{nothing}') as ends_sha256",
    )
