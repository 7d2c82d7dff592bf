"""Secret scans: a trigram index picks the texts that a rule's regex has to be tried on."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pattern_trigrams import trigram_query
from .shared import join_marks, stored

#: Bytes that a broadcast candidate key is taken to need.
_KEY_BYTES = 128


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches from left to right; those whose ``group`` is shorter than
    ``shortest`` are dropped. The pattern is Java's and Python's alike."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Kinds besides the base ones.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Matches folded at a time.
_BLOCK = 128
#: Spans from which a text is cut as an array of characters: each cut counts its way through a string.
_MANY_SPANS = 64


def trigram_postings(texts: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """The inverted index, as far as rules ask for it: (trigram, key) for each trigram of
    ``vocabulary`` that a lower-cased text holds."""
    low = texts.select(key, F.lower(text).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return low.select(key, F.explode(present).alias("trigram"))


def candidates(postings: DataFrame, key: str, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """One row a key with ``kinds``, the rules whose trigram query it satisfies, and ``n``, its postings.

    A key is in the intersection of some posting lists if it occurs in each of them; what is gathered
    for a key is bounded by the rules' trigrams.
    """
    held = postings.groupBy(key).agg(F.collect_set("trigram").alias("held"), F.count("*").alias("n"))

    def whole(trigrams: frozenset[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.array_contains("held", t) for t in sorted(trigrams)])

    wanted = [
        F.when(reduce(lambda a, b: a | b, [whole(trigrams) for trigrams in sets]), F.lit(kind))
        for kind, sets in queries.items()
    ]
    return held.select(key, F.array_compact(F.array(*wanted)).alias("kinds"), "n").where("size(kinds) > 0")


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches in a text: an array of (start, kind rank, end, kind) in code points.

    What lies between matches and the matches themselves add up to the text, which gives the places.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(_EMPTY).alias("spans"))

    def step(state: Column, item: Column) -> Column:
        begin = state["at"] + F.length(item["0"])
        end = begin + F.length(item["1"])
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = F.length(item["2"]) >= rule.shortest
        return F.struct(
            end.alias("at"), F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans")
        )

    def moved(span: Column, by: Column) -> Column:
        return F.struct((span["start"] + by).alias("start"), span["rank"].alias("rank"), (span["end"] + by).alias("end"), span["kind"].alias("kind"))

    def block(items: Column) -> Column:
        return F.aggregate(items, start, step)

    def join(state: Column, part: Column) -> Column:
        spans = F.transform(part["spans"], lambda span: moved(span, state["at"]))
        return F.struct((state["at"] + part["at"]).alias("at"), F.concat(state["parts"], F.array(spans)).alias("parts"))

    # The piece after the last match has none beside it, and so adds no span.
    found = _in_blocks(F.arrays_zip(between, whole, judged), block, join)
    return F.when(text.rlike(rule.pattern), found).otherwise(F.expr(_EMPTY))


def _in_blocks(items: Column, block, join) -> Column:
    """``items`` folded in blocks, and these joined: the array built in a fold is copied at every step, so
    one fold over all of them would take time with the square of their number."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<array<{_SPAN}>>)").alias("parts"))

    def fold(given: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(given) - 1) / _BLOCK).cast("int")), lambda b: block(F.slice(given, b * _BLOCK + 1, F.lit(_BLOCK)))
        )
        return F.aggregate(blocks, empty, join, lambda state: F.flatten(state["parts"]))

    # Through an array of one, so that the items are found once and not for each block.
    return F.transform(F.array(items), fold)[0]


_SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string>"
_EMPTY = f"cast(array() as array<{_SPAN}>)"


def _found(docs: DataFrame, text_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(_row, _text, _spans): each row as it is, its text (null: empty), and its spans in order."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: sets for kind, sets in queries.items() if sets}
    vocabulary = sorted({t for sets in indexed.values() for trigrams in sets for t in trigrams})
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("_row"), text.alias("_text"), F.xxhash64(text).alias("_key"))
    if indexed:
        postings = trigram_postings(docs.select(F.xxhash64(text).alias("_key"), text.alias("_text")), "_key", "_text", vocabulary)
        kinds = stored(candidates(postings, "_key", indexed), "secret-candidates")
        keyed = join_marks(keyed, kinds, "_key", "kinds", "n", _KEY_BYTES)
    parts = []
    for rank, rule in enumerate(rules):
        spans = rule_spans(F.col("_text"), rule, rank)
        if rule.kind in indexed:
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(F.expr(_EMPTY))
        parts.append(spans)
    return keyed.select("_row", "_text", F.array_sort(F.concat(*parts)).alias("_spans"))


def secret_spans(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: where secrets are, as (start, rank, end, kind) in code points, by start
    and then by the order of ``rules``.

    Rules with mandatory trigrams are tried only on texts that the index names; the others on every
    text. The index and the candidates are keyed by the text's hash, so copies count once; a hash
    shared by chance only adds a text to try. A null text has no spans. Repeated rows each get theirs,
    an empty table gives no rows, and a column named ``spans`` is replaced; others keep name and value.
    """
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != "spans"]
    return _found(docs, text_col, rules).select(*kept, F.col("_spans").alias("spans"))


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mask``. All rows and columns stay."""
    text = F.col("_text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<after: bigint, upto: bigint>>)").alias("cuts"))

    def step(state: Column, span: Column) -> Column:
        cut = F.struct(state["at"].alias("after"), span["start"].alias("upto"))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], F.concat(state["cuts"], F.array(cut))).otherwise(state["cuts"]).alias("cuts"),
        )

    # What stays of the text before each run: from the end of the runs before to its start.
    cuts = _in_blocks_of_spans(F.col("_spans"), start, step)
    rest = F.aggregate("_spans", F.lit(0).cast("long"), lambda at, span: F.greatest(at, span["end"]))

    def pieces(between) -> Column:
        heads = F.transform(cuts, lambda cut: F.concat(between(cut["after"], cut["upto"] - cut["after"]), F.lit(mask)))
        return F.array_join(F.concat(heads, F.array(between(rest, F.length(text) - rest))), "")

    few = pieces(lambda after, length: F.substring(text, after.cast("int") + 1, length.cast("int")))
    characters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    many = F.transform(
        F.array(characters),
        lambda all_: pieces(lambda after, length: F.array_join(F.slice(all_, after.cast("int") + 1, length.cast("int")), "")),
    )[0]
    masked = F.when(F.size("_spans") > _MANY_SPANS, many).when(F.size("_spans") > 0, few).otherwise(F.col(f"_row.`{text_col}`"))
    return _found(docs, text_col, rules).select(
        *[(masked if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    )


def _in_blocks_of_spans(spans: Column, start: Column, step) -> Column:
    """Cuts (after, upto) of spans in order, folded in blocks as ``_in_blocks`` does."""
    empty = F.struct(
        F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<array<struct<after: bigint, upto: bigint>>>)").alias("parts")
    )

    def join(state: Column, part: Column) -> Column:
        ahead = F.filter(part["cuts"], lambda cut: cut["upto"] >= state["at"])
        moved = F.transform(ahead, lambda cut: F.struct(F.greatest(cut["after"], state["at"]).alias("after"), cut["upto"].alias("upto")))
        return F.struct(F.greatest(state["at"], part["at"]).alias("at"), F.concat(state["parts"], F.array(moved)).alias("parts"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(spans, b * _BLOCK + 1, F.lit(_BLOCK)), start, step),
    )
    return F.aggregate(blocks, empty, join, lambda state: F.flatten(state["parts"]))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, of ``spans`` as they are ordered."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
