"""Document rules, and host verdicts from failure rates shrunk by an empirical beta prior."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import add_columns, small, stored

SYMBOLS = b"#*$%&|<>"
#: What separates words, and the bytes that continue a code point.
_NOT_COUNTED = b"\t\n\x0b\x0c\r " + bytes(range(0x80, 0xC0))

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: A document fails a rule where its condition holds.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "duplicate_lines": "2 * n_dup_lines > n_words",
}
#: The rules that reject a document by themselves; the others only count against its host.
BASE_RULES = ("short", "repetitive")


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more among ``words``."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0  # end: first position after the last covered word
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _measure(texts: list[bytes | None]) -> list[list[int]]:
    columns: list[list[int]] = [[] for _ in METRICS]
    for raw in texts:
        raw = raw or b""
        words = raw.split()
        lines = [line for line in raw.split(b"\n") if line.strip()] if b"\n" in raw else []
        row = (
            len(words),
            len(raw.translate(None, _NOT_COUNTED)),
            len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)),
            repeated_words(words),
        )
        for column, value in zip(columns, row):
            column.append(value)
    return columns


def rule_metrics(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Append ``METRICS`` and one ``fails_<rule>`` for each of ``RULES`` to the carried columns."""
    carry = docs.columns if carry is None else carry
    fields = [(name, pa.int64(), T.LongType()) for name in METRICS]
    measured = add_columns(docs, text_col, [c for c in carry if c not in {f"fails_{r}" for r in RULES}], fields, _measure)
    return measured.withColumns({f"fails_{rule}": F.expr(condition) for rule, condition in RULES.items()})


def host_verdicts(measured: DataFrame, host_col: str, max_rate: float) -> tuple[DataFrame, int]:
    """One row a host (host, n_docs, host_rejected, host_rate), and the bytes of these rows.

    For each rule, the rates of all hosts give a beta prior by moments: its mean is the pooled rate,
    its variance what the rates vary beyond binomial noise. A host's rate is the posterior mean; hosts
    that do not vary at all keep the pooled rate. A host is rejected if any rule's rate exceeds
    ``max_rate``. ``host_rate`` is the largest of them.
    """
    fails = {rule: f"f_{rule}" for rule in RULES}
    hosts = (
        measured.where(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(F.count("*").alias("n_docs"), *[F.count_if(F.col(f"fails_{r}")).alias(f) for r, f in fails.items()])
    )
    hosts = stored(hosts, "hosts")
    moments = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum(F.octet_length(F.col("host").cast("string"))).alias("bytes"),
        *[F.sum(f).alias(f) for f in fails.values()],
        *[F.sum(F.col(f) * F.col(f) / F.col("n_docs")).alias(f"{f}_sq") for f in fails.values()],
    ).first()
    rates = [F.lit(0.0)]
    for f in fails.values():
        if not moments["docs"]:
            break
        mean = moments[f] / moments["docs"]
        noise = mean * (1 - mean)
        between = moments[f"{f}_sq"] / moments["docs"] - mean * mean - noise * moments["hosts"] / moments["docs"]
        if noise == 0 or between <= noise * 1e-9:
            rates.append(F.lit(mean))
            continue
        strength = max(noise / between - 1, 0.0)
        rates.append((F.col(f) + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength)))
    rate: Column = F.greatest(*rates, F.lit(0.0))
    verdicts = hosts.select("host", "n_docs", (rate > max_rate).alias("host_rejected"), rate.alias("host_rate"))
    return verdicts, (moments["bytes"] or 0) + 64 * moments["hosts"]


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = 0.5,
    carry: list[str] | None = None,
) -> DataFrame:
    """Judge every row by the document rules and by its host.

    Returns the carried columns (all by default) with ``METRICS``, ``base_failed``, ``host_rejected``
    and ``kept``: false if a base rule fails or the host is rejected. A carried column with one of
    these names is replaced. A null text is empty; a row without a host answers for itself alone.
    Repeated rows count each; an empty table gives no rows. The texts are read once: what was
    measured is written to the shared folder, hosts are counted from that, and the verdicts are joined
    back, by broadcast where their measured size allows it.
    """
    carry = docs.columns if carry is None else carry
    added = {*METRICS, "base_failed", "host_rejected", "kept"}
    host = docs[f"`{host_col}`"]
    carry = [c for c in carry if c not in added]
    measured = rule_metrics(docs.withColumn("_host", host), text_col, [*carry, "_host"])
    measured = stored(measured, "rules")
    verdicts, size = host_verdicts(measured, "_host", max_rate)
    judged = measured.join(
        small(verdicts.select(F.col("host").alias("_host"), "host_rejected"), 1, size), "_host", "left"
    )
    failed = F.expr(" or ".join(f"fails_{rule}" for rule in BASE_RULES))
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return judged.select(
        *[f"`{c}`" for c in carry],
        *METRICS,
        failed.alias("base_failed"),
        rejected.alias("host_rejected"),
        (~failed & ~rejected).alias("kept"),
    )
