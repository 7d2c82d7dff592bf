"""Rates for documents, so that the tokens of soft domains add up to target shares."""

from __future__ import annotations

import math
import string
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small, stored

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE_ROWS = 4000
#: Word beginnings that tell a domain from the rest, for each domain at most.
TERMS = 24
_PREFIX = 4
#: Shapes of a text: the share of its bytes that are one of some signs, and the upper bounds of its bins.
_SHAPES = {
    "capitals": (string.ascii_uppercase, (0.02, 0.06, 0.2)),
    "marks": ("!#$%&*|<>", (0.002, 0.02, 0.08)),
    "digits": (string.digits, (0.002, 0.02, 0.1)),
    "spaces": (" ", (0.1, 0.16, 0.22)),
}
#: Steps whose losses a longer step may not exceed.
_MEMORY = 8
_BREAKS = "\t\n\x0b\x0c\r"
_LENGTHS = (200, 1000, 5000)


def _count(sign: str, text: str) -> Column:
    """How often an ASCII sign occurs in a text: what taking it out saves."""
    return F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit(sign), F.lit("")))


def _bin(value: Column, bounds: tuple[float, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(value > b, 1).otherwise(0) for b in bounds])


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``_low`` (lower case), ``_tokens`` (as many as pieces between single characters of white
    space, 1 at least) and one ``_bin_<shape>`` for each shape.

    Small letters and spaces are most of a text. They are taken out first, in one pass, so that signs are
    counted one by one in the little that is left.
    """
    out = docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    size = F.greatest(F.octet_length("_text"), F.lit(1))
    out = out.withColumns(
        {"_low": F.lower("_text"), "_rest": F.regexp_replace("_text", "[a-z ]+", ""), "_spaces": _count(" ", "_text"), "_bin_length": _bin(size, _LENGTHS)}
    )
    bins = {}
    for name, (signs, bounds) in _SHAPES.items():
        total = F.col("_spaces") if signs == " " else reduce(lambda a, b: a + b, [_count(sign, "_rest") for sign in signs])
        bins[f"_bin_{name}"] = _bin(total / size, bounds)
    breaks = reduce(lambda a, b: a + b, [_count(sign, "_rest") for sign in _BREAKS])
    return out.withColumns({"_tokens": (F.col("_spaces") + breaks + 1).cast("long"), **bins})


_BINS = {"_bin_length": len(_LENGTHS) + 1} | {f"_bin_{name}": len(bounds) + 1 for name, (_, bounds) in _SHAPES.items()}


def fit_domains(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> dict:
    """A naive Bayes model of ``labelled`` (id, domain) from at most ``sample_rows`` rows a domain.

    Inputs are which informative strings (word beginnings of the sample) a text holds, and its binned
    shapes. The rows are those with the least hashes; priors come from all labelled rows. The model is a
    small dictionary: domains, prior logs, terms, and for each feature the log likelihoods by domain.
    """
    known = labelled.where(F.col("domain").isNotNull() & F.col(id_col).isNotNull()).dropDuplicates([id_col])
    counts = {row["domain"]: row["count"] for row in known.groupBy("domain").count().collect()}
    domains = sorted(counts)
    if not domains:
        raise ValueError("no labelled document: the domains are unknown")
    picked = [
        known.where(F.col("domain") == d).orderBy(F.xxhash64(id_col), id_col).limit(sample_rows).select(F.col(id_col).alias("_id"), "domain")
        for d in domains
    ]
    ids = reduce(DataFrame.unionByName, picked)
    held = sum(min(sample_rows, n) for n in counts.values())
    # Only what is read, so that other columns of the documents clash with nothing here.
    texts = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("_given"))
    sample = texts.join(small(ids, held, 64), F.col("_doc") == F.col("_id"))
    shapes = list(_BINS)
    sample = stored(_prepared(sample, "_given").select("_id", "domain", "_low", *shapes).dropDuplicates(["_id"]), "mixing-sample")
    beginnings = F.array_distinct(F.transform(F.split("_low", r"\s+"), lambda w: F.substring(w, 1, _PREFIX)))
    seen = stored(
        sample.select("domain", F.explode(beginnings).alias("term"))
        .where(F.length("term") == _PREFIX)
        .groupBy("term")
        .agg(*[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)]),
        "mixing-terms",
    )
    sizes = {row["domain"]: row["count"] for row in sample.groupBy("domain").count().collect()}
    sizes = {d: sizes.get(d, 0) for d in domains}
    total = sum(sizes.values())
    terms: set[str] = set()
    for i, d in enumerate(domains):
        inside = (F.col(f"n{i}") + 0.5) / (sizes[d] + 1)
        outside = (sum(F.col(f"n{j}") for j in range(len(domains)) if j != i) + F.lit(0.5)) / (total - sizes[d] + 1)
        gain = F.abs(F.log(inside / outside)) * F.sqrt(sum(F.col(f"n{j}") for j in range(len(domains))))
        terms.update(row["term"] for row in seen.orderBy(gain.desc(), "term").limit(TERMS).collect())
    # A text holds a term wherever it stands, so it is counted once more that way.
    held_by = sample.groupBy("domain").agg(F.count("*"), *[F.count_if(F.contains("_low", F.lit(t))) for t in sorted(terms)]).collect()
    holding = {row["domain"]: row[2:] for row in held_by}
    rows = {t: [holding[d][i] if d in holding else 0 for d in domains] for i, t in enumerate(sorted(terms))}
    binned = sample.select("domain", F.explode(F.array(*[F.struct(F.lit(s).alias("shape"), F.col(s).alias("bin")) for s in shapes])).alias("f"))
    bins = {(r["domain"], r["shape"], r["bin"]): r["count"] for r in binned.groupBy("domain", "f.shape", "f.bin").count().collect()}
    return {
        "domains": domains,
        "priors": [math.log(counts[d] / sum(counts.values())) for d in domains],
        "terms": {
            t: (
                [math.log((n + 0.5) / (sizes[d] + 1)) for n, d in zip(rows[t], domains)],
                [math.log((sizes[d] - n + 0.5) / (sizes[d] + 1)) for n, d in zip(rows[t], domains)],
            )
            for t in sorted(terms)
        },
        "shapes": {
            s: [[math.log((bins.get((d, s, b), 0) + 0.5) / (sizes[d] + 0.5 * _BINS[s])) for d in domains] for b in range(_BINS[s])]
            for s in shapes
        },
    }


def domain_posteriors(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tokens`` and ``posterior``: an array in the order of ``model['domains']``. Columns of these
    names are replaced."""
    count = len(model["domains"])
    kept = [c for c in docs.columns if c not in ("tokens", "posterior")]
    # A struct keeps the documents' names apart from those used here.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(0)
    scored = _prepared(docs.select(row.alias("_row"), F.col(f"`{text_col}`").alias("_given")), "_given")
    has = {t: F.contains("_low", F.lit(t)) for t in model["terms"]}
    scored = scored.withColumn("_has", F.array(*has.values()) if has else F.array(F.lit(False)))
    logs = []
    for k in range(count):
        parts = [f"{model['priors'][k]!r}D"]
        for i, (present, absent) in enumerate(model["terms"].values()):
            parts.append(f"if(_has[{i}], {present[k]!r}D, {absent[k]!r}D)")
        for shape, table in model["shapes"].items():
            parts.append(f"array({', '.join(f'{row[k]!r}D' for row in table)})[{shape}]")
        logs.append(F.expr(" + ".join(parts)))
    scored = scored.withColumn("_logs", F.array(*logs))
    scored = scored.withColumn("_raised", F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))))
    mass = F.aggregate("_raised", F.lit(0.0), lambda a, x: a + x)
    scored = scored.withColumn("_mass", mass).withColumn("posterior", F.transform("_raised", lambda x: x / F.col("_mass")))
    return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], F.col("_tokens").alias("tokens"), "posterior")


def fit_rates(
    docs: DataFrame, domains: list[str], weights: dict[str, float], total: str = "same", least: float = 0.0, rounds: int = 1000,
    tolerance: float = 1e-4, settled: float = 1e-6,
) -> tuple[DataFrame, dict]:
    """``rate`` for each row of ``docs`` (tokens, posterior): nonnegative, and at least ``least`` (0..1).

    Minimises the squares of the gaps between expected domain tokens, sum(rate * tokens *
    posterior), and the targets, each in proportion to its target, starting from rate 1, by projected
    gradient steps. A step is one aggregate over the table, and a row's rate follows from the gaps so
    far, so nothing is kept between steps but a vector for each. ``total``: "same" keeps the number of
    tokens, "cover" takes the least at which no domain has to shrink.

    A step is as long as the last one found the loss to bend (the spectral length), and no shorter than the
    length that never overshoots, which it falls back to when the loss exceeds those of the last few steps. It
    ends where the rates that are returned have no gap above ``tolerance``, as a share of all tokens, or, should
    the targets be out of reach, where a step changes no more than ``settled`` of the tokens. ``rounds`` is
    a guard: without either by then, the report's ``converged`` is false and a warning says so. Returns
    the rows and a report.
    """
    names = range(len(domains))
    share = [max(0.0, float(weights.get(d, 0.0))) for d in domains]
    if sum(share) <= 0:
        raise ValueError("no domain has a positive weight")
    share = [w / sum(share) for w in share]

    def sums(rate: Column) -> list[Column]:
        return [F.sum(F.col("tokens") * rate * F.col("posterior")[k]) for k in names]

    def collected(df: DataFrame, columns: list[Column]) -> list[float]:
        return [float(value or 0.0) for value in df.agg(*columns).first()]

    pairs = [F.sum(F.col("tokens") * F.col("posterior")[j] * F.col("posterior")[k]) for j in names for k in names]
    found = collected(docs, sums(F.lit(1.0)) + pairs)
    start, gram = found[: len(domains)], found[len(domains) :]
    tokens = sum(start)
    report = {"domains": domains, "start": start, "target": start, "reached": start, "steps": 0, "converged": True}
    if not tokens:
        return docs.withColumn("rate", F.lit(1.0)), report
    scale = max([s / tokens / w for s, w in zip(start, share) if w > 0] + [1.0]) if total == "cover" else 1.0
    target = [w * scale for w in share]
    # Gaps are weighed by 1 / target; steps are for rates weighted by tokens.
    weigh = np.array([1 / max(t, 1e-3) for t in target])
    curvature = np.array(gram).reshape(len(domains), -1) / tokens * np.sqrt(np.outer(weigh, weigh))
    pull = weigh / max(float(np.linalg.eigvalsh(curvature)[-1]), 1e-9)

    safe = 1 / max(float(np.linalg.eigvalsh(curvature)[-1]), 1e-9)

    steps: list[list[float]] = []
    losses: list[float] = []
    converged, reached, last_gap = False, start, np.zeros(len(domains))
    for _ in range(rounds + 1):
        # The rates before the last step and after it.
        before, now = F.col("_state")[0], F.col("_state")[1]
        change = [F.sum(F.col("tokens") * F.abs(now - before)), F.sum(F.col("tokens") * (now - before) * (now - before))]
        *reached, moved, square = collected(docs.withColumn("_state", _states(steps, least)), sums(now) + change)
        gap = np.array(reached) / tokens - target
        if np.abs(gap).max() <= tolerance or (steps and moved <= settled * tokens):
            converged = True
            break
        if len(steps) == rounds:
            break
        loss = float((weigh * gap * gap).sum())
        length = safe
        if steps and loss <= max(losses[-_MEMORY:]):
            bend = float((weigh * (gap - last_gap) ** 2).sum())
            length = max(safe, square / tokens / bend) if bend > 0 else safe
        losses.append(loss)
        last_gap = gap
        steps.append([float(x) for x in length * weigh * gap])
    if not converged:
        warnings.warn(f"the mixture did not settle within {rounds} steps; shares reached: {[r / tokens for r in reached]}", stacklevel=2)
    report |= {"target": [t * tokens for t in target], "reached": list(reached), "steps": len(steps), "converged": converged}
    return docs.withColumn("rate", _states(steps, least)[1]), report


def _states(steps: list[list[float]], least: float) -> Column:
    """The rates before the last of ``steps`` and after it."""
    if not steps:
        return F.array(F.lit(1.0), F.lit(1.0))
    history = ", ".join(f"array({', '.join(f'{x!r}D' for x in step)})" for step in steps)
    pull = " + ".join(f"posterior[{k}] * step[{k}]" for k in range(len(steps[0])))
    return F.expr(
        f"aggregate(array({history}), array(1.0D, 1.0D), (state, step) -> array(state[1], greatest({float(least)!r}D, state[1] - ({pull}))))"
    )


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    total: str = "same",
    least: float = 0.0,
    carry: list[str] | None = None,
) -> tuple[DataFrame, dict]:
    """Rows of ``docs`` with ``tokens``, ``posterior`` and ``rate``, and the report of ``fit_rates``.

    A null text is empty and has one token. Repeated rows each count. With an empty table there are
    no rows. Domains without a weight have the target zero. Carried columns with these names are
    replaced.
    """
    carry = docs.columns if carry is None else carry
    kept = [c for c in carry if c not in ("tokens", "posterior", "rate")]
    model = fit_domains(docs, labelled, id_col, text_col)
    scored = domain_posteriors(docs, model, text_col).select(*[f"`{c}`" for c in kept], "tokens", "posterior")
    scored = stored(scored, "mixing")
    return fit_rates(scored, model["domains"], weights, total, least)


def mixed(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    total: str = "cover",
    least: float = 1.0,
) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part for certain, and once more
    with the remaining part as probability, drawn from the row's hash. Columns stay as they are. By
    default no rate is below 1, so every row stays."""
    # The row goes along as one value, whatever its columns are called.
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    )
    rated, _ = mixing_rates(whole, labelled, weights, id_col, text_col, total, least, carry=["_whole"])
    draw = F.pmod(F.xxhash64(F.lit("mixing"), F.col(f"_whole.`{id_col}`"), F.col(f"_whole.`{text_col}`")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(F.col("rate") + draw).cast("int")
    return rated.select("_whole", F.explode(F.array_repeat(F.lit(1), copies))).select("_whole.*")
