"""Toxicity scores that do not hang on which group a text mentions."""

from __future__ import annotations

import warnings
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import labelled_sample, remainder
from .shared import add_columns

#: Labelled documents that the classifier is fitted on, for each label at most (by expectation).
SAMPLE_ROWS = 4000
#: Documents of the sample that a feature must occur in.
LEAST_DOCS = 4
#: Terms that stand in for one another: a sentence should score the same with either. Fixed values.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("old", "young"),
    ("disabled", "blind", "deaf"),
    # German.
    ("frauen", "männer"),
    ("frau", "mann"),
    ("muslime", "christen", "juden"),
    ("schwarze", "weiße"),
    ("einwanderer", "flüchtlinge"),
    ("schwule", "lesben"),
    # French.
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("musulmans", "chrétiens", "juifs"),
    ("noirs", "blancs"),
    ("immigrés", "réfugiés"),
    # Spanish.
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("musulmanes", "cristianos", "judíos"),
    ("negros", "blancos"),
    ("inmigrantes", "refugiados"),
    # Words that say whether a man or a woman is meant; French and Spanish share some.
    ("he", "she"),
    ("his", "her"),
    ("himself", "herself"),
    ("er", "sie"),
    ("der", "die"),
    ("ein", "eine"),
    ("il", "elle"),
    ("le", "la", "el"),
    ("un", "une", "una"),
    ("él", "ella"),
    ("los", "las"),
)
_SEPARATORS = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
_BEGINNINGS = (4, 5)


class ToxicityModel(NamedTuple):
    """Intercept and weights; how many of the texts fitted on name an identity, and how many swapped
    forms of these the penalty has seen."""

    bias: float
    weights: dict[bytes, float]
    mentions: int = 0
    swaps: int = 0


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").lower().translate(_SEPARATORS).split()


def features(words: list[bytes] | set[bytes]) -> set[bytes]:
    """The words themselves and their beginnings (marked by a leading ``^``)."""
    words = set(words)
    return words.union(*({b"^" + w[:n] for w in words if len(w) >= n} for n in _BEGINNINGS))


def swapped(words: list[bytes], terms=IDENTITY_TERMS) -> list[list[bytes]]:
    """``words`` with each identity term replaced by the next of its group; then by the one after it,
    and so on, as often as the largest group has other terms. None if no term occurs."""
    place = {t.encode(): (group, i) for group in terms for i, t in enumerate(group)}
    hit = [place[w][0] for w in set(words) if w in place]
    turns = max((len(group) for group in hit), default=1)
    return [
        [
            w if w not in place or turn % len(place[w][0]) == 0 else place[w][0][(place[w][1] + turn) % len(place[w][0])].encode()
            for w in words
        ]
        for turn in range(1, turns)
    ]


def _sparse(rows: list[np.ndarray], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every feature that has a place; others have -1."""
    kept = [np.sort(place[r][place[r] >= 0]) for r in rows]
    return np.repeat(np.arange(len(kept)), [len(r) for r in kept]), np.concatenate(kept) if kept else np.empty(0, np.int64)


def fit(*args, **options) -> tuple[float, dict[bytes, float]]:
    """Intercept and weights of ``fit_model``."""
    return fit_model(*args, **options)[:2]


def fit_model(
    texts: list[bytes | None], labels: np.ndarray, weights: np.ndarray, fairness: float = 1.0, sparsity: float = 2e-4,
    rounds: int = 300, terms=IDENTITY_TERMS,
) -> ToxicityModel:
    """A sparse logistic model over which features a text has.

    The loss is the weighted log loss, ``sparsity`` times the absolute weights, and ``fairness`` times
    the mean square of how much a text's logit moves when its identity terms are swapped. Minimised
    by proximal gradient steps with momentum.
    """
    numbers: dict[bytes, int] = {}

    def numbered(found: set[bytes]) -> np.ndarray:
        return np.fromiter((numbers.setdefault(f, len(numbers)) for f in found), np.int64, len(found))

    # Texts are held as numbers of features; of a swapped text only what it gains and loses is.
    base, source, gained, lost = [], [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        own = features(words)
        base.append(numbered(own))
        for other in map(features, swapped(words, terms)):
            source.append(i)
            gained.append(numbered(other - own))
            lost.append(numbered(own - other))
    seen = np.bincount(np.concatenate(base), minlength=len(numbers)) if base else np.zeros(0, np.int64)
    # Identity terms stay in even where they are rare, so that swaps see them.
    named = {f for group in terms for t in group for f in features([t.encode()])}
    names = sorted(f for f, n in numbers.items() if seen[n] >= LEAST_DOCS or f in named)
    place = np.full(len(numbers), -1)
    place[[numbers[f] for f in names]] = np.arange(len(names))
    row, col = _sparse(base, place)
    plus_row, plus_col = _sparse(gained, place)
    minus_row, minus_col = _sparse(lost, place)
    pairs = len(source)
    total = weights.sum()
    size = np.zeros(len(texts))
    np.add.at(size, row, 1.0)
    w, bias = np.zeros(len(names)), 0.0
    ahead, ahead_bias, momentum = w.copy(), bias, 1.0

    def gradient(at: np.ndarray, at_bias: float) -> tuple[np.ndarray, float]:
        logits = at_bias + np.bincount(row, at[col], len(texts))
        error = weights * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / total
        grad = np.bincount(col, error[row], len(names))
        if pairs:
            moved = np.bincount(plus_row, at[plus_col], pairs) - np.bincount(minus_row, at[minus_col], pairs)
            pull = 2 * fairness * moved / pairs
            grad += np.bincount(plus_col, pull[plus_row], len(names)) - np.bincount(minus_col, pull[minus_row], len(names))
        return grad, error.sum()

    # Frequent features get small steps: a diagonal bound on the curvature.
    mean_size = np.bincount(col, (weights * (size + 1))[row], len(names)) / total
    swaps = np.bincount(plus_col, minlength=len(names)) + np.bincount(minus_col, minlength=len(names))
    wide = max((len(g) + len(m) for g, m in zip(gained, lost)), default=0)
    steps = 1 / (0.25 * mean_size + 2 * fairness * wide * swaps / max(1, pairs) + 1e-3)
    bias_step = 1 / (0.25 * ((weights * (size + 1)).sum() / total))
    for _ in range(rounds):
        grad, grad_bias = gradient(ahead, ahead_bias)
        new = ahead - steps * grad
        new = np.sign(new) * np.maximum(np.abs(new) - steps * sparsity, 0)
        new_bias = ahead_bias - bias_step * grad_bias
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        beta, momentum = (momentum - 1) / following, following
        ahead, ahead_bias = new + beta * (new - w), new_bias + beta * (new_bias - bias)
        w, bias = new, new_bias
    return ToxicityModel(float(bias), {f: float(w[i]) for i, f in enumerate(names) if w[i] != 0}, len(set(source)), pairs)


def toxicity_model(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    folds: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS, fairness: float = 1.0, terms=IDENTITY_TERMS,
) -> ToxicityModel:
    """``fit_model`` on a bounded sample outside the held-out fold. Without a labelled document, all score 0.5.

    The sample reaches the driver as its distinct words, in text order, not as texts. Where none of these
    texts names an identity the penalty is empty: the model's ``swaps`` is 0 and a warning says so. Give
    the corpus's own ``terms`` then.
    """
    sample, counts = labelled_sample(docs, labels, label_col, id_col, text_col, sample_rows, folds, held_out)

    def distinct(texts: list[bytes | None]) -> list[list[bytes]]:
        return [[b" ".join(dict.fromkeys(words_of(raw))) for raw in texts]]

    rows = add_columns(sample, "text", ["_id", "label"], [("words", pa.binary(), T.BinaryType())], distinct).collect()
    if not rows:
        return ToxicityModel(0.0, {})
    rows.sort(key=lambda r: (str(r["_id"]), bytes(r["words"])))
    target = np.array([r["label"] for r in rows], float)
    drawn = {label: max(1.0, float((target == label).sum())) for label in counts}
    weights = np.array([counts[r["label"]] / drawn[r["label"]] for r in rows], float)
    model = fit_model([bytes(r["words"]) for r in rows], target, weights, fairness, terms=terms)
    if not model.swaps:
        warnings.warn("no labelled text names an identity term, so no score change was penalised", stacklevel=2)
    return model


def toxicity_scores(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
    folds: int = 5, held_out: int = 0, carry: list[str] | None = None,
) -> DataFrame:
    """The carried columns with held_out, score and predicted for every row.

    A null or empty text has the score of no words at all. Repeated rows each get theirs; a null id is
    not held out (nor learned from); an empty table gives no rows; carried columns with these names
    are replaced.
    """
    bias, weights = model[:2]
    plain = {f: w for f, w in weights.items() if f[:1] != b"^"}
    begin = {n: {f[1:]: w for f, w in weights.items() if f[:1] == b"^" and len(f) == n + 1} for n in _BEGINNINGS}

    def score(texts: list[bytes | None]) -> list[list[float]]:
        logits = []
        for raw in texts:
            words = set(words_of(raw))
            logit = bias + sum(plain[w] for w in words & plain.keys())
            for n, table in begin.items():
                logit += sum(table[w] for w in {w[:n] for w in words if len(w) >= n} & table.keys())
            logits.append(logit)
        return [(1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30)))).tolist()]

    carry = docs.columns if carry is None else carry
    carry = [c for c in carry if c not in ("held_out", "score", "predicted")]
    ids = docs.withColumn("_held", F.coalesce(remainder(F.col(f"`{id_col}`"), folds) == held_out, F.lit(False)))
    scored = add_columns(ids, text_col, [*carry, "_held"], [("score", pa.float64(), T.DoubleType())], score)
    return scored.select(
        *[f"`{c}`" for c in carry], F.col("_held").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
