"""Language identification in two steps: the family, then pairwise linear machines within it."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import class_counts, remainder, sampled
from .shared import add_columns

#: Documents that the machines are fitted on, for each language at most (by expectation).
SAMPLE_ROWS = 500
DIMS = 4096
UNKNOWN = "und"
#: Families of closely related languages, by their codes; a code not listed is a family of its own. Fixed values.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "uralic": ("fi", "et", "hu"),
}
_SIGNS = bytes(c for c in range(128) if not chr(c).isalpha())
_LETTERS = bytes.maketrans(_SIGNS, b" " * len(_SIGNS))
_STEP = 1 << 20


def trigram_profile(raw: bytes) -> np.ndarray:
    """Square roots of the shares of byte trigrams, hashed to ``DIMS``: a vector of length 1.

    ASCII letters are lower-cased and other ASCII signs are spaces; a space stands before and after.
    """
    data = np.frombuffer(b" " + raw.lower().translate(_LETTERS) + b" ", np.uint8)
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, max(1, len(data) - 2), _STEP):
        part = data[at : at + _STEP + 2].astype(np.uint32)
        codes = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (part[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount(codes >> np.uint32(20), minlength=DIMS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def linear_machine(profiles: np.ndarray, positive: np.ndarray, penalty: float = 1e-3, rounds: int = 120) -> np.ndarray:
    """Weights, the intercept last, of a linear support vector machine (squared hinge, both sides
    weighing the same), by gradient steps with momentum."""
    data = np.column_stack([profiles, np.ones(len(profiles), np.float32)])
    sign = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32)
    w = np.zeros(data.shape[1], np.float32)
    ahead, momentum, step = w.copy(), 1.0, 1 / (4 + penalty)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * (data @ ahead))
        grad = penalty * ahead - 2 * (weight * sign * slack) @ data
        new = ahead - step * grad
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        ahead, w, momentum = new + (momentum - 1) / following * (new - w), new, following
    return w


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def fit(profiles: np.ndarray, langs: list[str]) -> dict:
    """One machine for each family against the rest, and one for each pair of languages within one."""
    langs = np.array(langs)
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs.tolist())):
        families.setdefault(family_of(lang), []).append(lang)
    names = sorted(families)
    own = np.array([family_of(lang) for lang in langs])
    heads = [linear_machine(profiles, own == name) for name in names] if len(names) > 1 else []
    pairs = {}
    for name in names:
        for a, b in combinations(families[name], 2):
            rows = (langs == a) | (langs == b)
            pairs[a, b] = linear_machine(profiles[rows], langs[rows] == a)
    return {"families": families, "names": names, "heads": heads, "pairs": pairs}


def predict(model: dict, profiles: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language of each profile and a score: how sure both steps are, from 0 to 1."""
    def sure(margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-4 * np.clip(margin, -10, 10)))

    data = np.column_stack([profiles, np.ones(len(profiles), np.float32)])
    if model["heads"]:
        margins = data @ np.stack(model["heads"]).T
        family, score = margins.argmax(axis=1), sure(margins.max(axis=1))
    else:
        family, score = np.zeros(len(data), np.int64), np.ones(len(data))
    found = np.empty(len(data), object)
    for i, name in enumerate(model["names"]):
        rows = np.nonzero(family == i)[0]
        langs = model["families"][name]
        votes, least = np.zeros((len(rows), len(langs))), np.full((len(rows), len(langs)), 1.0)
        for a, b in combinations(range(len(langs)), 2):
            chance = sure(data[rows] @ model["pairs"][langs[a], langs[b]])
            # A vote each; the margins only settle ties.
            votes[:, a] += (chance >= 0.5) + 1e-3 * chance
            votes[:, b] += (chance < 0.5) + 1e-3 * (1 - chance)
            least[:, a], least[:, b] = np.minimum(least[:, a], chance), np.minimum(least[:, b], 1 - chance)
        if len(rows):
            best = votes.argmax(axis=1)
            found[rows] = np.array(langs, object)[best]
            score[rows] *= least[np.arange(len(rows)), best]
    return found.tolist(), score


def language_model(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_out: int = 1,
    sample_rows: int = SAMPLE_ROWS,
) -> dict | None:
    """``fit`` on a bounded sample of documents with a language and a letter, outside the held-out
    fold. The sample reaches the driver as profiles. None if there is no such document."""
    known = docs.where(
        (remainder(F.col(f"`{id_col}`"), folds) != held_out) & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").rlike(r"\p{L}")
    ).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang_col}`").alias("label"), F.col(f"`{text_col}`").alias("text"))
    counts = class_counts(known, "label")

    def profiles(texts: list[bytes | None]) -> list[list[bytes]]:
        return [[trigram_profile(raw or b"").astype(np.float16).tobytes() for raw in texts]]

    sample = sampled(known, "_id", "label", counts, sample_rows)
    rows = add_columns(sample, "text", ["_id", "label"], [("profile", pa.binary(), T.BinaryType())], profiles).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (str(r["_id"]), r["label"], bytes(r["profile"])))
    matrix = np.stack([np.frombuffer(r["profile"], np.float16) for r in rows]).astype(np.float32)
    return fit(matrix, [r["label"] for r in rows])


def identify_languages(
    docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1,
    carry: list[str] | None = None,
) -> DataFrame:
    """The carried columns with held_out, lang_pred and score for every row.

    A null text, one without a letter, or any text when nothing was learned is ``und`` with score 0.
    Repeated rows each get theirs; a null id is not held out (nor learned from); an empty table gives
    no rows; carried columns with these names are replaced.
    """
    carry = docs.columns if carry is None else carry
    carry = [c for c in carry if c not in ("held_out", "lang_pred", "score")]

    def judge(texts: list[bytes | None]) -> list:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [i for i, raw in enumerate(texts) if raw is not None] if model else []
        for at in range(0, len(rows), 512):
            part = rows[at : at + 512]
            found, score = predict(model, np.stack([trigram_profile(texts[i]) for i in part]))
            for i, lang, s in zip(part, found, score):
                langs[i], scores[i] = lang, s
        return [langs, scores.tolist()]

    fields = [("lang_pred", pa.string(), T.StringType()), ("score", pa.float64(), T.DoubleType())]
    held = F.coalesce(remainder(F.col(f"`{id_col}`"), folds) == held_out, F.lit(False))
    text = F.when(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.col(f"`{text_col}`"))
    judged = add_columns(docs.withColumns({"_held": held, "_letters": text}), "_letters", [*carry, "_held"], fields, judge)
    return judged.select(*[f"`{c}`" for c in carry], F.col("_held").alias("held_out"), "lang_pred", "score")
