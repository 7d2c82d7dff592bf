"""Quality scores by a convolutional network over bytes, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import labelled_sample, remainder
from .shared import add_columns

#: Labelled documents that the network is fitted on, for each label at most (by expectation). Each is used whole.
SAMPLE_ROWS = 1500
#: Bytes of a chunk, and how far the next one starts after it.
CHUNK, STEP = 512, 448
#: Numbers for each byte; filters; bytes in half a filter's width, which is also the filters' step.
EMBED, FILTERS, HALF = 8, 24, 4
EPOCHS = 8
_AT_ONCE = 256


def chunks_of(raw: bytes | None) -> tuple[np.ndarray, int]:
    """Overlapping chunks (rows of ``CHUNK`` bytes) that cover a text, and the bytes filled in each.

    The last chunk ends where the text does. A text shorter than a chunk is filled up with zeros.
    """
    data = np.frombuffer(raw or b"", np.uint8)
    if len(data) <= CHUNK:
        return np.pad(data, (0, CHUNK - len(data)))[None], len(data)
    starts = np.append(np.arange(0, len(data) - CHUNK, STEP), len(data) - CHUNK)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts], CHUNK


def empty_network(seed: int = 5) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    normal = lambda *shape, scale: draw.normal(0, scale, shape).astype(np.float32)
    return {
        "embed": normal(256, EMBED, scale=0.5),
        "left": normal(HALF * EMBED, FILTERS, scale=0.2),
        "right": normal(HALF * EMBED, FILTERS, scale=0.2),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": normal(3 * FILTERS, scale=0.1),
        "shift": np.zeros(1, np.float32),
    }


def _pooled(net: dict[str, np.ndarray], chunks: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and the place where it is."""
    count = len(chunks)
    blocks = net["embed"][chunks].reshape(count * (CHUNK // HALF), HALF * EMBED)
    left = (blocks @ net["left"]).reshape(count, -1, FILTERS)
    right = (blocks @ net["right"]).reshape(count, -1, FILTERS)
    response = left[:, :-1] + right[:, 1:]
    for i in np.nonzero(filled < CHUNK)[0]:
        response[i, max(1, -(-int(filled[i]) // HALF)) :] = -np.inf
    place = response.argmax(axis=1)
    return np.take_along_axis(response, place[:, None], 1)[:, 0] + net["bias"], place


def _combined(active: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each document the mean, largest and least of its chunks."""
    return np.concatenate(
        [
            np.add.reduceat(active, firsts) / counts[:, None],
            np.maximum.reduceat(active, firsts),
            np.minimum.reduceat(active, firsts),
        ],
        axis=1,
    )


def network_scores(net: dict[str, np.ndarray], texts: list[bytes | None]) -> np.ndarray:
    """A probability for each text, from all of it, a bounded number of chunks at a time.

    Rounded to 6 places: beyond them it depends on which texts are worked on together."""
    pooled, counts, held, filled = [], [], [], []

    def flush() -> None:
        if held:
            chunks = np.concatenate(held)
            fill = np.concatenate(filled)
            for at in range(0, len(chunks), _AT_ONCE):
                pooled.append(_pooled(net, chunks[at : at + _AT_ONCE], fill[at : at + _AT_ONCE])[0])
            held.clear()
            filled.clear()

    waiting = 0
    for raw in texts:
        chunks, fill = chunks_of(raw)
        counts.append(len(chunks))
        held.append(chunks)
        filled.append(np.full(len(chunks), fill))
        waiting += len(chunks)
        if waiting >= _AT_ONCE:
            flush()
            waiting = 0
    flush()
    if not counts:
        return np.empty(0)
    counts = np.array(counts)
    joined = _combined(np.maximum(np.concatenate(pooled), 0), np.cumsum(counts) - counts, counts)
    logits = (joined @ net["dense"] + net["shift"]).astype(np.float64)
    return np.round(1 / (1 + np.exp(-np.clip(logits, -30, 30))), 6)


def _backward(
    net: dict[str, np.ndarray], grads: dict[str, np.ndarray], chunks: np.ndarray, place: np.ndarray, flow: np.ndarray
) -> None:
    """Add what some chunks contribute to the gradients of filters and byte numbers."""
    rows = np.arange(len(chunks))[:, None]
    windows = np.lib.stride_tricks.sliding_window_view(chunks, 2 * HALF, axis=1)[rows, place * HALF]
    inputs = net["embed"][windows].reshape(len(chunks), FILTERS, 2, HALF * EMBED)
    grads["left"] += np.einsum("cfe,cf->ef", inputs[:, :, 0], flow)
    grads["right"] += np.einsum("cfe,cf->ef", inputs[:, :, 1], flow)
    both = np.concatenate([net["left"], net["right"]]).T.reshape(FILTERS, 2 * HALF, EMBED)
    spread = (flow[:, :, None, None] * both).reshape(-1, EMBED)
    flat = windows.reshape(-1)
    grads["embed"] += np.stack([np.bincount(flat, spread[:, e], 256) for e in range(EMBED)], axis=1)


def fit(texts: list[tuple[np.ndarray, int]], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, rate: float = 4e-3) -> dict:
    """A network that minimises the weighted log loss over documents given as chunks, by Adam.

    The pooled maximum passes its gradient to one window a filter and chunk, so a step back costs
    little beside the step forward. Chunks go through both a bounded number at a time; between them only
    what the filters pooled is held.
    """
    net = empty_network()
    share = (weights * labels).sum() / weights.sum()
    net["shift"][:] = np.log(max(share, 1e-3) / max(1 - share, 1e-3))
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    draw, step, scale = np.random.default_rng(11), 0, weights / weights.mean()
    for epoch in range(epochs):
        order = draw.permutation(len(texts))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(order), 48):
            docs = order[at : at + 48]
            cut = [texts[i] for i in docs]
            counts = np.array([len(c) for c, _ in cut])
            firsts = np.cumsum(counts) - counts
            chunks = np.concatenate([c for c, _ in cut])
            fill = np.repeat([f for _, f in cut], counts)
            pieces = [slice(i, i + _AT_ONCE) for i in range(0, len(chunks), _AT_ONCE)]
            pooled = [_pooled(net, chunks[p], fill[p]) for p in pieces]
            raw, place = (np.concatenate(part) for part in zip(*pooled))
            active = np.maximum(raw, 0)
            joined = _combined(active, firsts, counts)
            logit = joined @ net["dense"] + net["shift"]
            error = (scale[docs] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[docs]) / len(docs)).astype(np.float32)
            back = error[:, None] * net["dense"]
            mean, top, low = (np.repeat(back[:, k * FILTERS : (k + 1) * FILTERS], counts, axis=0) for k in range(3))
            per = np.repeat(joined, counts, axis=0)
            flow = mean / np.repeat(counts, counts)[:, None]
            flow += top * (active == per[:, FILTERS : 2 * FILTERS]) + low * (active == per[:, 2 * FILTERS :])
            flow *= raw > 0
            grads = {k: np.zeros_like(net[k], np.float64) for k in ("left", "right", "embed")}
            grads |= {"dense": joined.T @ error, "shift": error.sum(keepdims=True), "bias": flow.sum(axis=0)}
            for p in pieces:
                _backward(net, grads, chunks[p], place[p], flow[p])
            step += 1
            for k, grad in grads.items():
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.01 * (grad * grad - second[k])
                net[k] -= (pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def place_threshold(net: dict[str, np.ndarray], scores: np.ndarray, labels: np.ndarray, threshold: float) -> dict:
    """The network with its logits moved so that ``threshold`` parts the labels best.

    Best is where the shares of both labels that fall on their own side have the greatest sum; the cut lies
    in the middle between the two scores it parts. Without both labels nothing moves.
    """
    if len(set(labels.tolist())) < 2:
        return net
    order = np.argsort(scores, kind="stable")
    ranked, good = scores[order], labels[order] == 1
    # A cut before i sends the first i to label 0; only places between unlike scores are cuts.
    gain = np.cumsum(np.where(good, -1 / good.sum(), 1 / (~good).sum()))[:-1]
    gain[ranked[1:] == ranked[:-1]] = -np.inf
    if not len(gain) or gain.max() <= 0:
        return net
    i = int(gain.argmax())
    odds = np.log(np.clip(ranked[i : i + 2], 1e-6, 1 - 1e-6) / np.clip(1 - ranked[i : i + 2], 1e-6, 1 - 1e-6)).mean()
    return net | {"shift": (net["shift"] + np.log(threshold / (1 - threshold)) - odds).astype(np.float32)}


def quality_network(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.3,
) -> dict[str, np.ndarray]:
    """``fit`` on a bounded sample of whole texts outside the held-out fold, with ``threshold`` placed where it
    parts the sample best. Without a labelled document the network is not fitted, and scores near 0.5."""
    sample, counts = labelled_sample(docs, labels, label_col, id_col, text_col, sample_rows, folds, held_out)
    rows = sample.select("_id", "label", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")).collect()
    if not rows:
        return empty_network()
    rows.sort(key=lambda r: (str(r["_id"]), bytes(r["raw"])))
    texts = [bytes(r["raw"]) for r in rows]
    target = np.array([r["label"] for r in rows], float)
    drawn = {label: max(1.0, float((target == label).sum())) for label in counts}
    weights = np.array([counts[r["label"]] / drawn[r["label"]] for r in rows], float)
    net = fit([chunks_of(raw) for raw in texts], target, weights)
    return place_threshold(net, network_scores(net, texts), target, threshold)


def quality_scores(
    docs: DataFrame, net: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
    folds: int = 5, held_out: int = 0, carry: list[str] | None = None,
) -> DataFrame:
    """The carried columns with held_out, score and predicted for every row.

    Null and empty texts score alike, as one chunk without bytes. Repeated rows each get theirs; a
    null id is not held out (nor learned from); an empty table gives no rows; carried columns with
    these names are replaced.
    """
    carry = docs.columns if carry is None else carry
    carry = [c for c in carry if c not in ("held_out", "score", "predicted")]
    ids = docs.withColumn("_held", F.coalesce(remainder(F.col(f"`{id_col}`"), folds) == held_out, F.lit(False)))
    scored = add_columns(
        ids, text_col, [*carry, "_held"], [("score", pa.float64(), T.DoubleType())], lambda texts: [network_scores(net, texts).tolist()]
    )
    return scored.select(
        *[f"`{c}`" for c in carry], F.col("_held").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
