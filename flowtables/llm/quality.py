"""Quality of texts by attention over their passages, learned from labels of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.language import held_out
from flowtables.llm.words import hashes_in, pieces, text_bytes

#: Words of a passage; training texts (those of least hash) and their greatest size.
PASSAGE, TRAINING_DOCUMENTS, TRAINING_BYTES = 48, 4_000, 64 << 10
#: Buckets of hashed words; units of the encoder and of the attention.
BUCKETS, HIDDEN, ATTENTION = 32, 16, 8
EPOCHS, RATE, DECAY, SEED = 40, 0.01, 1e-4, 11
#: A score from which a text is predicted to be good.
CUT = 0.3
SLICE = 4 << 20

#: Kinds of bytes that are counted: each mark for itself, and letters, digits, ...
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KIND = np.zeros(256, np.int64)
_KIND[[ord(c) for c in MARKS]] = np.arange(len(MARKS)) + 1
for _k, _chars in enumerate((range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100), [0x0A], [0x20])):
    _KIND[list(_chars)] = len(MARKS) + 1 + _k
KINDS = int(_KIND.max()) + 1
FEATURES = KINDS + BUCKETS + 4


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, a row each, and where each text's start (one more than
    texts).  A passage is ``PASSAGE`` words with what stands between and after them; every
    text has one at least, and passages cover it whole."""
    data, at = text_bytes(texts)
    hashes, first = hashes_in(data, at)
    words = np.searchsorted(first, at)
    counts = np.diff(words)
    number = np.maximum(1, -(-counts // PASSAGE))
    heads = np.concatenate([[0], np.cumsum(number)])
    owner = np.repeat(np.arange(len(counts)), number)
    inside = np.arange(heads[-1]) - heads[:-1][owner]
    start = np.where(inside > 0, first[np.minimum(words[:-1][owner] + inside * PASSAGE, max(0, len(first) - 1))] if len(first) else 0, at[:-1][owner])
    lengths = np.diff(np.append(start, len(data)))
    kinds = np.zeros(heads[-1] * KINDS, np.float64)
    ends = np.append(start, len(data))
    for a in range(0, len(data), SLICE):
        b = min(len(data), a + SLICE)
        low, high = np.searchsorted(ends, a, "right") - 1, np.searchsorted(ends, b, "left")
        span = np.clip(ends[low : high + 1], a, b)
        place = np.repeat(np.arange(high - low) * KINDS, np.diff(span)) + _KIND[data[a:b]]
        kinds[low * KINDS : high * KINDS] += np.bincount(place, minlength=(high - low) * KINDS)
    n = np.minimum(PASSAGE, np.maximum(0, counts[owner] - inside * PASSAGE))
    passage = np.repeat(np.arange(heads[-1]), n)
    bags = np.bincount(passage * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=heads[-1] * BUCKETS)
    out = np.zeros((heads[-1], FEATURES))
    size, many = np.maximum(lengths, 1)[:, None], np.maximum(n, 1)[:, None]
    out[:, :KINDS] = np.sqrt(kinds.reshape(-1, KINDS) / size)
    out[:, KINDS : KINDS + BUCKETS] = bags.reshape(-1, BUCKETS) / many
    for back in (1, 2):  # words that come again at once
        same = np.flatnonzero((hashes[back:] == hashes[:-back]) & (passage[back:] == passage[:-back])) + back
        out[:, KINDS + BUCKETS + back - 1] = np.bincount(passage[same], minlength=heads[-1]) / many[:, 0]
    out[:, -2] = np.log1p(lengths / many[:, 0])
    out[:, -1] = np.log1p(n)
    return out, heads


@dataclass
class Model:
    """Standardised features, an encoder, gated attention, and a logistic unit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (features - self.mean) / self.scale, heads)["score"]


def _forward(w: dict[str, np.ndarray], x: np.ndarray, heads: np.ndarray) -> dict[str, np.ndarray]:
    starts, number = heads[:-1], np.diff(heads)
    h = np.tanh(x @ w["encode"] + w["encode0"])
    v, u = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
    logit = (v * u) @ w["a"]
    top = np.maximum.reduceat(logit, starts)
    e = np.exp(logit - np.repeat(top, number))
    weight = e / np.repeat(np.add.reduceat(e, starts), number)
    z = np.add.reduceat(weight[:, None] * h, starts)
    return {"h": h, "v": v, "u": u, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))}


def _gradient(w, x, heads, y):
    f, number = _forward(w, x, heads), np.diff(heads)
    error = (f["score"] - y) / len(y)
    dz = np.repeat(error[:, None] * w["out"], number, axis=0)
    dh = f["weight"][:, None] * dz
    dweight = (dz * f["h"]).sum(axis=1)
    mean = np.add.reduceat(dweight * f["weight"], heads[:-1])
    dlogit = f["weight"] * (dweight - np.repeat(mean, number))
    gate = dlogit[:, None] * w["a"]
    dv, du = gate * f["u"] * (1 - f["v"] ** 2), gate * f["v"] * f["u"] * (1 - f["u"])
    dh = (dh + dv @ w["v"].T + du @ w["u"].T) * (1 - f["h"] ** 2)
    return {
        "encode": x.T @ dh, "encode0": dh.sum(axis=0), "v": f["h"].T @ dv, "u": f["h"].T @ du, "a": (f["v"] * f["u"]).T @ dlogit,
        "out": f["z"].T @ error, "out0": error.sum(keepdims=True),
    }


def fit(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """Gradient descent with momentum and scaling (Adam) over small lots of texts, in a fixed order."""
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    bags = [(b - mean) / scale for b in bags]
    draw = np.random.default_rng(SEED)
    shape = {"encode": (FEATURES, HIDDEN), "encode0": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "out": (HIDDEN,), "out0": (1,)}
    w = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) if not k.endswith("0") else np.zeros(s) for k, s in shape.items()}
    share = np.clip(y.mean(), 0.01, 0.99)
    w["out0"] += np.log(share / (1 - share))
    m, v, t = {k: np.zeros(s) for k, s in shape.items()}, {k: np.zeros(s) for k, s in shape.items()}, 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(bags))
        for lot in np.array_split(order, max(1, len(order) // 64)):
            x = np.concatenate([bags[i] for i in lot])
            heads = np.concatenate([[0], np.cumsum([len(bags[i]) for i in lot])])
            t += 1
            for k, g in _gradient(w, x, heads, y[lot]).items():
                g = g + DECAY * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, w)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """A model from ``TRAINING_DOCUMENTS`` labelled texts at most, of at most ``TRAINING_BYTES``; null if there are none.  Features
    are computed in tasks; the fit runs on the driver over this bounded sample."""
    known = labels.select(F.col("doc_id").alias("_label"), F.col(label).alias("y")).where("y is not null and _label is not null")
    # more than are needed, since long texts do not count; a label that is repeated counts once
    some = known.groupBy("_label").agg(F.min("y").alias("y")).orderBy(F.xxhash64("_label")).limit(2 * TRAINING_DOCUMENTS)
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    short = F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAINING_BYTES
    rows = named.join(F.broadcast(some), named["_id"] == F.col("_label")).where(short)
    chosen = rows.orderBy(F.xxhash64("_id"), F.xxhash64("text")).limit(TRAINING_DOCUMENTS)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x, heads = passages(batch["text"])
            bags = [x[a:b].astype(np.float32).tobytes() for a, b in zip(heads[:-1], heads[1:])]
            yield pa.RecordBatch.from_arrays([batch["_id"].cast(pa.int64()), batch["y"].cast(pa.float64()), pa.array(bags, pa.binary())], ["id", "y", "x"])

    found = chosen.mapInArrow(features, "id long, y double, x binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.id, bytes(r.x)))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES).astype(np.float64) for r in found]
    return fit(bags, np.array([r.y for r in found]))


def score_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, fold: int = 0
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row: the chance that its label is 1, and 1
    if that is at least ``CUT``.

    A text is cut into passages; each is encoded from what kinds of characters and words it
    has; a gated attention, learned together with the encoder from the labels of whole
    texts, weighs passages; the weighted sum is scored.  Labels of rows whose id is in the
    held-out fold are not used.  Null and empty texts are one passage without words and get
    a score, too.  Without any label all scores are 0.5.  Equal texts get equal scores.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    model = train(docs, labels.where(~held_out(F.col("doc_id"), folds, fold)), doc_id, text, label)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in pieces(batches, "text"):
            scores = np.full(batch.num_rows, 0.5) if model is None else model.scores(*passages(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores)], ["doc_id", "held_out", "score"])

    named = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id), folds, fold).alias("held_out"), F.col(text).alias("text"))
    scored = named.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
