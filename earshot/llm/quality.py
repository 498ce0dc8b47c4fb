"""Quality classification by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. A passage is encoded from its bytes and words: the share
of each byte value, and how much its words repeat. A hidden layer encodes it further, a gated
attention (tanh times sigmoid) weighs the passages of a bag against each other, and the weighted
sum is scored. Only documents have labels; which passages matter is learnt with the rest.

Weights are fitted on the driver to at most ``MOST_DOCS`` labelled documents of each label, of at
most ``MOST_BYTES`` each and ``SAMPLE_BYTES`` together, the first by a hash of their id. That
bounds the driver's data; encoding and scoring cover every passage of every text, however long.
Other columns than doc_id and text are not read.

Null texts are empty; an empty text is a bag without passages, whose score is the bias alone.
Repeated rows are scored each. Of a document's repeated labels the least counts; null labels
don't. If one label is missing, every text scores the share of label 1, and 1.0 if both are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.wordhash import word_spans

PASSAGE_WORDS = 64
HIDDEN, GATE = 16, 8
MOST_DOCS = 1500
MOST_BYTES = 1 << 17
SAMPLE_BYTES = 8 << 20
STEPS, RATE, DECAY = 150, 0.02, 1e-4

_BINS = 128
_STRETCH = 1 << 19
_EXTRA = 5
FEATURES = 256 + _EXTRA


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many each text has."""
    joined = b" ".join(texts)
    starts, ends, words = word_spans(joined)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    passages = -(-counts // PASSAGE_WORDS)
    of_text = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    begins = np.cumsum(passages) - passages
    of = begins[of_text] + place // PASSAGE_WORDS
    total = int(passages.sum())
    x = np.zeros((total, FEATURES), np.float32)
    if not total:
        return x, passages
    heads = np.flatnonzero(place % PASSAGE_WORDS == 0)
    # A passage's bytes run from its first word to the next passage's, or to its text's end; what
    # lies between texts belongs to none.
    begin = starts[heads]
    end = np.minimum(np.append(begin[1:], len(joined)), offsets[of_text[heads] + 1] - 1)
    spans = np.stack([end - begin, np.append(begin[1:], len(joined)) - end], 1).ravel()
    owner = np.repeat(np.stack([np.arange(total), np.full(total, total)], 1).ravel(), spans)
    raw = np.frombuffer(joined, np.uint8)[begin[0] :]
    held = np.bincount(owner * 256 + raw, minlength=(total + 1) * 256).reshape(-1, 256)[:total]
    x[:, :256] = np.sqrt(held / np.maximum(1, held.sum(1, keepdims=True)))
    n = np.bincount(of, minlength=total).astype(np.float32)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    bins = np.zeros(total * _BINS, bool)
    bins[of * _BINS + (words % np.uint64(_BINS)).astype(np.int64)] = True
    filled = bins.reshape(total, _BINS).sum(1)
    x[:, 256] = np.bincount(of, same, total) / n
    x[:, 257] = filled / n
    x[:, 258] = np.bincount(of, ends - starts, total) / n / 8
    x[:, 259] = np.log2(n) / 6
    x[:, 260] = filled / (_BINS * (1 - (1 - 1 / _BINS) ** n))
    return x, passages


@dataclass(frozen=True)
class Model:
    """Weights; without any, ``base`` is every text's score."""

    base: float
    weights: dict[str, np.ndarray] | None = None

    def score(self, x: np.ndarray, passages: np.ndarray) -> np.ndarray:
        """The score of each bag."""
        if self.weights is None:
            return np.full(len(passages), self.base)
        return _forward(self.weights, x, np.repeat(np.arange(len(passages)), passages),
                        len(passages))["y"]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _per_bag(values: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(bag, values, bags)
    return np.stack([np.bincount(bag, v, bags) for v in values.T], 1)


def _forward(p: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, bags: int) -> dict:
    scaled = np.clip((x - p["mean"]) / p["scale"], -6, 6)
    h = np.tanh(scaled @ p["encode"] + p["encode_bias"])
    t, s = np.tanh(h @ p["tanh"]), _sigmoid(h @ p["gate"])
    e = (t * s) @ p["attend"]
    most = np.full(bags, -np.inf)
    np.maximum.at(most, bag, e)
    a = np.exp(e - most[bag])
    a /= np.maximum(_per_bag(a, bag, bags), 1e-30)[bag]
    z = _per_bag(a[:, None] * h, bag, bags)
    return {"x": scaled, "h": h, "t": t, "s": s, "a": a, "z": z,
            "y": _sigmoid(z @ p["out"] + p["bias"][0])}


def _gradient(p: dict[str, np.ndarray], f: dict, bag: np.ndarray, error: np.ndarray) -> dict:
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    back = (error[:, None] * p["out"][None, :])[bag]
    of_a = (h * back).sum(1)
    of_e = a * (of_a - _per_bag(a * of_a, bag, len(error))[bag])
    gated = of_e[:, None] * p["attend"]
    of_t, of_s = gated * s * (1 - t**2), gated * t * s * (1 - s)
    of_h = a[:, None] * back + of_t @ p["tanh"].T + of_s @ p["gate"].T
    of_in = of_h * (1 - h**2)
    return {
        "encode": f["x"].T @ of_in, "encode_bias": of_in.sum(0), "tanh": h.T @ of_t,
        "gate": h.T @ of_s, "attend": (t * s).T @ of_e, "out": f["z"].T @ error,
        "bias": np.array([error.sum()]),
    }


def fit(x: np.ndarray, passages: np.ndarray, labels: np.ndarray) -> Model:
    """Weights for bags of ``passages`` features and their labels, by Adam on the whole sample.
    Both labels weigh the same."""
    if not len(labels) or labels.min() == labels.max():
        return Model(float(labels.mean()) if len(labels) else 1.0)
    draw = np.random.default_rng(0)
    bag = np.repeat(np.arange(len(passages)), passages)
    p = {
        "encode": draw.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
        "encode_bias": np.zeros(HIDDEN),
        "tanh": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "gate": draw.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "attend": draw.normal(0, 1, GATE), "out": draw.normal(0, HIDDEN**-0.5, HIDDEN),
        "bias": np.zeros(1),
    }
    fixed = {
        "mean": x.mean(0) if len(x) else np.zeros(FEATURES),
        "scale": np.maximum(x.std(0), 0.02) if len(x) else np.ones(FEATURES),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    fixed = {k: v.astype(np.float32) for k, v in fixed.items()}
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, STEPS + 1):
        f = _forward(p | fixed, x, bag, len(labels))
        error = (weight * (f["y"] - labels)).astype(np.float32)
        for k, g in _gradient(p, f, bag, error).items():
            g = g + DECAY * p[k]
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            corrected = np.sqrt(v / (1 - 0.999**step)) + 1e-8
            p[k] = p[k] - RATE * (m / (1 - 0.9**step)) / corrected
    return Model(float(share), p | fixed)


def _stretches(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > _STRETCH:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if texts:
        yield begin, len(texts)


def learn(docs: DataFrame, labels: DataFrame, chosen: Column, most: int = MOST_DOCS) -> Model:
    """The model of the ``chosen`` labelled rows of ``docs``, a bounded sample of them."""
    spark = docs.sparkSession
    known = (
        labels.where(F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").cast("int").alias("_label"))
    )
    # Ids and labels alone choose the sample; then its texts are read.
    fits = docs.where(chosen & (F.coalesce(F.octet_length("text"), F.lit(0)) <= MOST_BYTES))
    fits = fits.select("doc_id", "text")
    sizes = fits.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("_size"))
    judged = sizes.join(known, F.col("doc_id") == F.col("_id"))
    judged = judged.select("_id", "_label", "_size", F.xxhash64("_id", F.lit(0)).alias("_order"))
    sample = [
        judged.where(F.col("_label") == label).orderBy("_order", "_id").limit(most)
        for label in (0, 1)
    ]
    rows = []
    for of_label in sample:
        held = 0
        for r in of_label.select("_id", "_label", "_size").collect():
            held += r["_size"] or 0
            if held <= SAMPLE_BYTES:
                rows.append((r["_id"], r["_label"]))
    if not rows:
        return fit(np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.zeros(0))
    picked = spark.createDataFrame(rows, "_id long, _label int")
    # One text of each id, so that repeated rows don't lift the bound.
    bags = (
        fits.join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id", "_label")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )
    found = sorted(map(tuple, bags.collect()))
    x, passages = encode_all([text.encode() for _, _, text in found])
    return fit(x, passages, np.array([label for _, label, _ in found], np.float64))


def encode_all(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [encode(texts[a:b]) for a, b in _stretches(texts)]
    return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            scores = [
                shared.value.score(*encode(texts[a:b])) for a, b in _stretches(texts)
            ] or [np.zeros(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores), pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            scores = [
                shared.value.score(*encode(texts[a:b])) for a, b in _stretches(texts)
            ] or [np.zeros(0)]
            yield batch.filter(pa.array(np.concatenate(scores) >= least))

    return docs.mapInArrow(run, docs.schema)
