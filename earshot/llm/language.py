"""Language identification by prediction by partial matching over bytes.

Each language has a tree of contexts of up to three bytes. A byte's probability in a context is
its count over the context's total plus its number of different bytes; a byte not seen there
escapes, at that number over the same sum, to the next shorter context, and at last to one in
256. The counts are gathered from the training texts and then frozen, so the code length of a byte
after the three before it is a constant, and scoring a text is a lookup per byte and a sum. Lengths
are whole numbers of 1/1024 bit, so sums don't depend on how texts are batched.

The trees are fitted to a bounded amount of labelled text: ``MOST_BYTES`` in all, the same share
of it for each of the ``MOST_LANGUAGES`` languages with the most text. A language with less is
learnt from all its texts, another from whole texts of at most ``MOST_TEXT`` bytes, chosen by a
hash of their doc_id. No gram of these is left out: totals, kinds
and lengths come from every run of four bytes in them. The model holds a row per distinct run, so
it is bounded by the same number, on the driver and in every worker. It is sorted, not tabulated: a
byte is looked up after the longest context that has it in some language, and what other languages
escape to is part of its row. A context can be pruned by its share of a language's bytes, after
all counts are taken; it is then looked up as its longest suffix kept.

Every text is scored whole, whatever its length. Other columns are not read.

A text that is null or has no letter is ``und`` with score 0; so is every text if there is
nothing to learn from. Ties go to the first language in order. Rows without a doc_id aren't held
out and aren't learnt from. Repeated rows are scored each, and count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3
UNIT = 1024
# Parts of a unit in which escapes are added up, so that a byte's length is rounded once.
_FINE = 64

# Bytes of labelled text the trees are fitted to, in all and of one text, and languages learnt.
MOST_BYTES, MOST_TEXT, MOST_LANGUAGES = 16 << 20, 1 << 17, 200

_PAD = b"\n" * ORDER
_STRETCH = 1 << 19
_MERGE = 400_000


def _stretches(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """First and last of texts handled together."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > _STRETCH:
            yield begin, i
            begin, size = i, 0
        size += len(text) + ORDER
    if texts:
        yield begin, len(texts)


def _grams(texts: list[bytes]) -> np.ndarray:
    """Each run of four bytes, the first as the high byte; three newlines before each text."""
    raw = np.frombuffer(_PAD + _PAD.join(texts), np.uint8).astype("u4")
    return raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]


def gram_counts(texts: DataFrame) -> DataFrame:
    """lang, gram, n: runs of four bytes over all ``texts`` (lang, text), the first as the high
    byte. Each text starts after three newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.concatenate([n for _, n in parts])
            return keys, np.bincount(inverse, n, len(keys)).astype(np.int64)

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            data = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                own = [t.encode() for t, own in zip(data, langs, strict=True) if own == lang]
                for begin, end in _stretches(own):
                    gram = _grams(own[begin:end])
                    if not len(gram):
                        continue
                    parts = held.setdefault(lang, [])
                    parts.append(np.unique(gram, return_counts=True))
                    if sum(len(k) for k, _ in parts) > _MERGE:
                        held[lang] = [merged(parts)]
        for lang, parts in held.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(keys), pa.string()),
                    pa.array(keys.astype(np.int64)),
                    pa.array(n, pa.int64()),
                ],
                names=["lang", "gram", "n"],
            )

    found = texts.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Order:
    """The grams (context and byte) of one context length in order, each with its code length in
    each language, and the contexts in order, each with the length of its escape: 0 in a language
    that has no such context. Lengths are in 1/1024 bit over ``_FINE``."""

    grams: np.ndarray
    lengths: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` are in sorted ``keys``, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _suffix(grams: np.ndarray, k: int) -> np.ndarray:
    """The last byte of each gram after the ``k`` before it."""
    return grams & np.uint32((1 << 8 * (k + 1)) - 1)


@dataclass(frozen=True)
class Model:
    """Frozen code lengths, by order."""

    languages: list[str]
    orders: list[Order]

    def _of(self, grams: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte in each language."""
        out = np.zeros((len(grams), len(self.languages)), np.int32)
        left = np.arange(len(grams))
        for k in range(ORDER, -1, -1):
            order = self.orders[k]
            wanted = _suffix(grams[left], k)
            at, there = _found(order.grams, wanted)
            out[left[there]] += order.lengths[at[there]]
            left, wanted = left[~there], wanted[~there] >> 8
            at, there = _found(order.contexts, wanted)
            out[left[there]] += order.escapes[at[there]]
        out[left] += 8 * UNIT * _FINE
        return (out + _FINE // 2) // _FINE

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for begin, end in _stretches(texts):
            cost = self._of(_grams(texts[begin:end]))
            sizes = np.array([len(t) for t in texts[begin:end]])
            starts = np.cumsum(sizes + ORDER) - sizes - ORDER
            filled = np.flatnonzero(sizes)
            if len(filled):
                # Sums from a text's first byte to its last; the padding between is left out.
                bounds = np.stack([starts[filled], starts[filled] + sizes[filled]], 1).ravel()
                cost = np.concatenate([cost, np.zeros((1, out.shape[1]), np.int32)])
                out[begin + filled] = np.add.reduceat(cost, bounds, axis=0, dtype=np.int64)[::2]
        return out


def fit(counts: pd.DataFrame, min_share: float = 0.0) -> Model | None:
    """The model of gram counts (lang, gram, n). Contexts of a lower share than ``min_share`` in
    every language are left out of the model, but not of the counts."""
    if not len(counts):
        return None
    languages = sorted(counts["lang"].unique())
    lang = pd.Categorical(counts["lang"], categories=languages).codes
    grams, n = counts["gram"].to_numpy().astype(np.uint32), counts["n"].to_numpy(np.int64)
    # Each language's grams in order, so that those of one context stand together.
    own = []
    for i in range(len(languages)):
        keys, inverse = np.unique(grams[lang == i], return_inverse=True)
        own.append((keys, np.bincount(inverse, n[lang == i], len(keys))))

    orders, before = [], grams[:0]
    below = np.full((1, len(languages)), 8.0)
    for k in range(ORDER + 1):
        all_grams = np.unique(_suffix(grams, k))
        contexts = np.unique(all_grams >> 8)
        in_context = np.searchsorted(contexts, all_grams >> 8)
        parent = np.searchsorted(before, _suffix(all_grams, k - 1)) if k else 0
        bits = np.empty((len(all_grams), len(languages)))
        escapes = np.zeros((len(contexts), len(languages)))
        kept = np.zeros(len(contexts), bool)
        for i, (keys, m) in enumerate(own):
            keys, inverse = np.unique(_suffix(keys, k), return_inverse=True)
            m = np.bincount(inverse, m, len(keys))
            at = np.searchsorted(all_grams, keys)
            seen = np.bincount(in_context[at], m, len(contexts))
            kinds = np.bincount(in_context[at], minlength=len(contexts))
            has = kinds > 0
            escapes[has, i] = np.log2((seen[has] + kinds[has]) / kinds[has])
            bits[:, i] = escapes[in_context, i] + np.broadcast_to(below[:, i][parent], len(bits))
            whole = (seen + kinds)[in_context[at]]
            bits[at, i] = np.log2(whole / m)
            kept |= (seen >= min_share * m.sum()) & has
        lengths, out = (np.rint(x * UNIT * _FINE).astype(np.int32) for x in (bits, escapes))
        rows = kept[in_context]
        orders.append(Order(all_grams[rows], lengths[rows], contexts[kept], out[kept]))
        before, below = all_grams, bits
    return Model(languages, orders)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of a doc_id as text, modulo."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def learn(docs: DataFrame, chosen: Column) -> Model | None:
    """The model of the ``chosen`` rows of ``docs`` that have a text and a language, a bounded
    sample of them. The driver gets a row for each distinct gram of each language in it."""
    counts = gram_counts(bounded(docs.where(chosen)))
    return fit(counts.toArrow().to_pandas(strings_to_categorical=True))


def bounded(docs: DataFrame, most: int | None = None) -> DataFrame:
    """lang, text of about ``most`` bytes of labelled rows, all of them if they are fewer: the
    same for each language, of the rows whose doc_id's hash is below the share it may have."""
    labelled = docs.select("doc_id", "lang", "text").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    size = F.octet_length("text").cast("long")
    sizes = labelled.groupBy("lang").agg(
        F.sum(size).alias("bytes"), F.sum(F.when(size <= MOST_TEXT, size)).alias("small")
    )
    learnt = sizes.orderBy(F.col("bytes").desc(), "lang").limit(MOST_LANGUAGES).collect()
    each = (most or MOST_BYTES) / max(1, len(learnt))
    # A language with more than its share of bytes has its share of texts, none of them large.
    shares = docs.sparkSession.createDataFrame(
        [
            (r["lang"], *((1.0, None) if r["bytes"] <= each
                          else (each / max(1, r["small"] or 0), MOST_TEXT)))
            for r in learnt
        ],
        "lang string, _share double, _most long",
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 40)) / (1 << 40)
    chosen = labelled.join(F.broadcast(shares), "lang").where(
        F.col("_most").isNull() | ((size <= F.col("_most")) & (place < F.col("_share")))
    )
    return chosen.select("lang", "text")


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row's doc_id with lang_pred and score, the winner's share when each language's
    weight is 2 to the power of minus its code length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            letters = [t is not None and any(map(str.isalpha, t)) for t in texts]
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            rows = [i for i, has in enumerate(letters) if has and known is not None]
            if rows:
                lengths = known.lengths([texts[i].encode() for i in rows])
                best = lengths.argmin(1)
                over = lengths - lengths.min(1, keepdims=True)
                scores[rows] = 1 / np.exp2(-np.minimum(over / UNIT, 1000.0)).sum(1)
                for i, b in zip(rows, best.tolist(), strict=True):
                    names[i] = known.languages[b]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double"
    )
