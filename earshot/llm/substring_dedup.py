"""Substring dedup: cut passages that an earlier document has, by repeated-phrase automata.

A window is a run of 13 words. Every window has an anchor, the least hash among its runs of six
words; equal windows have equal anchors. Runs of up to eight windows with one anchor are a
segment, so a document is cut into overlapping segments and equal windows of two documents stand
in segments of one anchor.

1. Anchors are counted over all documents; those of two or more documents may recur. A filter of
   bounded size holds them. An anchor of more than ``SHARD_SEGMENTS`` segments is common, as a
   second filter says: from here on each of its windows is a segment of its own.
2. Segments whose anchor may recur go to their anchor's shard, or by their own digest if it is
   common, each text once per stretch of documents with its first and last document. Equal
   segments are told by 128 bits (anchor and digest). There, recurring passages are confirmed word
   by word: an Aho-Corasick automaton is compiled of the windows of a bounded number of segments,
   whole anchors at a time but for common ones, with each window's first document, and the
   segments are streamed through it. What comes out is, for every segment that recurs, the first
   document of each of its windows.
3. All documents are streamed again, and every segment of theirs takes what its text gave in the
   automaton, by (anchor, digest): equal segments hold equal windows wherever they stand. The
   windows whose first document is an earlier one are cut.

A passage that a third of all documents share is one segment text in step 2; in step 3 it is a
skewed join that adaptive execution splits. A phrase that they hold in differing surroundings is a
common anchor, whose windows are spread over the shards. A shard task holds one automaton.

Words are runs of bytes other than white space (0x20, 0x09 to 0x0D). Null texts and texts without
words have none. Very long texts are read whole. Further columns travel along untouched. Rows without a doc_id are neither earlier nor later: they stay whole and cut
nothing. Rows that share a doc_id are neither either; each is judged by its own text, which is
told apart by a 64-bit digest. Ties and repeats within a document cut nothing. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm import bloom
from earshot.llm.common import partitions, remove_staged, staged, staged_so_far
from earshot.llm.wordhash import MULTIPLIER, U, mix, sums, word_spans

WINDOW = 13
ANCHOR_WORDS = 6
# 13 - 6 + 1: the places of the anchor in a window, a power of two for the running minimum.
_PLACES = WINDOW - ANCHOR_WORDS + 1

# An anchor of more segments is common.
SHARD_SEGMENTS = 20_000

# Segments an automaton is compiled of: whole anchors until there are so many. With more, its root
# has so many different first words that building it takes longer than all else. They have at most
# 20 words each, so the words are fewer than there are characters.
COMPILED_SEGMENTS = 500

# Recurring anchors a shuffle partition should hold.
ANCHORS_PER_SHARD = 100_000

# Segments that are combined before they are sent, and text handled at a time.
COMBINED_SEGMENTS = 100_000
_STRETCH = 1 << 20

class Segments:
    """The segments of a stretch of texts: of which text, first word, windows, anchor, digest.
    Those of the anchors that the filter ``common`` lets pass have one window."""

    def __init__(self, texts: list[bytes], common: np.ndarray | None = None) -> None:
        split = [t.split() for t in texts]
        self.text = b" ".join(b" ".join(words) for words in split)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        self.starts, self.ends, words = word_spans(self.text)
        first = np.cumsum(counts) - counts
        n = max(0, len(words) - ANCHOR_WORDS + 1)
        grams = np.zeros(n, U)
        for j in range(ANCHOR_WORDS):
            grams = grams * U(MULTIPLIER) + words[j : j + n]
        least = mix(grams)
        step = 1
        while step < _PLACES:
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            step *= 2
        # Windows that lie in one text.
        inside = np.maximum(0, counts - WINDOW + 1)
        at = np.arange(int(inside.sum())) + np.repeat(first - (np.cumsum(inside) - inside), inside)
        of = np.repeat(np.arange(len(texts)), inside)
        anchor = least[at] if len(at) else np.zeros(0, U)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])
        run = np.flatnonzero(fresh)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        often = np.zeros(len(at), bool)
        if common is not None and len(run):
            passed = bloom.passes(common, anchor[run])
            often = np.repeat(passed, np.diff(np.append(run, len(at))))
        begin = np.flatnonzero((place % _PLACES == 0) | often)
        self.common = often[begin]
        self.of, self.word, self.anchor = of[begin], at[begin], anchor[begin]
        self.windows = np.diff(np.append(begin, len(at)))
        self.place = self.word - first[self.of]
        self.key = mix(
            sums(words, self.word, self.word + self.windows + WINDOW - 1)
            + self.windows.astype(U)
        )

    def words(self, i: int) -> bytes:
        last = self.word[i] + self.windows[i] + WINDOW - 2
        return self.text[self.starts[self.word[i]] : self.ends[last]]


def _stretches(
    batch: pa.RecordBatch, common: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, Segments]]:
    """Rows and segments, some text at a time."""
    rows, texts, size = [], [], 0
    for i, text in enumerate(batch.column("text")):
        data = (text.as_py() or "").encode()
        if texts and size + len(data) > _STRETCH:
            yield np.array(rows), Segments(texts, common)
            rows, texts, size = [], [], 0
        rows.append(i)
        texts.append(data)
        size += len(data)
    if texts:
        yield np.array(rows), Segments(texts, common)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def anchors(docs: DataFrame) -> DataFrame:
    """anchor, first, last, n: the first and last document of each, and its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for rows, found in _stretches(batch):
                yield pa.RecordBatch.from_arrays(
                    [_signed(found.anchor), pa.array(ids[rows][found.of])],
                    names=["anchor", "doc_id"],
                )

    placed = docs.select("doc_id", "text").mapInArrow(run, "anchor long, doc_id long")
    return placed.groupBy("anchor").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n")
    )


def _combined(rows: list[tuple[np.ndarray, ...]], texts: list[bytes]) -> pa.RecordBatch:
    """Each segment text once, with its first and last document."""
    anchor, key, doc, common = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((doc, key, anchor))
    anchor, key, doc, common = anchor[order], key[order], doc[order], common[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(order)) - 1
    return pa.RecordBatch.from_arrays(
        [
            _signed(anchor[begin]), _signed(np.where(common[begin], key[begin], U(0))),
            _signed(key[begin]),
            pa.array([texts[i] for i in order[begin]], pa.binary()),
            pa.array(doc[begin]), pa.array(doc[last]),
        ],
        names=["anchor", "part", "key", "words", "first", "last"],
    )


def segments(docs: DataFrame, shared) -> DataFrame:
    """anchor, part, key, words, first, last: segments that may recur, combined by stretch.
    ``shared`` has the filters of recurring and of common anchors; a common one's segments have
    their key as part, others part 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, often = shared.value
        rows, texts = [], []
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for of, found in _stretches(batch, often):
                may = np.flatnonzero(bloom.passes(words, found.anchor))
                rows.append(
                    (found.anchor[may], found.key[may], ids[of][found.of[may]], found.common[may])
                )
                texts += [found.words(i) for i in may.tolist()]
                if len(texts) >= COMBINED_SEGMENTS:
                    yield _combined(rows, texts)
                    rows, texts = [], []
        if texts:
            yield _combined(rows, texts)

    return docs.select("doc_id", "text").mapInArrow(
        run, "anchor long, part long, key long, words binary, first long, last long"
    )


class _Symbols(dict):
    """A character for each word met. Surrogates are no characters."""

    def __missing__(self, word: bytes) -> str:
        code = len(self)
        self[word] = symbol = chr(code if code < 0xD800 else code + 0x800)
        return symbol


def first_documents(held: dict[tuple[int, int], list]) -> Iterator[tuple[int, int, list[int]]]:
    """anchor, key and the first document of each window, for the segments that recur. ``held``
    has (words, first, last) by anchor and key, whole anchors or segments of one window.

    A segment that is its anchor's only one is a phrase as a whole; of others, that may share but
    some windows, each window is. No phrase of one anchor lies in a segment of another.
    """
    import ahocorasick

    symbols = _Symbols()
    automaton = ahocorasick.Automaton()
    texts_of = Counter(anchor for anchor, _ in held)
    # The later first document is overwritten by the earlier one.
    rows = [
        (anchor, key, "".join(map(symbols.__getitem__, words.split(b" "))), first, last)
        for (anchor, key), (words, first, last) in sorted(held.items(), key=lambda x: -x[1][1])
    ]
    for anchor, _, text, first, _ in rows:
        size = len(text) if texts_of[anchor] == 1 else WINDOW
        for j in range(len(text) - size + 1):
            automaton.add_word(text[j : j + size], first)
    automaton.make_automaton()
    for anchor, key, text, _, last in rows:
        firsts = [first for _, first in automaton.iter(text)]
        if min(firsts) < last:
            yield anchor, key, firsts * (len(text) - WINDOW + 1 if texts_of[anchor] == 1 else 1)


def recurring(found: DataFrame, partitions: int) -> DataFrame:
    """anchor, key, firsts of the segments some window of which an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        group: dict[tuple[int, int], list] = {}
        at = None

        def close_group() -> None:
            # An anchor of one document was let pass by chance, or a common one's window is of one.
            if min(x[1] for x in group.values()) < max(x[2] for x in group.values()):
                held.update(group)
            group.clear()

        def flush() -> pa.RecordBatch:
            rows = list(first_documents(held))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                ],
                names=["anchor", "key", "firsts"],
            )

        for batch in batches:
            for anchor, part, key, words, first, last in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (anchor, part) != at and group:
                    close_group()
                    if len(held) >= COMPILED_SEGMENTS:
                        yield flush()
                at = anchor, part
                seen = group.setdefault((anchor, key), [words, first, last])
                seen[1], seen[2] = min(seen[1], first), max(seen[2], last)
        if group:
            close_group()
        if held:
            yield flush()

    by = ["anchor", "part"]
    sharded = found.repartition(partitions, *by).sortWithinPartitions(*by)
    return sharded.mapInArrow(run, "anchor long, key long, firsts array<long>")


def cuts(docs: DataFrame, shared, firsts: DataFrame) -> DataFrame:
    """doc_id, text_key, cuts (place, mask): the windows of each text to cut, bit j of a mask
    for the window that starts j words after the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, often = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            keys = batch.column("text_key").to_numpy()
            for of, found in _stretches(batch, often):
                may = bloom.passes(words, found.anchor)
                row = of[found.of[may]]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(found.anchor[may]), _signed(found.key[may]),
                        pa.array(ids[row]), pa.array(keys[row]), pa.array(found.place[may]),
                    ],
                    names=["anchor", "key", "doc_id", "text_key", "place"],
                )

    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run, "anchor long, key long, doc_id long, text_key long, place long"
    )
    mask = F.aggregate(
        F.sequence(F.lit(0), F.size("firsts") - 1),
        F.lit(0),
        lambda m, j: F.when(
            F.get("firsts", j) < F.col("doc_id"),
            m.bitwiseOR(F.call_function("shiftleft", F.lit(1), j)),
        ).otherwise(m),
    )
    return (
        placed.join(firsts, ["anchor", "key"])
        .select("doc_id", "text_key", "place", mask.alias("mask"))
        .where("mask != 0")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("place", "mask")).alias("cuts"))
    )


def kept_words(text: bytes, found: list[dict] | None) -> tuple[int, int, bytes]:
    """Words, words cut, and the others joined by one space."""
    words = text.split()
    if not found:
        return len(words), 0, b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for cut in found:
        for j in range(_PLACES):
            if cut["mask"] >> j & 1:
                change[cut["place"] + j] += 1
                change[cut["place"] + j + WINDOW] -= 1
    keep = np.cumsum(change[:-1]) == 0
    kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedup(docs: DataFrame) -> DataFrame:
    """Every row's columns with n_words, n_removed and kept (its words that are left, joined by
    one space). Columns of these names in ``docs`` are replaced."""
    spark = docs.sparkSession
    added = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept", "string")
    docs = docs.drop(*added.names)
    judged = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    # A common anchor of one document is among them, as the filter may let it pass by chance.
    common = (F.col("n") > SHARD_SEGMENTS).alias("common")
    counted = anchors(judged).select("anchor", "first", "last", common)
    mark = staged_so_far()
    met = staged(counted.where("first < last or common").select("anchor", "common"), "anchors")
    sizes = met.agg(F.count("*"), F.count_if("common")).first()
    words = bloom.build(met, "anchor", sizes[0])
    # Both passes over the documents use one filter of common anchors: one that it lets pass by
    # chance has shorter segments in both.
    often = bloom.build(met.where("common"), "anchor", sizes[1]) if sizes[1] else None
    remove_staged(spark, mark)
    shared = spark.sparkContext.broadcast((words, often))
    shards = partitions(spark, sizes[0], ANCHORS_PER_SHARD)
    firsts = recurring(segments(judged, shared), shards)
    found = cuts(judged, shared, firsts)
    # Whole rows travel in one column, so that no column of theirs meets one of ours.
    rows = docs.select(F.struct("*").alias("row"))
    same = (rows["row.doc_id"] == found["doc_id"]) & (
        F.xxhash64(rows["row.text"]) == found["text_key"]
    )
    joined = rows.join(found, same, "left").select("row", "cuts")
    names = docs.columns
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row").flatten()
            kept = [
                kept_words((t.as_py() or "").encode(), c.as_py())
                for t, c in zip(columns[text], batch.column("cuts"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array([r[0] for r in kept], pa.int64()),
                    pa.array([r[1] for r in kept], pa.int64()),
                    pa.array([r[2].decode() for r in kept], pa.string()),
                ],
                names=[*names, *added.names],
            )

    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))
