"""SimHash near-duplicates, linked through a pigeonring filter.

A fingerprint's 64 bits lie on a ring of m segments. If two differ in at most d bits, some
segment starts a chain in which every first l segments differ in at most l * d / m bits. So each
distinct fingerprint is keyed by the segments of each chain whose budget is still nought; only
fingerprints that share such a key meet, the rest of the chain's budgets prune them, and the full
distance decides. Where more than ``MOST_TOGETHER`` share a key, as those of a template filled in
differently, they meet only if they share one of distance + 1 parts of the other bits too, which
two that are linked must. Equal fingerprints are one node, whatever their number.

A text without words (or null) has fingerprint 0 and links like any other. A very long text is
hashed whole, a stretch of words at a time. Rows whose doc_id is null link like any other and get
the smallest doc_id of their group, null if it has none. Rows that share a doc_id are linked by
their own texts. Repeated rows get one result each. Further columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import remove_staged, staged, staged_so_far
from earshot.llm.components import components

SHINGLE_WORDS = 3
DISTANCE = 2
SEGMENTS = 16
SEED = 42

# Fingerprints with one key that meet in pairs; of more, only those that share further bits do.
MOST_TOGETHER = 1000

# Such keys that are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 100_000

# Documents to leave out that are broadcast: two longs each.
BROADCAST_GONE = 500_000

# Bytes of a text whose words are held at a time.
_STRETCH = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _stretches(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of ``text``, a stretch at a time, each after the last words of the one before."""
    at, kept = 0, []
    while at < len(text):
        found = _SPACE.search(text, at + _STRETCH)
        end = found.end() if found else len(text)
        words = kept + text[at:end].split()
        yield words
        at, kept = end, words[max(0, len(words) - overlap) :] if overlap else []


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles, A-Z lower-cased, repeats included."""
    ones, total, words = np.zeros(64, np.int64), 0, []
    for words in _stretches((text or "").encode().lower(), shingle - 1):
        if len(words) < shingle:
            continue
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        joined = b" ".join(words)
        starts, ends = (ends - sizes).tolist(), ends.tolist()
        hashed = np.array(
            [
                xxhash.xxh64_intdigest(joined[a:b], SEED)
                for a, b in zip(starts, ends[shingle - 1 :], strict=False)
            ],
            "<u8",
        )
        ones += np.unpackbits(hashed.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
        total += len(hashed)
    if not total and words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little") if total else 0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, *more: str) -> DataFrame:
    """doc_id, the columns named in ``more``, fingerprint (a signed long) of every row."""
    names = ["doc_id", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(signed)],
                names=[*names, "fingerprint"],
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, "text").mapInArrow(run, f"{kinds}, fingerprint long")


def _rotated(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def links(nodes: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """a, b: pairs of ``nodes`` (node, fingerprint; fingerprints distinct) at most ``distance``
    bits apart."""
    if 64 % segments or distance >= segments:
        raise ValueError("segments must divide 64 and outnumber the distance")
    width = 64 // segments
    budget = {n: n * distance // segments for n in range(1, segments + 1)}
    # The longest chain of each budget is the strictest: counts only grow along it.
    longest = {b: n for n, b in budget.items()}
    key_bits = longest[0] * width
    starts = F.array(
        *[
            F.struct(
                F.lit(i).alias("start"), _rotated(F.col("fingerprint"), i * width).alias("ring")
            )
            for i in range(segments)
        ]
    )
    keyed = nodes.select("node", F.explode(starts).alias("_s")).select(
        "node",
        F.col("_s.start").alias("start"),
        F.col("_s.ring").alias("ring"),
        F.shiftrightunsigned("_s.ring", 64 - key_bits).alias("key"),
    )
    found = _meet(keyed, ["start", "key"], distance, width, longest)
    # Fingerprints that share a key differ in few bits beyond it, so of that many parts and one
    # more of those bits they share one: where very many share a key, only those meet.
    crowded = staged(
        keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where(F.col("n") > MOST_TOGETHER)
        .select("start", "key"),
        "crowded-keys",
    )
    many = crowded.count()
    if not many:
        return found.distinct()
    if many <= BROADCAST_KEYS:
        crowded = F.broadcast(crowded)
    ends = [n * (64 - key_bits) // (distance + 1) for n in range(distance + 2)]
    parts = F.array(
        *[
            F.struct(
                F.lit(n).alias("part"),
                F.shiftrightunsigned("ring", low)
                .bitwiseAND(F.lit((1 << (high - low)) - 1))
                .alias("bits"),
            )
            for n, (low, high) in enumerate(zip(ends, ends[1:]))
        ]
    )
    split = keyed.join(crowded, ["start", "key"]).select("*", F.explode(parts).alias("_p"))
    split = split.select("node", "start", "ring", "key", "_p.part", "_p.bits")
    others = keyed.join(crowded, ["start", "key"], "left_anti")
    return (
        _meet(others, ["start", "key"], distance, width, longest)
        .unionByName(
            _meet(split, ["start", "key", "part", "bits"], distance, width, longest)
        )
        .distinct()
    )


def _meet(
    keyed: DataFrame, keys: list[str], distance: int, width: int, longest: dict[int, int]
) -> DataFrame:
    """a, b: the pairs that share the keys and keep to the chain's budgets and the distance."""
    a, b = keyed.alias("a"), keyed.alias("b")
    differ = F.col("a.ring").bitwiseXOR(F.col("b.ring"))
    # One value that leads through the chain's budgets first and ends in the full distance, so
    # that no rule can put the full check before them.
    near = F.bit_count(differ) <= distance
    for allowed, n in sorted(longest.items(), reverse=True):
        if 0 < allowed < distance:
            prefix = F.bit_count(F.shiftrightunsigned(differ, 64 - n * width))
            near = F.when(prefix <= allowed, near).otherwise(F.lit(False))
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"a.{key}") == F.col(f"b.{key}")
    return a.join(b, same & (F.col("a.node") < F.col("b.node")) & near).select(
        F.col("a.node").alias("a"), F.col("b.node").alias("b")
    )


def _grouped(found: DataFrame, distance: int, segments: int) -> DataFrame:
    """fingerprint, group (the smallest fingerprint reachable) of the distinct ones of ``found``,
    staged."""
    mark = staged_so_far()
    nodes = staged(found.select("fingerprint").distinct(), "fingerprint-nodes")
    linked = components(
        links(nodes.withColumn("node", F.col("fingerprint")), distance, segments)
    ).withColumnRenamed("node", "fingerprint")
    grouped = staged(
        nodes.join(linked, "fingerprint", "left").select(
            "fingerprint", F.coalesce("component", "fingerprint").alias("group")
        ),
        "fingerprint-groups",
    )
    remove_staged(found.sparkSession, mark, grouped)
    return grouped


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """doc_id, fingerprint, component_id (the smallest doc_id reachable) of every row."""
    found = staged(fingerprints(docs, shingle), "fingerprints")
    grouped = _grouped(found, distance, segments)
    smallest = found.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    least = (
        grouped.join(smallest, "fingerprint")
        .groupBy("group")
        .agg(F.min("least").alias("component_id"))
    )
    named = grouped.join(least, "group").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(
    docs: DataFrame,
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """One row of each group: that of the smallest doc_id, and where unlike texts of the group
    share it, of the least fingerprint and digest. Texts of different groups that share a doc_id
    are told apart by a 64-bit digest and each judged in its own. Rows that repeat the one kept give
    one row. Rows without a doc_id can't be told apart and stay."""
    spark, mark = docs.sparkSession, staged_so_far()
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    found = staged(fingerprints(docs.withColumn("digest", digest), shingle, "digest"), "prints")
    known = found.where("doc_id is not null")
    grouped = _grouped(found, distance, segments)
    # One row a fingerprint before the groups are joined, however many copies it has.
    first = known.groupBy("fingerprint").agg(
        F.min(F.struct("doc_id", "fingerprint", "digest")).alias("first")
    )
    stays = grouped.join(first, "fingerprint").groupBy("group").agg(F.min("first").alias("first"))
    stays = staged(stays.select("first.doc_id", "first.digest"), "stays")
    rows = known.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    gone = staged(
        rows.join(stays, ["doc_id", "digest"], "left_anti").select("doc_id", "digest"), "gone"
    )

    def same(df: DataFrame, other: DataFrame):
        mine = F.xxhash64(F.coalesce(df["text"], F.lit("")))
        return (df["doc_id"] == other["doc_id"]) & (mine == other["digest"])

    # Few enough, they go to the documents; of more, whole documents are shuffled to them.
    if gone.count() <= BROADCAST_GONE:
        gone = F.broadcast(gone)
    kept = docs.join(gone, same(docs, gone), "left_anti")
    repeated = staged(
        rows.where("n > 1").join(stays, ["doc_id", "digest"]).select("doc_id", "digest"),
        "repeated",
    )
    remove_staged(spark, mark, gone, repeated)
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same(kept, repeated), "left_anti")
    twice = kept.join(repeated, same(kept, repeated), "left_semi")
    marked = twice.withColumn("_text_digest", digest)
    return once.unionByName(
        marked.dropDuplicates(["doc_id", "_text_digest"]).drop("_text_digest")
    )
