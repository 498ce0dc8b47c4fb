"""Benchmark decontamination: find documents that hold word windows of test items.

The hash set of the items' windows is broadcast when it is measured to be small. Of more, a filter
of bounded size is broadcast: words of 64 bits, in one of which each window sets three; documents'
windows that find all three set are few, and only they are shuffled to the items' windows. A
document's windows are hashed where they are read, and hits are verified word by word. Column
expressions and joins only.

Null and wordless texts have no words; items without words have no windows. Repeated rows get
one result each. A document text is keyed by (doc_id, digest of its text), so rows that share a
doc_id keep their own results. Further columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10

# An item window is under 1 kB in memory; this many are broadcast at most.
BROADCAST_WINDOWS = 100_000

# Words of the filter: one for each window, up to this many, of some 50 bytes in a broadcast.
FILTER_WORDS = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cases A-Z; runs of digits, letters a-z and characters beyond ASCII are words."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def _windows(words: Column, length: int) -> Column:
    """The hash of each run of ``length`` words, by its first word's place."""
    places = F.when(
        F.size(words) >= length, F.sequence(F.lit(1), F.size(words) - (length - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, length)))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, length, hash, words: every window of every item, each once per item."""
    split = items.select("item_id", words_of(F.col("text")).alias("_words")).where(
        F.size("_words") > 0
    )
    length = F.least(F.lit(window), F.size("_words"))
    places = F.sequence(F.lit(1), F.size("_words") - length + 1)
    return (
        split.select(
            "item_id",
            length.alias("length"),
            F.explode(
                F.transform(places, lambda i: F.slice(F.col("_words"), i, length))
            ).alias("words"),
        )
        .distinct()
        .withColumn("hash", F.xxhash64("words"))
    )


def _filter_word(hash_: Column, words: int) -> Column:
    """Which word of a filter a window's hash has its bits in."""
    return F.pmod(hash_, F.lit(words))


def _filter_bits(hash_: Column) -> Column:
    """The three bits that a window's hash sets there, from other digits of it."""

    def bit(at: int) -> Column:
        place = F.shiftrightunsigned(hash_, at).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return bit(58).bitwiseOR(bit(52)).bitwiseOR(bit(46))


def window_filter(windows: DataFrame, words: int) -> DataFrame:
    """word, bits: of ``words`` words of 64 bits those that the windows' hashes set bits in."""
    return windows.groupBy(_filter_word(F.col("hash"), words).alias("word")).agg(
        F.bit_or(_filter_bits(F.col("hash"))).alias("bits")
    )


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, at, length, item_id: where an item's window stands in a document."""
    windows = item_windows(items, window)
    # At most ``window`` rows; only the lengths that occur are scanned for.
    measured = windows.groupBy("length").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in measured)
    small = total <= BROADCAST_WINDOWS
    words = max(1, min(FILTER_WORDS, total))
    split = docs.select(
        "doc_id", F.md5("text").alias("text_key"), words_of(F.col("text")).alias("_doc_words")
    )
    found = None
    for length in sorted(r["length"] for r in measured):
        of_length = windows.where(F.col("length") == length)
        # The words of a row stay one shared value until a window hits.
        scanned = split.where(F.size("_doc_words") >= length).select(
            "*", F.posexplode(_windows(F.col("_doc_words"), length)).alias("at", "_hash")
        )
        if small:
            joined = scanned.join(F.broadcast(of_length), F.col("_hash") == F.col("hash"))
            mine = F.slice("_doc_words", F.col("at") + 1, F.col("length"))
        else:
            bits = _filter_bits(F.col("_hash"))
            passed = scanned.join(
                F.broadcast(window_filter(of_length, words)),
                (_filter_word(F.col("_hash"), words) == F.col("word"))
                & (F.col("bits").bitwiseAND(bits) == bits),
            )
            thin = passed.withColumn("_mine", F.slice("_doc_words", F.col("at") + 1, length))
            joined = thin.drop("_doc_words", "word", "bits").join(
                of_length, F.col("_hash") == F.col("hash")
            )
            mine = F.col("_mine")
        hits = joined.where(mine == F.col("words")).select(
            "doc_id", "text_key", "at", "length", "item_id"
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = split.where(F.lit(False)).select(
            "doc_id", "text_key", F.lit(0).alias("at"), F.lit(0).alias("length"),
            F.lit(0).cast(items.schema["item_id"].dataType).alias("item_id"),
        )
    return found


def covered(spans: Column) -> Column:
    """How many places sorted (at, length) spans cover."""
    start = F.struct(F.lit(0).alias("until"), F.lit(0).alias("total"))

    def add(done: Column, span: Column) -> Column:
        until = span["at"] + span["length"]
        fresh = F.greatest(F.lit(0), until - F.greatest(done["until"], span["at"]))
        return F.struct(
            F.greatest(done["until"], until).alias("until"),
            (done["total"] + fresh).alias("total"),
        )

    return F.aggregate(spans, start, add, lambda done: done["total"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, text_key, n_words, spans (at, length of each hit
    window), n_hit, item_ids (sorted as strings), contaminated."""
    hits = (
        occurrences(docs, items, window)
        .groupBy("doc_id", "text_key")
        .agg(
            F.sort_array(F.collect_set(F.struct("at", "length"))).alias("spans"),
            F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        )
        .select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans", "item_ids",
            covered(F.col("spans")).cast("long").alias("n_hit"),
        )
    )
    counted = docs.select(
        "doc_id", F.md5("text").alias("text_key"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return counted.join(hits, same, "left").select(
        "doc_id", "text_key", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<at:int,length:int>>")).alias("spans"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` no item window stands in, unchanged."""
    bad = occurrences(docs, items, window).select("doc_id", "text_key").distinct()
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.md5(docs["text"]) == bad["text_key"])
    return docs.join(bad, same, "left_anti")
