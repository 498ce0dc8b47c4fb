"""The corpus pipeline: documents to packed windows of token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; what it returns is
written as Parquet and read again as the next one's docs. All but the last return the columns of
documents: rejected rows are gone, and a row whose text was cut has its new text and n_chars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import decontaminate, packing, quality, simhash, substring_dedup
from earshot.llm.common import prepare, remove_staged, staged, staged_so_far, table
from earshot.llm.language import remainder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier, learnt from labels, scores 0.7 or more."""
    prepare(spark)
    model = quality.learn(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return quality.keep_good(docs, model)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has. Texts nothing is cut from stay
    as they are."""
    prepare(spark)
    cut = substring_dedup.dedup(docs.select(F.struct("*").alias("row"), "doc_id", "text"))
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return cut.select(
        [
            (F.when(changed, new[c]).otherwise(F.col("row")[c]) if c in new else F.col("row")[c])
            .alias(c)
            for c in docs.columns
        ]
    )


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, in sequences of at most 1024 token ids."""
    prepare(spark)
    packed = packing.pieces(docs, "byte_bpe_50k.json", 0)
    return packed.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one),
    ("substring dedup", cut_passages),
    ("benchmark decontamination", keep_uncontaminated),
    ("packing", pack),
]

# Classifier, fingerprints and tokenizer are beyond SQL; the tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one staged is removed once the next one's result is written."""
    prepare(spark)
    docs, mark = table(spark, sf_dir, "documents"), staged_so_far()
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        remove_staged(spark, mark, docs)
    return docs
