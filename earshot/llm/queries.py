"""The operators' queries, with the digest columns their contracts fix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import partitions_for, prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.substring_dedup import dedup

    prepare(spark)
    found = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.packing import pieces

    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    packed = pieces(docs, "byte_bpe_50k.json", 0)
    return packed.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.simhash import near_duplicates

    prepare(spark)
    found = near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.decontaminate import decontaminate

    prepare(spark)
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.sharding import shard

    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    ranges = partitions_for(docs, 1_000_000)
    dealt = shard(docs, ["doc_id", "size", "text_crc32"], 40, ranges=ranges)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.url_rules import judge

    prepare(spark)
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.token_files import round_trip

    prepare(spark)
    docs, path = table(spark, sf_dir, "documents"), "word_bpe_49k.json"
    back = round_trip(docs, path, 2, partitions_for(docs, 50_000))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.language import identify, learn, remainder

    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.language import remainder
    from earshot.llm.quality import learn, score

    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels, remainder("doc_id", 4) != 2)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.topk import search

    prepare(spark)
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.vector_codes import compress

    prepare(spark)
    coded = compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.token_counts import count_tokens

    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 2048)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from earshot.llm.negatives import mine

    prepare(spark)
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine(vectors, F.col("vec_id") % 100 == 0)


def all_queries() -> dict[str, Query]:
    found = {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
