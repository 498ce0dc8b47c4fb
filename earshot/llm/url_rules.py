"""URL filtering by mined association rules, under a short list of stated rules.

FP-growth mines combinations of URL tokens that go with a bad label; rules are pruned by support
and confidence and matched through an inverted index from token to rule. A stated rule
(host, path, verdict) that fits a URL comes before the mined ones, the longest first. Column
expressions, joins and the JVM's FP-growth only.

The rules come from a bounded number of labelled URLs (``MOST_LABELLED``); every page is matched.
The page's html and other columns are not read, and URLs of any length are taken whole.

A URL that is null or has no ``://`` has an empty host and path and no tokens: it is allowed
unless a stated rule fits. Repeated pages get a verdict each; repeated labels of a document
count as bad if any is. Without labels or rules everything unstated is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import staged

# The stated rules.
STATED = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# A mined rule needs this many bad URLs, at every size, and this share of those it fits bad.
MIN_ROWS = 25
MIN_CONFIDENCE = 0.6

# Labelled URLs the rules are mined from; of more, about so many, by a hash of the page. It bounds
# the tokens that the miner ranks on the driver: each stands in MIN_ROWS bad ones of these.
MOST_LABELLED = 1_000_000

# Token sets with a rule that are broadcast to the pages; more are joined by a shuffle.
BROADCAST_SETS = 100_000
_BAD = "\x00bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and the path up to a query or fragment."""
    mark = F.locate("://", F.coalesce(url, F.lit("")))
    after = F.when(mark > 0, F.substr(url, mark + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    rest = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), rest


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct host suffixes ("host:"), host labels and path segments' words."""
    labels = F.filter(F.split(host, r"\."), lambda t: t != "")
    words = F.filter(F.split(F.lower(path), r"[^\p{L}]+"), lambda t: t != "")
    return F.array_distinct(
        F.concat(
            F.transform(labels, lambda t: F.concat(F.lit("h:"), t)),
            F.transform(words, lambda t: F.concat(F.lit("p:"), t)),
        )
    )


def mine(
    urls: DataFrame,
    labels: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    min_rows: int = MIN_ROWS,
    most: int = MOST_LABELLED,
) -> DataFrame:
    """rule_id, tokens, confidence, support of token sets that go with bad labels.

    ``urls`` has page_id and tokens; a page is bad if its document's quality is 0 or toxic is 1.
    Tokens that stand in fewer than ``min_rows`` bad URLs can be in no rule and are left out before
    sets are mined. A rule is dropped if a shorter one among its tokens is at least as confident.
    """
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    judged = labels.groupBy(F.col("doc_id").alias("_page")).agg(
        F.max(F.coalesce(bad, F.lit(False))).alias("_bad")
    )
    known = staged(
        urls.join(judged, F.col("page_id") == F.col("_page")).select("page_id", "tokens", "_bad"),
        "labelled-urls",
    )
    share = min(1.0, most / max(1, known.count()))
    place = F.pmod(F.xxhash64("page_id", F.lit(6)), F.lit(1 << 40)) / (1 << 40)
    chosen = known.where(place < share).withColumn("_row", F.monotonically_increasing_id())
    each = chosen.select("_row", "_bad", F.explode("tokens").alias("_token"))
    often = (
        each.where("_bad").groupBy("_token").agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_rows).select("_token")
    )
    # A URL has few tokens, so a row's group is small, however common a token.
    cut = each.join(often, "_token").groupBy("_row", "_bad").agg(
        F.collect_set("_token").alias("_tokens")
    )
    baskets = staged(
        cut.select(
            F.when(F.col("_bad"), F.array_append("_tokens", F.lit(_BAD)))
            .otherwise(F.col("_tokens"))
            .alias("items")
        ),
        "baskets",
    )
    # Half a row less, so that rounding asks for ``min_rows`` and no more.
    support = min(1.0, (min_rows - 0.5) / max(1, baskets.count()))
    fitted = FPGrowth(minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = fitted.associationRules.where(F.element_at("consequent", 1) == _BAD).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )
    shorter = rules.select(F.col("tokens").alias("_part"), F.col("confidence").alias("_conf"))
    within = (
        (F.size("_part") < F.size("tokens"))
        & (F.size(F.array_except("_part", "tokens")) == 0)
        & (F.col("_conf") >= F.col("confidence"))
    )
    shared = rules.withColumn("_token", F.explode("tokens")).join(
        shorter.withColumn("_other", F.element_at("_part", 1)),
        (F.col("_token") == F.col("_other")) & within,
        "left_anti",
    )
    # A rule stays if none of its tokens leads to a shorter rule.
    kept = shared.groupBy("tokens", "confidence", "support").agg(F.count("*").alias("_n"))
    return kept.where(F.col("_n") == F.size("tokens")).select(
        F.concat_ws("+", "tokens").alias("rule_id"), "tokens", "confidence", "support"
    )


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, mined: for each distinct token set the most confident rule it holds. The index is
    bounded by the support: no more rules than the miner's frequent sets."""
    index = rules.select(
        "rule_id", "confidence", F.size("tokens").alias("_size"), F.explode("tokens").alias("_token")
    )
    sets = urls.select("tokens").distinct().withColumn("_key", F.xxhash64("tokens"))
    held = (
        sets.withColumn("_token", F.explode("tokens"))
        .join(index, "_token")
        .groupBy("tokens", "rule_id", "confidence", "_size")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") == F.col("_size"))
    )
    best = F.max_by("rule_id", F.struct("confidence", "rule_id"))
    return held.groupBy("tokens").agg(best.alias("mined"))


def stated_rule(host: Column, path: Column, rules=STATED) -> tuple[Column, Column]:
    """The longest stated rule that fits, as text like ``net/``, and its verdict."""
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [
        ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        for h, p, _ in order
    ]
    empty = F.lit(None).cast("string")

    def first(values: list[str]) -> Column:
        pairs = list(zip(fits, values, strict=True))[::-1]
        return reduce(lambda other, p: F.when(p[0], F.lit(p[1])).otherwise(other), pairs, empty)

    return first([h + p for h, p, _ in order]), first([v for *_, v in order])


def judge(
    pages: DataFrame,
    labels: DataFrame,
    stated=STATED,
    min_confidence: float = MIN_CONFIDENCE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the mined rule that fits, if any)."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "tokens", tokens_of(F.col("host"), F.col("path"))
    )
    rules = staged(mine(urls, labels, min_confidence, min_rows), "rules")
    found = staged(match(urls, rules), "matched-sets")
    if found.count() <= BROADCAST_SETS:
        found = F.broadcast(found)
    rule, verdict = stated_rule(F.col("host"), F.col("path"), stated)
    return (
        urls.join(found, "tokens", "left")
        .withColumn("rule", rule)
        .withColumn(
            "verdict",
            F.coalesce(verdict, F.when(F.col("mined").isNotNull(), "block").otherwise("allow")),
        )
        .select("page_id", "host", "path", "rule", "verdict", "mined")
    )
