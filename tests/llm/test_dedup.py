"""Substring dedup, SimHash near-duplicates and components against plain code."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from earshot.llm import bloom, simhash, substring_dedup
from earshot.llm.components import components
from tests.conftest import MEDIUM
from tests.llm import brute


def _removed(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))


def test_passages_of_earlier_documents_are_cut(docs, pairs, collected):
    found = substring_dedup.dedup(docs)
    assert collected(_removed(found), "*") == sorted(brute.substring_dedup(pairs), key=repr)
    assert found.columns == [*docs.columns, "n_words", "n_removed", "kept"]
    assert found.count() == docs.count()


def test_automata_shards_do_not_matter(docs, pairs, collected, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_SEGMENTS", 1)
    monkeypatch.setattr(substring_dedup, "COMBINED_SEGMENTS", 3)
    monkeypatch.setattr(substring_dedup, "COMPILED_SEGMENTS", 1)
    found = substring_dedup.dedup(docs)
    assert collected(_removed(found), "*") == sorted(brute.substring_dedup(pairs), key=repr)


def test_a_phrase_in_differing_surroundings_is_spread(spark, docs, collected, monkeypatch):
    phrases = [" ".join(f"c{n}w{j}" for j in range(12)) for n in range(3000)]
    phrase = min(phrases, key=lambda p: substring_dedup.Segments([f"{p} z".encode()]).anchor[0])
    texts = [f"a{n} b{n % 200} {phrase} d{n % 200} e{n}" for n in range(300)]
    held = substring_dedup.Segments([t.encode() for t in texts]).anchor
    assert np.unique(held, return_counts=True)[1].max() >= 300
    plain, most = substring_dedup.first_documents, 40
    monkeypatch.setattr(substring_dedup, "SHARD_SEGMENTS", most)

    def bounded(held):
        assert len(held) < 2 * most
        return plain(held)

    monkeypatch.setattr(substring_dedup, "first_documents", bounded)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = _removed(substring_dedup.dedup(df))
    expected = sorted(brute.substring_dedup(rows), key=repr)
    assert collected(found, "*") == expected and sum(r[2] > 0 for r in expected) == 100


def test_rows_that_share_an_id_and_rows_without(spark, docs, collected):
    passage = " ".join(f"p{n}" for n in range(20))
    rows = [(1, passage), (1, passage), (1, passage + " x"), (None, passage), (2, passage), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = collected(substring_dedup.dedup(df), "doc_id", "n_words", "n_removed")
    assert found == sorted(
        [(1, 20, 0), (1, 20, 0), (1, 21, 0), (None, 20, 0), (2, 20, 20), (3, 0, 0)], key=repr
    )


def test_empty_tables(spark, docs):
    empty = docs.limit(0)
    assert substring_dedup.dedup(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_first_documents_of_windows():
    words = [f"w{n}".encode() for n in range(16)]
    held = {
        (1, 1): [b" ".join(words[:15]), 7, 9],
        (1, 2): [b" ".join(words[1:16]), 3, 3],
        (2, 1): [b" ".join([b"z"] * 14), 5, 5],
    }
    assert sorted(substring_dedup.first_documents(held)) == [(1, 1, [7, 3, 3])]


def test_segments_hash_alike_wherever_they_stand():
    run = b" ".join(b"w%d" % n for n in range(40))
    one = substring_dedup.Segments([b"x y " + run, b"short", b""])
    two = substring_dedup.Segments([b"other", run.replace(b" ", b"\n")])
    keys = [{(a, k): s.words(i) for i, (a, k) in enumerate(zip(s.anchor, s.key))} for s in (one, two)]
    both = set(keys[0]) & set(keys[1])
    assert both and all(keys[0][k] == keys[1][k] for k in both)
    windows = {i for s in (two,) for a, n in zip(s.place, s.windows) for i in range(a, a + n)}
    assert windows == set(range(28))


def test_the_filter_lets_all_pass_that_are_in(spark, docs):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h"))
    words = bloom.build(hashes, "h", 5000)
    inside = hashes.toPandas()["h"].to_numpy().view(np.uint64)
    assert bloom.passes(words, inside).all()
    others = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    assert bloom.passes(words, others).mean() < 0.2
    assert not bloom.passes(bloom.build(hashes.limit(0), "h", 0), inside).any()


def test_fingerprints(pairs):
    for _, text in pairs:
        assert simhash.fingerprint(text) == brute.fingerprint(text)


def test_fingerprints_of_long_texts_in_stretches(monkeypatch):
    text = " ".join(f"W{n * n % 1009}\n" for n in range(500))
    expected = brute.fingerprint(text)
    for stretch in (1, 7, 100):
        monkeypatch.setattr(simhash, "_STRETCH", stretch)
        assert simhash.fingerprint(text) == expected


def test_near_duplicates(docs, pairs, collected):
    found = simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id"
    )
    assert collected(found, "*") == sorted(brute.near_duplicates(pairs), key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {c for _, _, c in brute.near_duplicates(pairs)}
    assert {r.doc_id for r in kept.collect()} == ids and kept.count() == len(ids)


def test_one_row_of_a_repeated_id_stays(spark, docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect()), key=repr) == sorted(
        [(1, "a b c d"), (None, "a b c d"), (None, None)], key=repr
    )


def test_unlike_texts_under_one_id_are_not_lost(spark, docs):
    words = " ".join(f"w{n}" for n in range(40))
    rows = [
        (1, words), (2, words), (2, "something else altogether, told once"),
        (5, "left hand text of five"), (5, "right hand words under the same number"),
        (7, words), (7, "something else altogether, told once"), (9, None), (9, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in simhash.keep_one(df).collect()]
    assert sorted(kept, key=repr)[:4] == [
        (1, words), (2, "something else altogether, told once"), (5, "left hand text of five"),
        (5, "right hand words under the same number"),
    ]
    assert len(kept) == 5 and kept.count((9, None)) + kept.count((9, "")) == 1
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(df).collect()}
    assert sorted(found.values()) == [1, 1, 1, 2, 2, 5, 5, 9]


def test_rows_without_an_id_link_others(spark, docs):
    """A and C are two bits from B, which has no id, and four from each other."""
    prints = [(1, 0b0011), (None, 0b0000), (3, 0b1100), (4, 1 << 60 | 0xFF << 20)]
    found = spark.createDataFrame(prints, "doc_id long, fingerprint long")
    groups = {r.fingerprint: r.group for r in simhash._grouped(found, 2, 16).collect()}
    assert groups[0b0011] == groups[0] == groups[0b1100] == 0 and len(set(groups.values())) == 2


def test_the_chain_is_checked_before_the_distance(spark, docs):
    nodes = spark.createDataFrame([(1, 2), (2, 3)], "node long, fingerprint long")
    plan = simhash.links(nodes)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "CASE WHEN" in join or "if (" in join
    chain, full = join.index("shiftrightunsigned("), join.rindex("bit_count((ring")
    assert chain < full


def test_a_crowded_key_does_not_meet_in_pairs(spark, docs, monkeypatch):
    """3,000 fingerprints with the same 28 bits: few pairs are compared, none is lost."""
    draw = random.Random(7)
    prints = sorted({0xABCDEF1 << 36 | draw.getrandbits(36) for _ in range(3000)})
    prints = sorted({*prints, *(p ^ 1 << draw.randrange(36) for p in prints[:50])})
    signed = [(n, p - (1 << 64) if p >> 63 else p) for n, p in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node long, fingerprint long")
    expected = {
        (a, b) for a, p in enumerate(prints) for b in range(a + 1, len(prints))
        if (p ^ prints[b]).bit_count() <= 2
    }
    found = {tuple(r) for r in simhash.links(nodes).collect()}
    assert found == expected and len(found) >= 50
    seen = []
    meet = simhash._meet
    monkeypatch.setattr(simhash, "_meet", lambda k, *rest: seen.append(k) or meet(k, *rest))
    simhash.links(nodes)
    split = seen[-1].groupBy("start", "key", "part", "bits").count()
    assert split.agg(F.max("count")).first()[0] < 20


def test_links_lose_no_pair(spark, docs, monkeypatch):
    draw = random.Random(0)
    prints = [draw.getrandbits(64) for _ in range(60)]
    for p in prints[:40]:
        for _ in range(4):
            flipped = p
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                flipped ^= 1 << bit
            prints.append(flipped)
    prints = sorted(set(prints))
    signed = [(n, p - (1 << 64) if p >> 63 else p) for n, p in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node long, fingerprint long")
    cases = ((2, 16, 1000), (2, 8, 1000), (1, 4, 1000), (3, 16, 1000), (2, 16, 0), (3, 8, 2))
    for distance, segments, together in cases:
        monkeypatch.setattr(simhash, "MOST_TOGETHER", together)
        expected = {
            (a, b)
            for a, p in enumerate(prints)
            for b, q in enumerate(prints)
            if a < b and (p ^ q).bit_count() <= distance
        }
        found = {tuple(r) for r in simhash.links(nodes, distance, segments).collect()}
        assert found == expected and expected


def test_components(spark, docs):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    edges += [(n, n + 1) for n in range(400, 460)] + [(500, n) for n in range(501, 560)]
    root = list(range(600))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {n: top(n) for e in edges for n in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_given_documents(spark, collected):
    from earshot.llm.queries import op1_substring_dedup, op3_simhash

    df = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    given = list(map(tuple, df.collect()))
    found = op1_substring_dedup(spark, MEDIUM)
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        brute.substring_dedup(given), key=repr
    )
    found = op3_simhash(spark, MEDIUM)
    assert collected(found, "doc_id", "fingerprint", "component_id") == sorted(
        brute.near_duplicates(given), key=repr
    )
