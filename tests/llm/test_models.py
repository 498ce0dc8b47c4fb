"""Language ID and the quality classifier: exact code lengths, gradients, held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from earshot.llm import language, quality
from earshot.llm.queries import op8_language_id, op9_quality
from tests.conftest import MEDIUM

# --- language


def _counts(texts: dict[str, list[bytes]]) -> pd.DataFrame:
    rows = Counter()
    for lang, own in texts.items():
        for text in own:
            padded = b"\n\n\n" + text
            for i in range(len(text)):
                rows[lang, int.from_bytes(padded[i : i + 4], "big")] += 1
    return pd.DataFrame([(lang, g, n) for (lang, g), n in rows.items()], columns=["lang", "gram", "n"])


def _code_length(texts: list[bytes], text: bytes) -> float:
    """Escapes from the longest context down, counted plainly."""
    seen = [Counter() for _ in range(4)]
    for own in texts:
        padded = b"\n\n\n" + own
        for i in range(3, len(padded)):
            for k in range(4):
                seen[k][padded[i - k : i], padded[i]] += 1
    total, padded = 0.0, b"\n\n\n" + text
    for i in range(3, len(padded)):
        bits = 0.0
        for k in (3, 2, 1, 0):
            after = {b: n for (c, b), n in seen[k].items() if c == padded[i - k : i]}
            if not after:
                continue
            whole = sum(after.values()) + len(after)
            if padded[i] in after:
                bits -= math.log2(after[padded[i]] / whole)
                break
            bits -= math.log2(len(after) / whole)
        else:
            bits += 8
        total += bits
    return total


def test_code_lengths_are_those_of_the_escapes():
    texts = {"en": [b"the cat sat on the mat", b"then"], "fr": [b"le chat est l\xc3\xa0"]}
    model = language.fit(_counts(texts), min_share=0.0)
    assert model.languages == ["en", "fr"]
    probes = [b"the chat", b"", b"zzz \x00\xff", b"mat\n\n\nthe", "l\u00e0".encode()]
    found = model.lengths(probes) / language.UNIT
    for text, lengths in zip(probes, found, strict=True):
        for lang, length in zip(model.languages, lengths, strict=True):
            expected = _code_length(texts[lang], text)
            assert abs(length - expected) <= len(text) / language.UNIT


def test_counts_do_not_depend_on_batches(spark, docs, monkeypatch):
    texts = {"en": [b"the cat sat on the mat", b"then", b""], "fr": [b"le chat"]}
    rows = [(lang, t.decode()) for lang, own in texts.items() for t in own]
    for stretch, merge in ((1, 1), (10**6, 10**6)):
        monkeypatch.setattr(language, "_STRETCH", stretch)
        monkeypatch.setattr(language, "_MERGE", merge)
        df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
        found = language.gram_counts(df).toPandas()
        joined = {(r.lang, r.gram): r.n for r in found.itertuples()}
        assert all(
            joined[r.lang, r.gram] >= r.n for r in _counts(texts).itertuples()
        )


def test_texts_without_letters_are_und(spark, docs):
    rows = [(1, None), (2, ""), (3, " 12 !"), (4, "the cat"), (4, "the cat"), (None, "le chat")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = language.fit(_counts({"en": [b"the cat sat"], "fr": [b"le chat est"]}), 0.0)
    found = {(r.doc_id, r.lang_pred) for r in language.identify(df, model).collect()}
    assert found == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "fr")}
    scores = [r.score for r in language.identify(df, model).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores.count(0) == 3
    assert {r.lang_pred for r in language.identify(df, None).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.learn(nothing, F.lit(True)) is None


def test_rare_grams_of_a_large_language_are_learnt(spark, docs):
    # More than 2^20 bytes, of which some stand once.
    own = {"en": b"the cat sat on the mat " * 50_000 + "\u0436\u0443\u043a q".encode(),
           "fr": b"le chat est l\xc3\xa0"}
    rows = [(n, lang, own[lang].decode()) for n, lang in enumerate(own)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.learn(df, F.lit(True))
    assert model.languages == ["en", "fr"]
    text = "the q, chat \u0436\u0443\u043a zz".encode()
    for lang, length in zip(model.languages, model.lengths([text])[0], strict=True):
        expected = _code_length([own[lang]], text)
        assert abs(length / language.UNIT - expected) <= len(text) / language.UNIT


def test_held_out_languages(spark):
    df = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    found = op8_language_id(spark, MEDIUM).join(df, "doc_id").where("held_out").toPandas()
    assert len(found) > 200 and (found["lang_pred"] == found["lang"]).mean() >= 0.97


# --- quality


def test_gradients():
    draw = np.random.default_rng(0)
    passages = np.array([3, 0, 2, 1])
    bag = np.repeat(np.arange(4), passages)
    x = draw.normal(size=(6, 5))
    labels = np.array([1.0, 0.0, 0.0, 1.0])
    p = {"encode": draw.normal(size=(5, 4)), "encode_bias": draw.normal(size=4),
         "tanh": draw.normal(size=(4, 3)), "gate": draw.normal(size=(4, 3)),
         "attend": draw.normal(size=3), "out": draw.normal(size=4), "bias": np.zeros(1)}
    fixed = {"mean": np.zeros(5), "scale": np.ones(5)}

    def loss(q):
        y = quality._forward(q | fixed, x, bag, 4)["y"]
        return -(labels * np.log(y) + (1 - labels) * np.log(1 - y)).sum()

    f = quality._forward(p | fixed, x, bag, 4)
    found = quality._gradient(p, f, bag, f["y"] - labels)
    for name, value in p.items():
        for at in np.ndindex(value.shape):
            up, down = (
                loss(p | {name: value + sign * 1e-6 * (np.arange(value.size).reshape(value.shape)
                                                       == np.ravel_multi_index(at, value.shape))})
                for sign in (1, -1)
            )
            assert abs((up - down) / 2e-6 - found[name][at]) < 1e-4


def test_passages_cover_whole_texts():
    texts = [b"", b" \n ", b"one", b"w " * 64, b"w " * 65, b"x" * 5000, b"   a b\nc " * 500]
    x, passages = quality.encode(texts)
    assert passages.tolist() == [0, 0, 1, 1, 2, 1, 24] and x.shape == (29, quality.FEATURES)
    for i, text in enumerate(texts):
        alone, n = quality.encode([text])
        begin = int(passages[:i].sum())
        assert np.array_equal(alone, x[begin : begin + int(n[0])])
    assert quality.encode([])[0].shape == (0, quality.FEATURES)


def test_without_both_labels(spark, docs):
    labels = spark.createDataFrame([(3, 1), (4, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels, F.lit(True))
    assert {r.score for r in quality.score(docs, model).collect()} == {1.0}
    model = quality.learn(docs, labels.limit(0), F.lit(True))
    assert model.base == 1.0 and quality.keep_good(docs, model).count() == docs.count()
    assert quality.score(docs.limit(0), model).count() == 0


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    found = op9_quality(spark, MEDIUM)
    judged = found.join(labels, "doc_id").where("held_out and quality is not null").toPandas()
    assert len(judged) > 50 and (judged["predicted"] == judged["quality"]).mean() >= 0.95
    kept = judged[judged["quality"] == 1]["predicted"].mean()
    assert kept >= 0.95
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_extra_columns_and_repeated_labels(spark, docs):
    labels = spark.createDataFrame(
        [(n, n % 2, 0) for n in range(22)] + [(3, 1, 0), (5, None, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.learn(docs, labels, F.lit(True))
    scores = quality.score(docs.unionByName(docs), model).collect()
    assert len(scores) == 2 * docs.count() and all(0 <= r.score <= 1 for r in scores)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns


# --- what is fitted is bounded


def test_language_samples_are_bounded_and_whole(spark, docs, monkeypatch):
    rows = [(n, "en" if n % 4 else "fr", f"word{n} " * (3 + n % 5)) for n in range(4000)]
    rows += [(9000 + n, "en", "x" * 5000) for n in range(3)] + [(None, None, "t"), (1, "de", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    texts = {t for _, _, t in rows}
    monkeypatch.setattr(language, "MOST_TEXT", 1000)
    for most in (40_000, 80_000, 10**9):
        held = [tuple(r) for r in language.bounded(df, most).collect()]
        assert {t for _, t in held} <= texts
        sizes = Counter()
        for lang, text in held:
            sizes[lang] += len(text)
        assert all(0.8 * most / 2 < n < 1.2 * most / 2 for n in sizes.values()) or most > 10**6
        assert any(len(t) == 5000 for _, t in held) == (most > 10**6)
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    assert {r.lang for r in language.bounded(df).collect()} == {"en"}
    assert language.bounded(df.limit(0)).count() == 0


def test_quality_samples_are_bounded_in_bytes(spark, docs, monkeypatch):
    """Very long texts, of which the driver would get all."""
    rows = [(n, f"some text {n} " * 400) for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, n, y: seen.append((n.sum(), len(y), y.sum())))
    for most in (50_000, 100_000):
        monkeypatch.setattr(quality, "SAMPLE_BYTES", most)
        quality.learn(df, labels, F.lit(True))
        _, texts, good = seen[-1]
        # A text has 4,800 to 5,600 bytes.
        assert good == texts - good and most - 5_600 < good * 5_600 and good * 4_800 <= most
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 10**9)
    quality.learn(df, labels, F.lit(True))
    assert seen[-1][1] == 200


def test_scores_are_those_of_plain_loops():
    """The forward pass written out, one passage and one unit at a time."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(7, quality.FEATURES)).astype(np.float32)
    passages = np.array([3, 0, 1, 3])
    w = {
        "encode": draw.normal(0, 0.1, (quality.FEATURES, quality.HIDDEN)),
        "encode_bias": draw.normal(size=quality.HIDDEN), "mean": x.mean(0), "scale": x.std(0),
        "tanh": draw.normal(size=(quality.HIDDEN, quality.GATE)),
        "gate": draw.normal(size=(quality.HIDDEN, quality.GATE)),
        "attend": draw.normal(size=quality.GATE), "out": draw.normal(size=quality.HIDDEN),
        "bias": draw.normal(size=1),
    }
    expected, at = [], 0
    for n in passages.tolist():
        hidden, weights = [], []
        for row in x[at : at + n].tolist():
            scaled = [max(-6.0, min(6.0, (v - m) / s))
                      for v, m, s in zip(row, w["mean"].tolist(), w["scale"].tolist())]
            h = [math.tanh(w["encode_bias"][j] + sum(v * w["encode"][i, j]
                 for i, v in enumerate(scaled))) for j in range(quality.HIDDEN)]
            attention = 0.0
            for g in range(quality.GATE):
                t = math.tanh(sum(h[j] * w["tanh"][j, g] for j in range(quality.HIDDEN)))
                s = sum(h[j] * w["gate"][j, g] for j in range(quality.HIDDEN))
                attention += w["attend"][g] * t / (1 + math.exp(-s))
            hidden.append(h)
            weights.append(math.exp(attention))
        pooled = [sum(a * h[j] for a, h in zip(weights, hidden)) / (sum(weights) or 1.0)
                  for j in range(quality.HIDDEN)]
        total = w["bias"][0] + sum(a * b for a, b in zip(pooled, w["out"].tolist()))
        expected.append(1 / (1 + math.exp(-total)))
        at += n
    found = quality.Model(0.5, w).score(x, passages)
    assert np.allclose(found, expected, atol=1e-5)
