"""Token files and packing: exact ids, round trips, and every id in one piece."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from earshot.llm import packing, token_counts, token_files
from earshot.llm.queries import all_queries
from earshot.llm.tokens import PieceEncoder
from tests.conftest import SMALL
from tests.llm import brute

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def _odd_texts() -> list[str]:
    draw = random.Random(0)
    letters = list("abSé.,!;'\n\t 12\u00a0\u3000\x1c\u0301Σß")
    odd = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(2000)]
    return [*odd, "", " ", "a  b", "foo.\nBar, baz.\n\nQux;; x,y", "word " * 300, "x" * 2000]


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("most", [50, 10**6])
def test_ids_are_the_tokenizers(path, most, pairs):
    texts = [t or "" for _, t in pairs] + _odd_texts()
    expected = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = PieceEncoder(path, most)
    for _ in range(2):
        assert [x.tolist() for x in encoder.each(texts)] == expected


def test_codes_come_back():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    for n in range(len(values) + 1):
        for chosen in (values[:n], values[::-1][:n]):
            control, data = token_files.pack(chosen)
            assert token_files.unpack(control, data, n).tolist() == chosen.tolist()
            assert len(control) == -(-n // 4)


def test_token_files(docs, pairs, collected, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    back = token_files.round_trip(docs, WORDS, 2, 5)
    found = collected(back.withColumn("c", F.crc32("ids")), "doc_id", "start", "n_tokens", "c")
    assert found == sorted(brute.token_files([(d, t or "") for d, t in pairs], WORDS, 2), key=repr)


def test_frequent_ids_take_a_byte(spark, docs):
    df = spark.createDataFrame([(n, "the the the the end") for n in range(50)], "doc_id long, text string")
    back = token_files.round_trip(df, WORDS, 2, 2)
    assert back.agg(F.sum("n_tokens")).first()[0] == 50 * 6


def test_empty_and_repeated(spark, docs):
    empty = docs.limit(0)
    assert token_files.round_trip(empty, WORDS, 2, 3).count() == 0
    assert packing.pieces(empty, BYTES, 0).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = token_files.round_trip(df, WORDS, 2, 3).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in back] == [
        (None, 0, 2), (1, 2, 3), (1, 5, 3), (2, 8, 1)
    ]
    lengths = packing.pieces(df, BYTES, 0).groupBy("doc_id").agg(F.sum("length")).collect()
    assert dict(map(tuple, lengths)) == {1: 6, None: 2, 2: 1}


def _check(pieces: list, ids: dict[int, np.ndarray]) -> None:
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids[doc]))
            assert p.crc == zlib.crc32(ids[doc][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[doc])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == 1024 or at & (at - 1) == 0


def test_packing(docs, pairs):
    tokenizer = Tokenizer.from_file(BYTES)
    ids = {
        d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for d, t in pairs
    }
    found = packing.pieces(docs, BYTES, 0).withColumn("crc", F.crc32("ids"))
    _check(found.collect(), ids)


def test_packing_given_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    tokenizer = Tokenizer.from_file(BYTES)
    ids = {
        r.doc_id: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        for r in df.collect()
    }
    found = packing.pieces(df, BYTES, 0).withColumn("crc", F.crc32("ids"))
    _check(found.collect(), ids)


def test_the_level_is_the_one_with_least_squares():
    """Each placement against the squares of all choices, computed anew."""
    draw, packer = np.random.default_rng(3), packing.SumOfSquares(32)
    levels: list[int] = []
    for n in range(400):
        size = int(draw.integers(1, 32))

        def squares(after: list[int]) -> int:
            return int((np.bincount([x for x in after if x < 32], minlength=33) ** 2).sum())

        choices = {h: [*levels[: levels.index(h)], *levels[levels.index(h) + 1 :], h + size]
                   for h in set(levels) if h + size <= 32}
        choices[0] = [*levels, size]
        least = min(squares(after) for after in choices.values())
        level = max(h for h, after in choices.items() if squares(after) == least)
        packer.add((n, 0, np.zeros(size, np.uint32), size))
        levels = [x for x in choices[level] if x < 32]
        expected = np.bincount(levels, minlength=33)
        assert packer._count[1:32].tolist() == expected[1:32].tolist()


def test_open_windows_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MOST_OPEN", 5)
    packer, laid = packing.SumOfSquares(32), []
    for n in range(100):
        laid += packer.add((n, 0, np.zeros(20, np.uint32), 20))
        assert packer._count.sum() <= 6
    laid += packer.close()
    assert sum(len(p[2]) for held in laid for p in held) == 2000


# --- token counts

COUNTED = ("doc_id", "n_bytes", "n_tokens", "over_limit")


def counted(rows, limit):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for d, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((d, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


@pytest.mark.parametrize("stretch", [1 << 20, 7])
def test_counts_are_the_tokenizers(spark, docs, pairs, collected, monkeypatch, stretch):
    monkeypatch.setattr(token_counts, "CHARS_AT_ONCE", stretch)
    found = token_counts.count_tokens(docs, WORDS, 5)
    assert collected(found, *COUNTED) == counted(pairs, 5)
    twice = token_counts.count_tokens(docs.unionByName(docs), WORDS, 5)
    assert twice.count() == 2 * len(pairs)
    assert token_counts.count_tokens(docs.limit(0), WORDS, 5).count() == 0


def test_given_documents_are_counted(spark, collected):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = all_queries()["op12_token_counts"](spark, SMALL)
    assert collected(found, *COUNTED) == counted(rows, 2048)


def test_whole_tokens_are_proved():
    tokenizer = Tokenizer.from_file(WORDS)
    whole = token_counts.whole_tokens(WORDS)
    assert len(whole) > 30_000 and len(set(whole)) == len(whole)
    assert all(len(x.ids) == 1 for x in tokenizer.encode_batch(whole, add_special_tokens=False))


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(WORDS, frozenset(token_counts.whole_tokens(WORDS)))


def test_every_character_up_to_ff_is_split_alike(counter):
    tokenizer = Tokenizer.from_file(WORDS)
    for code in range(256):
        for text in (chr(code), f"a{chr(code)}1", f"{chr(code)}{chr(code)}'s", f"x {chr(code)} y"):
            expected = len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert counter.count(text) == expected, repr(text)


_BITS = st.sampled_from(
    ["the", "Zürich", "é", "́", " ", "  ", "\n", "\x1c", " ", "　", "'S", "'re",
     "12", "½", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "漢字", "İ", "K", "ΑΣ", "\U0001f600",
     "\x00", "﻿", "​", "ą́", "가", "가"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(_BITS, st.text(max_size=4)), max_size=12), st.integers(1, 9))
def test_any_text_is_counted(counter, bits, stretch):
    text = "".join(bits)
    expected = len(counter._tokenizer.encode(text, add_special_tokens=False).ids)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "CHARS_AT_ONCE", stretch)
        assert counter.count(text) == expected


def test_merges_are_remembered_within_a_bound(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_KNOWN", 3)
    counter = token_counts.Counter(WORDS, frozenset())
    text = " ".join(f"word{chr(97 + n)}xq" for n in range(20)) + " " + "z" * 500
    expected = len(Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids)
    assert counter.count(text) == expected and len(counter._merged) <= 3
