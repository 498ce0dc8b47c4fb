"""Token counts by the whole-token shortcut.

Before the texts are read, every string of the vocabulary is tried: those that the merge model
leaves as one token are proved whole. Their list is bounded by the vocabulary and sent to the
workers. A text is normalised and split into pre-tokens as its tokenizer does; a pre-token on the
list counts as one, and only the rest go through the merges, each different one once while a
worker remembers it.

Texts of characters up to U+00FF are split here, by the same classes of characters. Others are cut
at spaces, and pieces with a character beyond are normalised and split by the tokenizer's own
steps, as is any piece with a special string, which the tokenizer encodes as it does by default.
Texts are read whole, a stretch of characters at a time, cut where no pre-token can go on.

Null and empty texts have no tokens. Repeated rows are counted as often as they occur, null ids are
kept, extra columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.tokens import (
    BEYOND,
    CHARS_AT_ONCE,
    LOWERED,
    SAFE_CUT,
    byte_letters,
    opened,
    pattern_of,
    special_strings,
    spelt,
    stretches,
)

# Different pre-tokens whose merges a worker remembers, and the longest of them.
MOST_KNOWN, LONGEST_KNOWN = 500_000, 64


def whole_tokens(path: str) -> list[str]:
    """The pre-tokens, as text, that are proved to be one token each. They have no character
    beyond U+00FF and are what the tokenizer makes of them: normalised, and not split further."""
    tokenizer = opened(path)
    end = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"] or ""
    byte_of = {letter: b for b, letter in byte_letters().items()}
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    proved = []
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if token in added or not token.endswith(end):
            continue
        letters = token[: len(token) - len(end)]
        try:
            text = bytes(byte_of[c] for c in letters).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if BEYOND.search(text) or not LOWERED.fullmatch(text):
            continue
        merged = tokenizer.model.tokenize(letters)
        if len(merged) == 1 and merged[0].id == number:
            proved.append(text)
    return sorted(proved)


class _Merged(dict):
    """Tokens of pre-tokens after the merges, each done once while it is remembered."""

    def __init__(self, model) -> None:
        self._model = model

    def __missing__(self, piece: str) -> int:
        n = len(self._model.tokenize(spelt(piece)))
        if len(piece) <= LONGEST_KNOWN:
            if len(self) >= MOST_KNOWN:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Counts the tokens of texts with a tokenizer file that lower-cases and drops white space."""

    def __init__(self, path: str, whole: frozenset[str]) -> None:
        self._tokenizer = opened(path)
        if pattern_of(self._tokenizer) is not LOWERED:
            raise ValueError(f"{path} does not split texts as whole tokens are counted here")
        self._whole = whole
        self._special = special_strings(self._tokenizer)
        self._merged = _Merged(self._tokenizer.model)

    def _plain(self, text: str) -> int:
        """Tokens of a text without characters beyond U+00FF and without special strings."""
        found = LOWERED.findall(text.lower())
        rest = [p for p in found if p not in self._whole]
        return len(found) - len(rest) + sum(map(self._merged.__getitem__, rest))

    def _other(self, text: str) -> int:
        if self._special.search(text):
            return len(self._tokenizer.encode(text, add_special_tokens=False).ids)
        normal = self._tokenizer.normalizer.normalize_str(text)
        merge = self._tokenizer.model.tokenize
        return sum(len(merge(p)) for p, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    def _stretch(self, text: str) -> int:
        if not self._special.search(text) and not BEYOND.search(text):
            return self._plain(text)
        pieces = SAFE_CUT.split(text)
        hard = [bool(BEYOND.search(p) or self._special.search(p)) for p in pieces]
        plain = " ".join(p for p, h in zip(pieces, hard) if not h)
        return self._plain(plain) + sum(self._other(p) for p, h in zip(pieces, hard) if h)

    def count(self, text: str | None) -> int:
        return sum(map(self._stretch, stretches(text or "", CHARS_AT_ONCE)))


@lru_cache(maxsize=2)
def _counter(path: str, whole: frozenset[str]) -> Counter:
    """The worker's counter; later tasks of the worker find what it remembers."""
    return Counter(path, whole)


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit``) of doc_id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(whole_tokens(path)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, shared.value)
        for batch in batches:
            counts = [counter.count(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    counted = docs.select("doc_id", size.alias("n_bytes"), "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
