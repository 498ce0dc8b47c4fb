"""Token ids of whole texts, one pre-token at a time.

Texts of characters up to U+00FF are split into pre-tokens here, by the same classes of characters
as their tokenizer's; what each is merged to comes from the tokenizer's own model. Pre-tokens
repeat far more often than texts, so a worker keeps the ids of those it has met, up to a bound. The
rest of a text, pieces between spaces that have a character beyond or a special string, go through
the tokenizer as they are: its splitting never joins what stands on two sides of a space after a
character that is no white space.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Pre-tokens and pieces a worker keeps; when they are more it forgets those met but once or twice.
MOST_PIECES = 1_200_000

# Characters of text turned into ids at a time.
CHARS_AT_ONCE = 1 << 20

# A space after white space is no safe place to cut. Python's \s holds every character that the
# tokenizers take for white space.
SAFE_CUT = re.compile(r"(?<=\S) ")
BEYOND = re.compile("[^\x00-\xff]")

# Classes of the characters up to U+00FF.
SPACE = "\t-\r \x85\xa0"
_SMALL, _LARGE = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "A-Z\xc0-\xd6\xd8-\xde"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"

# The tokenizers' ways of splitting, in the terms of their files.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_SPACED = _BYTES | {"use_regex": True}
_BARE = [
    {
        "type": "Split",
        "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        },
        "behavior": "Removed",
        "invert": True,
    },
    _BYTES | {"use_regex": False},
]
_LOWERED = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]

# The same over characters up to U+00FF, lower-cased ones or any, with the space before a word.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
LOWERED = re.compile(f"{_ENDINGS}|[{_SMALL}]+|[{_NUMBER}]|[^{SPACE}{_SMALL}{_NUMBER}]+")
_WORD = f"{_SMALL}{_LARGE}"
SPACED = re.compile(
    f"{_ENDINGS}| ?[{_WORD}]+| ?[{_NUMBER}]+| ?[^{SPACE}{_WORD}{_NUMBER}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints in Latin-1, else the next
    from U+0100."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}


_LETTERS = byte_letters()


def spelt(piece: str) -> str:
    """A pre-token in the vocabulary's letters, one for each byte."""
    if piece.isascii() and piece.isalnum():
        return piece
    return piece.encode().decode("latin-1").translate(_LETTERS)


def opened(path: str):
    """A tokenizer file, by its path or by the name of a public one, found where it is opened."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pattern_of(tokenizer) -> re.Pattern | None:
    """How a tokenizer splits characters up to U+00FF: ``LOWERED``, ``SPACED``, or neither."""
    steps = json.loads(tokenizer.to_str())
    normal, split = steps["normalizer"], steps["pre_tokenizer"]
    if normal is None and split == _SPACED:
        return SPACED
    if normal == {"type": "Sequence", "normalizers": _LOWERED} and split == {
        "type": "Sequence", "pretokenizers": _BARE
    }:
        return LOWERED
    return None


def special_strings(tokenizer) -> re.Pattern:
    """Finds a string that the tokenizer takes out of a text before it splits it."""
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)


def stretches(text: str, most: int) -> Iterator[str]:
    """A text in parts of about ``most`` characters, cut before a space that nothing goes over."""
    start = 0
    while len(text) - start > most:
        cut = SAFE_CUT.search(text, start + most)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class _Places(dict):
    """Where the ids of pieces are. A new piece gets the next place and waits to be encoded."""

    def __init__(self, new: list[tuple[bool, str]], plain: bool) -> None:
        self.taken, self._new, self._plain = 0, new, plain

    def __missing__(self, piece: str) -> int:
        place = self[piece] = self.taken + len(self._new)
        self._new.append((self._plain, piece))
        return place


class PieceEncoder:
    """Ids of texts, by a tokenizer file of the tokenizers library."""

    def __init__(self, path: str, most_pieces: int = MOST_PIECES) -> None:
        self._tokenizer = opened(path)
        self._pattern = pattern_of(self._tokenizer)
        self._special = special_strings(self._tokenizer)
        self._most = most_pieces
        self._new: list[tuple[bool, str]] = []
        # Pre-tokens, and pieces that go through the tokenizer.
        self._plain, self._hard = _Places(self._new, True), _Places(self._new, False)
        self._starts = np.zeros(1024, np.int64)
        self._sizes = np.zeros(1024, np.int64)
        self._met = np.zeros(1024, np.int64)
        self._ids = np.zeros(1 << 16, np.uint32)
        self._pieces = self._used = 0

    def _forget(self) -> None:
        """Keep the pieces met more than twice, or if those are too many too, none."""
        often = self._met[: self._pieces] > 2
        if often.sum() > self._most // 2:
            often[:] = False
        moved = np.cumsum(often) - 1
        for known in (self._plain, self._hard):
            kept = {p: int(moved[i]) for p, i in known.items() if often[i]}
            known.clear()
            known.update(kept)
        held = np.flatnonzero(often)
        flat, sizes = self._gather(held), self._sizes[held]
        self._pieces = self._used = 0
        self._store(flat, sizes)
        self._met[:] = 0

    def _store(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Append the ids of some pieces."""
        n, m = self._pieces + len(sizes), self._used + len(flat)
        if n > len(self._sizes):
            self._starts, self._sizes, self._met = (
                np.concatenate([x, np.zeros(2 * n - len(x), np.int64)])
                for x in (self._starts, self._sizes, self._met)
            )
        if m > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(2 * m - len(self._ids), np.uint32)])
        self._sizes[self._pieces : n] = sizes
        self._starts[self._pieces : n] = self._used + np.cumsum(sizes) - sizes
        self._ids[self._used : m] = flat
        self._pieces, self._used = n, m
        self._plain.taken = self._hard.taken = n

    def _gather(self, places: np.ndarray) -> np.ndarray:
        """The ids of pieces in a row."""
        sizes = self._sizes[places]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        at += np.repeat(self._starts[places] - (ends - sizes), sizes)
        return self._ids[at]

    def _learn(self) -> None:
        """Encode the pieces that wait, in the order of their places."""
        merge = self._tokenizer.model.tokenize
        hard = iter(
            self._tokenizer.encode_batch_fast(
                [p for plain, p in self._new if not plain], add_special_tokens=False
            )
        )
        ids = [
            [token.id for token in merge(spelt(p))] if plain else next(hard).ids
            for plain, p in self._new
        ]
        self._new.clear()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self._store(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)

    def _split(self, text: str) -> np.ndarray:
        """The places of a text's pieces."""
        if self._pattern and not BEYOND.search(text) and not self._special.search(text):
            return self._of_plain(text)
        out: list[np.ndarray] = []
        easy: list[str] = []
        for n, piece in enumerate(SAFE_CUT.split(text)):
            piece = f" {piece}" if n else piece
            if self._pattern and not BEYOND.search(piece) and not self._special.search(piece):
                easy.append(piece)
                continue
            out += [self._of_plain("".join(easy)), np.array([self._hard[piece]])]
            easy.clear()
        return np.concatenate([*out, self._of_plain("".join(easy))])

    def _of_plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        found = self._pattern.findall(text.lower() if self._pattern is LOWERED else text)
        return np.fromiter(map(self._plain.__getitem__, found), np.int64, len(found))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._pieces > self._most:
            self._forget()
        split = [self._split(text) for text in texts]
        if self._new:
            self._learn()
        places = np.concatenate(split)
        np.add.at(self._met, places, 1)
        ends = np.cumsum(np.append(0, self._sizes[places]))
        cuts = ends[np.cumsum([len(p) for p in split])[:-1]]
        return np.split(self._gather(places), cuts)

    def each(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of every text, null as empty, a bounded stretch of text at a time."""
        group, size = [], 0
        for text in texts:
            text = text or ""
            if group and size + len(text) > CHARS_AT_ONCE:
                yield from self._encode(group)
                group, size = [], 0
            if len(text) > CHARS_AT_ONCE:
                parts = [self._encode([part])[0] for part in stretches(text, CHARS_AT_ONCE)]
                yield np.concatenate(parts)
                continue
            group.append(text)
            size += len(text)
        if group:
            yield from self._encode(group)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a file; later tasks of the worker find what it has learnt."""
    return PieceEncoder(path)


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 16 or 32-bit, as the vocabulary needs),
    with the end id. Null texts have the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), np.array([end_id], np.uint32)
        for batch in batches:
            ids = [np.append(x, end) for x in enc.each(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([narrow(x) for x in ids], pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary"
    )


def narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id, or four behind a mark if one needs more."""
    if len(ids) and ids.max() > 0xFFFF:
        return b"\1" + ids.astype("<u4").tobytes()
    return b"\0" + ids.astype("<u2").tobytes()


def wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4" if data[0] else "<u2", offset=1)
