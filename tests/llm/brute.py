"""What the operators must return, computed plainly in one process."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def substring_dedup(rows, window=13):
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text)."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fingerprint(text: str | None) -> int:
    w = words((text or "").translate(_LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def near_duplicates(rows, distance=2):
    """(doc_id, fingerprint, component_id) of (doc_id, text)."""
    prints = {d: fingerprint(t) for d, t in rows}
    least = {}
    for d, p in prints.items():
        least[p] = min(d, least.get(p, d))
    found = np.array(list(least), np.uint64)
    root = {p: p for p in least}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in least:
        for q in found[np.bitwise_count(found ^ np.uint64(p)) <= distance].tolist():
            a, b = top(p), top(q)
            if a != b:
                root[a] = b
    component = defaultdict(lambda: 1 << 62)
    for p in least:
        component[top(p)] = min(component[top(p)], least[p])
    return [(d, f"{p:016x}", component[top(p)]) for d, p in prints.items()]


def decontaminate(rows, items, window=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def split(text):
        return word.findall((text or "").translate(_LOWER))

    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else []:
            windows[tuple(w[i : i + size])].add(str(item))
    sizes = sorted({len(k) for k in windows})
    out = []
    for d, text in rows:
        w, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def token_files(rows, path, end):
    """(doc_id, start, n_tokens, ids_crc32) of (doc_id, text)."""
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for d, text in sorted(rows):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def top_k(rows, k=20):
    """(query_id, rank, vec_id, score) of (vec_id, vector), a result for each row."""
    ok = [(i, x) for i, v in rows if i is not None and (x := _integers(v, 64)) is not None]
    out = []
    for n, (q, x) in enumerate(ok):
        if q % 20 == 0:
            scores = sorted(
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), i)
                for m, (i, y) in enumerate(ok)
                if m != n and len(x) == len(y)
            )
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return out


def _integers(vector, scale):
    from fractions import Fraction

    if vector is None or any(x is None or not np.isfinite(x) for x in vector):
        return None
    return [int(Fraction(x) * scale // 1) for x in vector]


def vector_codes(rows, rounds=2):
    """(vec_id, code, error, label_error, codebooks_sha256) of (vec_id, vector, label)."""
    kept = [(i, v, g) for i, x, g in rows if (v := _integers(x, 256)) is not None]
    if not kept:
        return []
    dim = -(-max(len(v) for _, v, _ in kept) // 16)
    cuts = []
    for _, v, _ in kept:
        v = v + [0] * (16 * dim - len(v))
        cuts.append([v[p * dim : (p + 1) * dim] for p in range(16)])
    first = sorted((i, x, n) for n, (i, x, _) in enumerate(rows_kept(rows)) if i is not None)[:64]
    books = [[cuts[n][p] for _, _, n in first] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            members = defaultdict(list)
            for c in cuts:
                members[nearest(c[p], books[p])[1]].append(c[p])
            for e, parts in members.items():
                books[p][e] = [sum(x) // len(parts) for x in zip(*parts)]
    digest = hashlib.sha256(
        ",".join(str(x) for book in books for e in book for x in e).encode()
    ).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(16)] for c in cuts]
    errors, by_label = [], defaultdict(list)
    for (_, _, g), f in zip(kept, found):
        error = sum(d for d, _ in f)
        errors.append(error if error < 2**63 else None)
        by_label[g].append(errors[-1])
    total = {g: None if None in e or sum(e) >= 2**63 else sum(e) for g, e in by_label.items()}
    return [
        (i, "".join(f"{e:02x}" for _, e in f), error, total[g], digest)
        for (i, _, g), f, error in zip(kept, found, errors)
    ]


def rows_kept(rows):
    return [r for r in rows if _integers(r[1], 256) is not None]


def hard_negatives(rows):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id,
    vector, label)."""
    kept = [
        (i, v, g) for i, x, g in rows if g is not None and (v := _integers(x, 256)) is not None
    ]
    last = 2**63

    def best(scored, k=5):
        return sorted(scored, key=lambda s: (-s[0], last if s[1] is None else s[1]))[:k]

    out = []
    for n, (a, x, g) in enumerate(kept):
        if a is None or a % 100:
            continue
        scored = [
            (max(-last, min(last - 1, sum(p * q for p, q in zip(x, y)))), i, h)
            for m, (i, y, h) in enumerate(kept)
            if m != n and len(x) == len(y)
        ]
        for p, i, _ in best(s for s in scored if s[2] == g):
            inside = (s for s in scored if s[2] != g and 80 * p <= 100 * s[0] <= 100 * p)
            out += [(a, i, r, j, p, s) for r, (s, j, _) in enumerate(best(inside), 1)]
    return out
