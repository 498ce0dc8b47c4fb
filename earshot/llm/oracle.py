"""DuckDB equivalents of the queries that SQL can express.

The others have none: XXH64 (op3), tokenizers (op2, op7, op12), mined rules (op6) and learnt models (op8,
op9) are tested against plain code, round trips or held-out accuracy.
"""

from __future__ import annotations

from earshot.llm.sharding import LONGEST_WALK, ROUNDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _followers(n: int) -> str:
    """The word and those after it, ``n`` in all, within its document."""
    return ", ".join(
        f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY pos)" if k else "word"
        for k in range(n)
    )


_OP1 = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split
), windows AS (
  SELECT doc_id, n, pos, word,
         CASE WHEN pos + 12 <= n THEN array_to_string([{_followers(13)}], ' ') END AS run
  FROM words
), firsts AS (
  SELECT run, min(doc_id) AS first FROM windows WHERE run IS NOT NULL GROUP BY run
), marked AS (
  SELECT w.doc_id, w.pos, w.word, coalesce(f.first < w.doc_id, FALSE) AS cut
  FROM windows w LEFT JOIN firsts f ON w.run = f.run
), covered AS (
  SELECT doc_id, pos, word,
         bool_or(cut) OVER (PARTITION BY doc_id ORDER BY pos
                            ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM marked
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id
)
SELECT s.doc_id, len(s.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id"""


def _clean_words(table: str, key: str) -> str:
    return rf"""
  SELECT {key} AS doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM {table}"""


_OP4 = f"""
WITH items AS ({_clean_words('benchmark', 'item_id')}
), item_words AS (
  SELECT doc_id, least(len(w), 10) AS size, len(w) AS n, unnest(w) AS word,
         generate_subscripts(w, 1) AS pos FROM items
), item_windows AS (
  SELECT DISTINCT doc_id AS item_id, size, array_to_string(list_slice(run, 1, size), ' ') AS run
  FROM (SELECT doc_id, size, n, pos, [{_followers(10)}] AS run FROM item_words)
  WHERE pos + size - 1 <= n
), docs AS ({_clean_words('documents', 'doc_id')}
), words AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs
), runs AS (
  SELECT doc_id, n, pos, [{_followers(10)}] AS run FROM words
), hits AS (
  SELECT r.doc_id, r.pos, r.size, i.item_id
  FROM (SELECT doc_id, pos, size, array_to_string(list_slice(run, 1, size), ' ') AS run
        FROM runs, (SELECT DISTINCT size FROM item_windows) WHERE pos + size - 1 <= n) r
  JOIN item_windows i ON r.run = i.run AND r.size = i.size
), found AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(len(f.ids), 0) AS n_items,
       sha256(coalesce(array_to_string(f.ids, ','), '')) AS items_sha256,
       c.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id"""


def _crc_table() -> str:
    """The 256 steps of crc32 for one byte, by its rule."""
    entries = []
    for byte in range(256):
        value = byte
        for _ in range(8):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        entries.append(str(value))
    return f"([{', '.join(entries)}]::BIGINT[])"


def _network() -> str:
    """The rounds over (x, y) below a and b, one select in another."""
    rows = "SELECT id, a, b, n, step, v % a AS x, v // a AS y FROM walk WHERE step = 0 OR v >= n"
    for r in range(ROUNDS):
        bits = "('0x' || substr(md5('0:{r}:' || {half}), 1, 8))::BIGINT"
        if r % 2:
            new = f"x, (y + {bits.format(r=r, half='x')}) % b AS y"
        else:
            new = f"(x + {bits.format(r=r, half='y')}) % a AS x, y"
        rows = f"SELECT id, a, b, n, step, {new} FROM ({rows})"
    return rows


_OP5 = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
         string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1,', 'g'), ',')
           AS digits
  FROM documents
), crced AS (
  SELECT doc_id, size, xor(list_reduce(
           list_prepend(4294967295, list_transform(list_slice(digits, 1, len(digits) - 1),
                                                   lambda d: ('0x' || d)::BIGINT)),
           lambda crc, byte: xor(crc >> 8, {_crc_table()}[(xor(crc, byte) & 255) + 1])),
         4294967295) AS text_crc32
  FROM sized
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS id FROM crced
), sides AS (
  SELECT n, a, greatest(1, CAST(ceil(n / a) AS BIGINT)) AS b
  FROM (SELECT count(*) AS n, greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS a
        FROM documents)
), walk AS (
  SELECT id, a, b, n, id AS v, 0 AS step FROM numbered, sides
  UNION ALL
  SELECT id, a, b, n, x + y * a AS v, step + 1
  FROM ({_network()})
  WHERE step <= {LONGEST_WALK}
), ended AS (
  SELECT id, v FROM walk WHERE step > 0 AND v < n
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(v % 40 AS INTEGER) AS shard,
       v // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN ended ON numbered.id = ended.id"""

_OP10 = """
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.row != c.row AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _coded(n: int) -> str:
    """Every part's nearest entry of the books after ``n`` rounds."""
    return f"""coded{n} AS (
  SELECT row, p, any_value(part) AS part, min(struct_pack(d := d, e := e)) AS best
  FROM (SELECT row, c.p, c.part, e,
               CAST(list_inner_product(c.part, c.part) - 2 * list_inner_product(c.part, b.part)
                    + list_inner_product(b.part, b.part) AS BIGINT) AS d
        FROM cuts c JOIN book{n} b ON c.p = b.p)
  GROUP BY row, p
)"""


def _moved(n: int) -> str:
    """The books of the next round."""
    return f"""book{n + 1} AS (
  SELECT b.p, b.e, coalesce(m.part, b.part) AS part
  FROM book{n} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY j) AS part
    FROM (SELECT p, best.e AS e, j, floor(sum(part[j]) / count(*)) AS mean
          FROM (SELECT p, best, part, unnest(range(1, len(part) + 1)) AS j FROM coded{n})
          GROUP BY p, best.e, j)
    GROUP BY p, e
  ) m ON b.p = m.p AND b.e = m.e
)"""


_OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}
), cuts AS (
  SELECT row, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS part
  FROM kept, range(16) t(p)
), book0 AS (
  SELECT p, row AS e, part FROM cuts WHERE row < 64
), {_coded(0)}, {_moved(0)}, {_coded(1)}, {_moved(1)}, {_coded(2)}, books AS (
  SELECT sha256(string_agg(CAST(CAST(part[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) AS hash
  FROM (SELECT p, e, part, unnest(range(1, len(part) + 1)) AS j FROM book2)
), codes AS (
  SELECT row, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY p) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM coded2 GROUP BY row
)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       hash AS codebooks_sha256
FROM kept JOIN codes USING (row), books"""

_OP13 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}
), scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.row AS other,
         c.vec_id AS id, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.row != c.row AND len(a.v) = len(c.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, other) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other
                               ORDER BY n.score DESC, n.id, n.other) AS INTEGER) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor
WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_substring_dedup": _OP1,
        "op4_benchmark_decontamination": _OP4,
        "op5_sharding": _OP5,
        "op10_top_k": _OP10,
        "op11_vector_codes": _OP11,
        "op13_hard_negatives": _OP13,
    }
