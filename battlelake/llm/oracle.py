"""DuckDB SQL for the operators that SQL can express."""

SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL["op5_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

SQL["op1_near_dup"] = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
    FROM w
), x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT p.a, p.b FROM p JOIN s sa ON sa.doc_id = p.a JOIN s sb ON sb.doc_id = p.b
    WHERE 100 * n >= 80 * (len(sa.shingles) + len(sb.shingles) - n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.shingles
"""

SQL["op10_decontaminate"] = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), b AS (
    SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), items AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS piece
    FROM b, LATERAL (SELECT unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i) WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM items
), windows AS (
    SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS piece
    FROM d, sizes, LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS i)
), hits AS (SELECT w.doc_id, w.size, w.i, t.item_id FROM windows w JOIN items t USING (size, piece)
), places AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, LATERAL (SELECT unnest(range(i, i + size)) AS k) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_DISTANCE = "list_sum(list_transform(list_zip(v.part, c.entry_part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _assigned(number: int) -> str:
    """Each part with its nearest entry of a round's codebooks."""
    return f"""
, d{number} AS (
    SELECT v.row_no, v.p, c.entry, coalesce({_DISTANCE}, 0)::BIGINT AS distance FROM parts v JOIN book{number} c ON c.p = v.p
), near{number} AS (
    SELECT row_no, p, entry, distance FROM d{number} QUALIFY row_number() OVER (PARTITION BY row_no, p ORDER BY distance, entry) = 1
)"""


def _refined(number: int) -> str:
    """The next round's codebooks: the floor of each component's mean, or the entry as it was."""
    return f"""
, means{number} AS (
    SELECT p, entry, k, floor(sum(v.part[k])::DOUBLE / count(*))::BIGINT AS mean
    FROM near{number} JOIN parts v USING (row_no, p), LATERAL (SELECT unnest(range(1, len(v.part) + 1)) AS k) GROUP BY p, entry, k
), lists{number} AS (SELECT p, entry, list(mean ORDER BY k) AS entry_part FROM means{number} GROUP BY p, entry
), book{number + 1} AS (
    SELECT b.p, b.entry, coalesce(l.entry_part, b.entry_part) AS entry_part FROM book{number} b LEFT JOIN lists{number} l USING (p, entry)
)"""


SQL["op12_codes"] = f"""
WITH whole AS (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row_no, vec_id, label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT row_no, p::INTEGER AS p, e[p * len(e) // 16 + 1:(p + 1) * len(e) // 16] AS part FROM whole, range(16) t(p)
), book0 AS (SELECT p, (row_no - 1)::INTEGER AS entry, part AS entry_part FROM parts WHERE row_no <= 64
){_assigned(0)}{_refined(0)}{_assigned(1)}{_refined(1)}{_assigned(2)}, coded AS (
    SELECT row_no, string_agg(lower(printf('%02x', entry)), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error FROM near2 GROUP BY row_no
), numbers AS (SELECT sha256(string_agg(array_to_string(entry_part, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (row_no), numbers
"""
