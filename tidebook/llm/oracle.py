"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE["op8_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (
    SELECT page_id, html, CAST(strlen(html) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS newest FROM payloads
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM sized
"""

ORACLE["op11_bag_search"] = f"""
WITH bags AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest({_WORDS}) AS term FROM documents) GROUP BY doc_id, term
),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM bags GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark)),
weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM bags, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
    FROM asked JOIN weighed USING (term) JOIN bags USING (term) JOIN sizes USING (doc_id), corpus
    GROUP BY item_id, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

# CRC-32 of each distinct word, byte by byte, from a table of what each low byte does in eight steps.
ORACLE["op13_importance"] = f"""
WITH steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
),
found AS (
    SELECT doc_id, NULL AS item_id, unnest({_WORDS}) AS word FROM documents
    UNION ALL SELECT NULL, item_id, unnest({_WORDS}) FROM benchmark
),
spelled AS (
    SELECT word, list_transform(range(length(hex(word)) // 2), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS bytes
    FROM (SELECT DISTINCT word FROM found)
),
hashed AS (
    SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM spelled, steps
),
counts AS (
    SELECT bucket, count(doc_id) AS s, count(item_id) AS t FROM found JOIN hashed USING (word) GROUP BY bucket
),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM counts
),
sums AS (
    SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
    FROM found JOIN hashed USING (word) JOIN gains USING (bucket) WHERE doc_id IS NOT NULL GROUP BY doc_id
),
noisy AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
    FROM documents LEFT JOIN sums USING (doc_id)
),
scored AS (
    SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM noisy
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank FROM ranked
"""
