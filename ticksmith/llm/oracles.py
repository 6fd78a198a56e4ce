"""DuckDB SQL for the queries that SQL can express: archives, windows of a benchmark, windows of
words, sets of n-grams, inner products and counts of hashed words. Fingerprints, flows, models,
shuffles and byte strings have none; their tests compare them with brute force."""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
    "op3_suffix_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
s AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
i AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM s),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[pos : pos + size - 1], ' ') AS words FROM i),
sizes AS (SELECT DISTINCT size FROM s),
c AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, sizes WHERE len(w) >= size),
o AS (SELECT doc_id, pos, size, array_to_string(w[pos : pos + size - 1], ' ') AS words FROM c),
m AS (SELECT doc_id, pos, size, item_id FROM o JOIN windows USING (size, words)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n
         FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM m) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit,
       coalesce(named.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_automaton_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS pos FROM d WHERE len(w) >= 35),
o AS (SELECT doc_id, pos, md5(array_to_string(w[pos : pos + 34], ' ')) AS words FROM s),
r AS (SELECT doc_id, pos FROM o WHERE words IN (SELECT words FROM o GROUP BY words HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, pos + k AS place FROM r, range(0, 35) t(k)),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
k AS (SELECT doc_id, count(gone.place) AS n_removed,
             string_agg(word, ' ' ORDER BY t.place) FILTER (WHERE gone.place IS NULL) AS kept
      FROM t LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    # Pairs of documents by the n-grams they share, then what their links reach.
    "op11_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS pos FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[pos : pos + 3], ' ') AS gram FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * common >= 85 * (x.n + y.n - common)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1) LEFT JOIN n USING (doc_id)""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN (SELECT * FROM s WHERE NOT same) USING (anchor_id)
WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    # CRC-32 over the bytes of a word: its table, then a fold.
    "op13_importance_resampling": f"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS word FROM benchmark),
words AS (SELECT DISTINCT unnest(w) AS word FROM d UNION SELECT DISTINCT word FROM b),
bytes AS (
  SELECT word, list_transform(range(0, octet_length(encode(word))), lambda i:
           16 * (instr('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 1, 1)) - 1)
           + instr('0123456789ABCDEF', substr(hex(encode(word)), 2 * i + 2, 1)) - 1) AS code
  FROM words
),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), code), lambda a, x:
           xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc
),
own AS (SELECT doc_id, unnest(w) AS word FROM d),
s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)
           / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
),
weighed AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
            FROM own JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((list_reduce(list_prepend(CAST(0 AS BIGINT),
           list_transform(range(1, 9), lambda i:
             instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1)),
           lambda a, x: 16 * a + x) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (doc_id)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM placed""",
}
