"""The same answers in SQL, for the operators that have a form in SQL."""

from __future__ import annotations

#: The byte table of CRC-32, by its definition.
_CRC_TABLE = """
steps(b, k, c) AS (
  SELECT range, 0, CAST(range AS UBIGINT) FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc_table AS (SELECT CAST(b AS UBIGINT) AS b, c FROM steps WHERE k = 8)"""


def _checksums(strings: str) -> str:
    """CTEs up to ``checksums(s, crc)`` of the distinct ``s`` in the CTE ``strings``.

    A checksum is the sum of what each byte leaves behind after as many zero bytes as follow it.
    """
    return f"""
hexed AS (SELECT s, lower(hex(encode(s))) AS h FROM (SELECT DISTINCT s FROM {strings})),
most_bytes AS (SELECT coalesce(max(length(h)) // 2, 0) AS n FROM hexed),
left_behind(b, k, c) AS (
  SELECT b, 0, c FROM crc_table
  UNION ALL
  SELECT l.b, k + 1, xor(l.c >> 8, t.c) FROM left_behind l JOIN crc_table t ON t.b = l.c & 255, most_bytes WHERE k + 1 < n
),
by_hex AS (SELECT lpad(printf('%x', b), 2, '0') AS x, k, c FROM left_behind),
started(k, c) AS (
  SELECT 0, 4294967295::UBIGINT
  UNION ALL
  SELECT k + 1, xor(s.c >> 8, t.c) FROM started s JOIN crc_table t ON t.b = s.c & 255, most_bytes WHERE k < n
),
bytes AS (SELECT s, h, unnest(range(length(h) // 2)) AS i FROM hexed),
summed AS (
  SELECT s, any_value(length(h) // 2) AS n, bit_xor(c) AS c FROM bytes
  JOIN by_hex ON x = substr(h, 2 * i + 1, 2) AND k = length(h) // 2 - 1 - i GROUP BY s
),
checksums AS (
  SELECT s, xor(xor(summed.c, started.c), 4294967295::UBIGINT) AS crc FROM summed JOIN started ON k = n
)"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: All windows of 50 bytes, as pairs of hexadecimal digits, compared by a 64-bit hash.
SUFFIX_DEDUP = """
WITH docs AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h,
         CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes FROM documents
),
starts AS (SELECT doc_id, h, unnest(range(n_bytes - 49)) AS s FROM docs WHERE n_bytes >= 50),
strings AS (SELECT doc_id, s, hash(substr(h, 2 * s + 1, 100)) AS string FROM starts),
least AS (SELECT string, min(doc_id) AS first FROM strings GROUP BY string),
gone AS (
  SELECT doc_id, s FROM strings JOIN least ON strings.string = least.string WHERE first < doc_id
),
marked AS (
  SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS opens
  FROM gone
),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM marked),
spans AS (SELECT doc_id, span, min(s) AS low, max(s) + 50 AS high FROM numbered GROUP BY doc_id, span),
counts AS (
  SELECT doc_id, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
),
gaps AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS past FROM spans
),
kept AS (
  SELECT docs.doc_id, string_agg(substr(h, 2 * past + 1, 2 * (low - past)), '' ORDER BY low)
         || substr(any_value(h), CAST(2 * max(high) + 1 AS BIGINT)) AS h
  FROM gaps JOIN docs ON gaps.doc_id = docs.doc_id GROUP BY docs.doc_id
)
SELECT docs.doc_id, docs.n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN docs.h ELSE coalesce(kept.h, '') END)) AS kept_sha256
FROM docs LEFT JOIN counts ON docs.doc_id = counts.doc_id LEFT JOIN kept ON docs.doc_id = kept.doc_id
"""

#: Every query against every vector.
EXACT_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

#: Every pair of documents that shares a shingle.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS w FROM documents
),
places AS (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
  ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)
),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(b, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes ON d.doc_id = sizes.doc_id LEFT JOIN least ON d.doc_id = least.doc_id
"""

#: Features as strings, counted by bucket; the drawn rows by a sort.
IMPORTANCE = f"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (
  SELECT true AS corpus, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), text FROM benchmark
),
words AS (
  SELECT corpus, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
),
places AS (SELECT corpus, doc_id, w, unnest(range(len(w))) AS i FROM words),
runs AS (
  SELECT corpus, doc_id, array_to_string(w[i + 1 : i + n], ' ') AS s
  FROM places JOIN (VALUES (1), (2), (3)) AS sizes(n) ON i + n <= len(w)
),
{_checksums("runs")},
features AS (SELECT corpus, doc_id, crc % 10000 AS bucket FROM runs JOIN checksums ON runs.s = checksums.s),
counts AS (
  SELECT CAST(range AS UBIGINT) AS bucket, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t
  FROM range(10000) LEFT JOIN features ON bucket = range GROUP BY range
),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (CAST(counts.t AS DOUBLE) + 1) * (CAST(totals.s AS DOUBLE) + 10000)
    / ((CAST(counts.s AS DOUBLE) + 1) * (CAST(totals.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM counts, totals
),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM features JOIN gains ON features.bucket = gains.bucket WHERE corpus GROUP BY doc_id
),
scored AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('42:' || words.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE
         ))) AS BIGINT) AS score
  FROM words LEFT JOIN weights ON words.doc_id = weights.doc_id WHERE corpus
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
         sum(CAST(n_words >= 20 AS INTEGER)) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

#: Six words in a row that occur again q words later, joined to stretches.
PERIODIC_RUNS = f"""
WITH RECURSIVE {_CRC_TABLE},
names AS (SELECT CAST(doc_id AS VARCHAR) AS s FROM documents),
{_checksums("names")},
texts AS (
  SELECT doc_id, CAST(crc AS BIGINT) AS h, CAST(crc // 10 AS BIGINT) AS g, list_filter(
    string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents JOIN checksums ON s = CAST(doc_id AS VARCHAR)
),
cut AS (SELECT *, CASE WHEN len(w) > 0 THEN g % len(w) END AS a FROM texts),
rounds AS (SELECT *, 1 + (len(w) - a) // (3 + g % 8) AS p FROM cut),
docs AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN list_transform(
    range(CAST(len(w) AS BIGINT)), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w
  FROM rounds
),
places AS (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM docs WHERE len(w) >= 12),
grams AS (SELECT doc_id, i, hash(array_to_string(w[i + 1 : i + 6], ' ')) AS gram FROM places),
again AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
),
joined AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM again),
periods AS (
  SELECT doc_id, min(i) AS start, count(*) + 5 + q AS length, q FROM joined GROUP BY doc_id, q, stretch
),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM periods
  WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length
),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
),
longest AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
),
single AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM docs),
kept AS (
  SELECT single.doc_id, string_agg(w[single.i + 1], ' ' ORDER BY single.i) AS line
  FROM single LEFT JOIN gone ON single.doc_id = gone.doc_id AND single.i = gone.i WHERE gone.i IS NULL GROUP BY single.doc_id
)
SELECT docs.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed ON docs.doc_id = listed.doc_id LEFT JOIN longest ON docs.doc_id = longest.doc_id
LEFT JOIN kept ON docs.doc_id = kept.doc_id
"""
