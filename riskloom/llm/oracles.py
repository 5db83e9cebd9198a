"""SQL for the operators that SQL can express."""

EXACT_DEDUP = r"""
WITH e AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', '', 'g')) AS text_sha256,
    length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM e WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

SOURCE_MIXING = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^ \t-\r]+')), 0) AS BIGINT) AS size,
    md5(CAST(doc_id AS VARCHAR)) AS place FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM g),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM n),
f AS (SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM w),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) - 2.0::DOUBLE * CAST(coalesce(sum(source_size) OVER b, 0) AS BIGINT))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM f WINDOW b AS (ORDER BY full_at, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN level >= full_at THEN 2.0::DOUBLE * source_size
    ELSE weight * (SELECT arg_min(level, (full_at, rank)) FROM l WHERE level < full_at) END AS target FROM l),
q AS (SELECT doc_id, size, source_size, target,
    CAST(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
c AS (SELECT size, upto / target AS fin FROM q WHERE size > 0 UNION ALL SELECT size, (source_size + upto) / target FROM q WHERE size > 0),
k AS (SELECT max(fin) AS cut FROM (SELECT fin, sum(size) OVER (ORDER BY fin) AS spent FROM c)
  WHERE spent <= 1.5::DOUBLE * (SELECT sum(size) FROM s))
SELECT doc_id, size, source_size, target, CAST(CASE WHEN target > 0 THEN size * (CASE WHEN upto / target <= cut THEN 1 ELSE 0 END
  + CASE WHEN (source_size + upto) / target <= cut THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM q CROSS JOIN k
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(13, len(w)) AS k, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM p),
s AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM q) WHERE len(w) >= k),
g AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM s),
h AS (SELECT g.r, g.k, g.i, q.item_id FROM g JOIN q ON g.k = q.k AND g.g = q.g),
c AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents),
s AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT r, doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS g FROM s),
m AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g),
h AS (SELECT r, i FROM g JOIN m USING (g) WHERE low < doc_id),
c AS (SELECT r, list(DISTINCT j) AS gone FROM (SELECT r, unnest(range(i, i + 13)) AS j FROM h) GROUP BY r),
k AS (SELECT d.r, string_agg(word, ' ' ORDER BY j) AS kept FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) d
  LEFT JOIN c ON c.r = d.r WHERE c.r IS NULL OR NOT list_contains(gone, j) GROUP BY d.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""

#: Connected documents by shared word shingles: k words a shingle, percent of the union that two sets share.
SIMILAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^ \t-\r]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - $more) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + $more], ' ')) AS g FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= $percent * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, comp) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.comp FROM r JOIN e ON e.a = r.node WHERE r.comp < e.b),
c AS (SELECT node, min(comp) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id$columns
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""

#: One assignment of every part (r: part, position, number of entry j, components c) and one mean per entry.
CODES_ROUND = """
a{r} AS MATERIALIZED (SELECT v.i, v.p, arg_min(b.j, (list_sum(list_transform(range(1, len(v.c) + 1), lambda k: (v.c[k] - b.c[k]) * (v.c[k] - b.c[k]))), b.j)) AS j
  FROM v JOIN b{r} b USING (p) GROUP BY v.i, v.p)"""
CODES_MEAN = """
s{r} AS (SELECT a.p, a.j, k, sum(v.c[k]) AS s, count(*) AS n FROM a{r} a JOIN v USING (i, p), unnest(range(1, len(v.c) + 1)) AS u(k) GROUP BY ALL),
b{next} AS MATERIALIZED (SELECT b.p, b.j, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN
  (SELECT p, j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c FROM s{r} GROUP BY p, j) m ON m.p = b.p AND m.j = b.j)"""

VECTOR_CODES = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS i, vec_id, label, x FROM
  (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
v AS MATERIALIZED (SELECT i, p, x[p * (len(x) // 8) + 1 : (p + 1) * (len(x) // 8)] AS c FROM e, unnest(range(0, 8)) AS u(p)),
b0 AS MATERIALIZED (SELECT p, i - 1 AS j, c FROM v WHERE i <= 16),
{",".join(CODES_ROUND.format(r=r) + "," + CODES_MEAN.format(r=r, next=r + 1) for r in range(6))},
{CODES_ROUND.format(r=6)},
d AS (SELECT a.i, a.p, a.j, list_sum(list_transform(range(1, len(v.c) + 1), lambda k: (v.c[k] - b.c[k]) * (v.c[k] - b.c[k]))) AS d
  FROM a6 a JOIN v USING (i, p) JOIN b6 b ON b.p = a.p AND b.j = a.j),
f AS (SELECT i, string_agg(format('{{:02x}}', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM d GROUP BY i)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(x, ',' ORDER BY p, j, k)) FROM (SELECT p, j, k, CAST(c[k] AS VARCHAR) AS x FROM b6, unnest(range(1, len(c) + 1)) AS u(k))) AS codebooks_sha256
FROM e JOIN f USING (i)
"""


def similar(k: int, percent: int, columns: str = "") -> str:
    return SIMILAR.replace("$more", str(k - 1)).replace("$percent", str(percent)).replace("$columns", columns)


NEAR_DEDUP = similar(4, 80, ", d.doc_id = component_id AS kept")
JACCARD_JOIN = similar(3, 90)

ALL: dict[str, str] = {
    "op13_ngram_jaccard_join": JACCARD_JOIN,
    "op12_vector_codes": VECTOR_CODES,
    "op9_minhash_dedup": NEAR_DEDUP,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op10_decontamination": DECONTAMINATION,
    "op4_exact_dedup": EXACT_DEDUP,
    "op8_source_mixing": SOURCE_MIXING,
}
