"""DuckDB statements of the queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Lines of at least 40 code points, by key, and the document that keeps a key of five documents or more.
ORACLES["op1_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, i, split[i] AS line,
           translate(trim(split[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, split, unnest(range(1, len(split) + 1)) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents))
),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper != doc_id AS gone FROM lines LEFT JOIN repeated USING (key))
GROUP BY doc_id
"""

# Every shared run of five words of every document and item, counted.
ORACLES["op5_decontaminate"] = """
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'i', item_id, text FROM benchmark
),
words AS (
    SELECT kind, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x09-\\x0D\\x20]+') AS w
    FROM texts
),
shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[k:k + 4], ' ') AS s
    FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)
),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id),
links AS (
    SELECT d.id AS doc_id, i.id AS item_id
    FROM shingles i JOIN shingles d ON i.s = d.s AND i.kind = 'i' AND d.kind = 'd' JOIN sizes ON sizes.id = i.id
    GROUP BY d.id, i.id, sizes.n HAVING 100 * count(*) >= 80 * sizes.n
)
SELECT doc_id, count(item_id) AS n_items,
       coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id), '') AS item_ids
FROM documents LEFT JOIN links USING (doc_id) GROUP BY doc_id
"""

# Fail bits of every document, then every (part, order, step) counted over them; orders as all
# arrangements of five letters, a filter's fails as a letter in a string per document.
ORACLES["op13_filter_audit"] = """
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
),
measured AS (
    SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x09-\\x0D\\x20]+') AS w,
           coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e
    FROM docs
),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
fails AS (
    SELECT part,
           CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN e THEN 'E' ELSE '' END AS f,
           coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM measured LEFT JOIN marks USING (doc_id)
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x != e.x
),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
judged AS (
    SELECT part, filter_order, step, letter, good, toxic,
           contains(f, letter) AS fails_here,
           NOT regexp_matches(f, '[' || before || letter || ']') AS kept_after,
           CASE WHEN before = '' THEN true ELSE NOT regexp_matches(f, '[' || before || ']') END AS passed_before,
           f = letter AS alone
    FROM fails, steps
),
counted AS (
    SELECT part, filter_order, step, letter,
           count(*) FILTER (WHERE kept_after) AS kept,
           count(*) FILTER (WHERE fails_here AND passed_before) AS removed,
           count(*) FILTER (WHERE fails_here AND NOT passed_before) AS redundant,
           count(*) FILTER (WHERE alone) AS unique_fails,
           coalesce(sum(good) FILTER (WHERE fails_here AND passed_before), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE fails_here AND passed_before), 0) AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

# Five rounds of exact integer k-means, unrolled: every vector against every centroid, the nearest by
# (distance, number), new centroids by floor division of componentwise sums, empty ones kept.
_DISTANCE = "list_sum(list_transform(range(1, 65), lambda i: (k.p[i] - {c}.p[i]) * (k.p[i] - {c}.p[i])))"
_ROUND = """
near{n} AS (
    SELECT k.r, arg_min(c.c, [{d}, c.c]) AS c FROM kept k, centres{n} c GROUP BY k.r
),
moved{n} AS (
    SELECT c, list(v ORDER BY i) AS p FROM (
        SELECT near{n}.c, i, CAST(floor(sum(k.p[i]) / count(*)) AS BIGINT) AS v
        FROM near{n} JOIN kept k USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY near{n}.c, i
    ) GROUP BY c
),
centres{m} AS (
    SELECT c.c, coalesce(m.p, c.p) AS p FROM centres{n} c LEFT JOIN moved{n} m USING (c)
),"""
ORACLES["op12_centroids"] = (
    """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
centres0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), p) - 1 AS INTEGER) AS c, p
    FROM kept QUALIFY c < 40
),"""
    + "".join(_ROUND.format(n=n, m=n + 1, d=_DISTANCE.format(c="c")) for n in range(5))
    + """
assigned AS (
    SELECT k.r, k.vec_id, arg_min(f.c, [{d}, f.c]) AS cluster, min({d}) AS distance
    FROM kept k, centres5 f GROUP BY k.r, k.vec_id
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(f.p, ',')) AS centroid_sha256
FROM assigned a JOIN centres5 f ON f.c = a.cluster
""".replace("{d}", _DISTANCE.format(c="f"))
)
