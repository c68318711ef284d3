"""SQL twins of the operators' queries, for DuckDB.

Packing, record files, near duplicates, byte passages (too slow over whole
tables there), sharding, toxicity and the quality classifier have none: tests
compare them with brute-force versions or measure held-out accuracy.
"""

from kerbside.llm import centroids, infill
from kerbside.llm.mixing import MOST, SEED, SHARE, WEIGHTS

EXACT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), m AS (
  SELECT doc_id, r, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines
  FROM d
), places AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS i,
         unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(list_slice(w, i, i + 7), ' '))) AS s FROM d
), counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, s) AS times FROM places
), repeated AS (
  SELECT r, sum(least(8, coalesce(i - before, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM counted WHERE times > 1) GROUP BY r
), judged AS (
  SELECT *, coalesce(n_repeat_words, 0)::BIGINT AS repeats,
         n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS failed,
         10 * n_symbols > n_words
           OR 2 * len(regexp_extract_all(t, '!')) > n_words
           OR 2 * len(regexp_extract_all(t, '\p{{Lu}}')) > word_chars
           OR word_chars > 15 * n_words OR word_chars < 2 * n_words
           OR 2 * n_dup_lines > n_lines AS rejected
  FROM m LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, repeats AS n_repeat_words, failed AS base_failed,
       NOT failed AND NOT rejected AS kept
FROM judged
"""

MIXING = f"""
WITH sizes AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighted AS (
  SELECT *, ([{", ".join(map(str, WEIGHTS))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM totals
), levels AS (
  SELECT *, ({SHARE} * sum(source_size) OVER ()
             - coalesce(sum({MOST} * source_size) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW fill AS (ORDER BY source_size / weight, source NULLS LAST)
), filled AS (
  SELECT source, source_size, weight, max(level) FILTER (level * weight <= {MOST} * source_size) OVER () AS level FROM levels
), targets AS (
  SELECT source, source_size, coalesce(least({MOST} * source_size::DOUBLE, level * weight), {MOST} * source_size::DOUBLE) AS target
  FROM filled
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate,
         ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS coin
  FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (coin < rate - floor(rate))::INT))::BIGINT AS taken FROM rated
"""

PHRASES = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, unnest(range(0, len(w) - 19)) AS i,
         unnest(list_transform(range(0, len(w) - 19), lambda i: array_to_string(list_slice(w, i + 1, i + 20), ' '))) AS s
  FROM d
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM places
), hit AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM ranked WHERE k > 1
), spans AS (
  SELECT doc_id, sum(least(20, coalesce(i - before, 20))) AS n_removed,
         list(struct_pack(low := coalesce(before + 20, 0), high := i) ORDER BY i)
           FILTER (before IS NULL OR i - before > 20) AS gaps, max(i) + 20 AS rest
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gaps IS NULL THEN w ELSE list_concat(
         flatten(list_transform(gaps, lambda g: list_slice(w, g.low + 1, g.high))),
         list_slice(w, rest + 1, len(w))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN spans USING (doc_id)
"""

def _clustering() -> str:
    """One pair of tables per round: ``a``, where vectors go, and ``c``, where centroids are after it."""

    def nearest(i: int) -> str:
        return f"""a{i} AS (
  SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, min(distance) AS distance, arg_min(cluster, (distance, cluster)) AS cluster
  FROM (SELECT r, vec_id, q, cluster,
               list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
        FROM kept CROSS JOIN c{i})
  GROUP BY r)"""

    def after(i: int) -> str:
        return f"""c{i} AS (
  SELECT cluster, coalesce(m.c, old.c) AS c FROM c{i - 1} AS old LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY k)::BIGINT[] AS c
    FROM (SELECT cluster, k, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(q) AS x, unnest(range(1, {centroids.DIMENSIONS + 1})) AS k FROM a{i - 1}) GROUP BY cluster, k)
    GROUP BY cluster) AS m USING (cluster))"""

    steps = ",\n".join(f"{nearest(i)},\n{after(i + 1)}" for i in range(centroids.ROUNDS))
    last = centroids.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSIONS}
), c0 AS (
  SELECT (row_number() OVER (ORDER BY name, q) - 1)::INT AS cluster, q AS c
  FROM (SELECT q, sha256('{centroids.SEED}:' || coalesce(vec_id::VARCHAR, 'null')) AS name FROM kept
        ORDER BY name, q LIMIT {centroids.CLUSTERS})
), {steps},
{nearest(last)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (cluster)
"""


INFILL = f"""
WITH drawn AS (
  SELECT doc_id, t, n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in range(4)] AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
               sha256('{infill.SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents)
), cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= {infill.PLAIN_FROM}
              THEN 'plain' WHEN h[4] % 100 < {infill.SUFFIX_FIRST_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": EXACT,
    "op3_quality_rules": QUALITY,
    "op5_source_mixing": MIXING,
    "op8_phrase_dedup": PHRASES,
    "op11_centroid_clustering": _clustering(),
    "op13_fill_in_middle": INFILL,
}
