"""DuckDB SQL of the shingle join, vector code and periodic run queries, by plain comparison of everything with everything that matters."""

from __future__ import annotations


def ngram_join_sql(n: int = 4, share: int = 85) -> str:
    """All pairs that share a shingle, their whole overlaps, and what links reach."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
sets AS MATERIALIZED (
  SELECT n, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i : i + {n - 1}], ' '))) END AS s
  FROM docs
),
tokens AS MATERIALIZED (SELECT n, unnest(s) AS t FROM sets),
shared AS (SELECT x.n AS a, y.n AS b, count(*) AS c FROM tokens x JOIN tokens y ON x.t = y.t AND x.n < y.n GROUP BY x.n, y.n),
links AS MATERIALIZED (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM shared JOIN sets x ON x.n = a JOIN sets y ON y.n = b
  WHERE 100 * c >= {share} * (len(x.s) + len(y.s) - c) AND x.doc_id <> y.doc_id
),
ends AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  WITH RECURSIVE steps(a, b) AS (SELECT a, b FROM ends UNION SELECT steps.a, ends.b FROM steps JOIN ends ON steps.b = ends.a)
  SELECT a, min(b) AS least_id FROM steps GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id
FROM sets LEFT JOIN reached ON reached.a = doc_id
"""


def vector_codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Nearest entries by computing all distances; rounds unrolled."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT n, part, min({{'d': list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}}) AS best
  FROM pieces JOIN book{r} USING (part) GROUP BY n, part
)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
  SELECT part, entry, i, sum(v)::BIGINT AS s, count(*) AS k
  FROM (SELECT part, best.e AS entry, unnest(p) AS v, unnest(range(len(p))) AS i FROM near{r} JOIN pieces USING (n, part))
  GROUP BY part, entry, i
),
means{r} AS (SELECT part, entry, list((s - ((s % k) + k) % k) // k ORDER BY i) AS m FROM sums{r} GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m, c) AS c FROM book{r} LEFT JOIN means{r} USING (part, entry))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
pieces AS MATERIALIZED (
  SELECT n, part, q[part * (len(q) // {parts}) + 1 : (part + 1) * (len(q) // {parts})] AS p
  FROM kept, (SELECT unnest(range({parts})) AS part)
),
book0 AS (SELECT part, n - 1 AS entry, p AS c FROM pieces WHERE n <= {entries}),{",".join(steps)},
coded AS (
  SELECT n, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY n
),
digest AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS v, unnest(range(len(c))) AS i FROM book{rounds})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (n) CROSS JOIN digest
"""


#: crc32 of an ASCII text: eight shifts a character, with the reversed polynomial 0xEDB88320.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x // 2, (x % 2) * 3988292384))), 4294967295)"""


def periodic_runs_sql() -> str:
    """A run of period q holds three equal words q apart at a multiple of q, and then a whole period that repeats;
    of the periods found so, all stretches of equality are listed."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         {_CRC32.format(text="doc_id::VARCHAR")} AS h
  FROM documents
),
sized AS (SELECT n, doc_id, w, len(w) AS size, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM docs),
plan AS (SELECT *, CASE WHEN planted THEN g % size ELSE size END AS a FROM sized),
texts AS (SELECT n, doc_id, w, size, a, CASE WHEN planted THEN 1 + (size - a) // (3 + g % 8) ELSE 1 END AS p FROM plan),
words AS MATERIALIZED (
  SELECT n, size, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS w
  FROM (SELECT n, size, w, a, p, unnest(range(size)) AS i FROM texts)
),
lists AS MATERIALIZED (SELECT n, list(w ORDER BY i) AS w FROM words GROUP BY n),
lags AS (SELECT n, size, unnest(range(1, size // 4 + 1)) AS q FROM texts),
places AS (SELECT n, q, unnest(range(0, size - 2 * q, q)) AS i FROM lags),
thrice AS (
  SELECT n, q, p.i FROM places p JOIN words x USING (n, i)
  JOIN words y ON y.n = p.n AND y.i = p.i + q AND y.w = x.w JOIN words z ON z.n = p.n AND z.i = p.i + 2 * q AND z.w = x.w
),
periods AS (
  SELECT DISTINCT n, q FROM thrice JOIN lists USING (n) WHERE w[i + 1 : i + q] = w[i + q + 1 : i + 2 * q]
),
breaks AS (
  SELECT n, q, x.i FROM periods JOIN words x USING (n) JOIN words y ON y.n = x.n AND y.i = x.i + q WHERE x.w <> y.w
  UNION ALL SELECT n, q, -1 FROM periods
  UNION ALL SELECT n, q, size - q FROM periods JOIN texts USING (n)
),
stretches AS (SELECT n, q, i + 1 AS s, lead(i) OVER (PARTITION BY n, q ORDER BY i) + q AS e FROM breaks),
runs AS MATERIALIZED (SELECT n, s, e, min(q) AS q FROM stretches WHERE e - s >= greatest(6, 4 * q) GROUP BY n, s, e),
top AS (
  SELECT n, count(*) AS n_runs, min({{'l': s - e, 's': s, 'q': q}}) AS best,
         string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS listed
  FROM runs GROUP BY n
),
gone AS (SELECT DISTINCT n, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT n, string_agg(w, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (n, i) GROUP BY n)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS "start", (-best.l)::BIGINT AS length, best.q::BIGINT AS period,
       (1000 * -best.l // best.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN top USING (n) LEFT JOIN kept USING (n)
"""
