"""DuckDB counterparts of the registered queries."""

from .licenses import TEMPLATES

_LISTED = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

OP5 = (
    f"""
WITH listed(license, wording) AS (VALUES {_LISTED}),"""
    + r"""
cut AS (SELECT license, list_filter(string_split_regex(lower(wording), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM listed),
own AS (SELECT license, len(w) AS n, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) AS s FROM cut),
sized AS (
  SELECT license, n, s, count(*) OVER (PARTITION BY license) AS total,
    list_min(list_filter([8, 16, 32, 64, 128, 256, 512, 1024], lambda c: c >= n * 1.25)) AS class FROM own),
texts AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
places AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: {'at': i - 1, 's': array_to_string(w[i:i + 4], ' ')})) AS p FROM texts),
hits AS (
  SELECT doc_id, license, total, s.s AS s, unnest([(p.at // class), (p.at // class) - 1]) AS k
  FROM places JOIN sized s ON p.s = s.s),
windows AS (
  SELECT doc_id, license, k, count(DISTINCT s)::DOUBLE / any_value(total) AS containment FROM hits GROUP BY doc_id, license, k)
SELECT doc_id, license, max(containment) AS containment, count(*) AS windows
FROM windows WHERE containment >= 0.8 GROUP BY doc_id, license
"""
)

OP6 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS key
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, 3 * source_size AS cap FROM sizes),
weighted AS (SELECT *, rank % 3 + 1 AS weight FROM ranked),
filled AS (
  SELECT *, (cap::DOUBLE / weight) AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS each
  FROM weighted),
level AS (SELECT arg_min(each, (ratio, rank)) AS level FROM filled WHERE each * weight < cap),
targets AS (
  SELECT source, source_size,
    CASE WHEN level IS NULL THEN cap::DOUBLE ELSE least(level * weight, cap::DOUBLE) END AS target
  FROM filled CROSS JOIN level),
budgets AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS rounds
  FROM targets),
prefixed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix FROM docs)
SELECT doc_id, size, b.source_size, target,
  (rounds * size + greatest(0, least(size, budget - rounds * b.source_size - prefix)))::BIGINT AS taken
FROM prefixed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""

OP9 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
listed AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s FROM docs),
sized AS (SELECT doc_id, s, len(s)::BIGINT AS n FROM listed),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n - count(*) AS u, count(*) AS i
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 100 >= (a.n + b.n - count(*)) * 85),
reach AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT p.b, r.c FROM reach r JOIN pairs p ON p.a = r.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept FROM sized JOIN least ON id = doc_id
"""

OP10 = r"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""



def _op13(rounds: int = 6) -> str:
    """Every round is a table of assignments and one of moved entries."""
    near = """
a{k} AS MATERIALIZED (
  SELECT vec_id, part, x, entry, d FROM (
    SELECT p.vec_id, p.part, p.x, c.entry, list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d,
      row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY d, c.entry) AS n
    FROM parts p JOIN c{k} c ON p.part = c.part) WHERE n = 1),"""
    move = """
s{k} AS (
  SELECT part, entry, i, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL),
m{k} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{k} GROUP BY part, entry),
c{next} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON c.part = m.part AND c.entry = m.entry),"""
    steps = "".join(near.format(k=k) + move.format(k=k, next=k + 1) for k in range(rounds)) + near.format(k=rounds)
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id) - 1 AS entry
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, entry AS n, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS x FROM kept CROSS JOIN range(8) AS r(part)),
c0 AS MATERIALIZED (SELECT part, n AS entry, x AS c FROM parts WHERE n < 16),{steps}
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
spelled AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT k.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept k JOIN coded USING (vec_id) CROSS JOIN spelled
"""


OP13 = _op13()

SQL = {"op5_licenses": OP5, "op10_topk": OP10, "op9_neardup": OP9, "op6_mixing": OP6, "op13_codes": OP13}
