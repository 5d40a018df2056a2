"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from framecurate.llm.secrets import BASE, COMPLEMENTS, KINDS, SCOPE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secrets() -> str:
    names = [k for k, _, _ in KINDS]
    found = []
    for i, (_, pattern, rule) in enumerate(KINDS):
        sound = {"value": f"length(regexp_extract(hit, {_q(pattern)}, 2)) >= 6",
                 "mixed": "regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]')",
                 "": "true"}[rule]
        found.append(f"""
  SELECT r, {i} AS kind, nth, length(gap) AS gap, length(hit) AS size, {sound} AS sound FROM (
    SELECT r, unnest(range(1, len(m) + 1)) AS nth, unnest(m) AS hit, unnest(p[1:len(m)]) AS gap FROM (
      SELECT r, string_split_regex(text, {_q(pattern)}) AS p, regexp_extract_all(text, {_q(pattern)}, 0) AS m
      FROM d WHERE regexp_matches(text, {_q(pattern)})))""")
    pairs = " OR ".join(f"(w.kind = {names.index(w)} AND p.kind = {names.index(x)})"
                        for w, parts in COMPLEMENTS.items() for x in parts)
    listed = "[" + ", ".join(_q(n) for n in names) + "]"
    count = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{names[i]}" for i in range(BASE))
    none = ", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in names[:BASE])
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({' UNION ALL '.join(found)}),
placed AS (
  SELECT r, kind, size, sound, sum(gap + size) OVER (PARTITION BY r, kind ORDER BY nth) AS e FROM found),
spans AS (SELECT r, kind, CAST(e - size AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed WHERE sound),
told AS (
  SELECT * FROM spans WHERE kind < {BASE}
  UNION ALL
  SELECT * FROM spans w WHERE kind >= {BASE} AND EXISTS (
    SELECT 1 FROM spans p WHERE p.r = w.r AND ({pairs}) AND p.s <= w.e + {SCOPE} AND p.e >= w.s - {SCOPE}
      AND (p.s >= w.e OR p.e <= w.s))),
each AS (
  SELECT r, {count}, count(*) FILTER (kind >= {BASE}) AS n_linked,
    string_agg({listed}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < {BASE}) AS base,
    string_agg({listed}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS every
  FROM told GROUP BY r)
SELECT doc_id, {none}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans,
  coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN each USING (r)"""


def _mixing(powers: dict[str, float], keep: float, seed: int, sweeps: int) -> str:
    dims = list(powers)
    goals = ", ".join(f"""g_{d} AS (
  SELECT {d}, p / sum(p) OVER () AS goal_{d} FROM (
    SELECT {d}, CASE WHEN sum(t) > 0 THEN pow(sum(t), {p}) ELSE 0 END AS p FROM cells GROUP BY {d}))"""
                      for d, p in powers.items())
    joins = " ".join(f"JOIN g_{d} ON c.{d} IS NOT DISTINCT FROM g_{d}.{d}" for d in dims)
    steps, last = [], "start"
    for n in range(sweeps):
        for d in dims:
            steps.append(f"""s{n}_{d} AS (SELECT * REPLACE (CASE WHEN raked > 0
  THEN raked * goal_{d} * whole / sum(raked) OVER (PARTITION BY {d}) ELSE 0 END AS raked) FROM {last})""")
            last = f"s{n}_{d}"
    return f"""
WITH n AS (
  SELECT doc_id, text, source, lang,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x09-\\x0D\\x20]+')) AS BIGINT) AS tokens FROM documents),
d AS (
  SELECT *, CASE WHEN tokens = 0 THEN 'empty'
    WHEN regexp_matches(coalesce(text, ''), '(AKIA|password|api_key|https?://|@)') THEN 'technical'
    WHEN tokens < 100 THEN 'note' WHEN tokens < 1000 THEN 'article' ELSE 'book' END AS topic FROM n),
cells AS (SELECT {', '.join(dims)}, CAST(sum(tokens) AS DOUBLE) AS t FROM d GROUP BY ALL),
{goals},
start AS (SELECT c.*, {', '.join(f'goal_{d}' for d in dims)}, t AS raked, sum(t) OVER () AS whole FROM cells c {joins}),
{', '.join(steps)},
ranked AS (
  SELECT *, sum(t) OVER w AS full_t, sum(raked) OVER () - sum(raked) OVER w AS open_r, {keep} * whole AS budget
  FROM {last} WHERE t > 0 AND raked > 0 WINDOW w AS (ORDER BY t / raked, {', '.join(dims)} ROWS UNBOUNDED PRECEDING)),
factors AS (
  SELECT (budget - coalesce(lag(full_t) OVER o, 0)) / (open_r + raked) AS f, t / raked AS until,
    row_number() OVER o AS nth FROM ranked WINDOW o AS (ORDER BY t / raked, {', '.join(dims)})),
factor AS (SELECT coalesce((SELECT f FROM factors WHERE f < until ORDER BY nth LIMIT 1),
                           (SELECT max(until) FROM factors)) AS f),
of AS (SELECT {', '.join(dims)}, CASE WHEN t > 0 THEN raked / t ELSE 0 END AS ratio FROM {last})
SELECT doc_id, d.source, d.lang, d.topic, tokens, round(CASE WHEN tokens > 0 THEN ratio ELSE 0 END, 6) AS weight,
  round(CASE WHEN tokens > 0 THEN least(1, f * ratio) ELSE 0 END, 6) AS probability,
  CAST('0x' || md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, ''))))[1:13] AS BIGINT)
    / CAST(1::BIGINT << 52 AS DOUBLE) < CASE WHEN tokens > 0 THEN least(1, f * ratio) ELSE 0 END AS selected
FROM d JOIN of ON {' AND '.join(f'd.{x} IS NOT DISTINCT FROM of.{x}' for x in dims)}, factor"""


_BACKOFF = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS text FROM documents),
words AS (
  SELECT r, unnest(range(1, len(m) + 1)) AS nth, unnest(m) AS w FROM (
    SELECT r, regexp_extract_all(text, '[^\x09-\x0D\x20]+') AS m FROM d)),
along AS (SELECT r, w, lag(w) OVER (PARTITION BY r ORDER BY nth) AS h FROM words),
c1 AS (SELECT w, count(*) AS n1 FROM words GROUP BY w),
c2 AS (SELECT h, w, count(*) AS n2 FROM along WHERE h IS NOT NULL GROUP BY h, w),
whole AS (SELECT count(*) AS n FROM words),
scored AS (
  SELECT r, CASE WHEN a.h IS NULL THEN ln(c.n1 / n)
                 WHEN n2 >= 2 THEN ln(CAST(n2 AS DOUBLE) / p.n1)
                 ELSE ln(0.4 * c.n1 / n) END AS s
  FROM along a JOIN c1 c USING (w) LEFT JOIN c2 USING (h, w) LEFT JOIN c1 p ON p.w = a.h, whole),
sums AS (SELECT r, count(*) AS k, sum(s) AS s FROM scored GROUP BY r)
SELECT doc_id, coalesce(k, 0) AS n_tokens, round(coalesce(s, 0), 4) AS log_score,
  round(s / k, 6) AS log_score_per_token
FROM d LEFT JOIN sums USING (r)"""


_RANKED = r"""
WITH found AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, * FROM documents)),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY r),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, whole GROUP BY term, docs),
asked AS (
  SELECT item_id, item, term, count(*) AS q FROM (
    SELECT item_id, text AS item, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (
  SELECT item_id, item, r, doc_id,
    CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), whole GROUP BY item_id, item, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, item ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


def oracle_sql(mix_powers: dict[str, float]) -> dict[str, str]:
    return {
        "op4_source_mixing": _mixing(mix_powers, 0.5, 11, 10),
        "op7_secret_scan": _secrets(),
        "op8_backoff_scores": _BACKOFF,
        "op11_ranked_search": _RANKED,
        "op12_exact_top_k": _TOP_K,
    }
