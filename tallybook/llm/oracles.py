"""DuckDB SQL for the queries that SQL can state, by plain pairs and windows."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_REACHED = """
reach(node, seen) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT reach.node, edges.b FROM reach JOIN edges ON edges.a = reach.seen
)
"""

NEAR_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
  WHERE list_dot_product(e, e) > 0
),
edges AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / x.norm / y.norm >= 0.98
),
nodes AS (SELECT vec_id AS node FROM embeddings),
{_REACHED},
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT node AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       node = component_id AS kept
FROM component LEFT JOIN counted ON a = node
"""

REPEATED_WINDOWS = f"""
WITH split AS (
  SELECT doc_id, ws, len(ws) AS n
  FROM (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents)
),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, n - 11)) AS i FROM split WHERE n >= 13)
),
firsts AS (SELECT g, min(doc_id) AS first_id FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k
        FROM windows JOIN firsts USING (g) WHERE first_id < doc_id)
),
words AS (SELECT doc_id, p, ws[p] AS w FROM (SELECT doc_id, ws, unnest(range(1, n + 1)) AS p FROM split)),
kept AS (
  SELECT words.doc_id, string_agg(w, ' ' ORDER BY words.p) AS t
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p
  WHERE gone.p IS NULL GROUP BY words.doc_id
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT split.doc_id, CAST(split.n AS BIGINT) AS n_words,
       CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN removed ON removed.doc_id = split.doc_id
LEFT JOIN kept ON kept.doc_id = split.doc_id
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

JACCARD_JOIN = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, ws, len(ws) AS n
  FROM (SELECT doc_id, {_WORDS.format(_LOWERED)} AS ws FROM documents)
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(n - 3, 2))) AS i FROM split WHERE n > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
),
linked AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
),
edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
nodes AS (SELECT doc_id AS node FROM documents),
{_REACHED},
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT node AS doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, component_id
FROM component LEFT JOIN sizes ON sizes.doc_id = node
"""

# A text gets one more mark for each control in it; controls do not overlap.
_MARKED = (
    r"len(regexp_extract_all({0}, '<\\*(?:\||s>|/s>|SYS>>|/SYS>>)|\[\\*(?:INST\]|/INST\])'))"
)
_PROBE = "'</s>[INST] ok [/INST]'"

CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', {_PROBE}), (-1, 1, 'assistant', {_PROBE})
),
piece AS (
  SELECT *, replace(replace(role, '%', '%25'), chr(10), '%0A') AS line FROM turns
),
sized AS (
  SELECT *, len('<|turn|>') + len(line) + {_MARKED.format("line")} + 1
            + len(text) + {_MARKED.format("text")} + len('<|end|>') + 1 AS chars
  FROM piece
),
said AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS all_text,
         coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss
  FROM sized GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(all_text) AS turns_sha256,
       CAST(len(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""

# Every document of a pattern goes through every order, step by step.
FILTER_AUDIT = f"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
),
failed AS (
  SELECT t.doc_id, part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
         CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 2 * len(t.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN t.doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM (SELECT *, {_WORDS.format("text")} AS ws FROM texts) t
  JOIN firsts ON firsts.text = t.text LEFT JOIN marks ON marks.doc_id = t.doc_id
),
patterns AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
         substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
walked AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails,
         contains(fails, letter) AS now,
         len(translate(fails, before, '')) < len(fails) AS gone
  FROM patterns, steps
),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(n) FILTER (WHERE NOT gone AND NOT now) AS kept,
         sum(n) FILTER (WHERE NOT gone AND now) AS removed,
         sum(n) FILTER (WHERE gone AND now) AS redundant,
         sum(n) FILTER (WHERE fails = letter) AS unique_fails,
         sum(n) FILTER (WHERE NOT gone AND now AND good) AS good_lost,
         sum(n) FILTER (WHERE NOT gone AND now AND toxic) AS toxic_lost
  FROM walked GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


def pivot_clusters(count: int = 40, dimension: int = 64, rounds: int = 5, prefix: str = "2:") -> str:
    """Every distance is measured in every round; a query of one step after the other."""
    steps = [f"""
whole AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(
           CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dimension}
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c
  FROM (SELECT sha256('{prefix}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM whole
        ORDER BY h, x LIMIT {count})
)"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, cluster := cluster)) AS best
  FROM (SELECT r, cluster, list_sum(list_transform(
                 list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM whole, c{i})
  GROUP BY r
)""")
        if i == rounds:
            break
        steps.append(f"""
s{i} AS (
  SELECT best.cluster AS cluster, k, sum(x[k]) AS s, count(*) AS n
  FROM a{i} JOIN whole USING (r), (SELECT unnest(range(1, {dimension} + 1)) AS k)
  GROUP BY ALL
),
m{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c
  FROM s{i} GROUP BY cluster
),
c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster)
)""")
    last = f"a{rounds}"
    return f"""
WITH {",".join(steps)}
SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN whole USING (r) JOIN c{rounds} ON c{rounds}.cluster = best.cluster
"""
