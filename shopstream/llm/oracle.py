"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, i, p[i] AS line,
                 {_LOWER.format("trim(p[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
          FROM parts, LATERAL unnest(range(1, len(p) + 1)) AS t(i)),
repeated AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
             GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.doc_id, l.i, l.line, coalesce(l.doc_id <> r.keeper, false) AS gone
           FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = "[x for x in regexp_split_to_array({0}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']".format(_LOWER.format("coalesce(text, '')"))

OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, LATERAL unnest(range(1, len(w) - 3)) AS t(i)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM b, LATERAL unnest(range(1, len(w) - 3)) AS t(i)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared / n_shingles >= 0.8
"""



def _op11(clusters: int = 40, rounds: int = 5) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT r, min([d, c]) AS best FROM (
    SELECT r, c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c{k}.v[i]) * (kept.v[i] - c{k}.v[i])))::BIGINT AS d
    FROM kept, c{k}) GROUP BY r)""")
        if k < rounds:
            steps.append(f"""
s{k} AS MATERIALIZED (SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM (
    SELECT best[2] AS c, v, unnest(range(1, 65)) AS i FROM a{k} JOIN kept USING (r)) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (SELECT c{k}.c, coalesce(m.v, c{k}.v) AS v FROM c{k} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{k} GROUP BY c) m USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND coalesce(isfinite(x), false)))),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('2:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {clusters})),{",".join(steps)},
f AS (SELECT vec_id, best[2] AS cluster, best[1] AS distance FROM a{rounds} JOIN kept USING (r))
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM f JOIN c{rounds} ON c{rounds}.c = f.cluster
"""


def _op12(levels: int = 4) -> str:
    def segment(level):
        if level > levels:
            return "NULL::VARCHAR"
        parts = "string_split(shape, '/')"
        if level == levels:
            return f"CASE WHEN len({parts}) >= {levels} THEN array_to_string({parts}[{levels}:], '/') END"
        return f"{parts}[{level}]"

    steps = []
    for k in range(1, levels + 1):
        steps.append(f"""
f{k} AS MATERIALIZED (SELECT host, node, seg, sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS labelled, sum(bad)::BIGINT AS bad,
        sum(CASE WHEN nxt IS NULL THEN n ELSE 0 END)::BIGINT AS ends, sum(CASE WHEN starts_with(nxt, '{{') THEN n ELSE 0 END)::BIGINT AS varies
    FROM (SELECT *, {segment(k)} AS seg, {segment(k + 1)} AS nxt FROM t{k - 1}) WHERE seg IS NOT NULL GROUP BY host, node, seg),
k{k} AS (SELECT *, labelled > 0 AS known FROM (SELECT *, sum(n) OVER (PARTITION BY host, node) AS total FROM f{k}) WHERE n >= 5 AND n * 50 >= total),
l{k} AS (SELECT *, lag(n) OVER w AS n0, lag(labelled) OVER w AS l0, lag(bad) OVER w AS b0, lag(ends) OVER w AS e0, lag(varies) OVER w AS v0,
        row_number() OVER w AS place FROM k{k}
    WINDOW w AS (PARTITION BY host, node, known ORDER BY bad / nullif(labelled, 0) NULLS FIRST, ends / n, varies / n, seg)),
r{k} AS (SELECT *, sum(CASE WHEN coalesce(
        power(bad::DOUBLE * l0 - b0::DOUBLE * labelled, 2) * (labelled + l0)::DOUBLE
            <= 3.84::DOUBLE * labelled * l0 * (bad + b0) * (labelled + l0 - bad - b0)
        AND abs(ends / n - e0 / n0) + abs(varies / n - v0 / n0) + abs((n - ends - varies) / n - (n0 - e0 - v0) / n0) <= 0.5::DOUBLE, false)
        THEN 0 ELSE 1 END) OVER (PARTITION BY host, node, known ORDER BY place) AS run FROM l{k}),
g{k} AS (SELECT host, node, known, run, CASE WHEN count(*) = 1 THEN min(seg) ELSE '{{' || string_agg(seg, '|' ORDER BY seg) || '}}' END AS branch
    FROM r{k} GROUP BY host, node, known, run),
t{k} AS MATERIALIZED (SELECT t.host, t.shape, t.n, t.labelled, t.bad,
        CASE WHEN t.seg IS NULL THEN t.node ELSE t.node || '/' || coalesce(g.branch, '*') END AS node
    FROM (SELECT *, {segment(k)} AS seg FROM t{k - 1}) t LEFT JOIN r{k} r ON t.host = r.host AND t.node = r.node AND t.seg = r.seg
    LEFT JOIN g{k} g ON r.host = g.host AND r.node = g.node AND r.known = g.known AND r.run = g.run)""")
    of_host = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    cases = [("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("net/", "block")]
    fits = [(of_host.format(rule[:rule.index("/")], rule[rule.index("/"):]), rule, verdict) for rule, verdict in cases]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
WITH p AS (SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '://([^/?#]*)([^?#]*)', 1)")}, '') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
u AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS by_rule,
        array_to_string(list_transform(string_split(substr(path, 2), '/'), lambda s:
            CASE WHEN regexp_matches(s, '^[0-9]+([.][A-Za-z]+)?$') THEN regexp_replace(s, '^[0-9]+([.][A-Za-z]+)?$', '{{n}}\\1')
                 WHEN length(s) >= 8 AND regexp_matches(s, '^[0-9A-Fa-f-]*[0-9][0-9A-Fa-f-]*$') THEN '{{id}}' ELSE s END), '/') AS shape FROM p),
t0 AS MATERIALIZED (SELECT host, shape, '' AS node, count(*) AS n, count(by_rule) AS labelled, count(*) FILTER (WHERE by_rule = 'block') AS bad
    FROM u GROUP BY host, shape),{",".join(steps)},
q AS (SELECT host, node, (sum(bad)::DOUBLE + 0.8::DOUBLE) / (sum(labelled)::DOUBLE + 4.0::DOUBLE) AS purity FROM t{levels} GROUP BY host, node)
SELECT page_id, u.host, path, rule, coalesce(by_rule, CASE WHEN purity >= 0.5::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, u.host || t.node AS template
FROM u JOIN t{levels} t ON u.host = t.host AND u.shape = t.shape JOIN q ON q.host = t.host AND q.node = t.node
"""


OP11, OP12 = _op11(), _op12()

ORACLE_SQL = {"op8_line_dedup": OP8, "op10_benchmark_decontamination": OP10, "op11_centroid_clustering": OP11, "op12_url_filter": OP12}
