"""DuckDB SQL of the operators that SQL can express, over the driver's tables."""

from __future__ import annotations

from steward.llm.quality_rules import MIN_GROUP, RATIOS


def _fence(metric: str) -> str:
    return f"max(CASE WHEN metric = '{metric}' THEN fence END) AS {metric}_fence"


def _corridor(end: str) -> str:
    return "CASE metric " + " ".join(f"WHEN '{r.name}' THEN {getattr(r, end)}" for r in RATIOS) + " END"


def _quartiles(level: str, keys: list[str]) -> str:
    by = "".join(f"{k}, " for k in keys)
    return f"""{level} AS (
    SELECT {by}metric, max(n_all) AS {level}_rows, min(CASE WHEN 4 * upto >= n_all THEN edge END) AS {level}_q1,
           min(CASE WHEN 4 * upto >= 3 * n_all THEN edge END) AS {level}_q3
    FROM (SELECT {by}metric, edge, sum(n) OVER (PARTITION BY {by}metric ORDER BY edge) AS upto,
                 sum(n) OVER (PARTITION BY {by}metric) AS n_all
          FROM (SELECT {by}metric, edge, sum(n) AS n FROM sketch GROUP BY {by}metric, edge))
    GROUP BY {by}metric)"""


_VALUES = ", ".join(
    f"CASE WHEN {r.base} > 0 THEN (1000 * {r.count}) // {r.base} ELSE 0 END AS {r.name}_value" for r in RATIOS
)
_SKETCH = " UNION ALL ".join(
    f"SELECT lang, source, '{r.name}' AS metric, ({r.name}_value >> greatest(length(bin({r.name}_value)) - 10, 0)) "
    f"<< greatest(length(bin({r.name}_value)) - 10, 0) AS edge, count(*) AS n FROM valued WHERE NOT base_failed GROUP BY ALL"
    for r in RATIOS
)
_WITHIN = " AND ".join(f"coalesce({r.name}_value <= {r.name}_fence, true)" for r in RATIOS)

QUALITY_RULES = f"""
WITH split AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
    FROM documents),
positions AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) >= 3),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM positions),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
counted AS (
    SELECT s.doc_id, lang, source, len(w)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
           (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
valued AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_VALUES} FROM counted),
sketch AS ({_SKETCH}),
{_quartiles("own", ["lang", "source"])},
{_quartiles("wide", ["lang"])},
{_quartiles("every", [])},
fenced AS (
    SELECT own.lang, own.source, metric,
           least(greatest(CASE WHEN own_rows >= {MIN_GROUP} THEN 4 * own_q3 - 3 * own_q1
                               WHEN wide_rows >= {MIN_GROUP} THEN 4 * wide_q3 - 3 * wide_q1
                               ELSE 4 * every_q3 - 3 * every_q1 END, {_corridor("lowest_fence")}),
                 {_corridor("highest_fence")}) AS fence
    FROM own JOIN wide w USING (metric) JOIN every e USING (metric) WHERE own.lang IS NOT DISTINCT FROM w.lang),
limits AS (
    SELECT lang, source, {", ".join(_fence(r.name) for r in RATIOS)} FROM fenced GROUP BY lang, source)
SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_WITHIN} AS kept
FROM valued v LEFT JOIN limits f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
"""

_RULED = """(SELECT {key}, verdict, rule FROM {rows}, (VALUES ('allow', 'org', '/', 'org/'),
      ('block', 'example.org', '/es/', 'example.org/es/'), ('block', 'example.org', '/en/1', 'example.org/en/1'),
      ('allow', 'com', '/fr/', 'com/fr/'), ('block', 'com', '/de/', 'com/de/')) AS r(verdict, rule_host, rule_path, rule)
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY length(rule) DESC) = 1)"""
_HOST = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_LINKS = (
    "'(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"'']?canonical\\b[^>]*\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)'",
    "'(?is)<link\\b[^>]*\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)[^>]*\\brel\\s*=\\s*[\"'']?canonical\\b'",
    "'(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"'']?refresh\\b[^>]*\\burl\\s*=\\s*[\"'']?([^\"''\\s>]+)'",
)
_NODE = (
    "regexp_replace(" + _HOST + ", ':(80|443)$', '') || regexp_replace(" + _PATH + ", '/$', '') || "
    "coalesce('?' || nullif(list_aggregate(list_filter(string_split(regexp_extract({0}, '(?s)^[^?#]*\\?([^#]*)', 1), '&'), "
    "lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=|$)')), 'string_agg', '&'), ''), '')"
)

#: Links are taken as absolute or rooted here; the tables have no others.
URL_FILTERS = f"""
WITH RECURSIVE parts AS (
    SELECT page_id, url, html, coalesce({_HOST.format("url")}, '') AS host, coalesce({_PATH.format("url")}, '') AS path
    FROM pages),
ruled AS {_RULED.format(key="page_id", rows="parts")},
links AS ({" UNION ALL ".join(f"SELECT url, host, regexp_extract(html, {x}, 1) AS link FROM parts" for x in _LINKS)}),
edges AS (
    SELECT url AS source, CASE WHEN starts_with(link, '/') THEN 'http://' || host || link ELSE link END AS target
    FROM links WHERE link <> '' AND contains(url, '://')),
ends AS (SELECT source AS url FROM edges UNION SELECT target FROM edges),
end_parts AS (SELECT url, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_NODE.format("url")} AS node FROM ends),
end_ruled AS (SELECT node, verdict FROM end_parts JOIN {_RULED.format(key="url", rows="end_parts")} USING (url)),
arcs AS (
    SELECT {_NODE.format("source")} AS a, {_NODE.format("target")} AS b FROM edges
    UNION SELECT {_NODE.format("target")}, {_NODE.format("source")} FROM edges),
reach AS (SELECT a, b FROM arcs UNION SELECT reach.a, arcs.b FROM reach JOIN arcs ON reach.b = arcs.a),
aliases AS (SELECT a AS node, min(verdict) AS alias_verdict FROM reach JOIN end_ruled ON reach.b = end_ruled.node GROUP BY a)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, s.alias_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN ruled r USING (page_id) LEFT JOIN aliases s ON {_NODE.format("p.url")} = s.node
"""

TOP_K = """
WITH vecs AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
    FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

NEAR_DUPLICATES = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS same FROM grams GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 5 * c >= 4 * (s.n + t.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(e.same_set_id, d.doc_id) AS same_set_id,
       coalesce(k.n_links, 0) AS n_links
FROM documents d LEFT JOIN (SELECT a, min(b) AS class_id FROM reach GROUP BY a) c ON c.a = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT same, min(doc_id) AS same_set_id FROM sizes GROUP BY same) e ON e.same = s.same
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) k ON k.a = d.doc_id
"""
