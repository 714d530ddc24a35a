"""DuckDB SQL for the operators that SQL can express on whole tables."""

from pulsegrid.llm.jaccard import K, PERCENT
from pulsegrid.llm.phrases import SIZE

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Written out here and not taken from the operator, so that a wrong pattern there shows: kind, pattern, group of the value.
_KINDS = (
    (0, r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2),
    (1, r"AKIA[A-Z0-9]+", 0),
    (2, r"[0-9a-f]+", 0),
    (3, r"[A-Za-z0-9+/_.=-]+", 0),
)


def _kind(number: int, pattern: str, group: int) -> str:
    pattern = pattern.replace("'", "''")
    return rf"""
    SELECT rid, {number} AS kind, generate_subscripts(m, 1) AS i, unnest(m) AS match, unnest(v) AS value,
           unnest(list_slice(g, 1, len(m))) AS gap
    FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v,
                 string_split_regex(t, '{pattern}') AS g FROM docs)"""


SECRETS = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents
), raw AS ({" UNION ALL ".join(_kind(*k) for k in _KINDS)}
), placed AS (
  SELECT rid, kind, value, length(match) AS n,
         sum(length(gap) + length(match)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop
  FROM raw
), bare AS (
  SELECT rid, kind, value, stop - n AS start, stop, regexp_replace(value, '^[+/_.=-]+', '') AS tail,
         regexp_replace(value, '^[+/_.=-]+|[+/_.=-]+$', '', 'g') AS name
  FROM placed WHERE length(value) >= CASE kind WHEN 1 THEN 18 WHEN 2 THEN 16 ELSE 12 END
), cut AS (
  SELECT rid, kind, name, CASE WHEN kind = 3 THEN name ELSE value END AS value,
         CAST(CASE WHEN kind = 3 THEN start + length(value) - length(tail) ELSE start END AS BIGINT) AS start,
         CAST(CASE WHEN kind = 3 THEN start + length(value) - length(tail) + length(name) ELSE stop END AS BIGINT) AS stop
  FROM bare WHERE kind < 3 OR length(name) >= 12
), cand AS (
  SELECT *, regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
         AND len(list_distinct(string_split(value, ''))) >= 8 AS live
  FROM cut
), usable AS (SELECT * FROM cand WHERE kind < 3 OR live
), base AS (SELECT * FROM usable WHERE kind < 3
), holders AS (
  SELECT name, count(DISTINCT owner) >= 5 AND count(DISTINCT (owner, coalesce(CAST(doc_id AS VARCHAR), ''))) >= 5 AS widely,
         bool_or(kind = 0) AS assigned
  FROM base JOIN docs USING (rid) GROUP BY name
), owned AS (
  SELECT w.* FROM usable w JOIN holders h USING (name)
  WHERE w.kind = 3 AND h.assigned AND NOT h.widely
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.start < w.stop AND w.start < b.stop)
), named AS (
  SELECT rid, kind, start, stop, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS s
  FROM (SELECT * FROM base UNION ALL SELECT * FROM owned)
), per AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_owned,
         string_agg(s, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
         string_agg(s, ',' ORDER BY start, kind, stop) AS spans
  FROM named GROUP BY rid
), judged AS (
  SELECT rid, count(*) FILTER (NOT h.widely AND b.live) AS n_live, count(*) FILTER (h.widely) AS n_example
  FROM base b JOIN holders h USING (name) GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN per USING (rid) LEFT JOIN judged USING (rid)
"""

PHRASES = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), windows AS MATERIALIZED (
  SELECT rid, doc_id, i, sha256(array_to_string(list_slice(w, i, i + {SIZE - 1}), ' ')) AS h
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {SIZE - 2})) AS i FROM docs)
), firsts AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + {SIZE})) AS p FROM windows JOIN firsts USING (h) WHERE d < doc_id
), words AS (SELECT rid, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM docs
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

JACCARD = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w
  FROM documents
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {K - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {K - 2}, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)
), ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (SELECT a AS node, a AS stop FROM ways UNION SELECT node, b FROM reach JOIN ways ON a = stop
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(c.m, d.doc_id), d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT node, min(stop) AS m FROM reach GROUP BY node) c ON c.node = d.doc_id
"""
