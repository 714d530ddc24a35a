"""DuckDB SQL for the operators on conversations and for hard negatives, by plain definitions."""

#: CRC-32 of a decimal number: the table of the reversed polynomial 0xEDB88320, then one step a digit.
TRIE = """
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), digits AS (
  SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS d
  FROM turns
), convs AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(crc, 4294967295) % 9 AS h
  FROM (SELECT conv_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), d),
          lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])) AS crc
        FROM digits, crc_table)
), placed AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), items AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
         sha256(length(role) || ':' || role || text) AS item, strlen(text) AS bytes
  FROM placed
), steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS depth, '' AS node, CAST(NULL AS VARCHAR) AS above, CAST(0 AS BIGINT) AS bytes
  FROM convs
  UNION ALL
  SELECT s.conv_id, s.depth + 1, sha256(s.node || i.item), s.node, i.bytes
  FROM steps s JOIN items i ON i.conv_id = s.conv_id AND i.depth = s.depth + 1
), last AS (SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id
), ends AS (
  SELECT node, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM steps JOIN last USING (conv_id, depth) GROUP BY node
), nodes AS MATERIALIZED (
  SELECT node, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n,
         (count(*) - 1) * any_value(bytes) AS saved
  FROM steps GROUP BY node
), children AS (SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above
), upward AS (
  SELECT node, node AS top, above FROM nodes
  UNION ALL
  SELECT u.node, n.node, n.above FROM upward u JOIN nodes n ON n.node = u.above
), totals AS (
  SELECT u.top AS node, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM upward u JOIN nodes n ON n.node = u.node LEFT JOIN children c ON c.node = u.node GROUP BY u.top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
       t.leaves AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = n.above LEFT JOIN children c ON c.node = n.node
LEFT JOIN ends e ON e.node = n.node
"""

_ESCAPED = r"""regexp_replace({}, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|\+>|unk>|pad>|(?:image|audio|document):[0-9]+>)',
                              '\1\\\2\3', 'g')"""

CHATS = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length('<s>' || {_ESCAPED.format("role")} || '[INST]' || {_ESCAPED.format("text")} || '[/INST]</s>'))
         AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM turns GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH rows AS MATERIALIZED (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.id AS anchor, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.id % 100 = 0 AND b.id <> a.id
), positives AS (
  SELECT anchor, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
), found AS (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 10
"""
