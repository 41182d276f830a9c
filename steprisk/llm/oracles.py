"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from steprisk.llm.codes import ENTRIES, PARTS, ROUNDS, SCALE
from steprisk.llm.trie import FAMILY, HANDED

# The reversed polynomial of CRC-32.
_POLYNOMIAL = 3988292384

PREFIX_TRIE = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_POLYNOMIAL}) ELSE c >> 1 END)) AS crc),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS number
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS donor,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda sign: ascii(sign)::BIGINT)),
      lambda c, byte: xor(c >> 8, crc[(xor(c, byte) & 255) + 1])), 4294967295) % {HANDED} AS handed
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.number, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.number <= c.handed
  UNION ALL
  SELECT c.conv_id, 1, t.number, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.number > c.handed),
sequences AS (
  SELECT c.conv_id,
    coalesce(list(md5(length(r.role) || ':' || r.role || r.text) ORDER BY r.own, r.number) FILTER (WHERE r.own IS NOT NULL), []) AS marks,
    coalesce(list(strlen(r.text) ORDER BY r.own, r.number) FILTER (WHERE r.own IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
members AS (
  SELECT conv_id, depth, array_to_string(marks[1:depth], '') AS node, array_to_string(marks, '') AS whole,
    CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END AS size
  FROM (SELECT *, unnest(range(len(marks) + 1)) AS depth FROM sequences)),
nodes AS (
  SELECT depth, node, left(node, 32 * (depth - 1)) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE node = whole), '')) AS ends_sha256
  FROM members GROUP BY depth, node),
children AS (SELECT above, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
leaves AS (
  SELECT m.node, count(DISTINCT m.whole) AS n_leaves FROM members m
  WHERE m.whole NOT IN (SELECT above FROM children) GROUP BY m.node),
below AS (
  SELECT node, sum(saves) AS saved_tokens FROM (
    SELECT DISTINCT u.node, v.node AS inner_node, (n.n_convs - 1) * n.size AS saves
    FROM members u JOIN members v ON v.conv_id = u.conv_id AND v.depth >= u.depth JOIN nodes n ON n.node = v.node)
  GROUP BY node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, l.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.above LEFT JOIN children c ON c.above = n.node
JOIN leaves l ON l.node = n.node JOIN below b ON b.node = n.node
"""


def _codes() -> str:
    """One pair of steps (assignment, update) per round, and a last assignment."""
    steps = [
        f"""vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS whole
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT row, position, whole[position * len(whole) // {PARTS} + 1 : (position + 1) * len(whole) // {PARTS}] AS part
  FROM vectors, range({PARTS}) AS t(position)),
book0 AS (SELECT position, row - 1 AS entry, part AS value FROM parts WHERE row <= {ENTRIES})"""
    ]
    for turn in range(ROUNDS + 1):
        steps.append(f"""near{turn} AS (
  SELECT row, position, min(struct_pack(away := away, entry := entry)) AS best FROM (
    SELECT p.row, p.position, b.entry,
      list_sum(list_transform(list_zip(p.part, b.value), lambda pair: (pair[1] - pair[2]) * (pair[1] - pair[2])))::BIGINT AS away
    FROM parts p JOIN book{turn} b ON b.position = p.position) GROUP BY row, position)""")
        if turn < ROUNDS:
            steps.append(f"""book{turn + 1} AS (
  SELECT b.position, b.entry, coalesce(m.value, b.value) AS value FROM book{turn} b LEFT JOIN (
    SELECT position, entry, list(((total - ((total % rows) + rows) % rows) // rows)::BIGINT ORDER BY place) AS value FROM (
      SELECT n.position, n.best.entry AS entry, place, sum(p.part[place])::BIGINT AS total, count(*) AS rows
      FROM near{turn} n JOIN parts p ON p.row = n.row AND p.position = n.position, range(1, 1 + len(p.part)) AS t(place)
      GROUP BY n.position, n.best.entry, place) GROUP BY position, entry
  ) m ON m.position = b.position AND m.entry = b.entry)""")
    last = f"""coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY position) AS code, sum(best.away)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY row),
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(value, lambda x: x::VARCHAR), ','), ',' ORDER BY position, entry)) AS codebooks_sha256
  FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM vectors JOIN coded USING (row), books"""
    return "WITH " + ",\n".join([*steps, last])


ORACLES: dict[str, str] = {"op12_prefix_trie": PREFIX_TRIE, "op13_codes": _codes()}
