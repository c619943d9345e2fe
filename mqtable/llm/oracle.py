"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

from mqtable.llm import secrets
from mqtable.llm.sharding import HASH_BITS

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP5 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_WHITE}), {_UPPER}) AS key FROM l),
common AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
r AS (SELECT k.*, coalesce(k.doc_id < common.keeper, false) AS dropped FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""

_WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[^0-9a-z\\x80-\\x{{10FFFF}}]+'), lambda w: w <> '')"

OP8 = f"""
WITH i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS s
        FROM d CROSS JOIN (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (win, n)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""


OP11 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_UPPER}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS root, doc_id AS node FROM n UNION SELECT r.root, e.b FROM r JOIN e ON e.a = r.node),
c AS (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id,
  coalesce(c.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def _op4() -> str:
    kinds = secrets.STRONG + secrets.WEAK
    n = len(secrets.STRONG)
    names = [k[0] for k in kinds]

    def part(j: int, name: str, pattern: str, group: int, least: int) -> str:
        p = pattern.replace("'", "''")
        mixed = "AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')" if name == "opaque" else ""
        return f"""
SELECT doc_id, {j} AS kind, start, start + length(hit) AS "end" FROM (
  SELECT doc_id, hit, val, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) - length(hit) AS start
  FROM (SELECT doc_id, unnest(range(len(hits))) AS i, unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[:len(hits)]) AS gap
        FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS hits, regexp_extract_all(text, '{p}', {group}) AS vals,
                     regexp_split_to_array(text, '{p}') AS gaps FROM d)))
WHERE length(val) >= {least} {mixed}"""

    def count(which: tuple[str, ...]) -> str:
        ids = ", ".join(str(names.index(w)) for w in which)
        return (
            f"count(CASE WHEN kind IN ({ids}) THEN 1 END) OVER (PARTITION BY doc_id ORDER BY start "
            f"RANGE BETWEEN {secrets.REACH} PRECEDING AND {secrets.REACH} FOLLOWING)"
        )

    label = "['" + "', '".join(names) + "'][kind + 1] || ':' || start || ':' || \"end\""
    counts = ", ".join(f"count(*) FILTER (kind = {j}) AS n_{name}" for j, name in enumerate(names[:n]))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS ({' UNION ALL '.join(part(j, *k) for j, k in enumerate(kinds))}),
a AS (SELECT *,
  coalesce(max(CASE WHEN kind < {n} THEN "end" END) OVER (PARTITION BY doc_id ORDER BY start RANGE UNBOUNDED PRECEDING), -1) > start
  OR coalesce(min(CASE WHEN kind < {n} THEN start END) OVER (PARTITION BY doc_id ORDER BY start
     RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "end") < "end" AS inside FROM p),
l AS (SELECT *, {count(secrets.IDENTIFIERS)} AS ids, {count(secrets.SECRETS)} AS keys FROM a WHERE kind < {n} OR NOT inside),
f AS (SELECT doc_id, CAST(start AS BIGINT) AS start, kind, CAST("end" AS BIGINT) AS "end" FROM l
  WHERE kind < {n} OR (kind = {names.index('login')} AND keys > 0) OR (kind = {names.index('opaque')} AND ids > 0)
     OR (kind = {names.index('endpoint')} AND ids > 0 AND keys > 0)),
g AS (SELECT doc_id, {counts},
  string_agg({label}, ',' ORDER BY start, kind) FILTER (kind < {n}) AS base,
  string_agg({label}, ',' ORDER BY start, kind) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{x}, 0) AS n_{x}' for x in names[:n])},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


def _op10(limit: int) -> str:
    digits = HASH_BITS // 4
    return f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {digits}) AS BIGINT) AS h FROM documents),
b AS (SELECT depth, h >> ({HASH_BITS} - depth) AS prefix, sum(n_bytes) AS total, min(h) AS low, max(h) AS high
  FROM d, range(0, 32) AS r(depth) GROUP BY ALL),
s AS (SELECT d.doc_id, d.n_bytes, min(b.depth) AS depth, any_value(d.h) AS h
  FROM d, range(0, 32) AS r(depth) JOIN b ON b.depth = r.depth AND b.prefix = d.h >> ({HASH_BITS} - r.depth)
  WHERE b.total <= {limit} OR b.low = b.high GROUP BY ALL)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(depth AS INTEGER) AS depth,
  CASE WHEN depth = 0 THEN '-' ELSE lpad(bin(h >> CAST({HASH_BITS} - depth AS INTEGER)), CAST(depth AS INTEGER), '0') END AS shard
FROM s
"""


def oracle(shard_bytes: int) -> dict[str, str]:
    return {
        "op4_secrets": _op4(),
        "op5_line_dedup": OP5,
        "op8_decontamination": OP8,
        "op10_sharding": _op10(shard_bytes),
        "op11_minhash": OP11,
    }
