"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

JACCARD_JOIN = f"""
with recursive w as (
  select doc_id, {_SPACED.format("coalesce(text, '')")} as w from documents
), s as (
  select doc_id, case when len(w) = 0 then [] else
    list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, greatest(len(w) - 3, 1) + 1)]) end as s
  from w
), t as (
  select doc_id, unnest(s) as t from s
), c as (
  select x.doc_id as a, y.doc_id as b, count(*) as c from t x join t y on x.t = y.t and x.doc_id <> y.doc_id group by 1, 2
), links as (
  select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * c >= 85 * (len(x.s) + len(y.s) - c)
), reach(a, b) as (
  select doc_id, doc_id from s union select r.a, l.b from reach r join links l on r.b = l.a
)
select doc_id, len(s)::bigint as n_shingles, min(b) as component_id from s join reach on a = doc_id group by doc_id, s
"""

DECONTAMINATE = f"""
with recursive d as (
  select row_number() over () as r, doc_id, {_ALNUM.format("coalesce(text, '')")} as w from documents
), b as (
  select item_id, {_ALNUM.format("coalesce(text, '')")} as w from benchmark
), win as (
  select distinct item_id, len(w[i:i + 9]) as n, array_to_string(w[i:i + 9], ' ') as t
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
), lens as (
  select distinct n from win
), grams as (
  select r, n, i, array_to_string(w[i:i + n - 1], ' ') as t
  from (select r, n, w, unnest(range(1, len(w) - n + 2)) as i from d, lens)
), found as (
  select distinct r, i, n, item_id from grams join win using (n, t)
), hit as (
  select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + n)) as p from found) group by r
), its as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id::varchar as item_id from found where item_id is not null) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join its using (r)
"""

_B32 = "array_to_string([" + ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v[{g + 1}] >> {15 - 5 * i} & 31), 1)" for g in range(8) for i in range(4)) + "], '')"

WARC = f"""
with p as (
  select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, octet_length(b) as n, h, [('0x' || substr(h, 1 + 5 * i, 5))::bigint for i in range(8)] as v from p
), m as (
  select *, max(page_id) over (partition by h) as top from d
)
select page_id, n::bigint as payload_bytes, {_B32} as payload_digest,
       case when page_id is distinct from top then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from top then top end as refers_to
from m
"""

FILTER_AUDIT = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(w) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER)
         + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS INTEGER)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) + 16 * CAST(words.doc_id > min(words.doc_id) OVER (PARTITION BY text) AS INTEGER) AS mask
  FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id),
counts AS (SELECT part, mask, good, toxic, count(*) AS n FROM masks GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, l.letter, l.bit,
         coalesce((SELECT sum(p.bit) FROM letters p WHERE strpos(filter_order, p.letter) < step), 0) AS prior
  FROM orders, range(1, 6) r(step), letters l WHERE l.letter = substr(filter_order, CAST(step AS INTEGER), 1)),
told AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & CAST(prior + bit AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(prior AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(prior AS INTEGER) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(prior AS INTEGER) = 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & CAST(prior AS INTEGER) = 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM told
"""

_FIELDS = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "text"]


def _leaf_sql(fields):
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


def _levels_sql(name, base):
    """All nodes of binary trees whose leaves are the rows (tree, i, n, h) of ``base``."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, i, n, h FROM {base}
  UNION ALL
  SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, level, i // 2, n)"""


def _path_sql(name, leaves, nodes, offset):
    """Per row (doc_id, tree, i) of ``leaves``: the sibling of each level, R if it stands behind, L before, N if there is none."""
    return f"""{name} AS (
  SELECT l.doc_id, p.level + {offset} AS place, CASE WHEN s.h IS NULL THEN 'N' WHEN s.i > p.i THEN 'R' || s.h ELSE 'L' || s.h END AS step
  FROM {leaves} l JOIN {nodes} p ON p.tree = l.tree AND p.i = l.i >> p.level AND p.n > 1
  LEFT JOIN {nodes} s ON s.tree = p.tree AND s.level = p.level AND s.i = xor(p.i, 1))"""


MERKLE = f"""
WITH RECURSIVE crc_rows AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_rows),
rows AS (
  SELECT doc_id, {_leaf_sql(_FIELDS)} AS leaf,
         {_leaf_sql([*_FIELDS[:3], "CAST(n_chars + 1 AS VARCHAR)", "text"])} AS changed,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit,
         coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM documents, crc),
leaves AS (SELECT tree, i, n, leaf AS h FROM rows),
{_levels_sql("nodes", "leaves")},
subroots AS (SELECT tree AS lang, h FROM nodes WHERE n = 1),
tops AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n, h, lang FROM subroots),
{_levels_sql("top_nodes", "tops")},
{_path_sql("lower", "rows", "nodes", 0)},
placed AS (SELECT doc_id, 'all' AS tree, tops.i FROM rows JOIN tops ON tops.lang = rows.tree),
{_path_sql("upper", "placed", "top_nodes", 1000)},
proofs AS (SELECT doc_id, list(step ORDER BY place) AS steps FROM (SELECT * FROM lower UNION ALL SELECT * FROM upper) p GROUP BY doc_id),
told AS (
  SELECT r.doc_id, r.leaf, s.h AS subroot, (SELECT h FROM top_nodes WHERE n = 1) AS root,
         sha256(list_reduce(list_prepend('', coalesce(p.steps, [])), lambda a, x: a || x[2:])) AS proof_sha256,
         list_reduce(list_prepend(CASE WHEN hit THEN changed ELSE leaf END, coalesce(p.steps, [])),
                     lambda a, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || a WHEN 'R' THEN a || x[2:] ELSE a END)) AS folded_root
  FROM rows r
  JOIN subroots s ON s.lang = r.tree LEFT JOIN proofs p ON p.doc_id = r.doc_id)
SELECT *, folded_root = root AS verified FROM told
"""
