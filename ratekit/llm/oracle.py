"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

from . import decontaminate as DC
from . import host_quality as HQ
from . import lexical_search as LS
from . import minhash_dedup as MD
from . import slot_sharding as SS
from . import url_equivalence as UE

ORACLE_SQL: dict[str, str] = {}

_LOW, _HIGH = HQ.STRENGTH

ORACLE_SQL["op2_host_quality"] = rf"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {HQ.WINDOW - 1}], ' ') AS g
  FROM d, unnest(range(1, len(w) - {HQ.WINDOW - 2})) t(i)),
twice AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + {HQ.WINDOW})) AS p FROM windows JOIN twice USING (doc_id, g))
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (
  SELECT *, n_words < {HQ.MIN_WORDS} OR 100 * n_repeat_words > {HQ.MAX_REPEAT_PCT} * n_words AS base_failed
  FROM m),
hosts AS (
  SELECT host, count(*) AS n, sum(base_failed::INT)::BIGINT AS f FROM b WHERE host IS NOT NULL GROUP BY host),
mean AS (SELECT sum(f) / sum(n)::DOUBLE AS mu FROM hosts),
spread AS (SELECT sum(n * pow(f / n::DOUBLE - mu, 2)) / sum(n) AS v FROM hosts, mean),
prior AS (
  SELECT mu, CASE WHEN v <= 0 THEN {_HIGH}
                  ELSE least(greatest(mu * (1 - mu) / v - 1, {_LOW}), {_HIGH}) END AS k
  FROM mean, spread),
verdicts AS (SELECT host, (f + mu * k) / (n + k) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rate > {HQ.MAX_RATE}, false) AS kept,
       host, round(rate, 6) AS host_rate, coalesce(rate > {HQ.MAX_RATE}, false) AS host_rejected
FROM b LEFT JOIN verdicts USING (host)
"""

ORACLE_SQL["op4_minhash_dedup"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n, list(g ORDER BY g) AS gs FROM s GROUP BY doc_id),
c AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY gs) AS class_id FROM n),
cs AS (SELECT s.* FROM s JOIN c USING (doc_id) WHERE doc_id = class_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM cs x JOIN cs y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b
  WHERE 100 * k >= {MD.THRESHOLD_PCT} * (x.n + y.n - k)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT class_id AS a, class_id AS b FROM c
  UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a),
label AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(c.class_id, d.doc_id) AS class_id,
       coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN label ON label.a = c.class_id
"""

_ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL["op6_decontaminate"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII_LOWER}),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {DC.WINDOW}) AS k,
         array_to_string(w[i:i + least(len(w), {DC.WINDOW}) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - {DC.WINDOW}, 0) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
own AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, len(w) - k + 2)) t(i)),
hits AS (SELECT doc_id, i, k, item_id FROM own JOIN windows USING (k, g)),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {DC.HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op8_slot_sharding"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + {SS.OVERHEAD} AS size,
         xor(list_reduce(list_prepend(4294967295, list_transform(
           regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
         ('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))), 8))::BIGINT
           % {SS.SLOTS} AS vslot
  FROM documents, crc),
slots AS (SELECT vslot, sum(size)::BIGINT AS bytes, count(*) AS n FROM d GROUP BY vslot),
ranked AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, vslot) AS rn FROM slots),
lpt(rn, loads, shard) AS (
  SELECT 0::BIGINT, list_transform(range(24), lambda x: 0::BIGINT), 0
  UNION ALL
  SELECT s.rn, list_transform(l.loads, lambda x, i:
           CASE WHEN i = list_position(l.loads, list_min(l.loads)) THEN x + s.bytes * 100000 + 1 ELSE x END),
         list_position(l.loads, list_min(l.loads))::INT - 1
  FROM lpt l JOIN ranked s ON s.rn = l.rn + 1),
placed AS (
  SELECT vslot, shard, coalesce(sum(n) OVER (PARTITION BY shard ORDER BY vslot
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM ranked JOIN lpt USING (rn))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INT AS shard,
       (first + row_number() OVER (PARTITION BY vslot ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT
         AS slot,
       NULL::INT AS grown_shard, vslot::INT AS virtual_slot
FROM d JOIN placed USING (vslot)
"""

_HOST = "regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)"
_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
          ("allow", "com", "/fr/"), ("block", "com", "/de/")]
_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in _RULES)
_TRACKING = "^(" + "|".join(UE.TRACKING) + ")(=|$)"


def _fitting(rows: str, key: str) -> str:
    """For each ``key`` of ``rows`` (with host and path) its longest fitting rule."""
    return f"""SELECT {key}, arg_max(rh || rp, len(rh || rp)) AS rule, arg_max(v, len(rh || rp)) AS verdict
  FROM {rows}, (VALUES {_RULE_ROWS}) r(v, rh, rp)
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY {key}"""


ORACLE_SQL["op5_url_equivalence"] = rf"""
WITH RECURSIVE links AS (
  SELECT url, unnest(list_filter([
    regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(html, '(?is)<link\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)[^>]*\brel\s*=\s*["'']?canonical\b', 1),
    regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*?\burl\s*=\s*["'']?([^"''\s>]+)',
                   1)], lambda t: t <> '')) AS t
  FROM pages WHERE url IS NOT NULL),
targets AS (
  SELECT url AS a, CASE WHEN contains(t, '://') THEN t
      WHEN starts_with(t, '//') THEN regexp_extract(url, '^([^:/?#]*:)//', 1) || t
      WHEN starts_with(t, '/') THEN regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1) || t
      ELSE regexp_extract(url, '^([^:/?#]*://[^/?#]*)', 1)
           || regexp_replace('/' || regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '^/', ''), '[^/]*$', '')
           || t END AS b
  FROM (SELECT DISTINCT url, replace(t, '&amp;', '&') AS t FROM links)),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT b FROM targets),
parts AS (
  SELECT url, translate({_HOST}, {_ASCII_LOWER}) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
         list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
                     lambda p: p <> '' AND NOT regexp_matches(p, '{_TRACKING}')) AS params
  FROM urls),
plain AS (
  SELECT url AS a, '://' || regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
           || regexp_replace(path, '/+$', '')
           || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS b
  FROM parts WHERE regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') <> ''),
edges AS (SELECT a, b FROM targets UNION SELECT a, b FROM plain),
either AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
  SELECT a, a AS b FROM either UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a),
label AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
nodes AS (
  SELECT node, component, translate(regexp_extract(node, '://([^/?#]*)', 1), {_ASCII_LOWER}) AS host,
         regexp_extract(node, '://[^/?#]*([^?#]*)', 1) AS path FROM label),
own AS ({_fitting('nodes', 'node')}),
classes AS (
  SELECT component, bool_or(coalesce(verdict = 'block', false)) AND NOT bool_or(coalesce(verdict = 'allow', false))
           AS blocked
  FROM nodes LEFT JOIN own USING (node) GROUP BY component),
p AS (
  SELECT page_id, url, translate({_HOST}, {_ASCII_LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS ({_fitting('p', 'page_id')})
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN coalesce(blocked, false) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(component, url) AS alias_of
FROM p LEFT JOIN ruled USING (page_id) LEFT JOIN label ON node = url LEFT JOIN classes USING (component)
"""

_LEAF = "sha256(concat(" + ", ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "{n}", "text")) + "))"


def _levels(name: str, leaves: str) -> str:
    """Nodes (lang, h, j, d) of every tree over ``leaves`` (lang, j, d), and the steps (lang, j, h, sib, side) up."""
    return f"""
{name}(lang, h, j, d, n) AS (
  SELECT lang, 0, j, d, count(*) OVER (PARTITION BY lang) FROM {leaves}
  UNION ALL
  SELECT lang, h + 1, j // 2, sha256(string_agg(d, '' ORDER BY j)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY lang, h, j // 2, n)"""


def _proof(nodes: str, leaves: str, start: str, name: str) -> str:
    """Siblings and folded node of every row of ``leaves`` (id, lang, j, sibs, tried): up to the root of its tree."""
    return f"""
{name}(id, lang, h, j, sibs, tried, n) AS (
  SELECT l.id, l.lang, 0, l.j, l.sibs, l.tried, x.n FROM {start} l JOIN {nodes} x
    ON x.lang IS NOT DISTINCT FROM l.lang AND x.h = 0 AND x.j = l.j
  UNION ALL
  SELECT p.id, p.lang, p.h + 1, p.j // 2, p.sibs || coalesce(s.d, ''),
         sha256(CASE WHEN s.d IS NULL THEN p.tried WHEN p.j % 2 = 1 THEN s.d || p.tried ELSE p.tried || s.d END), (p.n + 1) // 2
  FROM {name} p LEFT JOIN {nodes} s ON s.lang IS NOT DISTINCT FROM p.lang AND s.h = p.h AND s.j = xor(p.j, 1)
  WHERE p.n > 1)"""


ORACLE_SQL["op12_merkle_manifest"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
base AS (
  SELECT row_number() OVER () AS id, doc_id, lang, {_LEAF.format(n="n_chars")} AS leaf,
         {_LEAF.format(n="(n_chars + 1)")} AS moved, n_chars,
         xor(list_reduce(list_prepend(4294967295, list_transform(
           regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS crc
  FROM documents, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j, leaf AS d,
         '' AS sibs, CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN moved ELSE leaf END AS tried
  FROM base),
{_levels("nodes", "leaves")},
subroots AS (
  SELECT lang, d, NULL AS none, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM nodes WHERE n = 1),
tops AS (SELECT 'all' AS lang, j, d FROM subroots),
{_levels("top", "tops")},
{_proof("nodes", "leaves", "leaves", "climb")},
half AS (
  SELECT c.id, 'all' AS lang, s.j, c.sibs, c.tried, s.d AS subroot
  FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1),
{_proof("top", "half", "half", "rise")}
SELECT l.doc_id, l.leaf, h.subroot, t.d AS root, sha256(r.sibs) AS proof_sha256, r.tried AS folded_root,
       r.tried = t.d AS verified
FROM rise r JOIN leaves l USING (id) JOIN half h USING (id), (SELECT d FROM top WHERE n = 1) t
WHERE r.n = 1
"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL["op13_lexical_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, {_TERMS} AS w FROM documents),
docs AS (SELECT id, doc_id, w, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
sums AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM docs),
tf AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(w) AS t FROM docs) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), sums),
items AS (
  SELECT DISTINCT item_id, list_sort(list_distinct(w)) AS w FROM (SELECT item_id, {_TERMS} AS w FROM benchmark)),
item_terms AS (SELECT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, * FROM items)),
m AS (SELECT id, doc_id, 100 - {LS.LENGTH_SHARE} + (({LS.LENGTH_SHARE} * n * nd) // l) AS m FROM docs, sums),
scores AS (
  SELECT i, any_value(item_id) AS item_id, id, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item_terms JOIN tf USING (t) JOIN weights USING (t) JOIN m USING (id) GROUP BY i, id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
