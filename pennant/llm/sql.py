"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from pennant.llm.chat_events import CONTROLS, OPEN, SHUT
from pennant.llm.risk_rules import RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _rules_sql(risk: float = 0.05, error: float = 0.05) -> str:
    value = lambda r: f"CASE WHEN {r.base} > 0 THEN (1000 * {r.top}) // {r.base} END"
    sign = lambda r: ">" if r.above else "<"
    tests = "\nUNION ALL\n".join(
        f"SELECT s.stratum, '{r.name}' AS rule, c.i, c.cutoff, count(*) AS n, count(*) FILTER (({value(r)}) {sign(r)} c.cutoff) AS k "
        f"FROM good s, (VALUES {', '.join(f'({i}, {c})' for i, c in enumerate(r.cutoffs))}) c(i, cutoff) GROUP BY ALL" for r in RULES)
    hit = " OR ".join(
        f"coalesce(({value(r)}) {sign(r)} (SELECT c.cutoff FROM chosen c WHERE c.rule = '{r.name}' AND c.stratum = m.stratum), false)"
        for r in RULES)
    a = risk / len(RULES)
    return rf"""
WITH w AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, {_WORDS} AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, (VALUES (0), (1), (2)) o(j) GROUP BY doc_id),
m AS MATERIALIZED (SELECT w.doc_id, stratum, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
good AS MATERIALIZED (SELECT b.* FROM b JOIN (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1) l
  ON l.doc_id = b.doc_id WHERE NOT base_failed),
tests AS MATERIALIZED ({tests}),
level AS (SELECT {error} / greatest(1, count(DISTINCT stratum) * {len(RULES)}) AS l FROM good),
p AS (SELECT *, CASE WHEN k > n * {a!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1)
  - lgamma(n - i + 1) + i * ln({a!r}) + (n - i) * ln(1 - {a!r})))) END AS p FROM tests),
ok AS (SELECT *, bool_and(p <= (SELECT l FROM level)) OVER (PARTITION BY stratum, rule ORDER BY i) AS passed FROM p),
chosen AS MATERIALIZED (SELECT stratum, rule, arg_max(cutoff, i) AS cutoff FROM ok WHERE passed GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({hit}) AS kept FROM b m"""


_MIX = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight::DOUBLE, source) AS i FROM r),
c AS (SELECT i, cap, weight, (sum(cap) OVER (ORDER BY i) - cap)::BIGINT AS used, (sum(weight) OVER (ORDER BY i DESC))::BIGINT AS open,
  (SELECT sum(source_size) FROM s)::BIGINT AS total FROM o),
lv AS (SELECT arg_min((total - used)::DOUBLE / open, i) AS level FROM c WHERE cap >= ((total - used)::DOUBLE / open) * weight),
t AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT level FROM lv) * weight) AS target FROM r),
x AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken FROM x"""

_NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT pairs.a, pairs.b FROM pairs JOIN n x ON x.doc_id = pairs.a JOIN n y ON y.doc_id = pairs.b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""

_URLS = r"""
WITH u AS (SELECT page_id, url, DATE '2024-01-01' + (((page_id % 365) + 365) % 365)::INTEGER AS fetch_date,
  lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''),
  '\.?(:[0-9]*)?$', '')) AS host,
  list_filter(string_split(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)), '/'), lambda s: s <> '') AS seg
  FROM pages),
h AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::BIGINT AS v FROM (SELECT DISTINCT host FROM u WHERE host <> '')),
pd AS (SELECT p, ('0x' || substr(md5(p), 1, 6))::BIGINT AS v FROM (SELECT DISTINCT regexp_replace(host, '^[^.]*\.', '') AS p FROM h)),
sg AS (SELECT k, ('0x' || substr(md5(k), 1, 6))::BIGINT AS v FROM (SELECT DISTINCT host || '/' || seg[1] AS k FROM u WHERE host <> '' AND len(seg) > 0)),
spans AS MATERIALIZED (
  SELECT 'spam' AS list, host AS key, 'block' AS verdict, DATE '2024-01-01' + (v % 200)::INTEGER AS valid_from,
    CASE WHEN v % 6 = 0 THEN DATE '2024-01-01' + (v % 200 + 60)::INTEGER END AS valid_to FROM h WHERE v % 3 = 0
  UNION ALL SELECT 'spam', host, 'block', DATE '2024-01-01' + (v % 200 + 100)::INTEGER, NULL FROM h WHERE v % 30 = 0
  UNION ALL SELECT 'domains', p, 'block', DATE '2024-01-01' + (v % 300)::INTEGER, NULL FROM pd WHERE v % 4 = 0
  UNION ALL SELECT 'cleared', k, 'allow', DATE '2024-01-01' + (v % 250)::INTEGER, NULL FROM sg WHERE v % 5 = 0),
keys AS (
  SELECT url, fetch_date, array_to_string(l[len(l) - i + 1:], '.') AS key, i AS depth
    FROM (SELECT url, fetch_date, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT DISTINCT url, fetch_date, string_split(host, '.') AS l FROM u WHERE host <> ''))
  UNION ALL SELECT url, fetch_date, host || '/' || array_to_string(seg[1:i], '/'), 1000 + i
    FROM (SELECT url, fetch_date, host, seg, unnest(range(1, len(seg) + 1)) AS i FROM (SELECT DISTINCT url, fetch_date, host, seg FROM u WHERE host <> ''))),
hit AS (SELECT url, fetch_date, count(*) OVER (PARTITION BY url, fetch_date) AS n, list, key, verdict, valid_from, valid_to,
  row_number() OVER (PARTITION BY url, fetch_date ORDER BY depth DESC, verdict <> 'block', list, key) AS rn
  FROM keys JOIN spans USING (key) WHERE valid_from <= fetch_date AND (valid_to IS NULL OR fetch_date < valid_to))
SELECT u.page_id, u.fetch_date::VARCHAR AS fetch_date, u.host, coalesce(n, 0)::BIGINT AS n_active, coalesce(verdict, 'none') AS verdict, list, key,
  valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to
FROM u LEFT JOIN hit ON hit.url = u.url AND hit.fetch_date = u.fetch_date AND rn = 1"""

# the escapes and the frame of pennant.llm.chat_events, of which only lengths matter here
_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + CONTROLS AS n FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + length(role) + FRAME)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""".replace("CONTROLS", " + ".join(
    f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in CONTROLS)).replace("FRAME", str(len(OPEN) + len(SHUT) + 1))

_NEAREST = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20"""

_FIELD = "coalesce(strlen(COL::VARCHAR) || ':' || COL::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.replace("COL", c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
# crc32 of a decimal number: bytes one after another, eight shifts each
_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x // 2, (x % 2) * 3988292384))))"""

_MERKLE = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_LEAF}) AS leaf,
  CASE WHEN {_CRC} % 3 = 0 THEN sha256({_LEAF.replace("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other
  FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (SELECT 0 AS level, g, pos, leaf AS h, n FROM p
  UNION ALL SELECT level + 1, g, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM t WHERE n > 1 GROUP BY level, g, pos // 8),
s AS MATERIALIZED (SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, pos, subroot AS h, n FROM s
  UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 7) // 8) FROM u WHERE n > 1 GROUP BY level, pos // 8),
nodes AS MATERIALIZED (SELECT 0 AS part, g, level, pos, h, n FROM t UNION ALL SELECT 1, NULL, level, pos, h, n FROM u),
sib AS MATERIALIZED (SELECT a.part, a.g, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
  coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.part = b.part AND a.g IS NOT DISTINCT FROM b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8
  WHERE a.n > 1 GROUP BY ALL),
w AS MATERIALIZED (SELECT row_number() OVER () AS rid, p.*, s.subroot, s.height, s.pos AS spos FROM p JOIN s USING (g)),
f AS (SELECT rid, g, pos, spos, height, 0 AS step, coalesce(other, leaf) AS acc, '' AS proof FROM w
  UNION ALL SELECT f.rid, f.g, f.pos, f.spos, f.height, f.step + 1, sha256(sib.l || f.acc || sib.r), f.proof || sib.l || sib.r
  FROM f JOIN sib ON sib.part = CASE WHEN f.step < f.height THEN 0 ELSE 1 END
    AND sib.g IS NOT DISTINCT FROM CASE WHEN f.step < f.height THEN f.g END
    AND sib.level = CASE WHEN f.step < f.height THEN f.step ELSE f.step - f.height END
    AND sib.pos = CASE WHEN f.step < f.height THEN f.pos // (8 ** f.step)::BIGINT ELSE f.spos // (8 ** (f.step - f.height))::BIGINT END),
z AS (SELECT rid, arg_max(acc, step) AS folded_root, arg_max(proof, step) AS proof FROM f GROUP BY rid),
root AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM w JOIN z USING (rid), root"""

_FILL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, t, n, ('0x' || x[1:8])::BIGINT % (n + 1) AS a, ('0x' || x[9:16])::BIGINT % (n + 1) AS b,
  ('0x' || x[17:24])::BIGINT % 100 AS c, ('0x' || x[25:32])::BIGINT % 100 AS e FROM d),
f AS (SELECT *, least(a, b) AS low, greatest(a, b) AS high,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, t[1:low] AS p, t[low + 1:high] AS m, t[high + 1:] AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM o"""

SQL = {"op4_event_sourced_chat": _CHAT, "op5_block_matrix_search": _NEAREST, "op6_temporal_url_lists": _URLS, "op7_risk_controlled_rules": _rules_sql(), "op8_weighted_mix": _MIX, "op9_min_max_dedup": _NEAR,
       "op12_merkle_manifest": _MERKLE, "op13_fill_in_middle": _FILL}
