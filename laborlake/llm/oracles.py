"""SQL for DuckDB that the queries must agree with, where SQL can say it."""

from __future__ import annotations

#: Bitwise CRC-32 of an ASCII text, before its last complement.
CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({c}, ''), lambda x: ascii(x)::BIGINT)), lambda crc, byte:
    list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))"""
#: As in secret_scan, for an engine whose case folding goes beyond ASCII.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLES = {
    "op2_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * inter >= 80 * (nx.n + ny.n - inter)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT ways.y, reach.other FROM reach JOIN ways ON ways.x = reach.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op3_warc": """
WITH r AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT payload_digest, max(page_id) AS m FROM r WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN m IS NOT NULL AND m IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN m IS DISTINCT FROM page_id THEN m END AS refers_to
FROM r LEFT JOIN g USING (payload_digest)
""",
    "op4_line_dedup": """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS n, unnest(ls) AS line FROM d),
k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM l WHERE trim(line) <> ''),
same AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.i - b.i AS shift, b.i, b.n, length(b.line) AS chars
  FROM k a JOIN k b ON a.line = b.line AND (a.doc_id, a.i) < (b.doc_id, b.i)),
islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY x, y, shift ORDER BY i) AS island FROM same),
runs AS (
  SELECT DISTINCT y, min(i) AS a, max(i) AS b FROM islands GROUP BY x, y, shift, island HAVING sum(chars) >= 40),
covered AS (SELECT DISTINCT y AS doc_id, unnest(generate_series(a, b)) AS i FROM runs),
joined AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS part FROM covered JOIN k USING (doc_id, i)),
gone AS (SELECT doc_id, unnest(generate_series(min(n), max(n))) AS n FROM joined GROUP BY doc_id, part),
marked AS (
  SELECT l.doc_id, l.n, l.line, g.n IS NOT NULL AS removed,
    g.n IS NOT NULL AND lag(g.n) OVER (PARTITION BY l.doc_id ORDER BY l.n) IS NULL AS begins
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.n = l.n)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed_lines, count(*) FILTER (begins) AS n_runs,
  coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT removed), '') AS kept_text
FROM marked GROUP BY doc_id
""",
    "op11_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id AS c, list(digest ORDER BY turn NULLS FIRST, digest) AS ds, list(length(text) ORDER BY turn NULLS FIRST, digest) AS ns
  FROM t GROUP BY 1),
opening AS (
  SELECT c, ds, ns, xor(4294967295, """ + CRC.format(c="CAST(c AS VARCHAR)") + r""") % 6 AS h FROM own),
rebuilt AS (
  SELECT o.c, coalesce(b.ds[1:o.h], []) || o.ds[o.h + 1:] AS ds, coalesce(b.ns[1:o.h], []) || o.ns[o.h + 1:] AS ns
  FROM opening o LEFT JOIN own b ON b.c = o.c - o.c % 100),
members AS (
  SELECT c, d, len(ds) = d AS ends, array_to_string(ds[1:d], ',') AS node, coalesce(ns[d], 0) AS chars,
    CASE WHEN d > 0 THEN array_to_string(ds[1:d - 1], ',') END AS parent
  FROM rebuilt, unnest(generate_series(0, len(ds))) AS u(d)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(c) AS c, count(*) AS n, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d),
children AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
above AS (SELECT DISTINCT low.node, low.d, up.node AS top, up.d AS top_d FROM members low JOIN members up ON up.c = low.c AND up.d <= low.d),
totals AS (
  SELECT a.top, a.top_d, count(*) FILTER (k.n_children IS NULL) AS n_leaves, CAST(sum((n.n - 1) * n.chars) AS BIGINT) AS saved_tokens
  FROM above a JOIN nodes n ON n.node = a.node AND n.d = a.d LEFT JOIN children k ON k.parent = a.node AND k.d = a.d GROUP BY ALL)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  n.ends_sha256
FROM nodes n JOIN totals ON top = n.node AND top_d = n.d LEFT JOIN children k ON k.parent = n.node AND k.d = n.d
  LEFT JOIN nodes p ON p.node = n.parent AND p.d = n.d - 1
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, n_chars, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-')) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, """ + CRC.format(c="CAST(doc_id AS VARCHAR)") + r""") % 7 = 0 AS chosen
  FROM documents),
l AS (
  SELECT doc_id, lang, sha256(concat(head, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), tail)) AS leaf,
    CASE WHEN chosen THEN sha256(concat(head, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || n_chars + 1, '-'), tail)) END AS tampered
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
up(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY lang, level, i // 2, n),
sub AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top(level, i, n, h) AS (
  SELECT 0, i, n, subroot FROM sub
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n),
root AS (SELECT h AS root FROM top WHERE n = 1),
steps AS (
  SELECT p.doc_id, p.leaf, p.i AS at, p.lang, u.level, (p.i >> u.level) % 2 AS is_right, s.h AS other
  FROM placed p JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.i = p.i >> u.level AND u.n > 1
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = u.level AND s.i = xor(u.i, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.i, p.lang, 64 + u.level, (b.i >> u.level) % 2, s.h
  FROM placed p JOIN sub b ON b.lang IS NOT DISTINCT FROM p.lang JOIN top u ON u.i = b.i >> u.level AND u.n > 1
  LEFT JOIN top s ON s.level = u.level AND s.i = xor(u.i, 1)),
paths AS (
  SELECT p.doc_id, p.leaf, p.lang, p.i, coalesce(p.tampered, p.leaf) AS h,
    coalesce(list({'r': is_right, 'o': other} ORDER BY level) FILTER (s.level IS NOT NULL), []) AS path
  FROM placed p LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM p.lang AND s.at = p.i GROUP BY ALL),
done AS (
  SELECT *, sha256(array_to_string(list_transform(list_filter(path, lambda s: s.o IS NOT NULL), lambda s: s.o), '')) AS proof_sha256,
    list_reduce(list_concat([{'r': 0, 'o': h}], path), lambda a, s: {'r': 0, 'o':
      CASE WHEN s.o IS NULL THEN sha256(a.o) WHEN s.r = 1 THEN sha256(concat(s.o, a.o)) ELSE sha256(concat(a.o, s.o)) END}).o AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM done JOIN sub ON sub.lang IS NOT DISTINCT FROM done.lang CROSS JOIN root
""",
    "op13_secret_scan": r"""
WITH p(kind, name, pattern, grp, least) AS (VALUES
  (0, 'assign', '""" + ASSIGN + r"""', 1, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]+', 0, 24),
  (3, 'random', '[A-Za-z0-9+/_=-]{16,}', 0, 16)),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, kind, name, least, generate_subscripts(hits, 1) AS i, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(vals) AS val
  FROM (SELECT r, kind, name, least, string_split_regex(t, pattern) AS gaps, regexp_extract_all(t, pattern) AS hits,
    CASE grp WHEN 1 THEN regexp_extract_all(t, pattern, 1) ELSE regexp_extract_all(t, pattern) END AS vals FROM d CROSS JOIN p)),
s AS (
  SELECT r, kind, name, least, val, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM m),
spans AS (
  SELECT r, kind, name, hit, val, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM s WHERE length(val) >= least),
base AS (SELECT * FROM spans WHERE kind < 3),
cut1 AS (SELECT regexp_replace(t, '""" + ASSIGN + r"""', ' ', 'g') AS t FROM d),
cut2 AS (SELECT regexp_replace(t, 'AKIA[A-Z0-9]{16,}', ' ', 'g') AS t FROM cut1),
cut3 AS (SELECT regexp_replace(t, '[0-9a-f]{24,}', ' ', 'g') AS t FROM cut2),
runs AS (
  SELECT true AS secret, replace(val, '.', '') AS run FROM spans WHERE kind = 0
  UNION ALL SELECT true, unnest(regexp_extract_all(t, 'AKIA[A-Z0-9]{16,}')) FROM cut1
  UNION ALL SELECT true, unnest(regexp_extract_all(t, '[0-9a-f]{24,}')) FROM cut2
  UNION ALL SELECT false, run FROM (SELECT unnest(regexp_extract_all(t, '[A-Za-z0-9+/_=-]{8,}')) AS run FROM cut3) WHERE len(run) < 16),
pairs AS (
  SELECT secret, run[k] AS a, run[k + 1] AS b FROM (SELECT secret, run, unnest(generate_series(1, len(run) - 1)) AS k FROM runs)),
counts AS (SELECT secret, a, b, count(*) AS n, sum(count(*)) OVER (PARTITION BY secret, a) AS total FROM pairs GROUP BY secret, a, b),
candidates AS (SELECT row_number() OVER () AS c, * FROM spans WHERE kind = 3 AND regexp_matches(hit, '[A-Za-z]')),
steps AS (
  SELECT c, hit[k] AS a, hit[k + 1] AS b FROM (SELECT c, hit, unnest(generate_series(1, len(hit) - 1)) AS k FROM candidates)),
firsts AS (SELECT DISTINCT secret, a, total FROM counts),
alone AS (SELECT b, sum(n) + 0.5 AS one FROM counts WHERE NOT secret GROUP BY b),
whole AS (SELECT coalesce(sum(n), 0) + 0.5 * 67 AS whole FROM counts WHERE NOT secret),
scored AS (
  SELECT c, sum(ln((0.5 / 67 + 0.5 * coalesce(coalesce(x.n, 0) / xt.total, 1.0 / 67)) * (coalesce(ot.total, 0) + 10)
    / (coalesce(o.n, 0) + 10 * coalesce(one, 0.5) / whole))) AS score
  FROM steps s CROSS JOIN whole LEFT JOIN alone l ON l.b = s.b
  LEFT JOIN counts x ON x.secret AND x.a = s.a AND x.b = s.b LEFT JOIN firsts xt ON xt.secret AND xt.a = s.a
  LEFT JOIN counts o ON NOT o.secret AND o.a = s.a AND o.b = s.b LEFT JOIN firsts ot ON NOT ot.secret AND ot.a = s.a
  GROUP BY c),
added AS (
  SELECT k.* EXCLUDE (c) FROM candidates k JOIN scored USING (c)
  WHERE score >= 2 * ln(1000000) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = k.r AND b.s < k.e AND k.s < b.e)),
listed AS (
  SELECT r, kind, concat(name, ':', s, ':', e) AS one, s FROM base UNION ALL SELECT r, kind, concat(name, ':', s, ':', e), s FROM added)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex, sha256(coalesce(string_agg(one, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(one, ',' ORDER BY s, kind), '') AS spans
FROM d LEFT JOIN listed USING (r) GROUP BY r
""",
}
