"""DuckDB SQL of the text queries that SQL can express, written from their definitions."""

from __future__ import annotations

from cellspark.llm import secrets, urls

URLS = """
WITH RECURSIVE p AS (
  SELECT row_number() OVER () AS rid, page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT rid, arg_max(r.verdict, length(h || pre)) AS verdict, arg_max(h || pre, length(h || pre)) AS rule
  FROM p JOIN rules r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, pre) GROUP BY rid),
judged AS (SELECT p.*, fit.verdict AS said, fit.rule FROM p LEFT JOIN fit USING (rid)),
seeds AS (
  SELECT host, avg(CASE WHEN said = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS t, avg(CASE WHEN said = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS d
  FROM judged WHERE host <> '' GROUP BY host),
hosts AS (SELECT DISTINCT host FROM p WHERE host <> ''),
linked AS (
  SELECT DISTINCT rid, host AS src, translate(regexp_extract(u, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT rid, host, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']?\\s*((?:https?:)?//[^"''\\s>]+)', 1)) AS u FROM p)),
named AS (SELECT string_split(host, '.') AS l FROM hosts WHERE NOT regexp_matches(host, '^[0-9.]+(:[0-9]*)?$')),
chained AS (SELECT DISTINCT array_to_string(l[i:], '.') AS child, array_to_string(l[i + 1:], '.') AS parent FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM named WHERE len(l) > 2)),
above AS (
  SELECT child, parent FROM chained WHERE parent NOT IN (
    'ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.za', 'co.in', 'co.jp', 'ne.jp', 'or.jp', 'co.kr',
    'com.br', 'com.cn', 'com.mx', 'com.tr', 'com.tw')),
edges AS (
  SELECT src, dst, sum(n) AS n FROM (
    SELECT src, dst, count(*) AS n FROM linked WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY src, dst
    UNION ALL SELECT child, parent, 1 FROM above UNION ALL SELECT parent, child, 1 FROM above) GROUP BY src, dst),
ways AS (
  SELECT 0 AS kind, src AS a, dst AS b, 0.85::DOUBLE * n / sum(n) OVER (PARTITION BY src) AS w FROM edges
  UNION ALL SELECT 1, dst, src, 0.85::DOUBLE * n / sum(n) OVER (PARTITION BY dst) FROM edges
  UNION ALL SELECT 0, '*', host, (1 - 0.85::DOUBLE) * t FROM seeds UNION ALL SELECT 1, '*', host, (1 - 0.85::DOUBLE) * d FROM seeds
  UNION ALL SELECT 0, '*', '*', 1 UNION ALL SELECT 1, '*', '*', 1),
walk(step, kind, host, score) AS (
  SELECT 0, kind, b, w FROM ways WHERE a = '*'
  UNION ALL
  SELECT step + 1, kind, b, sum(score * w) FROM (SELECT walk.step, ways.kind, ways.b, walk.score, ways.w FROM walk JOIN ways ON walk.kind = ways.kind AND walk.host = ways.a WHERE step < 250)
  GROUP BY step, kind, b),
scores AS (
  SELECT host, round(sum(CASE WHEN kind = 0 THEN score ELSE 0 END), 9) AS trust, round(sum(CASE WHEN kind = 1 THEN score ELSE 0 END), 9) AS distrust
  FROM walk WHERE step = 250 AND host <> '*' GROUP BY host)
SELECT page_id, judged.host, path, rule, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust,
  coalesce(said, CASE WHEN coalesce(distrust, 0) >= 0.01 AND distrust > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN scores ON judged.host = scores.host
"""


def _secrets() -> str:
    parts = []
    for order, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT rid, unnest(list_transform(list_filter(range(1, len(m) + 1), lambda i: length(v[i]) >= {rule.least}), lambda i: {{
    'start': (list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT,
    'ord': {order},
    'size': length(m[i]), 'kind': '{rule.kind}'}})) AS s
  FROM (SELECT rid, string_split_regex(t, '{pattern}') AS pieces, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS v FROM d)""")
    base = "(" + ", ".join(f"'{k}'" for k in secrets.BASE) + ")"
    text = "s.kind || ':' || s.start || ':' || (s.start + s.size)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
told AS (
  SELECT rid, count(*) FILTER (s.kind = 'assign') AS a, count(*) FILTER (s.kind = 'access') AS k, count(*) FILTER (s.kind = 'hex') AS h,
    string_agg({text}, ',' ORDER BY s.start, s.ord) FILTER (s.kind IN {base}) AS base, string_agg({text}, ',' ORDER BY s.start, s.ord) AS spans
  FROM found GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (rid)
"""


SECRETS = _secrets()

CHAT = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + 1 + length('<|im_end|>') + 1
    + length(regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<(\\\\*)\\|', '<\\1\\\\|', 'g'))
    + length(regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')))::BIGINT AS formatted_chars,
  sum(4 + strlen(role) + strlen(text))::BIGINT AS n_tokens
FROM c GROUP BY conv_id
"""

_SAFE = "regexp_replace({0}, '<(\\\\*)\\|', '<\\1\\\\|', 'g')"

ATTACHED = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, concat_ws('/', conv_id, turn) AS ref FROM conversations),
h AS (SELECT *, t[1:n // 2] AS a, t[n // 2 + 1:] AS b, (ceil(n / 28) * 2)::BIGINT AS image, n % 3 * 256 AS pages FROM c)
SELECT conv_id, turn,
  sha256('<|im_start|>' || {_SAFE.format("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")} || chr(10) || {_SAFE.format("a")} || '<|image|>' || {_SAFE.format("b")} || '<|document|><|im_end|>' || chr(10)) AS formatted_sha256,
  '0:image:' || ref || ':' || image || ',1:document:' || ref || ':' || pages AS attached, '<|image|><|document|>' AS placeholders, 3::BIGINT AS n_texts,
  sha256(a || chr(10) || b || chr(10)) AS texts_sha256, CASE WHEN role = 'assistant' THEN n + length('<|image|><|document|>') END AS loss_chars,
  4 + strlen(role) + strlen(t) + image + pages AS n_tokens
FROM h
"""

_LOW = f"translate(text, '{urls.UPPER}', '{urls.LOWER}')"
_WORD = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all({_LOW}, {_WORD}), []) AS ws FROM documents),
b AS (SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all({_LOW}, {_WORD}) AS ws FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, n, array_to_string(ws[i + 1:i + n], ' ') AS w FROM (
    SELECT item, ws, least(10, len(ws)) AS n, unnest(range(0, len(ws) - least(10, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(ws[i + 1:i + n], ' ') AS w FROM (SELECT rid, ws, n, unnest(range(0, len(ws) - n + 1)) AS i FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT rid, i, n, item FROM dw JOIN bw USING (n, w)),
covered AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS at FROM hit) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS page FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest, CASE WHEN page IS NULL OR page = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page <> page_id THEN page END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND n >= 100
"""

LINES = """
WITH d AS (SELECT DISTINCT doc_id, text, sha256(text) AS content, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
raw AS (SELECT doc_id, content, unnest(range(0, len(ls))) AS i, unnest(ls) AS line FROM d),
l AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, content ORDER BY i) - 1 AS pos, sum(words) OVER (PARTITION BY doc_id, content ORDER BY i) AS upto
  FROM (SELECT *, len(regexp_extract_all(line, '\\S+')) AS words FROM raw) WHERE words > 0),
doc AS (SELECT doc_id, content, list(line ORDER BY pos) AS ls FROM l GROUP BY doc_id, content),
win AS (
  SELECT s.doc_id, s.content, s.pos AS a, min(e.pos) + 1 AS b FROM l s JOIN l e ON s.doc_id = e.doc_id AND s.content = e.content AND e.pos >= s.pos AND e.upto >= s.upto - s.words + 50 GROUP BY ALL
  UNION
  SELECT e.doc_id, e.content, max(s.pos), e.pos + 1 FROM l e JOIN l s ON s.doc_id = e.doc_id AND s.content = e.content AND s.pos <= e.pos AND e.upto - s.upto + s.words >= 50 GROUP BY e.doc_id, e.content, e.pos),
keyed AS (SELECT win.*, array_to_string(ls[a + 1:b], chr(10)) AS w, row_number() OVER (PARTITION BY array_to_string(ls[a + 1:b], chr(10)) ORDER BY win.doc_id, win.content, a) AS nth FROM win JOIN doc USING (doc_id, content)),
later AS (SELECT k.* FROM keyed k JOIN keyed f ON k.w = f.w AND f.nth = 1 WHERE k.doc_id <> f.doc_id OR k.content <> f.content OR k.a >= f.b),
gone AS (SELECT DISTINCT doc_id, content, unnest(range(a, b)) AS pos FROM later),
runs AS (SELECT doc_id, content, min(i) AS lo, max(i) AS hi FROM (SELECT l.*, l.pos - row_number() OVER (PARTITION BY doc_id, content ORDER BY l.pos) AS isle FROM l JOIN gone USING (doc_id, content, pos)) GROUP BY doc_id, content, isle),
cut AS (SELECT DISTINCT doc_id, content, unnest(range(lo, hi + 1)) AS i FROM runs),
kept AS (
  SELECT raw.doc_id, raw.content, count(*) AS n, count(*) FILTER (cut.i IS NOT NULL) AS removed, string_agg(line, chr(10) ORDER BY raw.i) FILTER (cut.i IS NULL) AS text
  FROM raw LEFT JOIN cut ON raw.doc_id = cut.doc_id AND raw.content = cut.content AND raw.i = cut.i GROUP BY raw.doc_id, raw.content)
SELECT documents.doc_id, CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, coalesce(n, 0) AS n_lines, coalesce(removed, 0) AS n_removed
FROM documents LEFT JOIN kept ON documents.doc_id = kept.doc_id AND sha256(documents.text) = kept.content
"""

_SPACE = "\\x20\\x09-\\x0D"

INFILL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid, array_to_string(u[hi + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
