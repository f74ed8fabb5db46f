"""DuckDB SQL for the queries of this package that SQL can express.

Tokenizers (op7, op9, op13, pipeline) and seeded sketches (op3) have none; their
tests hold them against the libraries and brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP1 = r"""
WITH records AS (
  SELECT 2 * page_id AS record_id, 'response' AS kind, url, 1000 * page_id AS ts, page_id, 0 AS late, html FROM pages
  UNION ALL
  SELECT 2 * page_id + 1, 'revisit',
    CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '#.*$', '') || '#part'
      WHEN 1 THEN regexp_replace(regexp_replace(url, '#.*$', ''), '^http:', 'HTTPS:') ELSE url END,
    1000 * page_id + CASE WHEN page_id % 10 = 9 THEN -500 ELSE (page_id % 5) * 1000000 + 500 END, page_id,
    CASE WHEN page_id % 10 = 9 THEN -500 ELSE (page_id % 5) * 1000000 + 500 END, html
  FROM pages
), bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''), '^(?i:https?)://(?i:www\.)?', '') AS b FROM records
), keyed AS (
  SELECT *, lower(regexp_replace(regexp_extract(b, '^[^/?]*'), ':(80|443)$', '')) || regexp_replace(
      regexp_replace(regexp_replace(regexp_replace(b, '^[^/?]*', ''), '([?&])(utm_[a-z]+|ref|sessionid)=[^&]*(&|$)', '\1', 'g'),
        '([?&])(utm_[a-z]+|ref|sessionid)=[^&]*(&|$)', '\1', 'g'), '[/?&]+$', '') AS url_key,
    sha256(coalesce(html, '')) AS sha, 'day ' || (page_id % 97) AS day FROM bare
), responses AS (
  SELECT url_key, ts, max(record_id) AS response_id, arg_max(sha, record_id) AS sha, arg_max(day, record_id) AS day,
    arg_max(page_id, record_id) AS page_id FROM keyed WHERE kind = 'response' GROUP BY url_key, ts
), revisits AS (
  SELECT record_id, url_key, ts,
    CASE WHEN page_id % 3 = 0 THEN 'W/"' || sha[1:16] || '"' WHEN page_id % 7 = 1 THEN '"old"' WHEN page_id % 3 = 1 THEN '"' || sha[1:16] || '"' END AS tag,
    CASE WHEN page_id % 6 <> 5 THEN day END AS own_day, 't' || ts AS date, page_id % 2 = 0 AS cached
  FROM keyed WHERE kind = 'revisit'
), found AS (
  SELECT v.*, r.response_id, r.sha, r.day, r.page_id AS response_page FROM revisits v ASOF LEFT JOIN responses r ON v.url_key = r.url_key AND v.ts > r.ts
), judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN tag IS NOT NULL THEN
      CASE WHEN replace(tag, 'W/', '') = '"' || sha[1:16] || '"' THEN 'resolved' ELSE 'stale' END
    WHEN own_day IS NULL THEN 'unchecked' WHEN own_day = day THEN 'resolved' ELSE 'stale' END AS status FROM found
)
SELECT record_id, url_key, ts, status, CASE WHEN status = 'resolved' THEN response_id END AS response_id,
  CASE WHEN status = 'resolved' THEN sha END AS digest,
  CASE WHEN status = 'resolved' THEN CASE WHEN cached THEN 'cache-control: max-age=60' || chr(10) ELSE '' END
    || 'content-type: text/html' || chr(10) || 'date: ' || date || chr(10) || 'etag: ' || coalesce(tag, '"' || sha[1:16] || '"') || chr(10)
    || 'last-modified: ' || coalesce(own_day, day) || chr(10) || 'set-cookie: a=' || response_page END AS headers
FROM judged
"""

OP2 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, unnest(range(0, length(h), 400)) AS pos, h FROM d),
b AS (SELECT doc_id, pos, h[pos + 1:pos + 498] AS h FROM c),
p AS (SELECT doc_id, pos, h, unnest(range(1, least(200, length(h) // 2) + 1)) AS i FROM b),
s AS (SELECT doc_id, pos // 2 + i AS i, h[2 * i - 1:2 * i] AS byte, CASE WHEN 2 * i + 98 <= length(h) THEN md5_number(h[2 * i - 1:2 * i + 98]) END AS str FROM p),
f AS (SELECT str, min(doc_id) AS first FROM s WHERE str IS NOT NULL GROUP BY str),
m AS (SELECT s.doc_id, i, byte, max((coalesce(f.first, s.doc_id) < s.doc_id)::INT) OVER (PARTITION BY s.doc_id ORDER BY i ROWS 49 PRECEDING) AS gone
  FROM s LEFT JOIN f ON s.str = f.str),
e AS (SELECT *, gone > coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) AS opens FROM m),
k AS (SELECT doc_id, count(*) AS n_bytes, sum(gone)::BIGINT AS n_removed, count(*) FILTER (opens) AS n_spans,
  sha256(coalesce(unhex(string_agg(byte, '' ORDER BY i) FILTER (gone = 0)), ''::BLOB)) AS kept_sha256 FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS most,
  (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, source_size, least(most, weight * coalesce((SELECT arg_min(level, place) FROM l WHERE most > weight * level), 'inf'::DOUBLE)) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  ('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) * size AS taken FROM r
"""

OP5 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents
), u AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM near UNION SELECT reach.doc_id, near.b FROM reach JOIN near ON reach.other = near.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

OP6 = rf"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents
), u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, CASE WHEN lead(word, 4) OVER o IS NOT NULL
    THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS gram
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, i, (gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1)::INT AS twice FROM g),
r AS (SELECT doc_id, sum(c)::BIGINT AS n FROM (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS 4 PRECEDING) AS c FROM t) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts,
    length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_upper
  FROM w LEFT JOIN r USING (doc_id)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
m AS (SELECT doc_id, lang, base_failed, unnest([
    {{'measure': 1, 'value': CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END}}, {{'measure': 2, 'value': CASE WHEN n_words > 0 THEN n_shouts / n_words ELSE 0 END}},
    {{'measure': 3, 'value': CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END}}, {{'measure': 4, 'value': CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END}}
  ], recursive := true) FROM b),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
k AS (SELECT lang, measure, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
  FROM m SEMI JOIN good USING (doc_id), unnest([0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7]::DOUBLE[]) AS c(cutoff) WHERE NOT base_failed GROUP BY ALL),
p AS (SELECT lang, measure, cutoff, k < 0.005 * n AND (
    SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.005) + (n - j) * ln(0.995))) FROM unnest(range(0, k + 1)) AS x(j)
  ) <= 0.05 / ((SELECT count(DISTINCT coalesce(lang, '?')) FROM k) * 32) AS passes FROM k),
h AS (SELECT lang, measure, min(cutoff) AS most FROM p WHERE passes GROUP BY ALL),
out AS (SELECT DISTINCT m.doc_id FROM m JOIN h ON m.lang IS NOT DISTINCT FROM h.lang AND m.measure = h.measure WHERE value > most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM out) AS kept FROM b
"""

OP8 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, ws FROM d),
s AS (SELECT doc_id, i, word, CASE WHEN i + 49 <= len(ws) THEN md5_number(array_to_string(ws[i:i + 49], ' ')) END AS win FROM u),
f AS (SELECT win, min(doc_id) AS first FROM s WHERE win IS NOT NULL GROUP BY win),
m AS (SELECT s.doc_id, i, word, max((coalesce(f.first, s.doc_id) < s.doc_id)::INT) OVER (PARTITION BY s.doc_id ORDER BY i ROWS 49 PRECEDING) AS gone
  FROM s LEFT JOIN f ON s.win = f.win),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
  FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*(?:/?s>|</?SYS>>|/?INST\]|/?ROLE\]))', '\1\\\2', 'g'))
    + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 16 + length(url_encode(role)) END AS chars FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM w, unnest([1, 2, 3, 4, 5]) AS ks(k), unnest(range(1, len(ws) - k + 2)) AS starts(i) GROUP BY ALL HAVING count(*) >= 100
), c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
longer AS (
  SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(a) AS most
  FROM c, unnest([2, 3, 4]) AS ks(k), unnest(range(1, len(ws) - k + 2)) AS starts(i) WHERE k < len(ws) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, a, n, l.f AS l, r.f AS r, cut, 1000 * a * n // (l.f * r.f) AS score
  FROM c JOIN n USING (lang), unnest([1, 2, 3, 4]) AS cs(cut)
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1:], ' ') WHERE cut < len(c.ws)
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

OP12 = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY i) AS ks, list(len(regexp_extract_all(text, '{WORD}')) ORDER BY i) AS ns,
    (xor(list_reduce([ord(x) FOR x IN string_split(conv_id::VARCHAR, '')],
      LAMBDA a, b: list_reduce(range(8), LAMBDA x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b::BIGINT)), 4294967295::BIGINT), 4294967295) % 4)::INT AS h
  FROM t GROUP BY conv_id
), p AS (
  SELECT c.conv_id, list_concat(coalesce(b.ks[1:c.h], []), c.ks[c.h + 1:]) AS ks, list_concat(coalesce(b.ns[1:c.h], []), c.ns[c.h + 1:]) AS ns
  FROM c LEFT JOIN c AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), m AS (
  SELECT conv_id, d, d = len(ks) AS ends, md5(array_to_string(ks[1:d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], '')) END AS parent,
    CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS n FROM p, unnest(range(0, len(ks) + 1)) AS ds(d)
), v AS (
  SELECT d, node, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY d, node
), k AS (SELECT parent AS node, d - 1 AS d, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
f AS (SELECT v.*, coalesce(k.n, 0) AS n_children FROM v LEFT JOIN k USING (node, d)),
s AS (
  SELECT m.node, m.d, sum(f.own)::BIGINT AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM f JOIN m ON m.conv_id = f.conv_id AND m.d <= f.d GROUP BY ALL
)
SELECT f.conv_id, f.d AS depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s ON s.node = f.node AND s.d = f.d LEFT JOIN f AS o ON o.node = f.parent AND o.d = f.d - 1
"""

ORACLE_SQL: dict[str, str] = {
    "op1_revisits": OP1,
    "op2_bwt_intervals": OP2,
    "op4_mix": OP4,
    "op5_lsh_forest": OP5,
    "op6_quality_rules": OP6,
    "op8_seed_extend": OP8,
    "op10_reply_trees": OP10,
    "op11_rollup_phrases": OP11,
    "op12_prefix_trie": OP12,
}
