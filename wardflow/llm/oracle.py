r"""DuckDB SQL that returns the same rows as the training-data queries.

Words are runs of [^\x20\x09-\x0D]; a text's lines are split at \n.
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SOURCE_MIX = rf"""
WITH d AS (
  SELECT doc_id, text, source, len({_WORDS})::BIGINT AS size,
    coalesce(doc_id::VARCHAR, '~') || ':' || coalesce(md5(text), '~') AS name,
    -- the rows of a source that repeat a document are numbered, and draw each for itself
    row_number() OVER (PARTITION BY source, doc_id, md5(text)) - 1 AS nth FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS total FROM d GROUP BY source),
r AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w FROM s),
a AS (SELECT sum(total) AS all_words, sum(w) AS all_w FROM r),
-- sources by the level at which they stop; the level is the first that its own source does not stop
o AS (
  SELECT *, 2.0 * total / w AS stops, row_number() OVER (ORDER BY 2.0 * total / w, w, source NULLS LAST) AS nth,
    coalesce(sum(total) OVER (ORDER BY 2.0 * total / w, w, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_before,
    coalesce(sum(w) OVER (ORDER BY 2.0 * total / w, w, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
  FROM r),
lv AS (
  SELECT arg_min(level, nth) AS level FROM (
    SELECT (1.5 * all_words - 2.0 * size_before) / (all_w - w_before) AS level, stops, nth FROM o, a)
  WHERE level <= stops),
t AS (
  SELECT source, total::BIGINT AS source_size,
    CASE WHEN level IS NULL THEN 2.0 * total ELSE least(2.0 * total, level * w) END AS target
  FROM r, lv),
c AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || name || CASE WHEN nth > 0 THEN ':' || nth ELSE '' END), 1, 13))::BIGINT
      / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM e
"""

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
v AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS words
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
g AS (SELECT doc_id, words FROM v GROUP BY ALL HAVING count(*) > 1),
q AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM v JOIN g USING (doc_id, words)) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaim,
    len(list_filter(list_zip(ws, ws[2:]), lambda z: z[1] = z[2]))::BIGINT AS n_echoes
  FROM d LEFT JOIN q USING (doc_id)),
b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (10 * n_upper > 3 * word_chars)::BIGINT
    + 16 * (10 * n_exclaim > n_words)::BIGINT + 32 * (2 * n_dup_lines > n_lines)::BIGINT
    + 64 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::BIGINT
    + 128 * (5 * n_echoes > n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits, CASE WHEN bit_count(fail_bits) = 1 THEN fail_bits ELSE 0 END::BIGINT AS sole_failure
FROM b
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS w
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
v AS (
  SELECT doc_id, w, line || chr(10) || lead(line, 1) OVER x || chr(10) || lead(line, 2) OVER x AS three
  FROM f WINDOW x AS (PARTITION BY doc_id ORDER BY w)),
o AS (
  SELECT doc_id, w, row_number() OVER (PARTITION BY three ORDER BY doc_id, w) AS nth
  FROM v WHERE three IS NOT NULL),
z AS (SELECT DISTINCT doc_id, unnest(range(w, w + 3)) AS w FROM o WHERE nth > 1),
k AS (
  SELECT l.doc_id, count(f.w) AS n_lines, count(z.w) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE z.w IS NULL), '') AS text
  FROM l LEFT JOIN f ON l.doc_id = f.doc_id AND l.i = f.i LEFT JOIN z ON f.doc_id = z.doc_id AND f.w = z.w
  GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  length(k.text)::BIGINT AS n_chars, md5(k.text) AS text_md5
FROM d LEFT JOIN k USING (doc_id)
"""

CHAT_PREFERENCES = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations),
last AS (SELECT conv_id, max(turn) AS turn FROM c WHERE role = 'assistant' GROUP BY conv_id),
lt AS (SELECT l.conv_id, l.turn, max(c.text) AS text
       FROM last l JOIN c ON c.conv_id = l.conv_id AND c.turn = l.turn AND c.role = 'assistant' GROUP BY ALL),
r AS (
  SELECT c.conv_id, c.turn, c.role, CASE WHEN own.conv_id IS NULL THEN c.text ELSE other.text END AS text
  FROM c LEFT JOIN lt own ON own.conv_id = c.conv_id AND own.turn = c.turn AND c.role = 'assistant'
         LEFT JOIN lt other ON other.conv_id = c.conv_id + 1
  WHERE own.conv_id IS NULL OR other.conv_id IS NOT NULL),
t AS (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r', * FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS pos FROM t),
m AS (
  SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.pos, b.pos) AS pos,
    coalesce(a.role = b.role AND a.text = b.text, false) AS same
  FROM (SELECT * FROM p WHERE side = 'c') a FULL JOIN (SELECT * FROM p WHERE side = 'r') b
    ON a.conv_id = b.conv_id AND a.pos = b.pos),
d AS (SELECT conv_id, coalesce(min(pos) FILTER (WHERE NOT same), max(pos) + 1) - 1 AS n, bool_or(NOT same) AS differs
      FROM m GROUP BY conv_id),
x AS (
  SELECT p.*, n, CASE WHEN pos <= n THEN 'p' ELSE side END AS part,
    '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body
  FROM p JOIN d USING (conv_id) WHERE side = 'c' OR pos > n),
y AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part ORDER BY pos) AS ends FROM x),
z AS (
  SELECT conv_id, part, string_agg(head || body, '' ORDER BY pos) AS text,
    string_agg((ends - length(body))::VARCHAR || '-' || ends::VARCHAR, ',' ORDER BY pos)
      FILTER (WHERE role = 'assistant') AS spans
  FROM y GROUP BY conv_id, part)
SELECT d.conv_id, n AS prompt_turns, md5(coalesce(a.text, '')) AS prompt_md5, md5(coalesce(b.text, '')) AS chosen_md5,
  md5(coalesce(e.text, '')) AS rejected_md5, coalesce(b.spans, '') AS chosen_spans, coalesce(e.spans, '') AS rejected_spans,
  differs
FROM d LEFT JOIN z a ON a.conv_id = d.conv_id AND a.part = 'p' LEFT JOIN z b ON b.conv_id = d.conv_id AND b.part = 'c'
  LEFT JOIN z e ON e.conv_id = d.conv_id AND e.part = 'r'
"""

#: The batches of op9, with tokens counted by two patterns: SQL cannot count by a vocabulary file (a test runs it).
TOKEN_COUNTS = r"""
WITH RECURSIVE ids AS (SELECT doc_id, encode(doc_id::VARCHAR) AS b FROM documents),
-- crc32 of the id's text, bit by bit
crc AS (
  SELECT doc_id, b, 0 AS i, 0 AS k, 4294967295::BIGINT AS c FROM ids
  UNION ALL
  SELECT doc_id, b, CASE WHEN k = 8 THEN i + 1 ELSE i END, CASE WHEN k = 8 THEN 0 ELSE k + 1 END,
    CASE WHEN k = 0 THEN xor(c, ascii(decode(b)[i + 1])::BIGINT)
         WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc WHERE i < octet_length(b)),
h AS (SELECT doc_id, xor(c, 4294967295) % 10 AS bucket FROM crc WHERE i = octet_length(b)),
d AS (
  SELECT source, lang, bucket, coalesce(text, '') AS text,
    CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) ELSE coalesce(text, '') END AS rest
  FROM documents JOIN h USING (doc_id)),
n AS (
  SELECT source, lang, v.tokenizer, bucket,
    len(regexp_extract_all(CASE WHEN bucket = 5 THEN rest ELSE text END, v.p)) AS n_tokens
  FROM d, (VALUES ('words-1', '[^\x20\x09-\x0D]+'),
                  ('pieces-2', '[\p{L}\p{N}]+|[^\p{L}\p{N}\x09-\x0D\x20]')) v(tokenizer, p))
SELECT source, lang, tokenizer, count(*) AS n_docs, sum(n_tokens)::BIGINT AS n_tokens
FROM n WHERE bucket <> 3 GROUP BY ALL
"""

SPELLING_VARIANTS = r"""
WITH RECURSIVE
-- crc32 of every byte value, eight shifts each
bt AS (SELECT b, 0 AS k, b::BIGINT AS c FROM range(256) r(b)
       UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bt WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bt WHERE k = 8),
r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
x AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx FROM g),
h AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || substr(hx, 2 * i - 1, 2))::BIGINT for i in range(1, length(hx) // 2 + 1)]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM x, tab),
w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
         ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
-- every word without one of its code points
d AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN v b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN v b ON a.less = b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word),
b AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n,
        min(near) FILTER (WHERE near_n = top) AS form
      FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS top FROM p) GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
        CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM v LEFT JOIN b USING (word)),
c AS (SELECT word, word AS here, form AS next FROM f
      UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.next = f.word)
SELECT f.word, f.form, c.here AS root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.next IS NULL
"""

_NORMAL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

BENCHMARK_HITS = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_NORMAL_WORDS} AS ws FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_NORMAL_WORDS} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(10, len(ws)) AS k, array_to_string(list_slice(ws, pos, pos + least(10, len(ws)) - 1), ' ') AS words
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS pos FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT r, pos, k, array_to_string(list_slice(ws, pos, pos + k - 1), ' ') AS words
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)),
h AS (SELECT r, pos, dw.k, item FROM dw JOIN iw USING (words)),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(pos, pos + k)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
t AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
      FROM (SELECT r, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::BIGINT AS n FROM t GROUP BY ALL HAVING sum(docs) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
-- every group with every kept term of its language
c AS (SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n, k.n AS lang_n
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
s AS (SELECT lang, source, sum(n)::BIGINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT c.*, 1 + (1000000000::HUGEINT * (c.n + 1)) // (s.total + l.v) AS p,
    1 + (1000000000::HUGEINT * (c.lang_n + 1)) // (l.total + l.v) AS q
  FROM c JOIN s ON s.lang = c.lang AND s.source = c.source JOIN l ON l.lang = c.lang),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
both_parts AS (
  SELECT * FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 200
"""
