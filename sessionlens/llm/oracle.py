"""DuckDB statements of the registered queries that SQL can express."""

from __future__ import annotations

from sessionlens.llm.conversation_repair import DELETE, INSERT, REROLE, TRUNCATED
from sessionlens.llm.license_scan import DICE, TEMPLATES
from sessionlens.llm.quality_rules import Rules
from sessionlens.llm.secret_scan import BASE, KINDS, MANY_OWNERS, PATTERNS

SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:least(i + 2, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * o >= 90 * (p.n + q.n - o)),
reach(doc_id, other) AS (
  SELECT x, y FROM link UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON l.x = r.other),
least_of AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc_id = d.doc_id"""

DECONTAMINATION = rf"""
WITH b AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
    SELECT item_id, w, least(len(w), 13) AS m, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
    FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
hit AS (
  SELECT doc_id, i, t.m, item_id FROM (
    SELECT doc_id, k.m, i, array_to_string(w[i:i + k.m - 1], ' ') AS s FROM (
      SELECT doc_id, w, k.m, unnest(range(1, len(w) - k.m + 2)) AS i
      FROM d, (SELECT DISTINCT m FROM win) k) k) t
  JOIN win ON win.m = t.m AND win.s = t.s),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
owner AS (SELECT s, min(doc_id) AS o FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN owner ON win.s = owner.s WHERE o < doc_id),
word AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (
  SELECT word.doc_id, count(gone.p) AS n_removed,
    coalesce(string_agg(CASE WHEN gone.p IS NULL THEN x END, ' ' ORDER BY i), '') AS t
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.i GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

_RULES = Rules()
_LIMITS = ", ".join(f"({n}, {x})" for n, x in _RULES.coverage_limits.items())

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {SPACE_WORDS} AS w FROM documents),
word AS (
  SELECT doc_id, i, length(w[i]) AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
chars AS (SELECT doc_id, sum(c) AS word_chars FROM word GROUP BY doc_id),
lim(n, x) AS (VALUES (3, 9.9), {_LIMITS}),
win AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lim)),
twice AS (SELECT doc_id, n, s, min(i) AS first_i FROM win GROUP BY 1, 2, 3 HAVING count(*) > 1),
inside AS (
  SELECT DISTINCT win.doc_id, win.n, unnest(range(win.i, win.i + win.n)) AS p
  FROM win JOIN twice t ON t.doc_id = win.doc_id AND t.n = win.n AND t.s = win.s
  WHERE win.n = 3 OR win.i > first_i),
cover AS (
  SELECT inside.doc_id, inside.n, count(*) AS words, sum(c) AS c
  FROM inside JOIN word ON word.doc_id = inside.doc_id AND word.i = inside.p GROUP BY 1, 2),
over_limit AS (
  SELECT DISTINCT cover.doc_id FROM cover JOIN lim ON lim.n = cover.n JOIN chars ON chars.doc_id = cover.doc_id
  WHERE CAST(c AS DOUBLE) / word_chars - CAST(x AS DOUBLE) > 0),
line AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id, t ORDER BY k) AS copy
  FROM (SELECT doc_id, parts[k] AS t, k
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS k
              FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM d)))
  WHERE regexp_matches(t, '[^\x20\x09-\x0D]')),
dup AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))) AS c
  FROM line WHERE copy > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(three.words, 0) AS n_repeat_words,
    coalesce(CAST(dup.c AS DOUBLE) / word_chars, 0) AS line_cover, o.doc_id IS NOT NULL AS repeats
  FROM d LEFT JOIN chars ON chars.doc_id = d.doc_id LEFT JOIN dup ON dup.doc_id = d.doc_id
  LEFT JOIN (SELECT * FROM cover WHERE n = 3) three ON three.doc_id = d.doc_id
  LEFT JOIN over_limit o ON o.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words)
    AND NOT repeats AND line_cover <= {_RULES.line_limit} AS kept
FROM m"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in TEMPLATES.items())


WORDS_OF = "regexp_extract_all(lower({}), '[a-z0-9]+')"
BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

LICENSE_SCAN = rf"""
WITH tpl AS (
  SELECT name, {BIGRAMS} AS g FROM (SELECT name, {WORDS_OF.format('body')} AS w FROM (VALUES {_TEMPLATES}) t(name, body))),
part AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS p FROM documents
    UNION ALL
    SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\n[ \t\r]*\n')) AS p FROM documents)),
gram AS (SELECT doc_id, {BIGRAMS} AS g FROM (SELECT doc_id, {WORDS_OF.format('p')} AS w FROM part) WHERE len(w) >= 2),
found AS (
  SELECT DISTINCT doc_id, name, 2.0 * len(list_intersect(gram.g, tpl.g)) / (len(gram.g) + len(tpl.g)) AS dice
  FROM gram, tpl),
good AS (SELECT doc_id, name, CAST(dice AS DOUBLE) AS dice FROM found WHERE dice >= {DICE}),
agg AS (
  SELECT doc_id, count(*) AS n, max(dice) AS best,
    (SELECT string_agg(name, ',' ORDER BY name) FROM (SELECT DISTINCT name FROM good h WHERE h.doc_id = good.doc_id)) AS names
  FROM good GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, coalesce(best, 0.0) AS best_dice
FROM documents LEFT JOIN agg ON agg.doc_id = documents.doc_id"""

WARC_AUDIT = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, count(*) AS copies FROM pages GROUP BY 1, 2, 3),
r AS (
  SELECT page_id, copies, html, sha256(coalesce(CAST(page_id AS VARCHAR), '-') || chr(10) ||
    CAST(length(url) AS VARCHAR) || chr(10) || url || chr(10) || html) AS record_id, url FROM p),
w AS (
  SELECT page_id, copies, record_id, html, 'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:sha256:' ||
    record_id || '>' || e || 'WARC-Target-URI: ' || regexp_replace(url, '[\r\n]', ' ', 'g') || e ||
    'Content-Type: text/html' || e || 'Content-Length: ' || CAST(strlen(html) AS VARCHAR) || e || e || html || e || e AS body
  FROM r, (SELECT chr(13) || chr(10) AS e)),
o AS (
  SELECT *, CAST(strlen(body) AS BIGINT) AS length, sha256(body) AS sha256,
    row_number() OVER (ORDER BY page_id NULLS LAST, record_id) - 1 AS ordinal,
    CAST(coalesce(sum(strlen(body)) OVER (ORDER BY page_id NULLS LAST, record_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
    CAST('0x' || substr(record_id, 1, 6) AS BIGINT) AS k
  FROM w),
there AS (
  SELECT *, CAST(coalesce(sum(CASE WHEN k % 59 <> 0 THEN length END) OVER (ORDER BY ordinal
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) - "offset" AS s
  FROM o)
SELECT page_id, record_id, copies, ordinal, "offset", length, sha256,
  CASE WHEN k % 59 = 0 THEN 'missing' WHEN k % 53 = 0 AND html <> translate(html, 'aeiou', 'eioua') THEN 'corrupt'
    WHEN s <> 0 THEN 'moved' ELSE 'intact' END AS status,
  CAST(CASE WHEN k % 59 = 0 THEN 0 ELSE 1 END AS BIGINT) AS found, CASE WHEN k % 59 <> 0 THEN s END AS shift
FROM there"""


def _found(kind: str) -> str:
    """Spans of one kind: the parts between matches and the matches alternate."""
    pattern, group, least = PATTERNS[kind]
    rx = pattern.replace("'", "''")
    size = "lambda x: length(x)"
    return f"""
  SELECT doc_id, source, kind, rank, "start", "start" + length(whole) AS "end", v AS value FROM (
    SELECT doc_id, source, '{kind}' AS kind, {KINDS.index(kind)} AS rank, m[i] AS whole, v[i] AS v,
      list_sum(list_transform(gap[1:i], {size})) + coalesce(list_sum(list_transform(m[1:i - 1], {size})), 0) AS "start"
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, source, regexp_extract_all(text, '{rx}') AS m, regexp_extract_all(text, '{rx}', {group}) AS v,
        regexp_split_to_array(text, '{rx}') AS gap FROM t)))
  WHERE length(v) >= {least}"""


_LINES = """string_agg(kind || ':' || CAST("start" AS VARCHAR) || ':' || CAST("end" AS VARCHAR), ',' ORDER BY "start", rank)"""
_BASE = ", ".join(f"'{k}'" for k in BASE)

SECRET_SCAN = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_found(k) for k in KINDS)}),
owners AS (SELECT value, count(DISTINCT coalesce(source, chr(1))) >= {MANY_OWNERS} AS copied FROM s GROUP BY value),
per_doc AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
    {_LINES} FILTER (WHERE kind IN ({_BASE})) AS base, {_LINES} AS spans,
    count(*) FILTER (WHERE copied) AS n_copied, count(*) FILTER (WHERE NOT copied) AS n_live
  FROM s JOIN owners ON owners.value = s.value GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live
FROM t LEFT JOIN per_doc p ON p.doc_id = t.doc_id"""


#: crc32 of ``text`` (code points up to U+00FF) as a column ``h``: the table of the reflected
#: polynomial, then one step a byte
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def _crc32(text: str) -> str:
    code = f"list_transform(string_split({text}, ''), lambda x: CAST(unicode(x) AS BIGINT))"
    octets = f"flatten(list_transform({code}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")


SPELLING_VARIANTS = rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
x AS (
  SELECT run, k, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM r, crc),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
    ELSE run END AS word, k FROM x),
v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
gap AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS g
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gap a JOIN gap b ON a.i = b.i AND a.g = b.g AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gap a JOIN v b ON b.word = a.g
  UNION SELECT b.word, a.word, a.n FROM gap a JOIN v b ON b.word = a.g),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, hex(encode(other))) AS other, max(n) AS n FROM near GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * v.n THEN other END AS form,
    CASE WHEN best.n >= 2 * v.n THEN best.n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
walk(word, top) AS (
  SELECT word, form FROM f WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.top WHERE f.form IS NOT NULL),
last_of AS (SELECT walk.word, walk.top FROM walk JOIN f ON f.word = walk.top WHERE f.form IS NULL)
SELECT f.word, form, coalesce(last_of.top, f.word) AS root, n, n_near, form_n
FROM f LEFT JOIN last_of ON last_of.word = f.word"""


#: States of the role order: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE {CRC_TABLE},
x AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc),
y AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM x),
z AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS mark
  FROM y),
f AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair,
    CASE WHEN mark = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM z),
ins(a, b, c, edits, rows) AS (VALUES
  (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, {INSERT}, 'I', ['user:']), (0, 3, {2 * INSERT}, 'II', ['user:', 'assistant:']), (1, 2, {INSERT}, 'I', ['user:']),
  (1, 3, {2 * INSERT}, 'II', ['user:', 'assistant:']), (2, 3, {INSERT}, 'I', ['assistant:']), (3, 2, {INSERT}, 'I', ['user:'])),
shift(a, ini, b, role) AS (VALUES (0, 's', 1, 'system'), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
edit AS (
  SELECT f.conv_id, f.i, st.a, st.a AS b, {DELETE} AS c, 'D' AS edits, CAST([] AS VARCHAR[]) AS rows FROM f, (VALUES (0), (1), (2), (3)) st(a)
  UNION ALL
  SELECT f.conv_id, f.i, shift.a, shift.b, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END, 'K', [f.role || ':' || f.text]
  FROM f JOIN shift ON shift.ini = f.ini WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT f.conv_id, f.i, shift.a, shift.b, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END + {REROLE}, 'R', [shift.role || ':' || f.text]
  FROM f JOIN shift ON shift.ini <> 's' WHERE fault IN ('', 'truncated')),
way(conv_id, i, st, cost, audit, rows) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM conversations
  UNION ALL
  SELECT conv_id, i, st, first(cost ORDER BY cost, audit), first(audit ORDER BY cost, audit), first(rows ORDER BY cost, audit)
  FROM (
    SELECT way.conv_id, e.i, e.b AS st, way.cost + n.c + e.c AS cost, way.audit || n.edits || e.edits AS audit,
      list_concat(list_concat(way.rows, n.rows), e.rows) AS rows
    FROM way JOIN ins n ON n.a = way.st
    JOIN edit e ON e.conv_id IS NOT DISTINCT FROM way.conv_id AND e.i = way.i + 1 AND e.a = n.b)
  GROUP BY conv_id, i, st),
ends AS (
  SELECT way.conv_id, way.i, cost + n.c AS cost, audit || n.edits AS audit, list_concat(way.rows, n.rows) AS rows
  FROM way JOIN ins n ON n.a = way.st WHERE n.b IN (0, 3)),
best AS (
  SELECT conv_id, first(cost ORDER BY i DESC, cost, audit) AS cost, first(audit ORDER BY i DESC, cost, audit) AS audit,
    first(rows ORDER BY i DESC, cost, audit) AS rows FROM ends GROUP BY conv_id),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT best.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
  sha256(array_to_string(rows, chr(10))) AS repaired_sha256
FROM best LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM best.conv_id"""
