"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOWER.format("coalesce(text, '')")

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n, count(*) OVER (PARTITION BY list_sort(sh)) AS size FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, d.b FROM r JOIN d ON d.a = r.b)
SELECT n.doc_id, n.n AS n_shingles, (SELECT min(b) FROM r WHERE r.a = n.doc_id) AS component_id,
  CASE WHEN n.n = 0 THEN 1 ELSE n.size END AS class_size
FROM n
"""

OP2 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) AS x FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.x[i] * c.x[i] FOR i IN range(1, len(q.x) + 1)])::bigint AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::int AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_TEXT)} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS.format(_TEXT)} AS ws FROM benchmark),
i AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[k : k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS k FROM i)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, array_to_string(ws[k : k + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d CROSS JOIN sizes)),
h AS (SELECT doc_id, n, k, item_id FROM dw JOIN iw USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS s
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS x FROM h) GROUP BY 1)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
hot AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, hot.holder IS NOT NULL AND hot.holder <> doc_id AS gone FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM m
"""

OP11 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_TEXT}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::bigint AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM w) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, (2000000::hugeint * c.a) // (x.a + y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1 : c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
subs AS (SELECT lang, a AS big, array_to_string(ws[i : i + m - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN subs s ON s.lang = c.lang AND s.phrase = c.phrase WHERE 100 * s.big >= 80 * c.a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::bigint AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

_CRC_BYTE = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1)))"
_CRC = f"xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, length(key) + 1), lambda i: ord(substr(key, i, 1))::ubigint)), lambda c, b: {_CRC_BYTE}), 4294967295::ubigint)"
_BARE = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _edit(letter: str, cost: str, tail: str, said: str | None) -> str:
    """SQL of the value (cost, audit, repaired lines) of an edit put before a tail."""
    lines = f"{tail}.o" if said is None else f"list_prepend({said}, {tail}.o)"
    return f"{{'c': {tail}.c + {cost}, 'a': '{letter}' || {tail}.a, 'o': {lines}}}"


def _row_edits(q: int, given: str, tail: str) -> str:
    """SQL of the best way to use a row in state ``q``, whose next new role is ``given``."""
    kept = {0: "CASE x WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE x WHEN 'u' THEN v2 END", 2: "CASE x WHEN 'a' THEN v3 END", 3: "CASE x WHEN 'u' THEN v2 END"}[q]
    keep = _edit("K", "w", f"({kept})", "role || ':' || text")
    rerole = _edit("R", "3 + w", tail, f"'{given}:' || text")
    return f"list_min(list_filter([{_edit('D', '4', f'v{q}', None)}, CASE WHEN w IS NOT NULL THEN {keep} END, CASE WHEN w IS NOT NULL THEN {rerole} END], lambda e: e.c IS NOT NULL))"


_INSERT_U, _INSERT_A = "'user:'", "'assistant:'"
OP12 = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS key FROM conversations),
h AS (SELECT *, {_CRC} % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM d),
f AS (SELECT *, left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS px,
    CASE WHEN {_BARE.format("text")} = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
      WHEN right({_BARE.format("text")}, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM o),
r AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN NULL WHEN fault = 'truncated' THEN 3 ELSE 0 END AS w FROM f),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE px || x NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM r GROUP BY 1),
v AS (SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'o': []::varchar[]}} AS v0, {{'c': 6, 'a': 'II', 'o': ['user:', 'assistant:']}} AS v1,
    {{'c': 3, 'a': 'I', 'o': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'o': []::varchar[]}} AS v3 FROM g
  UNION ALL
  SELECT conv_id, i - 1, list_min([m0, {_edit("I", "3", "z2", _INSERT_U)}]), list_min([m1, {_edit("I", "3", "z2", _INSERT_U)}]), z2,
    list_min([m3, {_edit("I", "3", "m2", _INSERT_U)}])
  FROM (SELECT *, list_min([m2, {_edit("I", "3", "m3", _INSERT_A)}]) AS z2 FROM (
    SELECT v.conv_id, v.i, {_row_edits(0, "user", "v2")} AS m0, {_row_edits(1, "user", "v2")} AS m1,
      {_row_edits(2, "assistant", "v3")} AS m2, {_row_edits(3, "user", "v2")} AS m3
    FROM v JOIN r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i))),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(duplicate, 0)::bigint AS duplicate,
  coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal, coalesce(v0.c, 0)::bigint AS cost,
  coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.o, chr(10)), '')) AS repaired_sha256
FROM c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM c.conv_id AND v.i = 0
"""

ORACLES = {
    "op1_ngram_jaccard_join": OP1,
    "op2_exact_topk_search": OP2,
    "op7_benchmark_decontamination": OP7,
    "op8_line_dedup": OP8,
    "op9_warc": OP9,
    "op11_phrase_collocations": OP11,
    "op12_conversation_repair": OP12,
}
