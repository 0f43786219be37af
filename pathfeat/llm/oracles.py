"""SQL for the operators that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_LOWER = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"

_SHINGLES = rf"""words AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i
    FROM words WHERE len(ws) > 0)),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS digest
  FROM shingles GROUP BY doc_id)"""

_OP1 = f"""WITH RECURSIVE {_SHINGLES},
classes AS (SELECT digest, min(doc_id) AS rep, min(n) AS n FROM sets GROUP BY digest),
own AS (SELECT rep, n, sh FROM classes JOIN shingles ON doc_id = rep),
shared AS (SELECT x.rep AS a, y.rep AS b, min(x.n) AS na, min(y.n) AS nb, count(*) AS c
  FROM own x JOIN own y ON x.sh = y.sh AND x.rep < y.rep GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
  coalesce(l.component, c.rep, d.doc_id) AS component_id,
  d.doc_id = coalesce(l.component, c.rep, d.doc_id) AS kept
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN classes c USING (digest)
LEFT JOIN least l ON l.a = c.rep"""

_OP5 = """WITH whole AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id,
    CAST(list_sum([q.v[i] * x.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM whole q JOIN whole x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_OP9 = """WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
logged AS (
  SELECT conv_id, list({'r': role, 't': text}
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS ts FROM turns GROUP BY conv_id),
whole AS (SELECT ts, min(conv_id) AS conv_id, count(*) AS n_copies FROM logged GROUP BY ts),
shorter AS (SELECT DISTINCT ts[1:i] AS ts
  FROM (SELECT ts, unnest(generate_series(1, len(ts) - 1)) AS i FROM whole))
SELECT conv_id, len(ts) AS n_turns, n_copies,
  array_to_string(['<|' || coalesce(t.r, 'none') || '|>' || chr(10) || coalesce(t.t, '') || chr(10)
    FOR t IN ts], '') AS text
FROM whole ANTI JOIN shorter USING (ts)"""

_ITEM_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

_OP10 = f"""WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS w
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i
    FROM items WHERE len(ws) > 0)),
words AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
places AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
    FROM words, (SELECT DISTINCT n FROM windows))),
found AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, w)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS place FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)"""

_OP12 = rf"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z
  FROM (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM pieces)),
one AS (SELECT lang, x, count(*) AS f FROM t GROUP BY ALL),
two AS (SELECT lang, x, y, count(*) AS f FROM t WHERE y IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, x, y, z, count(*) AS f FROM t WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (SELECT lang, x, y, max(f) AS f FROM (
  SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY ALL),
cuts AS (
  SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, u.f AS l, v.f AS r, 1 AS k
  FROM two p JOIN one u ON u.lang = p.lang AND u.x = p.x JOIN one v ON v.lang = p.lang AND v.x = p.y
  LEFT JOIN longer g ON g.lang = p.lang AND g.x = p.x AND g.y = p.y
  WHERE p.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * p.f)
  UNION ALL
  SELECT p.lang, p.x || ' ' || p.y || ' ' || p.z, p.f, u.f, v.f, 1
  FROM three p JOIN one u ON u.lang = p.lang AND u.x = p.x
  JOIN two v ON v.lang = p.lang AND v.x = p.y AND v.y = p.z
  UNION ALL
  SELECT p.lang, p.x || ' ' || p.y || ' ' || p.z, p.f, u.f, v.f, 2
  FROM three p JOIN two u ON u.lang = p.lang AND u.x = p.x AND u.y = p.y
  JOIN one v ON v.lang = p.lang AND v.x = p.z),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
weakest AS (SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM weakest JOIN (SELECT lang, sum(f) AS n FROM one GROUP BY lang) USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""


def _either(names: str) -> str:
    """A pattern for letters of either case A-Z and nothing else."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)


def _found(kind: str, pattern: str, keep: str) -> str:
    """Matches ``m`` of a pattern with their places: texts between them are counted up."""
    return f"""SELECT rid, '{kind}' AS kind, s, s + length(m) AS e FROM (
  SELECT rid, ms[i] AS m, list_sum([length(p) FOR p IN ps[1:i]])
    + coalesce(list_sum([length(p) FOR p IN ms[1:i - 1]]), 0) AS s
  FROM (SELECT rid, ms, ps, unnest(generate_series(1, len(ms))) AS i
    FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS ps FROM texts)))
  WHERE {keep}"""


_GIVEN = r'["\x27]?\x20*[:=]\x20*["\x27]?'
_ASSIGN = f"(?:{_either('password|passwd|secret|token|api_?key')}){_GIVEN}([A-Za-z0-9+/_.=-]+)"
_IDENT = _either("username|user|login|account|client_?id|access_?key_?id|access_?key")
_HOST = _either("hostname|host|endpoint|server")
_NAMED = f"(?:({_IDENT})|(?:{_HOST})){_GIVEN}([A-Za-z0-9+/_.=@-]+)"
_ADDRESS = r"[A-Za-z][A-Za-z0-9+.-]{0,15}://[\x21\x23-\x26\x28-\x3B\x3D\x3F-\x7E]+"
_LONG_ENOUGH = f"length(regexp_extract(m, '{_NAMED}', 2)) >= 3"
_MIXED = """regexp_matches(m, '[A-Za-z]') AND regexp_matches(m, '[0-9]')
  AND len(list_distinct(string_split(m, ''))) >= 8"""

_OP13 = rf"""WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
strong AS (
  {_found("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 1)) >= 6")}
  UNION ALL {_found("access", "AKIA[A-Z0-9]+", "length(m) >= 20")}
  UNION ALL {_found("hex", "[0-9a-f]{24,}", "true")}),
given AS (SELECT DISTINCT * FROM (
  {_found("ident", _NAMED, f"{_LONG_ENOUGH} AND regexp_extract(m, '{_NAMED}', 1) <> ''")}
  UNION ALL {_found("ident", "AKIA[A-Z0-9]+", "length(m) BETWEEN 8 AND 19")}
  UNION ALL {_found("endpoint", _NAMED, f"{_LONG_ENOUGH} AND regexp_extract(m, '{_NAMED}', 1) = ''")}
  UNION ALL {_found("endpoint", _ADDRESS, "true")}) g
  WHERE NOT EXISTS (SELECT 1 FROM strong o WHERE o.rid = g.rid AND o.s < g.e AND o.e > g.s)),
opaque AS (SELECT * FROM ({_found("opaque", "[A-Za-z0-9+/_=-]{16,}", _MIXED)}) g
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM strong UNION ALL SELECT * FROM given) o
    WHERE o.rid = g.rid AND o.s < g.e AND o.e > g.s)),
blank AS ({_found("blank", r"\n[\x20\x09\x0D]*\n", "true")}),
parts AS (SELECT p.*, (SELECT count(*) FROM blank b WHERE b.rid = p.rid AND b.s < p.s) AS scope
  FROM (SELECT * FROM strong UNION ALL SELECT * FROM given UNION ALL SELECT * FROM opaque) p),
near AS (SELECT DISTINCT a.rid, a.kind, a.s, a.e, b.kind AS beside FROM parts a JOIN parts b
  ON a.rid = b.rid AND a.scope = b.scope AND b.s <= a.e + 160 AND b.e >= a.s - 160
  WHERE a.kind IN ('ident', 'opaque', 'endpoint')),
met AS (SELECT rid, kind, s, e, bool_or(beside IN ('access', 'ident')) AS identifier,
    bool_or(beside IN ('assign', 'hex', 'opaque')) AS secret, bool_or(beside = 'endpoint') AS endpoint
  FROM near GROUP BY ALL),
spans AS (SELECT * FROM strong UNION ALL SELECT rid, kind, s, e FROM met
  WHERE (kind = 'ident' AND secret) OR (kind = 'opaque' AND (identifier OR endpoint))
    OR (kind = 'endpoint' AND identifier AND secret)),
joined AS (SELECT rid, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access,
    count_if(kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, list_position(kinds, kind), e)
      FILTER (kind IN ('assign', 'access', 'hex')) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, list_position(kinds, kind), e) AS every
  FROM (SELECT *, ['assign', 'access', 'hex', 'ident', 'opaque', 'endpoint'] AS kinds FROM spans) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM texts LEFT JOIN joined USING (rid)"""

ORACLES: dict[str, str] = {
    "op1_minhash": _OP1,
    "op5_top_k": _OP5,
    "op9_chat_format": _OP9,
    "op10_decontamination": _OP10,
    "op12_collocations": _OP12,
    "op13_secrets": _OP13,
}
