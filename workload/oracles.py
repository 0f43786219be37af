"""The same queries as SQL over the same tables."""

from __future__ import annotations

# Fixed values, stated a second time on purpose: a wrong entry in the library's tables
# must not be right here as well. Characters that make a word invalid, in a class.
_SPECIAL = r"""[!@#$%^&*()_+\-=,./;:'\[{}\]"\\|]"""
# The stemmer's suffix tables: suffix and replacement.
_STEP_2 = """ational ate tional tion enci ence anci ance izer ize bli ble alli al entli ent eli e
ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous aliti al
iviti ive biliti ble logi log"""
_STEP_3 = "icate ic ative - alize al iciti ic ical ic ful - ness -"
_STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _table(text: str) -> list[tuple[str, str]]:
    words = text.split()
    return [(a, b.strip("-")) for a, b in zip(words[::2], words[1::2])]


# Measures of a word by its runs of consonants (C) and vowels (V); y is a vowel after a
# consonant.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_START = "^(" + _C + "[aeiouy]|[aeiou])[aeiou]*"
_M_ABOVE_0 = _START + "[^aeiou]"
_M_IS_1 = _START + _C + "(" + _V + ")?$"
_M_ABOVE_1 = _START + _C + _V + "[^aeiou]"
_VOWEL = "[aeiou]|[^aeiou]y"
_SHORT = "^" + _C + "[aeiouy][^aeiouwxy]$"
_CONSONANT_END = _START + "(" + _C + _V + ")*" + _C + "$"

DPMIN = 100
_BLANK_FREE = r"[^ \t\n\x0B\f\r]+"


def _with(*ctes: str, select: str, recursive: bool = False) -> str:
    text = f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select
    # Read several times each; inlined, their whole chain would be repeated.
    for name in ("stems", "st", "heads", "graph", "ranked"):
        text = text.replace(f"\n{name} AS (", f"\n{name} AS MATERIALIZED (")
        text = text.replace(f"WITH {name} AS (", f"WITH {name} AS MATERIALIZED (")
    return text


def _tagged(word: str, k: str) -> str:
    return f"""CASE length({word}) % 3 WHEN 0 THEN 'VB' WHEN 1 THEN 'NN' ELSE 'NNS' END AS pos,
    CASE length({word}) % 2 WHEN 0 THEN 'prep' ELSE 'pobj' END AS label,
    CAST(CASE WHEN {k} = 1 THEN 0 ELSE (ascii({word}) + length({word})) % {k} END AS INT) AS ptr"""


def _tokens(name: str, pattern: str) -> str:
    """Tokens of all documents in groups of four."""
    return f"""{name}_at AS (
  SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ws FROM documents)),
{name} AS (
  SELECT doc_id, CAST((i - 1) // 4 AS INT) AS line_no, CAST((i - 1) % 4 + 1 AS INT) AS k, word,
    {_tagged('word', '((i - 1) % 4 + 1)')}
  FROM {name}_at)"""


TOK = _tokens("tok", r"\p{L}+") + """,
nouns0 AS (SELECT *, pos LIKE '%NN%' OR word LIKE '%NN%' AS noun FROM tok)"""


def _stems(source: str) -> str:
    """Stems of the distinct words of ``source`` (a query with a column word)."""

    def cut(n: int, w: str = "w") -> str:
        return f"left({w}, length({w}) - {n})"

    def has(pattern: str, w: str) -> str:
        return f"regexp_matches({w}, '{pattern}')"

    def rules(table, test: str) -> str:
        whens = []
        for suffix, new in table:
            rest = cut(len(suffix))
            extra = f" AND right({rest}, 1) IN ('s', 't')" if suffix == "ion" else ""
            whens.append(
                f"WHEN ends_with(w, '{suffix}') THEN "
                f"CASE WHEN {has(test, rest)}{extra} THEN {rest} || '{new}' ELSE w END"
            )
        return f"CASE {' '.join(whens)} ELSE w END"

    m0, m1, m2, vowel, short = _M_ABOVE_0, _M_IS_1, _M_ABOVE_1, _VOWEL, _SHORT
    doubled = (
        "(length(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND "
        f"(NOT {has('[aeiouy]$', 'w')} OR ends_with(w, 'y') AND "
        f"{has(_CONSONANT_END, 'w')}))"
    )
    last = sorted(((s, "") for s in _STEP_4.split()), key=lambda r: -len(r[0]))
    return f"""p0 AS (SELECT DISTINCT word, word AS w FROM ({source}) WHERE length(word) > 2),
p1 AS (SELECT word, CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {cut(2)}
  WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {cut(1)} ELSE w END AS w FROM p0),
p2 AS (SELECT word, CASE
    WHEN ends_with(w, 'eed') THEN CASE WHEN {has(m0, cut(3))} THEN {cut(1)} ELSE w END
    WHEN ends_with(w, 'ed') AND {has(vowel, cut(2))} THEN {cut(2)}
    WHEN ends_with(w, 'ing') AND {has(vowel, cut(3))} THEN {cut(3)} ELSE w END AS w,
  NOT ends_with(w, 'eed') AND (ends_with(w, 'ed') AND {has(vowel, cut(2))}
    OR ends_with(w, 'ing') AND {has(vowel, cut(3))}) AS cut FROM p1),
p3 AS (SELECT word, CASE WHEN NOT cut THEN w
    WHEN {has('(at|bl|iz)$', 'w')} THEN w || 'e'
    WHEN {doubled} THEN CASE WHEN right(w, 1) IN ('l', 's', 'z') THEN w ELSE {cut(1)} END
    WHEN {has(short, 'w')} THEN w || 'e' ELSE w END AS w FROM p2),
p4 AS (SELECT word, CASE WHEN ends_with(w, 'y') AND {has(vowel, cut(1))}
    THEN {cut(1)} || 'i' ELSE w END AS w FROM p3),
p5 AS (SELECT word, {rules(_table(_STEP_2), m0)} AS w FROM p4),
p6 AS (SELECT word, {rules(_table(_STEP_3), m0)} AS w FROM p5),
p7 AS (SELECT word, {rules(last, m2)} AS w FROM p6),
p8 AS (SELECT word, CASE WHEN ends_with(w, 'e') AND ({has(m2, 'w')}
    OR {has(m1, 'w')} AND NOT {has(short, cut(1))}) THEN {cut(1)} ELSE w END AS w FROM p7),
stems AS (SELECT word, CASE WHEN ends_with(w, 'll') AND {has(m2, 'w')}
    THEN {cut(1)} ELSE w END AS stem FROM p8)"""


_PAIRS_AT = f"""pair_words AS (
  SELECT ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM (
    SELECT regexp_extract_all(text, '{_BLANK_FREE}') AS ws FROM conversations
    UNION ALL SELECT regexp_extract_all(text, '{_BLANK_FREE}') FROM benchmark)),
label_parts AS (
  SELECT CAST(length(regexp_replace(ws[i], '[^\\p{{L}}]', '', 'g')) % 3
      = length(regexp_replace(ws[i + 1], '[^\\p{{L}}]', '', 'g')) % 3 AS VARCHAR) AS truth,
    regexp_extract_all(ws[i] || ' ' || ws[i + 1], '\\p{{L}}+') AS parts FROM pair_words),
label_list AS (SELECT parts[1] AS w1, parts[2] AS w2, truth = 'true' AS label
  FROM label_parts WHERE len(parts) = 2)"""

_WORDS = "SELECT word FROM nouns0 WHERE noun"
_ALL_WORDS = f"{_WORDS} UNION ALL SELECT w1 FROM label_list UNION ALL SELECT w2 FROM label_list"


_FIRST_WORDS = "SELECT doc_id, line_no, word AS raw FROM tok WHERE k = 1"


def _stemmed(all_words: str, head_words: str = _FIRST_WORDS) -> str:
    return _stems(all_words) + f""",
st AS (SELECT t.doc_id, t.line_no, t.k, t.pos, t.label, t.ptr,
    CASE WHEN t.noun THEN coalesce(s.stem, t.word) ELSE t.word END AS word, t.word AS raw, t.noun AS noun0
  FROM nouns0 t LEFT JOIN stems s USING (word)),
heads AS (SELECT h.doc_id, h.line_no, CASE WHEN bool_or(t.noun0 AND t.ptr = 0 AND t.raw = h.raw)
    THEN min(h.stem) ELSE min(h.raw) END AS head
  FROM (SELECT h.doc_id, h.line_no, h.raw, coalesce(s.stem, h.raw) AS stem
    FROM ({head_words}) h LEFT JOIN stems s ON s.word = h.raw) h
  JOIN st t USING (doc_id, line_no) GROUP BY h.doc_id, h.line_no, h.raw)"""


_GRAPH = """graph AS MATERIALIZED (
  SELECT *, pos LIKE '%NN%' OR word LIKE '%NN%' AS noun,
    min(k) OVER (PARTITION BY doc_id, line_no, word, pos, label, ptr) AS node,
    min(CASE WHEN ptr = 0 AND word = head THEN k END) OVER (PARTITION BY doc_id, line_no) AS root
  FROM st JOIN heads USING (doc_id, line_no)),
ranked AS (
  SELECT *, sum(CASE WHEN noun THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, line_no ORDER BY k) AS nth,
    sum(CASE WHEN noun THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, line_no) AS n_nouns FROM graph),
edges AS (
  SELECT c.*, coalesce(CASE WHEN c.ptr = 0 THEN c.root ELSE p.node END, 0) AS parent
  FROM ranked c LEFT JOIN graph p
    ON c.doc_id = p.doc_id AND c.line_no = p.line_no AND c.ptr = p.k)"""


def _walk(inner: str = "pos", end: str = "pos") -> str:
    """Paths up from every noun node; inner and end are the texts of a token."""
    return f"""nodes AS (SELECT doc_id, line_no, k, word, noun, nth, n_nouns, parent,
    {inner} AS inner_text, {end} AS end_text FROM edges WHERE node = k),
walk(doc_id, line_no, a, a_nth, up, path, dp, b, b_noun, b_nth, n_nouns, seen) AS (
  SELECT doc_id, line_no, word, nth, parent, end_text, NULL::VARCHAR, NULL::VARCHAR, false, nth, n_nouns, [k]
  FROM nodes WHERE noun
  UNION ALL
  SELECT w.doc_id, w.line_no, w.a, w.a_nth, n.parent, w.path || '-' || n.inner_text,
    w.path || '-' || n.end_text, n.word, n.noun, n.nth, w.n_nouns, list_append(w.seen, n.k)
  FROM walk w JOIN nodes n ON n.doc_id = w.doc_id AND n.line_no = w.line_no AND n.k = w.up
  WHERE NOT list_contains(w.seen, w.up)),
rec AS (SELECT * FROM walk WHERE dp IS NOT NULL AND b_noun AND a <> b)"""


_CELLS = """cells AS (SELECT dp, a, b, count(*) AS n FROM rec GROUP BY dp, a, b),
support AS (SELECT dp, count(DISTINCT (a, b)) AS n_pairs, CAST(sum(n) AS BIGINT) AS n_records
  FROM cells GROUP BY dp)"""
_FREQUENT = f"""frequent AS (SELECT * FROM support WHERE n_pairs >= {DPMIN}),
vocab AS (SELECT dp, row_number() OVER (ORDER BY dp) - 1 AS id FROM frequent),
vec AS (SELECT count(*) AS vec_size FROM vocab)"""


def _pairs(conflicts: bool = False) -> str:
    having = " HAVING bool_or(label) = bool_and(label)" if conflicts else ""
    return f"""pairs AS (SELECT a, b, bool_or(label) AS label FROM (
    SELECT coalesce(x.stem, w1) AS a, coalesce(y.stem, w2) AS b, l.label FROM label_list l
    LEFT JOIN stems x ON x.word = w1 LEFT JOIN stems y ON y.word = w2)
  GROUP BY a, b{having})"""


def _found(symmetric: bool = True) -> str:
    flipped = " UNION ALL SELECT dp, b, a, n FROM cells" if symmetric else ""
    return f"""found AS (SELECT p.a, p.b, p.label, v.id, CAST(sum(c.n) AS BIGINT) AS n
  FROM (SELECT dp, a, b, n FROM cells{flipped}) c
  JOIN vocab v USING (dp) JOIN pairs p USING (a, b) GROUP BY p.a, p.b, p.label, v.id)"""


_DENSE = """dense AS (SELECT p.a, p.b, p.label, v.id, coalesce(f.n, 0) AS n
  FROM pairs p CROSS JOIN vocab v LEFT JOIN found f ON f.a = p.a AND f.b = p.b AND f.id = v.id),
vectors AS (SELECT a, b, label, string_agg(CAST(n AS VARCHAR), ',' ORDER BY id) AS vector
  FROM dense GROUP BY a, b, label HAVING sum(n) > 0)"""

_RECORDS = [TOK, _stemmed(_WORDS), _GRAPH, _walk()]
_HALF = "least(a_nth, b_nth) <= ceil(n_nouns / 2.0)"
_LABELLED = [TOK, _PAIRS_AT, _stemmed(_ALL_WORDS), _GRAPH, _walk(), _CELLS, _FREQUENT, _pairs()]
_FOUND = [*_LABELLED, _found()]

# The text of a stemmed line, head and tokens.
_LINES = """line_texts AS (SELECT doc_id, line_no,
    length(min(head)) + 1 + sum(length(word) + length(pos) + length(label) + length(CAST(ptr AS VARCHAR)) + 4) - 1
      AS line_length
  FROM st JOIN heads USING (doc_id, line_no) GROUP BY doc_id, line_no)"""

_RULE = """scored AS (SELECT a, b, label,
    CAST(sum(CASE WHEN string_split(dp, '-')[1] = string_split(dp, '-')[-1] THEN n ELSE 0 END) AS DOUBLE)
      / CAST(sum(n) AS DOUBLE) AS score
  FROM found JOIN vocab USING (id) GROUP BY a, b, label),
folded AS (SELECT *, score > 0.5 AS prediction,
    CAST((row_number() OVER (PARTITION BY label ORDER BY a, b) - 1) % 10 AS INT) AS fold FROM scored),
predictions AS (SELECT f.*, (g.t - h.t + 1) / CAST(g.n - h.n + 2 AS DOUBLE) AS prior FROM folded f
  JOIN (SELECT fold, count(*) AS n, count(*) FILTER (label) AS t FROM folded GROUP BY fold) h USING (fold)
  CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (label) AS t FROM folded) g)"""
# Multinomial naive Bayes in closed form, for every fold from the rows outside it.
_BAYES = """examples AS (SELECT a, b, label,
    CAST((row_number() OVER (PARTITION BY label ORDER BY a, b) - 1) % 10 AS INT) AS fold
  FROM (SELECT DISTINCT a, b, label FROM found)),
cell AS (SELECT f.*, e.fold FROM found f JOIN examples e USING (a, b)),
fold_cells AS (SELECT fold, label, id, sum(n) AS n FROM cell GROUP BY fold, label, id),
all_cells AS (SELECT label, id, sum(n) AS n FROM cell GROUP BY label, id),
sizes AS (SELECT fold, label, count(*) AS n FROM examples GROUP BY fold, label),
folds AS (SELECT DISTINCT fold FROM examples),
classes AS (SELECT DISTINCT label FROM examples),
weights AS (
  SELECT f.fold, c.label, v.id, coalesce(t.n, 0) - coalesce(x.n, 0) AS n
  FROM folds f CROSS JOIN classes c CROSS JOIN vocab v
  LEFT JOIN all_cells t ON t.label = c.label AND t.id = v.id
  LEFT JOIN fold_cells x ON x.fold = f.fold AND x.label = c.label AND x.id = v.id),
theta AS (
  SELECT fold, label, id,
    ln(n + 1.0::DOUBLE) - ln(sum(n) OVER (PARTITION BY fold, label) + (SELECT vec_size FROM vec)::DOUBLE) AS t
  FROM weights),
priors AS (
  SELECT f.fold, c.label,
    ln((SELECT count(*) FROM examples e WHERE e.fold <> f.fold AND e.label = c.label) + 1.0::DOUBLE)
      - ln((SELECT count(*) FROM examples e WHERE e.fold <> f.fold) + 2.0::DOUBLE) AS p
  FROM folds f CROSS JOIN classes c),
raw_scores AS (
  SELECT x.a, x.b, x.label, x.fold, t.label AS class, min(p.p) + sum(x.n * t.t) AS r
  FROM cell x JOIN theta t ON t.fold = x.fold AND t.id = x.id
  JOIN priors p ON p.fold = x.fold AND p.label = t.label GROUP BY ALL),
scored AS (
  SELECT a, b, label, fold, round(1 / (1 + exp(max(r) FILTER (NOT class) - max(r) FILTER (class))), 6) AS score,
    max(r) FILTER (class) > max(r) FILTER (NOT class) AS prediction
  FROM raw_scores GROUP BY a, b, label, fold),
predictions AS (SELECT f.*, (g.t - h.t + 1) / CAST(g.n - h.n + 2 AS DOUBLE) AS prior FROM scored f
  JOIN (SELECT fold, count(*) AS n, count(*) FILTER (label) AS t FROM examples GROUP BY fold) h USING (fold)
  CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (label) AS t FROM examples) g)"""
_PRIORS = """FROM scored f
  JOIN (SELECT fold, count(*) AS n, count(*) FILTER (label) AS t FROM examples GROUP BY fold) h USING (fold)
  CROSS JOIN (SELECT count(*) AS n, count(*) FILTER (label) AS t FROM examples) g)"""


def _spread(n: str, t: str) -> str:
    """n times the entropy of n rows of which t are true."""
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2(CAST({x} AS DOUBLE)) ELSE 0 END"
    return f"({part(n)} - {part(t)} - {part(f'({n} - {t})')})"


def _tree_level(k: int) -> str:
    """One level of every fold's tree: the rows of all nodes, learnt from or not, their
    best split, and where it sends them."""
    return f"""total{k} AS (SELECT tree, node, count(*) AS n, count(*) FILTER (label) AS t
  FROM place{k} WHERE fold <> tree GROUP BY ALL),
right{k} AS (SELECT tree, node, id, n AS "at", sum(c) OVER w AS rn, sum(t) OVER w AS rt FROM (
    SELECT p.tree, p.node, c.id, c.n, count(*) AS c, count(*) FILTER (p.label) AS t
    FROM place{k} p JOIN held c USING (e) WHERE p.fold <> p.tree GROUP BY ALL)
  WINDOW w AS (PARTITION BY tree, node, id ORDER BY n DESC)),
split{k} AS (SELECT tree, node, id, "at", gain FROM (
    SELECT r.*, round(({_spread("n", "t")} - {_spread("rn", "rt")} - {_spread("(n - rn)", "(t - rt)")}) / n, 12) AS gain
    FROM right{k} r JOIN total{k} USING (tree, node) WHERE rn >= 2 AND n - rn >= 2)
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, id, "at") = 1),
place{k + 1} AS (SELECT p.tree, p.e, p.label, p.fold,
    2 * p.node + CASE WHEN coalesce(c.n, 0) >= s."at" THEN 1 ELSE 0 END AS node
  FROM place{k} p JOIN split{k} s USING (tree, node)
  LEFT JOIN held c ON c.e = p.e AND c.id = s.id)"""


def _trees(depth: int) -> str:
    """Entropy trees grown to a depth, and the predictions of the one that left a row out."""
    levels = ",\n".join(_tree_level(k) for k in range(depth))
    ends = "\nUNION ALL ".join(
        f"SELECT * FROM place{k}" + (f" ANTI JOIN split{k} USING (tree, node)" if k < depth else "")
        for k in range(depth + 1)
    )
    totals = "\nUNION ALL ".join(
        f"SELECT *, {k} AS depth FROM total{k}" for k in range(depth)
    )
    return f"""{_BAYES[: _BAYES.index("fold_cells AS")].rstrip().rstrip(",")},
numbered AS (SELECT *, row_number() OVER (ORDER BY a, b) AS e FROM examples),
held AS (SELECT e, id, n FROM cell JOIN numbered USING (a, b)),
place0 AS (SELECT f.fold AS tree, e, label, e.fold, 1::BIGINT AS node
  FROM (SELECT DISTINCT fold FROM examples) f CROSS JOIN numbered e),
{levels},
total{depth} AS (SELECT tree, node, count(*) AS n, count(*) FILTER (label) AS t
  FROM place{depth} WHERE fold <> tree GROUP BY ALL),
ends AS ({ends}),
totals AS ({totals}
UNION ALL SELECT *, {depth} FROM total{depth}),
scored AS (SELECT x.a, x.b, x.label, x.fold, t / CAST(n AS DOUBLE) AS score, t / CAST(n AS DOUBLE) > 0.5 AS prediction
  FROM ends JOIN totals USING (tree, node) JOIN numbered x USING (e) WHERE ends.fold = tree),
predictions AS (SELECT f.*, (g.t - h.t + 1) / CAST(g.n - h.n + 2 AS DOUBLE) AS prior {_PRIORS}"""


_TREES = _trees(10)
_CONFUSION = """conf AS (SELECT count(*) AS n, count(*) FILTER (prediction AND label) AS tp,
    count(*) FILTER (prediction AND NOT label) AS fp, count(*) FILTER (NOT prediction AND label) AS fn,
    count(*) FILTER (NOT prediction AND NOT label) AS tn,
    avg(abs(score - label::INT)) AS mae, sqrt(avg(power(score - label::INT, 2))) AS rmse,
    avg(abs(prior - label::INT)) AS mae0, sqrt(avg(power(prior - label::INT, 2))) AS rmse0
  FROM predictions)"""
_PREDICTED = [*_FOUND, _RULE]

_RAW = _tokens("raw", _BLANK_FREE) + r""",
raw_lines AS (SELECT doc_id, line_no,
    regexp_replace(min(word) FILTER (k = 1), '[^\p{L}]', '', 'g') AS head,
    bool_or(contains(word, '/')) AS slash,
    bool_or(regexp_matches(word, '""" + _SPECIAL.replace("'", "''") + """')) AS special
  FROM raw GROUP BY doc_id, line_no)"""

# Sentences of any length as tokens, and why a line is rejected.
_LONG = r"""sentences AS (
  SELECT doc_id, i, regexp_extract_all(parts[i], '[^ \t\x0B\f\r,]+') AS ws
  FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
    FROM (SELECT doc_id, regexp_split_to_array(text, '[.\n]') AS parts FROM documents))),
long_words AS (
  SELECT doc_id, CAST((i - 1) * 100000 + g AS INT) AS line_no, ws[12 * g + 1:12 * g + 12] AS ws
  FROM (SELECT *, unnest(generate_series(0, (len(ws) - 1) // 12)) AS g FROM sentences WHERE len(ws) > 0)),
long_heads AS (
  SELECT doc_id, line_no, ws, len(ws) AS n,
    regexp_replace(ws[length(ws[-1]) % len(ws) + 1], '[^\p{L}]', '', 'g') AS raw
  FROM long_words WHERE len(ws) > 0),
long_tok AS (
  SELECT doc_id, line_no, n, CAST(k AS INT) AS k, word,
    CASE length(word) % 3 WHEN 0 THEN 'VB' WHEN 1 THEN 'NN' ELSE 'NNS' END AS pos,
    CASE length(word) % 2 WHEN 0 THEN 'prep' ELSE 'pobj' END AS label,
    CAST(CASE WHEN length(word) = 13 THEN n + 1 WHEN k = 1 THEN 0
      ELSE (ascii(word) + 3 * length(word)) % (n + 1) END AS INT) AS ptr
  FROM (SELECT doc_id, line_no, n, k, ws[k] AS word
    FROM (SELECT *, unnest(generate_series(1, n)) AS k FROM long_heads WHERE n > 1))),
long_lines AS (
  SELECT doc_id, line_no, bool_or(contains(word, '/') OR length(word) = 15) AS arity,
    bool_or(regexp_matches(word, '""" + _SPECIAL.replace("'", "''") + r"""')) AS special,
    bool_or(ptr > n) AS pointer FROM long_tok GROUP BY doc_id, line_no),
reasons AS (
  SELECT doc_id, line_no, raw, CASE WHEN raw = '' THEN 'empty head' WHEN n = 1 THEN 'no tokens'
    WHEN arity THEN 'token arity' WHEN special THEN 'special character' WHEN pointer THEN 'pointer' END AS reason
  FROM long_heads LEFT JOIN long_lines USING (doc_id, line_no)),
tok AS MATERIALIZED (SELECT doc_id, line_no, k, word, pos, label, ptr
  FROM long_tok JOIN reasons USING (doc_id, line_no) WHERE reason IS NULL),
nouns0 AS (SELECT *, pos LIKE '%NN%' OR word LIKE '%NN%' AS noun FROM tok)"""
_LONG_STEMMED = _stemmed(
    f"{_WORDS} UNION ALL SELECT raw FROM reasons WHERE reason IS NULL",
    "SELECT doc_id, line_no, raw FROM reasons WHERE reason IS NULL",
)


def _areas() -> str:
    by_score = "SELECT score, count(*) FILTER (label) AS pos, count(*) FILTER (NOT label) AS neg FROM predictions GROUP BY score"
    return f"""by_score AS ({by_score}),
cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS pos_down, sum(neg) OVER (ORDER BY score DESC) AS neg_down,
    sum(pos) OVER (ORDER BY score) AS pos_up, sum(neg) OVER (ORDER BY score) AS neg_up FROM by_score),
areas AS (SELECT sum(pos) AS p, sum(neg) AS q, sum(pos * (neg_up - neg + neg / 2.0)) AS won,
    sum(pos * pos_down / CAST(pos_down + neg_down AS DOUBLE)) AS pr_true,
    sum(neg * neg_up / CAST(pos_up + neg_up AS DOUBLE)) AS pr_false FROM cum)"""


_SIDE = """SELECT {name} AS class, round({tp} / ({tp} + {fn}::DOUBLE), 6) AS tp_rate,
  round({fp} / ({fp} + {tn}::DOUBLE), 6) AS fp_rate, round({tp} / ({tp} + {fp}::DOUBLE), 6) AS precision,
  round({tp} / ({tp} + {fn}::DOUBLE), 6) AS recall,
  round(2 * {tp} / (2 * {tp} + {fp} + {fn}::DOUBLE), 6) AS f1,
  round(({tp}::DOUBLE * {tn} - {fp}::DOUBLE * {fn})
    / sqrt(({tp} + {fp})::DOUBLE * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn})), 6) AS mcc,
  round(CAST(won AS DOUBLE) / (p * q), 6) AS roc_area, round({pr}, 6) AS prc_area FROM conf, areas"""
_SIDES = (
    _SIDE.format(name="true", tp="tp", fp="fp", fn="fn", tn="tn", pr="pr_true / p")
    + "\nUNION ALL\n"
    + _SIDE.format(name="false", tp="tn", fp="fn", fn="fp", tn="tp", pr="pr_false / q")
)


def _records_sql(select: str, *more: str) -> str:
    return _with(*_RECORDS, *more, select=select, recursive=True)


def _labelled_sql(select: str, *more: str) -> str:
    return _with(*_FOUND, *more, select=select, recursive=True)


def _predicted_sql(select: str, *more: str) -> str:
    return _with(*_PREDICTED, *more, select=select, recursive=True)


def _arff_sql(data: str) -> str:
    return f"""SELECT 0 AS section, 0 AS num, 0 AS part, '@RELATION vectors' AS value
UNION ALL SELECT 1, id, 0, '@ATTRIBUTE col' || id || ' NUMERIC' FROM vocab
UNION ALL SELECT 2, 0, 0, '@ATTRIBUTE class {{True, False}}'
UNION ALL SELECT 3, 0, 0, '@DATA'
UNION ALL SELECT 4, num, 0, '%' || num || chr(9) || a || chr(9) || b FROM numbered
UNION ALL SELECT 4, num, 1, {data} FROM numbered"""


_ARFF_LINES = _arff_sql("vector || CASE WHEN label THEN ',True' ELSE ',False' END")
_NUMBERED = "numbered AS (SELECT *, row_number() OVER (ORDER BY a, b) AS num FROM vectors)"


def _formats() -> str:
    def body(inner: str, end: str) -> str:
        return _walk(inner, end)

    first = body(
        "word || '/' || pos || '/' || label", "'X/' || pos || '/' || label"
    )
    second = body("word || '/' || label", "'X/' || label")
    for name in ("nodes", "walk", "rec"):
        second = second.replace(f"{name} AS (", f"{name}2 AS (")
    second = (
        second.replace("walk(doc_id", "walk2(doc_id")
        .replace("FROM walk", "FROM walk2")
        .replace("FROM nodes", "FROM nodes2")
        .replace("JOIN nodes", "JOIN nodes2")
    )
    return _with(
        TOK,
        _stemmed(_WORDS),
        _GRAPH,
        first,
        second,
        select="""SELECT 'word_pos_label' AS format, doc_id, line_no, dp, a, b FROM rec
UNION ALL SELECT 'word_label', doc_id, line_no, dp, a, b FROM rec2""",
        recursive=True,
    )


def _noun_pairs(where: str) -> str:
    return _with(
        TOK,
        _stemmed(_WORDS),
        _GRAPH,
        select=f"""SELECT x.doc_id, x.line_no, x.k AS i, y.k AS j, x.word AS a, y.word AS b
FROM ranked x JOIN ranked y ON x.doc_id = y.doc_id AND x.line_no = y.line_no
WHERE x.noun AND y.noun AND x.word <> y.word{where}""",
    )


_SUMMARY = """SELECT n, tp + tn AS correct, fp + fn AS incorrect, round((tp + tn) / n::DOUBLE, 6) AS accuracy,
  round(((tp + tn) / n::DOUBLE - chance) / (1 - chance), 6) AS kappa, round(mae, 6) AS mae,
  round(rmse, 6) AS rmse, round(100 * mae / mae0, 6) AS relative_absolute_error,
  round(100 * rmse / rmse0, 6) AS root_relative_squared_error
FROM (SELECT *, ((tp + fp)::DOUBLE * (tp + fn) + (fn + tn)::DOUBLE * (fp + tn)) / (n::DOUBLE * n) AS chance FROM conf)"""

ORACLES: dict[str, str] = {
    "parse_arcs": _with(
        _RAW,
        select="""SELECT doc_id, line_no, head, k, word, pos, label, ptr
FROM raw JOIN raw_lines USING (doc_id, line_no) WHERE head <> '' AND NOT slash AND NOT special""",
    ),
    "reject_arcs": _with(
        _RAW,
        select="""SELECT doc_id, line_no, CASE WHEN head = '' THEN 'empty head' WHEN slash THEN 'token arity'
  ELSE 'special character' END AS reason FROM raw_lines WHERE head = '' OR slash OR special""",
    ),
    "stem_vocabulary": _with(
        TOK,
        _stems("SELECT word FROM tok"),
        select="""SELECT word, coalesce(stem, word) AS stem FROM (SELECT DISTINCT word FROM tok)
LEFT JOIN stems USING (word)""",
    ),
    "stem_arcs": _with(
        TOK,
        _stemmed(_WORDS),
        select="SELECT doc_id, line_no, head, k, word FROM st JOIN heads USING (doc_id, line_no)",
    ),
    "head_graph": _with(
        TOK,
        _stemmed(_WORDS),
        _GRAPH,
        select="SELECT doc_id, line_no, k, node, parent FROM edges",
    ),
    "noun_pairs": _noun_pairs(""),
    "noun_pairs_first_half": _noun_pairs(" AND least(x.nth, y.nth) <= ceil(x.n_nouns / 2.0)"),
    "path_records": _records_sql("SELECT doc_id, line_no, dp, a, b FROM rec"),
    "path_records_first_half": _records_sql(
        f"SELECT doc_id, line_no, dp, a, b FROM rec WHERE {_HALF}"
    ),
    "reject_arcs_long": _with(
        _LONG, select="SELECT doc_id, line_no, reason FROM reasons WHERE reason IS NOT NULL"
    ),
    "head_graph_long": _with(
        _LONG, _LONG_STEMMED, _GRAPH, select="SELECT doc_id, line_no, k, node, parent FROM edges"
    ),
    "path_records_long": _with(
        _LONG,
        _LONG_STEMMED,
        _GRAPH,
        _walk(),
        select="SELECT doc_id, line_no, dp, a, b FROM rec",
        recursive=True,
    ),
    "path_formats": _formats(),
    "path_cells": _records_sql("SELECT dp, a, b, n FROM cells", _CELLS),
    "path_support": _records_sql("SELECT * FROM support", _CELLS),
    "frequent_paths": _records_sql("SELECT * FROM frequent", _CELLS, _FREQUENT),
    "frequent_word_paths": _with(
        TOK,
        _stemmed(_WORDS),
        _GRAPH,
        _walk("word || '/' || label", "'X/' || label"),
        _CELLS,
        select="SELECT * FROM support WHERE n_pairs >= 5",
        recursive=True,
    ),
    "routed_lines": _with(
        _LONG,
        select="""SELECT doc_id, line_no, CASE WHEN reason IS NULL THEN CAST(n AS INT) END AS n_tokens, reason
FROM reasons JOIN long_heads USING (doc_id, line_no)""",
    ),
    "merged_corpora": _records_sql("SELECT * FROM support", _CELLS),
    "path_ids": _records_sql("SELECT dp, id FROM vocab", _CELLS, _FREQUENT),
    "vector_size": _records_sql("SELECT vec_size FROM vec", _CELLS, _FREQUENT),
    "max_by_key": _records_sql("SELECT dp, greatest(max(n), 0) AS n FROM cells GROUP BY dp", _CELLS),
    "kept_records": _records_sql(
        "SELECT doc_id, line_no, dp, a, b FROM rec SEMI JOIN vocab USING (dp)", _CELLS, _FREQUENT
    ),
    "numbered_pairs": _records_sql(
        """SELECT doc_id, line_no, id, dp, a, b FROM rec JOIN vocab USING (dp)
UNION ALL SELECT doc_id, line_no, id, dp, b, a FROM rec JOIN vocab USING (dp)""",
        _CELLS,
        _FREQUENT,
    ),
    "legacy_text_records": _labelled_sql(
        """SELECT kind, a, b, label, id, dp, n, vector, CAST(line_length AS INT) AS line_length, rejected, reason FROM (
SELECT 'label' AS kind, a, b, label, NULL::BIGINT AS id, NULL::VARCHAR AS dp, NULL::BIGINT AS n,
  NULL::VARCHAR AS vector, NULL AS line_length, NULL::VARCHAR AS rejected, NULL::VARCHAR AS reason FROM pairs
UNION ALL SELECT 'numbered', a, b, NULL, id, dp, NULL, NULL, line_length, NULL, NULL
  FROM rec JOIN vocab USING (dp) JOIN line_texts USING (doc_id, line_no)
UNION ALL SELECT 'numbered', b, a, NULL, id, dp, NULL, NULL, line_length, NULL, NULL
  FROM rec JOIN vocab USING (dp) JOIN line_texts USING (doc_id, line_no)
UNION ALL SELECT 'path', a, b, NULL, NULL, dp, NULL, NULL, line_length, NULL, NULL
  FROM rec JOIN line_texts USING (doc_id, line_no)
UNION ALL SELECT 'vector', a, b, label, NULL, NULL, NULL, vector, NULL, NULL, NULL FROM vectors
UNION ALL SELECT 'cell', a, b, NULL, id, NULL, n, NULL, NULL, NULL, NULL FROM found
UNION ALL SELECT 'vocabulary', NULL, NULL, NULL, id, dp, NULL, NULL, NULL, NULL, NULL FROM vocab
UNION ALL SELECT 'size', NULL, NULL, NULL, NULL, NULL, vec_size, NULL, NULL, NULL, NULL FROM vec
UNION ALL SELECT 'reject', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, a || ' ' || b || ' ' || a, 'third field'
  FROM pairs)""",
        _DENSE,
        _LINES,
    ),
    "label_rows": _with(
        _PAIRS_AT,
        select="""SELECT array_to_string(list_append(parts, truth), ' ') AS line,
  CASE WHEN len(parts) = 2 THEN 'kept' ELSE 'field count' END AS outcome, count(*) AS n
FROM label_parts GROUP BY ALL""",
    ),
    "labelled_pairs": _with(
        _PAIRS_AT,
        _stems("SELECT w1 AS word FROM label_list UNION ALL SELECT w2 FROM label_list"),
        _pairs(),
        select="SELECT a, b, label FROM pairs",
    ),
    "labelled_pairs_without_conflicts": _with(
        _PAIRS_AT,
        _stems("SELECT w1 AS word FROM label_list UNION ALL SELECT w2 FROM label_list"),
        _pairs(conflicts=True),
        select="SELECT a, b, label FROM pairs",
    ),
    "label_join": _labelled_sql(
        "SELECT p.a, p.b, p.label, f.id, f.n FROM pairs p LEFT JOIN found f ON p.a = f.a AND p.b = f.b"
    ),
    "labels_without_evidence": _labelled_sql(
        "SELECT a, b, label FROM pairs ANTI JOIN found USING (a, b)"
    ),
    "pair_path_counts": _labelled_sql("SELECT a, b, label, id, n FROM found"),
    "pair_path_counts_directed": _with(
        *_LABELLED, _found(symmetric=False), select="SELECT a, b, label, id, n FROM found", recursive=True
    ),
    "dense_cells": _labelled_sql(
        """SELECT a, b, lpad(CAST(id AS VARCHAR), CAST(length(CAST(vec_size AS VARCHAR)) AS INT), '0') AS idx, n
FROM dense CROSS JOIN vec""",
        _DENSE,
    ),
    "labeled_vectors": _labelled_sql("SELECT a, b, label, vector FROM vectors", _DENSE),
    "labeled_vectors_compatible": _with(
        TOK,
        _PAIRS_AT,
        _stemmed(_ALL_WORDS),
        _GRAPH,
        _walk().replace("rec AS (SELECT * FROM walk WHERE", f"rec AS (SELECT * FROM walk WHERE {_HALF} AND"),
        _CELLS,
        _FREQUENT,
        _pairs(),
        _found(),
        _DENSE,
        select="SELECT a, b, label, vector FROM vectors",
        recursive=True,
    ),
    "arff_lines": _labelled_sql(_ARFF_LINES, _DENSE, _NUMBERED),
    "arff_bytes": _labelled_sql(
        f"SELECT CAST(sum(strlen(value) + 1) AS BIGINT) AS n_bytes FROM ({_ARFF_LINES})", _DENSE, _NUMBERED
    ),
    "sparse_arff_lines": _labelled_sql(
        _arff_sql("entries"),
        """entered AS (SELECT a, b, label, string_agg(id || ' ' || n, ', ' ORDER BY id) AS cells FROM found GROUP BY ALL)""",
        """numbered AS (SELECT *, row_number() OVER (ORDER BY a, b) AS num, '{' || cells || ', ' ||
  (SELECT count(*) FROM vocab) || CASE WHEN label THEN ' True}' ELSE ' False}' END AS entries FROM entered)""",
    ),
    "sparse_arff_roundtrip": _labelled_sql("SELECT a, b, label, vector FROM vectors", _DENSE),
    "arff_roundtrip": _labelled_sql("SELECT a, b, label, vector FROM vectors", _DENSE),
    "resumed_vectors": _labelled_sql("SELECT a, b, label, vector FROM vectors", _DENSE),
    "tsv_roundtrip": _labelled_sql(
        "SELECT p.a, f.id, p.b, f.n, p.label FROM pairs p LEFT JOIN found f ON p.a = f.a AND p.b = f.b"
    ),
    "text_corpus": _with(
        _RAW,
        select="""SELECT head, CAST(n AS INT) AS n_tokens, count(*) AS n_lines
FROM raw_lines JOIN (SELECT doc_id, line_no, count(*) AS n FROM raw GROUP BY ALL) USING (doc_id, line_no)
WHERE head <> '' AND NOT slash AND NOT special GROUP BY ALL""",
    ),
    "folds": _predicted_sql(
        """SELECT a, b, label, round(score, 6) AS score, prediction, fold, round(prior, 6) AS prior
FROM predictions"""
    ),
    "cv_summary": _predicted_sql(
        _SUMMARY,
        _CONFUSION,
    ),
    "cv_class_details": _predicted_sql(_SIDES, _CONFUSION, _areas()),
    "cv_weighted_average": _predicted_sql(
        "SELECT "
        + ", ".join(
            f"round(sum(w * {c}) / sum(w) FILTER ({c} IS NOT NULL), 6) AS {c}"
            for c in "tp_rate fp_rate precision recall f1 mcc roc_area prc_area".split()
        )
        + f" FROM ({_SIDES.replace(', 6)', ', 15)')}) JOIN "
        "(SELECT label AS class, CAST(count(*) AS DOUBLE) AS w FROM predictions GROUP BY label) USING (class)",
        _CONFUSION,
        _areas(),
    ),
    "naive_bayes_predictions": _labelled_sql(
        "SELECT a, b, label, fold, score, round(prior, 6) AS prior, prediction FROM predictions", _BAYES
    ),
    "naive_bayes_class_details": _labelled_sql(_SIDES, _BAYES, _CONFUSION, _areas()),
    "tree_nodes": _labelled_sql(
        """SELECT CAST(tree AS INT) AS tree, node, CAST(depth AS INT) AS depth, n, t AS n_true, id, "at", round(gain, 9) AS gain
FROM totals LEFT JOIN (SELECT * FROM split0 UNION ALL SELECT * FROM split1) USING (tree, node)""",
        _trees(2),
    ),
    "tree_predictions": _labelled_sql(
        """SELECT a, b, label, fold, round(score, 6) AS score, round(prior, 6) AS prior, prediction
FROM predictions""",
        _TREES,
    ),
    "tree_summary": _labelled_sql(_SUMMARY, _TREES, _CONFUSION),
    "tree_class_details": _labelled_sql(_SIDES, _TREES, _CONFUSION, _areas()),
    "confusion_counts": _predicted_sql(
        "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY label, prediction"
    ),
    "confusion_samples": _predicted_sql(
        """SELECT bucket, CAST(rank AS INT) AS rank, a, b, label, prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY a, b) AS rank FROM (
    SELECT *, CASE WHEN prediction AND label THEN 'tp' WHEN prediction THEN 'fp'
      WHEN label THEN 'fn' ELSE 'tn' END AS bucket FROM predictions)) WHERE rank <= 5"""
    ),
}
