"""Porter stemming as SQL expressions.

The algorithm is the published one (M.F. Porter, "An algorithm for suffix
stripping", 1980) with the later ``bli`` and ``logi`` rules. Each step is an
expression over one word ``w``. The steps run as a chain of ``transform`` calls over
an array of words, so a step's input is bound once however often the step uses it,
the plan stays linear in the number of steps, and no row leaves the JVM or crosses a
shuffle. The expressions are SQL text: building the same tree from column objects
costs seconds of calls into the JVM.

Letters are tested as written: an upper-case letter is a consonant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Consonants and vowels as character classes. ``y`` is a vowel exactly when a
# consonant precedes it, so a consonant run starts with [^aeiou] and goes on with
# [^aeiouy]*, and a later vowel run starts with [aeiouy] and goes on with [aeiou]*.
_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
_FIRST_VOWELS = f"^(?:{_CONSONANTS}[aeiouy]|[aeiou])[aeiou]*"

MEASURE_ABOVE_0 = f"{_FIRST_VOWELS}[^aeiou]"
MEASURE_IS_1 = f"{_FIRST_VOWELS}{_CONSONANTS}(?:{_VOWELS})?$"
MEASURE_ABOVE_1 = f"{_FIRST_VOWELS}{_CONSONANTS}{_VOWELS}[^aeiou]"
HAS_VOWEL = "[aeiou]|[^aeiou]y"
SHORT_SYLLABLE = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"
ENDS_IN_CONSONANT = f"{_FIRST_VOWELS}(?:{_CONSONANTS}{_VOWELS})*{_CONSONANTS}$"

# The suffix tables of the algorithm, longest first among suffixes
# that end alike.
DOUBLE_SUFFIXES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
SINGLE_SUFFIXES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
LAST_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _cut(n: int) -> str:
    """The word without its last n letters."""
    return f"substring(w, 1, length(w) - {n})"


def _ends(*suffixes: str) -> str:
    return "(" + " OR ".join(f"endswith(w, '{s}')" for s in suffixes) + ")"


def _first_rule(rules: list[tuple[str, str]]) -> str:
    """The result of the first rule whose suffix ends the word, else the word.

    Rules are grouped by their last two letters, and one set test lets most words
    pass without trying any of them.
    """
    by_ending: dict[str, list[tuple[str, str]]] = {}
    for suffix, result in rules:
        by_ending.setdefault(suffix[-2:], []).append((suffix, result))
    endings = ", ".join(f"'{e}'" for e in by_ending)
    whens = [f"WHEN substring(w, -2, 2) NOT IN ({endings}) THEN w"]
    for ending, group in by_ending.items():
        inner = " ".join(f"WHEN endswith(w, '{s}') THEN {result}" for s, result in group)
        whens.append(f"WHEN endswith(w, '{ending}') THEN CASE {inner} ELSE w END")
    return f"CASE {' '.join(whens)} ELSE w END"


def _plurals() -> str:
    return f"""CASE WHEN NOT endswith(w, 's') OR endswith(w, 'ss') AND NOT endswith(w, 'sses') THEN w
        WHEN {_ends('sses', 'ies')} THEN {_cut(2)} ELSE {_cut(1)} END"""


def _after_ed_ing(rest: str) -> str:
    last = f"substring({rest}, -1, 1)"
    doubled = f"""endswith({rest}, concat({last}, {last}))
        AND ({last} NOT IN ('a', 'e', 'i', 'o', 'u', 'y', '')
             OR {last} = 'y' AND {rest} RLIKE '{ENDS_IN_CONSONANT}')"""
    return f"""CASE
        WHEN endswith({rest}, 'at') OR endswith({rest}, 'bl') OR endswith({rest}, 'iz')
            THEN concat({rest}, 'e')
        WHEN {doubled}
            THEN CASE WHEN {last} IN ('l', 's', 'z') THEN {rest}
                 ELSE substring({rest}, 1, length({rest}) - 1) END
        WHEN {rest} RLIKE '{SHORT_SYLLABLE}' THEN concat({rest}, 'e')
        ELSE {rest} END"""


def _past_and_gerund() -> str:
    return f"""CASE
        WHEN endswith(w, 'eed')
            THEN CASE WHEN {_cut(3)} RLIKE '{MEASURE_ABOVE_0}' THEN {_cut(1)} ELSE w END
        WHEN endswith(w, 'ed') AND {_cut(2)} RLIKE '{HAS_VOWEL}' THEN {_after_ed_ing(_cut(2))}
        WHEN endswith(w, 'ing') AND {_cut(3)} RLIKE '{HAS_VOWEL}' THEN {_after_ed_ing(_cut(3))}
        ELSE w END"""


def _final_y() -> str:
    return f"""CASE WHEN endswith(w, 'y') AND {_cut(1)} RLIKE '{HAS_VOWEL}'
        THEN concat({_cut(1)}, 'i') ELSE w END"""


def _replace_suffix(table: list[tuple[str, str]]) -> str:
    return _first_rule(
        [
            (
                suffix,
                f"CASE WHEN {_cut(len(suffix))} RLIKE '{MEASURE_ABOVE_0}' "
                f"THEN concat({_cut(len(suffix))}, '{replacement}') ELSE w END",
            )
            for suffix, replacement in table
        ]
    )


def _strip_suffix() -> str:
    rules = []
    for suffix in LAST_SUFFIXES:
        rest = _cut(len(suffix))
        test = f"{rest} RLIKE '{MEASURE_ABOVE_1}'"
        if suffix == "ion":
            test = f"{_ends('sion', 'tion')} AND {test}"
        rules.append((suffix, f"CASE WHEN {test} THEN {rest} ELSE w END"))
    return _first_rule(rules)


def _final_e() -> str:
    return f"""CASE WHEN endswith(w, 'e') AND (w RLIKE '{MEASURE_ABOVE_1}'
            OR w RLIKE '{MEASURE_IS_1}' AND NOT {_cut(1)} RLIKE '{SHORT_SYLLABLE}')
        THEN {_cut(1)} ELSE w END"""


def _final_ll() -> str:
    return f"CASE WHEN endswith(w, 'll') AND w RLIKE '{MEASURE_ABOVE_1}' THEN {_cut(1)} ELSE w END"


STEPS = (
    # Only the length of the whole word decides whether it is stemmed: after the
    # first step it may be shorter and still goes on.
    f"CASE WHEN length(w) > 2 THEN {_plurals()} END",
    _past_and_gerund(),
    _final_y(),
    _replace_suffix(DOUBLE_SUFFIXES),
    _replace_suffix(SINGLE_SUFFIXES),
    _strip_suffix(),
    _final_e(),
    _final_ll(),
)


def stems_or_null(words: str) -> Column:
    """Stems of an array of words, given as SQL text.

    Null for null entries and for words under three letters, which keep their form.
    """
    state = words
    for step in STEPS:
        state = f"transform({state}, w -> {step})"
    return F.expr(state)


def stem(word: str) -> Column:
    """Stem of one word, given as SQL text."""
    return F.coalesce(F.get(stems_or_null(f"array({word})"), F.lit(0)), F.expr(word))
