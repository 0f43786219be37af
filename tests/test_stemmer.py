import random

from pathfeat.functions.stemmer import stem

# Published examples and the words of the sample corpus.
KNOWN = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "milling": "mill", "agreed": "agre", "disabled": "disabl", "matting": "mat",
    "mating": "mate", "meetings": "meet", "messing": "mess", "furniture": "furnitur",
    "dramatize": "dramat", "able": "abl", "aircraft": "aircraft", "chair": "chair",
    "sofa": "sofa", "relational": "relat", "conditional": "condit", "rational": "ration",
    "hopping": "hop", "falling": "fall", "hissing": "hiss", "filing": "file", "sky": "sky",
    "happy": "happi", "triplicate": "triplic", "formative": "form", "hopeful": "hope",
    "goodness": "good", "adjustment": "adjust", "adoption": "adopt", "controll": "control",
    "roll": "roll", "is": "is", "ies": "i", "archaeology": "archaeolog", "possibly": "possibl",
}

# The suffix tables of the algorithm, apart from the library's.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble", "logi": "log",
}.items()
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}.items()
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def vowels(word):
    """Whether each letter is a vowel: y is one after a consonant."""
    flags = []
    for i, c in enumerate(word):
        flags.append(c in "aeiou" or (c == "y" and i > 0 and not flags[-1]))
    return flags


def measure(word):
    v = vowels(word)
    return sum(1 for x, y in zip(v, v[1:]) if x and not y)


def short(word):
    v = vowels(word)
    return len(word) > 2 and not v[-3] and v[-2] and not v[-1] and word[-1] not in "wxy"


def brute_force(word):
    """The algorithm letter by letter."""
    if len(word) < 3:
        return word
    w = word
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix) and any(vowels(w[: -len(suffix)])):
                w = w[: -len(suffix)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and not vowels(w)[-1]:
                    w = w if w[-1] in "lsz" else w[:-1]
                elif measure(w) == 1 and short(w):
                    w += "e"
                break
    if w.endswith("y") and any(vowels(w[:-1])):
        w = w[:-1] + "i"
    for table in (STEP_2, STEP_3):
        hit = max((r for r in table if w.endswith(r[0])), key=lambda r: len(r[0]), default=None)
        if hit and measure(w[: -len(hit[0])]) > 0:
            w = w[: -len(hit[0])] + hit[1]
    last = max((s for s in STEP_4 if w.endswith(s)), key=len, default=None)
    if last:
        rest = w[: -len(last)]
        if measure(rest) > 1 and (last != "ion" or rest.endswith(("s", "t"))):
            w = rest
    if w.endswith("e") and (measure(w) > 1 or measure(w) == 1 and not short(w[:-1])):
        w = w[:-1]
    if w.endswith("ll") and measure(w) > 1:
        w = w[:-1]
    return w


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "word string")
    return {r["word"]: r["stem"] for r in df.select("word", stem("word").alias("stem")).collect()}


def test_known_words(spark):
    assert stems(spark, KNOWN) == KNOWN


def test_letter_by_letter(spark):
    rng = random.Random(7)
    endings = ["", "s", "ed", "ing", "eed", "sses", "ies", "y", "e", "ll", "yyed", "yying"]
    endings += ["ational", "tional", "enci", "izer", "bli", "alli", "entli", "ization", "ator"]
    endings += ["iveness", "aliti", "biliti", "logi", "icate", "ative", "ness", "ful", "ement"]
    endings += ["ment", "ent", "sion", "tion", "ion", "ou", "ous", "ible", "ance", "ive", "ize"]
    words = {
        "".join(rng.choice("aeioubcdlsztyxwm") for _ in range(rng.randint(0, 6))) + rng.choice(endings)
        for _ in range(20000)
    }
    got = stems(spark, sorted(words))
    assert {w: s for w, s in got.items() if s != brute_force(w)} == {}


def test_upper_case_letters_are_consonants(spark):
    assert stems(spark, ["AEIed", "CaTs", "Hopping"]) == {
        "AEIed": "AEIed", "CaTs": "CaT", "Hopping": "Hop",
    }
