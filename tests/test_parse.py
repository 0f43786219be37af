from pathfeat.operators.parse import parse_arcs, parse_labels, reject_arcs, reject_labels

# A line of the published corpus format and the known rejects below.
GOOD = "abounded\tabounded/VBD/ccomp/0 in/IN/prep/1 land/JJ/dep/4 mongers/NNS/pobj/2\t22\t1927,7\t1930,9"


def reasons(lines, values):
    return {r["value"]: r["reason"] for r in reject_arcs(lines(values)).collect()}


def test_tail_is_dropped(lines):
    row = parse_arcs(lines([GOOD])).first()
    assert row["head"] == "abounded"
    assert [t.asDict() for t in row["toks"]][3] == {
        "word": "mongers", "pos": "NNS", "label": "pobj", "ptr": 2,
    }
    assert len(row["toks"]) == 4


def test_rejects(lines):
    cases = {
        "are\tare/VBP/ROOT/0 branch/NN/nn/3 //NN/attr/1\t10\t1968,3": "token arity",
        "\tare/VBP/ROOT/0 branch/NN/nn/1": "empty head",
        "": "empty head",
        "   ": "empty head",
        "\x01\tare/VBP/ROOT/0": "empty head",
        "are": "no tokens",
        "are\t10\t1968,3": "no tokens",
        "a\ta-b/NN/x/0": "special character",
        'a\ta"b/NN/x/0': "special character",
        "a\ta\\b/NN/x/0": "special character",
        "a\ta]b/NN/x/0": "special character",
        "a\ta|b/NN/x/0": "special character",
        "a\ta/NN/x/": "token arity",
        "a\ta/NN/x/0 b/NN/x/1 c/NN/x/9": "pointer",
        "a\ta/NN/x/z": "pointer",
        "a\ta/NN/x/-1": "pointer",
        "a\ta/NN/x/99999999999": "pointer",
    }
    assert reasons(lines, list(cases)) == cases
    assert parse_arcs(lines(list(cases))).count() == 0


def test_accepted(lines):
    values = [
        GOOD,
        "a\ta<b>?~`/NN/x/0",
        "a  \x0b a/NN/x/0/   b/NN/x/+1 \x02",
        "a\ta/NN/x/0 b/\t5",  # one part only: taken for the tail
    ]
    assert reasons(lines, values) == {}
    rows = parse_arcs(lines(values)).orderBy("line_id").collect()
    assert [[t["ptr"] for t in r["toks"]] for r in rows] == [[0, 1, 4, 2], [0], [0, 1], [0]]


def test_every_line_is_kept_or_rejected(lines):
    values = [GOOD, "are", "x\ty/NN/z/0", "", "q\tq/q/q"]
    df = lines(values)
    assert parse_arcs(df).count() + reject_arcs(df).count() == len(values)


def test_labels(lines):
    df = lines(["dog animal TRUE", " cat\tanimal  false ", "a b", "a b c true", "a b maybe", ""])
    kept = parse_labels(df).orderBy("line_id").select("w1", "w2", "label").collect()
    assert [tuple(r) for r in kept] == [("dog", "animal", True), ("cat", "animal", False)]
    lost = {r["value"]: r["reason"] for r in reject_labels(df).collect()}
    assert lost == {
        "a b": "field count", "a b c true": "field count", "a b maybe": "no truth value", "": "field count",
    }


def test_rejects_are_parsed_once(lines):
    plan = reject_arcs(lines([GOOD, "are"]))._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan
