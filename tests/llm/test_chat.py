import random

from pathfeat.llm.chat import chat_texts


def brute(rows):
    turns = {}
    for key, turn, role, text in set(rows):
        if key is not None:
            turns.setdefault(key, []).append((turn, role, text))
    order = lambda t: [(x is not None, x or (0 if i == 0 else "")) for i, x in enumerate(t)]
    turns = {k: [t[1:] for t in sorted(v, key=order)] for k, v in turns.items()}
    out = []
    for key, own in turns.items():
        if any(len(v) > len(own) and v[: len(own)] == own for v in turns.values()):
            continue
        same = [k for k, v in turns.items() if v == own]
        if key == min(same):
            text = "".join(f"<|{'none' if r is None else r}|>\n{t or ''}\n" for r, t in own)
            out.append((key, len(own), len(same), text))
    return sorted(out)


def test_chat(spark):
    rnd = random.Random(4)
    rows = []
    for c in range(150):
        base = random.Random(c % 40)
        whole = [(i, base.choice(["user", "assistant", None]), base.choice(["a", "b", "", None, "c"])) for i in range(6)]
        rows += [(c, *t) for t in whole[: rnd.randint(1, 6)]]
    rows += [(500, None, "user", "x"), (500, 0, None, None), (500, 0, "none", ""), (501, 7, "user", "gap"), (501, 9, "user", "gap")]
    rows += [(None, 0, "user", "lost"), (0, *rows[0][1:]), (502, 0, "user", "long " * 20_000)]
    rows += [(600 + i, n, "user", "same") for i in range(50) for n in range(3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, n int")
    got = sorted(map(tuple, chat_texts(df.repartition(5)).collect()))
    assert got == brute(rows)
    assert chat_texts(df.where("conv_id > 9000")).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat_texts(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
