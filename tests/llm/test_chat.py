import random

from corpusmill.llm import chat_snapshots as cs


def brute(rows):
    key = lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""))
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    seq = {c: [(r[2], r[3]) for r in sorted(v, key=key)] for c, v in convs.items()}
    order = sorted(seq, key=lambda c: (c is None, c or 0))
    out = []
    for c in order:
        s = seq[c]
        longer = any(len(o) > len(s) and o[: len(s)] == s for o in seq.values())
        earlier = any(seq[o] == s for o in order[: order.index(c)])
        kept = not longer and not earlier
        chat = "".join(f"<|im_start|>{a or ''}\n{b or ''}<|im_end|>\n" for a, b in s) if kept else None
        out.append((c, len(s), kept, chat))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    return sorted((tuple(r) for r in cs.format_conversations(df).collect()), key=repr)


def test_snapshots_collapse(spark):
    rng = random.Random(1)
    rows, n = [], 0
    for _ in range(60):
        turns = [(("user", "assistant")[i % 2], f"t{rng.randrange(3)}") for i in range(rng.randint(1, 8))]
        for upto in range(1, len(turns) + 1, rng.randint(1, 3)):
            rows += [(n, i, *t) for i, t in enumerate(turns[:upto])]
            n += 1
    assert run(spark, rows) == brute(rows)


def test_long_conversation_over_blocks(spark):
    long = [(1, i, "user", f"m{i}") for i in range(700)]
    rows = long + [(2, i, "user", f"m{i}") for i in range(650)] + [(3, i, "user", f"m{i}") for i in range(64)] + [(4, i * 50, "user", f"m{i}") for i in range(65)] + [(5, i, "user", f"m{i + 1}") for i in range(64)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 1, "", ""), (None, 0, "user", "x"), (None, 1, "user", "y"), (2, 0, "user", "x"), (3, 0, "user", "x"), (4, 0, "user", None), (5, 0, "user", ""), (6, -5, "user", "q"), (6, 70, "user", "q"), (7, 0, "user", "q")]
    assert run(spark, rows) == brute(rows)
    doubled = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    assert run(spark, doubled) == brute(doubled)
    assert run(spark, []) == []


def test_plan_has_no_python_and_extra_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "c", 1)], "conv_id long, turn long, role string, text string, chat string, _k int")
    out = cs.format_conversations(df)
    assert out.columns == ["conv_id", "n_turns", "kept", "chat"]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
