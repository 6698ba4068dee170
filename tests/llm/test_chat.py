import random

from ledgerloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for r in set(rows):
        convs.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    lists = {
        c: [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))] for c, ts in convs.items()
    }
    out = {}
    for c, turns in lists.items():
        equal = [d for d, other in lists.items() if other == turns]
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in lists.values())
        if not longer and c == min(equal, key=lambda d: (d is None, d or 0)):
            text = "".join(f"<|im_start|>{role}\n{body}<|im_end|>\n" for role, body in turns)
            out[c] = (len(turns), len(equal), text)
    return out


def result(df):
    return {r.conv_id: (r.n_turns, r.n_equal, r.text) for r in df.collect()}


def test_like_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in range(300):
        base = rng.randrange(40)
        rows += [(c, t, "user" if t % 2 else "assistant", f"text {base % 7 if t < 2 else base} {t}") for t in range(rng.randint(1, 7))]
    rows += [(900, t, "user", f"long {t} " * 50) for t in range(400)] + [(901, t, "user", f"long {t} " * 50) for t in range(399)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(chat.formatted(df)) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, None, "b"),
        (2, 0, "user", ""),
        (3, None, "user", ""),
        (3, 1, "", "b"),
        (3, 1, "", "b"),
        (4, 0, "user", "x"),
        (4, 0, "user", "a"),
        (None, 0, "user", "n"),
        (5, 0, "user", "x" * 200000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS n_turns", "3 AS _conv")
    assert result(chat.formatted(df)) == brute(rows)
    assert chat.formatted(df.filter("turn > 99")).count() == 0


def test_a_prefix_by_text_only_is_no_snapshot(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "ab"), (3, 0, "user", "a<|im_end|>\n"), (4, 0, "user", "a"), (4, 1, "user", "b")]
    assert set(result(chat.formatted(spark.createDataFrame(rows, SCHEMA)))) == {2, 3, 4}


def test_roles_can_be_renamed(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "hi")], SCHEMA)
    assert chat.formatted(df, {"assistant": "model"}).first().text == "<|im_start|>model\nhi<|im_end|>\n"
