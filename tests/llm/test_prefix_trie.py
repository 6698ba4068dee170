import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def lists(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def brute_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100  # the remainder has the sign of c
        out[c] = convs.get(c - base, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(nodes):
    return sorted(map(tuple, nodes.select(*COLUMNS).collect()))


def own_trie(turns, store):
    numbered = prefix_trie.numbered_turns(turns, store)
    return prefix_trie.prefix_trie(numbered, turns.select("conv_id").distinct(), store)


def test_rebuilt_like_brute_force(spark, store):
    """Ties, repeats, nulls, negative ids, conversations without turns of their own, a hot one and equal ones."""
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 260, 3), *range(-250, -90, 7), 100, 200, -100, 4000]:
        rows += [(c, t, rng.choice(["user", None, "bot"]), f"é{rng.randrange(3)}" * rng.randrange(4)) for t in range(rng.randrange(1, 9))]
    rows += [(3, None, "user", "first"), (3, None, "user", "a"), (6, 1, "user", "tie"), (6, 1, "user", "tie"), (6, 1, "bot", "tie")]
    rows += [(9, 5, "x" * 40 + "b", "1"), (9, 5, "x" * 40 + "a", "2"), (9, 5, "x" * 16, "3"), (None, 0, "user", "nobody")]
    rows += [(5000, t, "user", f"hot {t}") for t in range(3000)] + [(5001, t, "user", f"hot {t}") for t in range(2000)]
    rows += [(6000 + i, t, "user", "the same") for i in range(60) for t in range(3)]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("place", "depth", "steps", "label", "key")})
    got = plain(prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns.repartition(6), store), store))
    assert got == brute_trie(brute_rebuilt(lists(rows)))


def test_many_ways_to_share(spark, store):
    """Few texts, so that conversations part and end at every depth, and labels are split again and again."""
    rng = random.Random(5)
    rows = [(c, t, "u", rng.choice("aab")) for c in range(400) for t in range(rng.randrange(1, 12))]
    rows += [(1000 + n, t, "u", "a") for n in range(33) for t in range(n)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert plain(own_trie(turns, store)) == brute_trie(lists(rows))


def test_empty_and_rootless(spark, store):
    none = spark.createDataFrame([], SCHEMA)
    assert plain(prefix_trie.prefix_trie(*prefix_trie.rebuilt(none, store), store)) == []
    # where h is 2 or more and there is no first conversation, nothing is left of two turns
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    turns = spark.createDataFrame([(c, 0, "user", "a"), (c, 1, "user", "b")], SCHEMA)
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert plain(prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, store), store)) == [(c, 0, None, 1, 0, 1, 0, ends)]


def test_two_fattest(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", prefix_trie.two_fattest(F.col("a"), F.col("b"))).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_lists_longer_than_a_segment(spark, store, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_SEGMENT", 50)
    ends = spark.range(0, 3000).selectExpr("id AS conv_id", "id % 2 AS d1", "IF(id < 2000, 7L, 8L) AS d2")
    got = {(r.d1, r.d2): r.ends_sha256 for r in prefix_trie._end_lists(ends).collect()}
    for a in (0, 1):
        for b, part in ((7, range(a, 2000, 2)), (8, range(2000 + a, 3000, 2))):
            assert got[a, b] == hashlib.sha256(",".join(map(str, part)).encode()).hexdigest()
