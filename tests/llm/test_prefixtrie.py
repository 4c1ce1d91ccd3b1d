import hashlib
import math
import random
import zlib

import pytest

from appraise.llm import prefixtrie

KIND = "conv_id long, turn long, role string, text string, depth string, x int, m string, n_convs double"


def brute(rows):
    """All nodes of the trie of rows (conv_id, turn, role, text), from the definition."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    seq = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seq[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]  # % as in SQL: towards zero
    nodes = {}
    for c, s in seq.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    out = []
    for n, members in nodes.items():
        below = [m for m in nodes if m[:len(n)] == n]
        ends = ",".join(map(str, sorted(c for c in members if len(seq[c]) == len(n))))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids.get(n, [])), sum(m not in kids for m in below),
                    sum((len(nodes[m]) - 1) * len(m[-1][1].encode()) for m in below if m), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, height=None):
    return sorted((tuple(r) for r in prefixtrie.trie(df, height).collect()), key=str)


def table(n, turns, seed, kinds=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, turns)):
            rows.append((c * rng.choice((1, 1, 2)) - 3 * (c % 2), t, rng.choice(("user", "assistant")), f"té{rng.randrange(kinds)}" * rng.randrange(3)))
    return rows


@pytest.mark.parametrize("n,turns,height", [(60, 9, None), (60, 9, 2), (40, 14, 1), (12, 60, 5)])
def test_every_node_equals_the_definition(spark, n, turns, height):
    rows = table(n, turns, n + turns)
    df = spark.createDataFrame([(*r, "d", 1, "m", 2.0) for r in rows], KIND).repartition(4)
    assert found(df, height) == brute(rows)


def test_deep_copies_cross_many_bands(spark):
    deep = [(f"turn {t}", "user") for t in range(90)]
    rows = [(c, t, role, text) for c in (5, 6, 7, 8, 23) for t, (text, role) in enumerate(deep[:90 - c])]
    df = spark.createDataFrame([(*r, "d", 1, "m", 2.0) for r in rows], KIND)
    want = brute(rows)
    assert found(df, 8) == want and found(df) == want


def test_odd_rows(spark):
    long = "x" * 300_000
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, None, None, None), (1, 0, "", ""), (1, 0, None, "tie"), (1, 0, "a", "tie"), (1, 0, "a", "tie"),
            (2, 5, "user", long), (2, 6, "user", long), (3, 0, "user", "only"), (9, 1, "a:b", "c"), (9, 2, "a", "b:c"), (-7, 0, "user", "neg"), (-5, 0, "user", "base")]
    df = spark.createDataFrame([(*r, "d", 1, "m", 2.0) for r in rows], KIND)
    assert found(df) == brute(rows)
    assert found(df.where("false")) == []


def test_a_hot_node_is_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE", 50)
    rows = [(5 * c, t, "user", "same") for c in range(400) for t in range(10)]
    df = spark.createDataFrame([(*r, "d", 1, "m", 2.0) for r in rows], KIND).repartition(6)
    assert found(df) == brute(rows)
