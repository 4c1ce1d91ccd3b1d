import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from appraise.llm import ppm
from appraise.llm.tables import training
from appraise.llm.textcols import texts_of
from tests.llm.helpers import BLANK_WORDS, frame, low, odd_texts, text_of


def symbols(text):
    return list(low(text).encode()) + [0xFE]


def trie(texts, share):
    """The counts of every context of up to ORDER bytes, and the bytes held for it."""
    count, total = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)], 0
    for t in texts:
        s = [0xFF] * ppm.ORDER + symbols(t)
        for i in range(ppm.ORDER, len(s)):
            total += 1
            for k in range(ppm.ORDER + 1):
                count[k][tuple(s[i - k:i])][s[i]] += 1
    return [{c: (sum(n.values()), held) for c, n in level.items() if (held := {b: v for b, v in n.items() if v >= share * total})} for level in count]


def brute(levels, text):
    s, out = [0xFF] * ppm.ORDER + symbols(text), 0.0
    for i in range(ppm.ORDER, len(s)):
        excluded = set()
        for k in range(ppm.ORDER, -1, -1):
            if (c := tuple(s[i - k:i])) not in levels[k]:
                continue
            total, held = levels[k][c]
            left = {b: n for b, n in held.items() if b not in excluded}
            escapes = total - sum(held.values()) + len(left)
            if s[i] in left:
                out += math.log10(left[s[i]] / (sum(left.values()) + escapes))
                break
            if sum(left.values()) + escapes:
                out += math.log10(escapes / (sum(left.values()) + escapes))
            excluded = set(held)
        else:
            out -= math.log10(ppm.SYMBOLS - len(excluded))
    return out


@pytest.mark.parametrize("share", [2.0 ** -22, 0.002])
def test_scores_against_brute_force(spark, share, monkeypatch):
    docs = [d for d in odd_texts() if d[0] not in (8, 9)] + [(100 + i, text_of(20 + i, i, 40 if i % 2 else 4000)) for i in range(50)]
    train = [(i, t) for i, t in docs if zlib.crc32((str(i) if i is not None else "").encode()) % 10]
    df = frame(spark, docs)
    monkeypatch.setattr(ppm, "TOKEN_SHARE", share)
    build = ppm.build
    monkeypatch.setattr(ppm, "build", lambda grams: build(grams, share))
    got = ppm.score(df, df.where(training("doc_id", ppm.FOLD))).collect()
    count = Counter(w for _, t in train for w in BLANK_WORDS.findall(low(t)) + ["\nend"])
    n, v, levels = sum(count.values()), len(count), trie([t for _, t in train], share)
    want = []
    for i, t in docs:
        w = BLANK_WORDS.findall(low(t)) + ["\nend"]
        want.append((i, zlib.crc32((str(i) if i is not None else "").encode()) % 10 == 0, len(w), sum(count[x] > 0 for x in w), n,
                     sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), brute(levels, t)))
    for a, b in zip(sorted(map(tuple, got), key=repr), sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_of_all_next_symbols_add_up_to_one(spark):
    docs = frame(spark, [(i, text_of(30, i, 60)) for i in range(12)])
    t = ppm.build(ppm.counts(docs).where("kind = 1").select("key", "n"), 0.001)
    for context in (b"\xff\xff\xff\xff\xff", b"w1 w1", b"zz w1", b"zzzzz", b"\xff\xff\xffw1"):
        head = int.from_bytes(context, "big") << 8
        code = np.array([head | s for s in range(256)], np.uint64)
        total = (10 ** t.log10(code)).sum()
        assert total == pytest.approx(1, abs=1.1 * 10 ** t.log10(code).min() + 1e-9)  # the 257th symbol stands for none


@pytest.mark.parametrize("common", [2.0, 0.002])
def test_grams_that_are_joined_score_as_those_that_are_broadcast(spark, common, monkeypatch):
    docs = [d for d in odd_texts() if d[0] not in (8, 9)] + [(100 + i, text_of(20 + i, i, 40 if i % 2 else 4000)) for i in range(30)]
    monkeypatch.setattr(ppm, "TRIE_SHARE", common)
    df = frame(spark, docs)
    got = ppm.score(df, df.where(training("doc_id", ppm.FOLD))).collect()
    levels = trie([t for i, t in docs if zlib.crc32((str(i) if i is not None else "").encode()) % 10], 0)
    want = sorted(((i, brute(levels, t)) for i, t in docs), key=repr)
    for a, b in zip(sorted(((r.doc_id, r.score) for r in got), key=repr), want, strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-9)


def test_a_byte_seen_once_among_millions_counts(spark):
    """Of 5 million positions one is less than a share of 2^-22."""
    n, rare = 5_000_000, text_of(20, 3)
    levels = trie(["a" * 20, rare], 0)
    for k, level in enumerate(levels):  # the other n - 20 times that an "a" follows some
        total, held = level[(97,) * k]
        level[(97,) * k] = (total + n - 20, {**held, 97: held[97] + n - 20})
    train = frame(spark, [(1, "a" * n), (2, rare)])
    new = "w1 " + rare[:30] + "aab"
    got = {r.doc_id: r.score for r in ppm.score(frame(spark, [(3, rare), (4, new)]), train).collect()}
    assert got == {3: pytest.approx(brute(levels, rare), rel=1e-9), 4: pytest.approx(brute(levels, new), rel=1e-9)}


def test_index_finds_its_keys_only():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 40, 5000)).astype(np.uint64)
    index = ppm.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000).astype(np.uint64), keys)
    assert (index.find(other) == -1).all() and ppm.Index(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


def test_gram_codes_do_not_cross_texts():
    import pyarrow as pa
    code, begin = ppm.gram_codes(texts_of(pa.array(["Ab", None, "c"])))
    assert begin.tolist() == [0, 3, 4]
    assert [c.to_bytes(6, "big") for c in code.tolist()] == [b"\xff" * 5 + b"a", b"\xff" * 4 + b"ab", b"\xff\xff\xffab\xfe", b"\xff" * 5 + b"\xfe",
                                                             b"\xff" * 5 + b"c", b"\xff" * 4 + b"c\xfe"]


def test_nothing_to_learn_and_empty(spark):
    none = frame(spark, [])
    got = ppm.score(frame(spark, [(1, "ab"), (2, None)]), none).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 2, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert {round(r.score, 9) for r in got} == {round(-3 * math.log10(257), 9), round(-math.log10(257), 9)}
    assert ppm.score(none, frame(spark, [(1, "ab")])).count() == 0
