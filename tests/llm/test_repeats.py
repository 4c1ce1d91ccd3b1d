import hashlib
import random

import numpy as np
import pytest

from appraise.llm import repeats
from tests.llm.helpers import edited, frame, odd_texts, text_of


def brute(texts, length):
    """{row: (doc_id, bytes, removed spans, kept bytes)} from the definition; ids must be unique or rows equal."""
    body = [(i, (t or "").encode()) for i, t in texts]
    first = {}
    for i, b in body:
        for s in range(len(b) - length + 1):
            place = (-1 if i is None else i, s)
            w = b[s:s + length]
            if w not in first or place < first[w]:
                first[w] = place
    out = []
    for i, b in body:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (-1 if i is None else i, s):
                gone[s:s + length] = [True] * length
        spans, at = [], 0
        while at < len(b):
            if gone[at]:
                end = at
                while end < len(b) and gone[end]:
                    end += 1
                spans.append((at, end))
                at = end
            else:
                at += 1
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def found(df, **settings):
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in repeats.remove(df, **settings).collect()), key=str)


def corpus(n, seed, vocabulary=40):
    rng = random.Random(seed)
    texts = [text_of(rng.randrange(0, 60), seed * 1000 + i, vocabulary) for i in range(n)]
    passage = text_of(30, seed, 500)
    for i in range(0, n, 3):
        cut = rng.randrange(len(texts[i]) + 1)
        texts[i] = texts[i][:cut] + passage[rng.randrange(40):] + texts[i][cut:]
    texts += [edited(t, 0.05, i) for i, t in enumerate(texts[::4])] + texts[::7] + [passage * 3]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize("length,gram", [(100, 32), (24, 8), (12, 12), (9, 2), (5, 1)])
def test_equals_the_definition(spark, length, gram):
    texts = corpus(60, length)
    assert found(frame(spark, texts).repartition(7), length=length, gram=gram) == brute(texts, length)


def test_crowded_keys_are_split_to_the_end(spark):
    rng = random.Random(4)
    core = text_of(12, 77, 900)[:40]
    texts = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(50))) + core + "".join(rng.choice("ab") for _ in range(rng.randrange(50)))) for i in range(150)]
    want = brute(texts, 30)
    assert found(frame(spark, texts), length=30, gram=10, group=3) == want
    assert found(frame(spark, texts), length=30, gram=10) == want


def test_odd_texts_overlaps_and_runs(spark):
    texts = odd_texts() + [(20, "x" * 250), (21, "ab" * 300), (22, "\0" * 130 + "q" + "\0" * 130), (23, "é" * 120), (24, "y" * 99), (25, "y" * 100), (26, "y" * 101)]
    assert found(frame(spark, texts)) == brute(texts, 100)
    assert found(frame(spark, texts).where("false")) == []


def test_long_texts_are_scanned_in_parts(spark, monkeypatch):
    whole = text_of(9000, 3, 2000)
    texts = [(1, whole), (2, whole[20_000:45_000] + "end"), (3, text_of(4000, 8, 2000) + whole[:3000])]
    monkeypatch.setattr(repeats, "SPAN", 7001)
    monkeypatch.setattr("appraise.llm.textcols.CHUNK_BYTES", 5000)
    t = next(repeats.slices(iter(frame(spark, texts).select("text").toArrow().to_batches())))[1]
    one = repeats.scan(t, 100, 32)
    monkeypatch.setattr(repeats, "SPAN", 1 << 22)
    assert len(one[0]) > len(repeats.scan(t, 100, 32)[0])  # cut at the parts' ends
    starts = np.concatenate([s + np.arange(n) for s, n in zip(one[1], one[2])])
    assert sorted(starts) == list(range(len(whole.encode()) - 99))
    assert found(frame(spark, texts)) == brute(texts, 100)


def test_rows_of_one_id(spark):
    a, b = text_of(40, 1), text_of(40, 2)
    texts = [(5, a), (5, a), (5, b + a), (None, b), (6, b)]
    got = found(frame(spark, texts))
    by = {(r[0], r[1]): r for r in got}
    assert [r for r in got if r[0] == 5 and r[1] == len(a)] == [(5, len(a), [], a.encode())] * 2  # an earlier start in a text of the same id
    assert by[(None, len(b))][2] == [] and by[(6, len(b))][2] == [(0, len(b))]
    assert by[(5, len(a) + len(b))][3] == b""  # b stands in the null id's text, a earlier under its own id


def test_report(spark):
    texts = corpus(20, 2)
    got = sorted((tuple(r) for r in repeats.report(frame(spark, texts)).collect()), key=str)
    assert got == sorted(((i, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute(texts, 100)), key=str)
