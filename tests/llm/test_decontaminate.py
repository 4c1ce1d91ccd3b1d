import hashlib

from appraise.llm import decontaminate
from tests.llm.helpers import ALNUM_WORDS, frame, low, odd_texts, text_of


def brute(docs, items):
    out = []
    for i, text in docs:
        w = ALNUM_WORDS.findall(low(text))
        hit, names = set(), set()
        for item, body in items:
            v = ALNUM_WORDS.findall(low(body))
            n = min(10, len(v))
            wins = {tuple(v[p:p + n]) for p in range(len(v) - n + 1)} if n else set()
            for p in range(len(w) - n + 1 if n else 0):
                if tuple(w[p:p + n]) in wins:
                    hit.update(range(p, p + n))
                    names.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def test_against_brute_force(spark):
    a, b = text_of(40, 21), text_of(25, 22)
    items = [(1, a), (10, b), (2, "Short one here!"), (3, None), (4, ""), (2, "Short one here!"), (None, text_of(12, 30)), (11, " ".join(a.split(" ")[3:30]))]
    docs = odd_texts() + [
        (20, "begin " + a.upper() + " end"), (21, text_of(30, 3) + " " + " ".join(a.split(" ")[5:15])), (22, " ".join(a.split(" ")[5:14])),
        (23, "SHORT, one (here) and short one here"), (24, b + "\n" + b), (25, " ".join(a.split(" ")[:12] + b.split(" ")[:12])), (26, text_of(12, 30))]
    got = decontaminate.contamination(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(docs, items), key=repr)


def test_every_offset_of_a_shared_span_is_found(spark):
    a = text_of(30, 40).split(" ")
    docs = [(i, text_of(i % 13, i) + " " + " ".join(a[i:i + 10]) + " " + text_of(7, 90 + i)) for i in range(21)]
    got = decontaminate.contamination(frame(spark, docs), spark.createDataFrame([(1, " ".join(a))], "item_id long, text string")).collect()
    assert all(r.n_hit == 10 and r.contaminated for r in got)


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(frame(spark, [(1, "a b c")]), items).collect()] == [0]
    assert decontaminate.contamination(frame(spark, []), items).count() == 0
