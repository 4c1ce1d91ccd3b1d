import itertools

import numpy as np

from appraise.llm import quality
from tests.llm.helpers import BLANK_WORDS, frame, odd_texts, text_of


def base(text):
    text = text or ""
    w = BLANK_WORDS.findall(text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = {x for x in wins if wins.count(x) > 1} if len(wins) < 5000 else set()
    hit = {i + j for i, x in enumerate(wins) if x in many for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK_WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def docs_and_labels(spark, n=160):
    docs, labels = [], []
    for i in range(n):
        good = "\n".join(text_of(12, 1000 * i + k, 400).replace("w", "word") + "." for k in range(8))
        bad = "\n".join(" | ".join(f"MENU{(i + k + j) % 50}!!" for j in range(9)) + " ### $$$" for k in range(8))
        docs.append((i, good if i % 2 else bad))
        labels.append((i, i % 2, 0))
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_counts_against_brute_force(spark):
    line = text_of(20, 3)
    docs = odd_texts() + [(30, "\n".join([line, line, " ", " ", line + "x"])), (31, "a b c a b c a b"), (32, "é# é# é# |<>"), (33, (line + " ") * 5), (34, "a\r\na\n\na")]
    docs = [d for d in docs if d[0] != 8]
    got = quality.judge(frame(spark, docs), None).collect()
    want = [(i, *base(t)[:5], base(t)[5]) for i, t in docs]
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.kept != r.base_failed for r in got)  # nothing learned: the fixed counts decide


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    count = np.array([3, 1, 0, 6, 2])
    e, t = rng.normal(size=(count.sum(), 2)), rng.normal(size=(2, 2))
    got, at = quality.viterbi(e, count, t), 0
    for n in count:
        def score(y):
            return sum(e[at + i, y[i]] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1))
        best = max(itertools.product((0, 1), repeat=int(n)), key=score)
        assert tuple(got[at:at + n]) == best
        at += n


def test_learns_and_keeps_clean_held_out_documents(spark):
    docs, labels = docs_and_labels(spark)
    model = quality.train(frame(spark, docs[:80]), labels)
    got = {r.doc_id: r for r in quality.judge(frame(spark, docs[80:]), model).collect()}
    assert all(got[i].kept == bool(i % 2) for i, _ in docs[80:])
    kept = quality.keep(frame(spark, docs[80:]), model)
    assert kept.columns == frame(spark, []).columns and {r.doc_id for r in kept.collect()} == {i for i in range(81, 160, 2)}


def test_empty_and_one_sided_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(frame(spark, odd_texts()), none) is None
    assert quality.judge(frame(spark, []), None).count() == 0
    both = spark.createDataFrame([(5, 0, 0), (5, 1, 0), (7, 1, 0), (None, 0, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.train(frame(spark, odd_texts()), both) is None
