import random
import re
import zlib

import numpy as np

from appraise.llm import langid
from tests.llm.helpers import frame, odd_texts

SOUNDS = {"aa": "the ing tion and er re".split(), "bb": "ung ich sch der keit ß".split(), "cc": "ción ado que os ña ll".split()}


def rows(n):
    rng, names = random.Random(3), sorted(SOUNDS)
    out = []
    for i in range(n):
        lang = names[0] if rng.random() < 0.7 else rng.choice(names)
        out.append((i, " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), lang))
    return out


def test_held_out_accuracy_and_folds(spark):
    data = rows(600)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = langid.identify(docs, langid.train(docs, each=60, landmarks=24)).collect()
    lang = {i: l for i, _, l in data}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_predictions_ignore_ids_and_languages(spark):
    data = rows(200)
    model = langid.train(spark.createDataFrame(data, "doc_id long, text string, lang string"), each=40, landmarks=12)
    a = spark.createDataFrame(data, "doc_id long, text string, lang string")
    b = spark.createDataFrame([(1000 - i, t, None) for i, t, _ in data], "doc_id long, text string, lang string")
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(a, model).collect()} == \
        {1000 - r.doc_id: (r.lang_pred, r.score) for r in langid.identify(b, model).collect()}


def test_odd_texts(spark):
    data = rows(100)
    model = langid.train(spark.createDataFrame(data, "doc_id long, text string, lang string"), each=20, landmarks=6)
    odd = odd_texts() + [(50, "123 !? 456"), (51, "١٢٣ ؟"), (52, "é")]
    got = langid.identify(frame(spark, odd), model).collect()
    assert len(got) == len(odd) and {r.doc_id for r in got if r.lang_pred == "und"} == {0, 1, 2, 50, 51}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert langid.identify(frame(spark, []), model).count() == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (None, "abc", "aa"), (2, None, "aa")], "doc_id long, text string, lang string")
    assert langid.train(docs) is None
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, None).collect()} == {("und", 0.0)}


def test_scores_against_plain_kernel_ridge(spark):
    """All rows as landmarks: the scores are those of weighted kernel ridge regression written out with sets."""
    data = [(i, t, l) for i, t, l in rows(60) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")

    def grams(text):
        b = re.sub(rb"[^a-z\x80-\xff]", b" ", text.lower().encode())
        return {(b + b"  ")[p:p + n] for p in range(len(b)) for n in (1, 2, 3)}
    sets, names = [grams(t) for _, t, _ in data], sorted({l for *_, l in data})
    gram = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    y = np.array([[l == n for n in names] for *_, l in data], float)
    w = (y / y.sum(axis=0)).sum(axis=1)[:, None]
    m = len(data)
    a = np.linalg.solve(gram.T @ (w * gram) + langid.RIDGE * (gram / m + 1e-6 * np.eye(m)), gram.T @ (w * y))
    want = {d[0]: s for d, s in zip(data, gram @ a, strict=True)}
    got = langid.identify(docs, langid.train(docs, each=1000, landmarks=1000)).collect()
    assert len(got) == m
    for r in got:
        s = want[r.doc_id]
        assert abs(r.score - min(max(s.max(), 0), 1)) < 1e-3 and s[names.index(r.lang_pred)] > s.max() - 1e-3


def test_repeated_ids_are_bounded_by_rows(spark):
    """One id on many equal rows and on rows of different text: at most ``each`` rows of a language are learned from."""
    data = [(1, f"abc def {i % 40}", "aa") for i in range(400)] + [(7, "ung sch keit", "bb")] * 50
    ids = [i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(ids[0] if i == 1 else ids[1], t, l) for i, t, l in data], "doc_id long, text string, lang string")
    model = langid.train(docs, each=5, landmarks=1000)
    assert model.languages == ["aa", "bb"] and model.marks.shape[1] <= 10
    got = {r.text: r.lang_pred for r in langid.identify(docs, model).join(docs, "doc_id").select("text", "lang_pred").where("text not like 'abc%'").distinct().collect()}
    assert got == {"ung sch keit": "bb"}
