import pytest

from appraise.llm import license
from tests.llm.helpers import ALNUM_WORDS, frame, low, odd_texts, text_of


def brute(text):
    """Every window that holds a shingle of a template, as if all of them were retrieved."""
    w = ALNUM_WORDS.findall(low(text))
    sh = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    out = {}
    for t, (name, body) in enumerate(license.TEMPLATES):
        v = license.template_words(body)
        own = {tuple(v[i:i + 5]) for i in range(len(v) - 4)}
        m, best = len(v) - 4, None
        for k in range((len(sh) - 1) // 5 + 1 if sh else 0):
            if not any(s in own for s in sh[5 * k:5 * k + 6]):
                continue
            at = [i for i in range(max(0, 5 * k - 2 * m), min(len(sh), 5 * k + 6 + 2 * m)) if sh[i] in own]
            n = len({sh[i] for i in at})
            if 100 * n >= 75 * len(own) and (best is None or (n, -at[0]) > best):
                best = (n, -at[0])
        if best:
            out[t] = -best[1]
    names = ",".join(sorted({license.TEMPLATES[t][0] for t in out}))
    return len(out), names, min(out.values(), default=-1)


def test_templates_anywhere_in_a_text(spark):
    docs = odd_texts()
    for i, (_, body) in enumerate(license.TEMPLATES):
        for k in range(9):
            docs.append((100 + 10 * i + k, text_of(40 + k, i) + "\n" + (body.upper() if k % 2 else body) + " " + text_of(30, i + 50)))
        words = body.split(" ")
        docs.append((500 + i, " ".join(words[:len(words) // 2])))
        docs.append((600 + i, " ".join("x" if j == len(words) // 2 else w for j, w in enumerate(words))))
    docs.append((700, " ".join(b for _, b in license.TEMPLATES)))
    docs.append((701, (license.TEMPLATES[1][1] + " ") * 200))
    docs = [d for d in docs if d[0] != 8]
    got = license.scan(frame(spark, docs)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute(t)) for i, t in docs], key=repr)


def test_empty_and_short_templates(spark):
    assert license.scan(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        license.scan(frame(spark, [(1, "a")]), [("X", "only four words here")])
