"""Small inputs and plain brute-force versions that the tests of tests/llm share."""

import random
import re

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return (text or "").translate(UP)


def text_of(n, seed, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in text.split(" "))


def frame(spark, texts, **more):
    """doc_id, text and columns whose names clash with those the operators use inside."""
    rows = [(i, t, f"{i}", 7, "other", b"k", 1.5) for i, t in texts]
    kind = "doc_id long, text string, rid string, key int, words string, band binary, n double"
    return spark.createDataFrame(rows, kind)


def odd_texts():
    """Null, empty, blank, short, non-ASCII, repeated and very long texts."""
    long = text_of(60_000, 5)
    return [(0, None), (1, ""), (2, " \n\t\n "), (3, "One"), (4, "Ünïcode ÆØÅ 漢字 \U0001F600 text"), (5, text_of(80, 1)), (6, text_of(80, 1)),
            (7, text_of(80, 2)), (7, text_of(80, 2)), (8, long), (9, "x" * 20_000), (10, "a b c d"), (11, "A b  c\td"), (None, text_of(70, 9)),
            (12, "\x1f<|endoftext|>\x00 end")]


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
