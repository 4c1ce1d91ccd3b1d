import hashlib
import random

import public_tokenizers
import pytest

from appraise.llm import bpe
from tests.llm.helpers import frame, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def strange(n):
    rng = random.Random(8)
    pick = (lambda: rng.randrange(32, 127), lambda: rng.randrange(1, 0x300), lambda: rng.randrange(0x2000, 0xD7FF), lambda: rng.randrange(0xE000, 0x110000),
            lambda: rng.choice([9, 10, 32, 0x1C, 0x85, 0xA0]))
    return ["".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(150))) for _ in range(n)] + ["ab" * 2000, "<|endoftext|> <|endoftext|>x<|endo", " " * 99 + "a"]


@pytest.mark.parametrize("most", [1 << 17, 3])
def test_ids_and_round_trip_equal_the_library(spark, library, most):
    docs = odd_texts() + [(100 + i, t) for i, t in enumerate(strange(120))]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(frame(spark, docs), PATH, most).collect()}
    want = set()
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert text == (t or "")
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == want


def test_lexicon_numbers_its_words_and_no_others():
    words = sorted({w.encode() for w in " the then thing sing singing ring ringing a ab abc zingé é".split(" ")} - {b""})
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, [[i, i + 1] for i in range(len(words))]))
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert lexicon.numbers([b"", b"th", b"thez", b"zzz", b"ringingg", b"\xc3"]).tolist() == [-1] * 6
    plain = sum(len(w) for w in words)
    assert len(lexicon.key) < plain and lexicon.ids[lexicon.first[2]:lexicon.first[3]].tolist() == [2, 3]
    assert bpe.Lexicon(bpe.compile_lexicon([], [])).numbers([b"a"]).tolist() == [-1]


def test_long_words_merge_as_short_ones():
    rules, rng = bpe.merges(PATH), random.Random(2)
    for n in (1, 2, 10, 47):
        for _ in range(60):
            w = bytes(rng.choice(b"abehinorst") for _ in range(n))
            assert rules.encode(w) == rules._encode_long(w) == rules.merged(w)


def test_decode_of_odd_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, [72, None, 10 ** 6, -4]), (2, None), (3, []), (4, [50256])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, PATH).collect()}
    assert got == {1: bpe.merges(PATH).bytes_of[72].decode(), 2: "", 3: "", 4: "<|endoftext|>"}
    assert bpe.digests(frame(spark, []), PATH).count() == 0


def test_the_lexicon_holds_at_most_the_wanted_number_and_whole_counts(spark):
    docs = frame(spark, [(i, " ".join(f"w{k}" for k in range(9) for _ in range(k + 1 if k < 7 else 7)) + " " + "y" * 100) for i in range(5)])
    for most in (0, 1, 2, 3, 4, 6, 100):
        words = {r.word for r in bpe.frequent(docs, PATH, most).collect()}
        assert len(words) <= most and not any(len(w) > bpe.LONGEST for w in words)
    assert " w" in {r.word for r in bpe.frequent(docs, PATH, 1).collect()} and len({r.word for r in bpe.frequent(docs, PATH, 100).collect()}) >= 10


def test_clashing_names_are_kept(spark):
    row = spark.createDataFrame([(1, "some text", "mine", "own", 5)], "doc_id long, text string, __text string, `__TEXT_` string, n long")
    got = bpe.encode(row, PATH, bpe.lexicon(row, PATH)).first()
    assert (got["__text"], got["__TEXT_"], got.n) == ("mine", "own", 5) and len(got.ids) == 2
