import numpy as np
import public_tokenizers
import pytest

from appraise.llm import tokencount
from tests.llm.helpers import frame, odd_texts, text_of

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((start, i - start))
            start = i + 1
    return out + ([(start, len(ids) - start)] if start < len(ids) else [])


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block", [1, 3, 64, 5000])
def test_blocks_of_any_size(spark, width, block):
    rng = np.random.default_rng(block)
    files = {"none": [], "one": [7], "only ends": [9] * 5, "no end": [1, 2, 3] * 30, "mixed": rng.integers(0, 10, 400).tolist(),
             "rare": [9, *rng.integers(0, 9, 300).tolist(), 9, 9, 4]}
    rows = []
    for name, ids in files.items():
        data = np.array(ids, tokencount.WIDTHS[width]).tobytes()
        rows += [(name, p // width, bytearray(data[p:p + block * width])) for p in range(0, len(data), block * width)]
    np.random.default_rng(1).shuffle(rows := [tuple(r) for r in rows])
    blocks = spark.createDataFrame([(str(a), int(b), bytearray(c)) for a, b, c in rows], "file string, pos long, content binary")
    got = sorted((r.file, r.ordinal, r.start, r.n_tokens) for r in tokencount.scan(blocks, 9, width).collect())
    assert got == sorted((f, k, *d) for f, ids in files.items() for k, d in enumerate(brute(ids, 9)))


def test_flat_files_on_disk(spark, tmp_path):
    ids = np.random.default_rng(3).integers(0, 50, 1000)
    for k, part in enumerate((ids[:700], ids[700:], ids[:0])):
        (tmp_path / f"{k}.bin").write_bytes(part.astype("<u2").tobytes())
    got = tokencount.scan(tokencount.read_files(spark, str(tmp_path), block=64), 49).collect()
    want = [(k, *d) for part in (ids[:700], ids[700:]) for k, d in enumerate(brute(part.tolist(), 49))]
    assert sorted((r.ordinal, r.start, r.n_tokens) for r in got) == sorted(want)


@pytest.mark.parametrize("stretch", [7, 64, 200])
def test_stretches_of_the_prefix_scan(spark, tmp_path, monkeypatch, stretch):
    """Files of many blocks over many stretches, among them one whose documents span several of both."""
    monkeypatch.setattr(tokencount, "STRETCH", stretch)
    monkeypatch.setattr(tokencount, "TASK_BYTES", 1000)
    rng = np.random.default_rng(stretch)
    files = {"mixed": rng.integers(0, 12, 900).tolist(), "long": [1] * 500 + [9] + [2] * 450, "ends": [9] * 90, "last": [3] * 70 + [9]}
    for name, ids in files.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, "<u4").tobytes())
    blocks = tokencount.read_files(spark, str(tmp_path), width=4, block=7)
    assert blocks.count() == sum(-(-len(ids) // 7) for ids in files.values())
    found = tokencount.scan(blocks, 9, 4)
    assert found.rdd.getNumPartitions() == -(-4 * sum(map(len, files.values())) // 1000)
    got = sorted((r.file.rsplit("/", 1)[1][:-4], r.ordinal, r.start, r.n_tokens) for r in found.collect())
    assert got == sorted((f, k, *d) for f, ids in files.items() for k, d in enumerate(brute(ids, 9)))


def test_a_partial_id_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x01\x00\x02")
    with pytest.raises(Exception, match="buffer size"):
        tokencount.scan(tokencount.read_files(spark, str(tmp_path)), 9).collect()


def test_documents_count_as_the_tokenizer_says(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [d for d in odd_texts() if d[0] != 12] + [(100 + i, text_of(i, i)) for i in range(60)]
    got = tokencount.document_counts(frame(spark, docs).repartition(3), RANKS, PATTERN, 50256, block=100).collect()
    assert sorted([(r.doc_id, r.n_tokens) for r in got], key=repr) == sorted([(i, len(library.encode(t or "").ids)) for i, t in docs], key=repr)
    assert tokencount.document_counts(frame(spark, []), RANKS, PATTERN, 50256).count() == 0
