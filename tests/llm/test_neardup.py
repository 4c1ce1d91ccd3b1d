import numpy as np

from appraise.llm import components, neardup
from tests.llm.helpers import BLANK_WORDS, edited, frame, low, odd_texts, text_of
from tests.llm import helpers


def shingles(text):
    w = BLANK_WORDS.findall(low(text))
    return {tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    comp = helpers.components(len(docs), links)
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if comp[j] == comp[k] and docs[j][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(sets[k]), least, i == least))
    return out


def check(spark, docs):
    got = neardup.groups(frame(spark, docs)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(docs), key=repr)


def test_copies_near_copies_and_odd_texts(spark):
    docs = odd_texts()
    for f in range(30):
        base = text_of(60 + 11 * f, 100 + f, 10 ** 6)
        docs += [(1000 + 10 * f + k, edited(base, share, 17 * f + k)) for k, share in enumerate((0, 0, 0.01, 0.02, 0.03, 0.05, 0.08))]
    docs.append((90, text_of(80, 1).upper()))
    check(spark, docs)


def test_a_chain_is_one_component(spark):
    words = text_of(400, 77, 10 ** 6).split(" ")
    docs = [(50 - i, " ".join(words[10 * i:10 * i + 120])) for i in range(25)]
    check(spark, docs)


def test_dense_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 24)
    monkeypatch.setattr(neardup, "ANCHORS", 3)
    base = text_of(150, 5, 10 ** 6)
    docs = [(i, edited(base, 0.002 * (i % 60), i)) for i in range(150)]
    check(spark, docs)


def test_pairs_that_are_alike_by_a_crowded_passage(spark):
    """Documents of one passage and as much text of their own, and pairs that are alike by that passage alone, at exactly 0.75."""
    passage = text_of(304, 12, 10 ** 6)

    def page(own, seed):
        return passage + " " + text_of(own, seed, 10 ** 8)
    docs = [(i, page(300, 10_000 + i)) for i in range(3000)]
    pairs = [(5000 + k, page(50, 20_000 + k)) for k in range(24)]
    for k in range(0, 24, 2):
        one, two = shingles(pairs[k][1]), shingles(pairs[k + 1][1])
        assert 100 * len(one & two) == 75 * len(one | two)
    got = {r.doc_id: r.component_id for r in neardup.groups(frame(spark, docs + pairs)).collect()}
    assert {got[i] for i, _ in pairs} == {5000} and all(got[i] == i for i, _ in docs)


def test_dense_pairs_connect_all_links(spark):
    rng, sets = np.random.default_rng(9), []
    for k in range(160):  # overlapping pieces of a few shared runs, and some shingles of their own
        run, size = k % 4, int(rng.integers(20, 60))
        start = int(rng.integers(0, 20))
        sets.append(np.unique(np.concatenate([1000 * run + np.arange(start, start + size), rng.integers(10 ** 6, 10 ** 9, int(rng.integers(0, 12)))])))
    sets += [sets[0][:-1], sets[1][1:], np.array([5]), np.array([5, 6, 7, 8]), np.array([5, 6, 7])]
    rows = [(i, len(x), bytearray(x.astype(np.int64).tobytes())) for i, x in enumerate(sets)]
    got = neardup.dense_pairs(spark.createDataFrame(rows, "cid long, n long, set binary")).collect()
    comp = helpers.components(len(sets), [(r.a, r.b) for r in got])
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - both)]
    assert len(links) > 20 and all(comp[i] == comp[j] for i, j in links)


def test_rows_of_a_dense_region_are_told_whatever_the_batches():
    import pyarrow as pa
    rows = [(t, bytes([h] * 8) + bytes([i] * 8), 100 * t + 10 * h + i) for t, h, k in ((0, 1, 9), (0, 2, 3), (1, 2, 5), (1, 3, 2), (2, 1, 8), (2, 2, 3)) for i in range(k)]
    for size in (1, 2, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary()), pa.array([r[2] for r in part])],
                                              ["t", "key", "cid"]) for at in range(0, len(rows), size) for part in [rows[at:at + size]]]
        got = {(a, b) for out in neardup._neighbours(iter(batches)) for a, b in zip(*out.to_pydict().values(), strict=True)}
        near = {(x[2], y[2]) for i, x in enumerate(rows) for y in rows[i + 1:i + 4] if x[0] == y[0] and x[1][:8] == y[1][:8]}
        assert {p for p in got if p[0] != p[1]} == near
        dense = {p[0] for p in got if p[0] == p[1]}
        assert dense == {10 + i for i in range(9)} | {120, 124} | {210 + i for i in range(8)} | {220, 221, 222}


def test_groups_of_a_cluster_without_links_are_bounded(spark, monkeypatch):
    """Pages of one template, 0.6 alike, form one cluster of single classes: no task may get all of them as one group."""
    monkeypatch.setattr(neardup, "BLOCK", 10)
    monkeypatch.setattr(neardup, "ANCHORS", 2)
    template, sizes, confirmed = text_of(300, 6, 10 ** 6), [], neardup._confirmed

    def counted(rows):
        sizes.append(rows.groupBy("cluster", "block").count().agg({"count": "max"}).first()[0])
        return confirmed(rows)
    monkeypatch.setattr(neardup, "_confirmed", counted)
    docs = [(i, template + " " + text_of(80 if i % 50 else 30, 700 + i, 10 ** 6)) for i in range(250)]
    check(spark, docs)
    assert len(sizes) == 2 and max(sizes) <= 60


def test_cells_cover_all_pairs_of_different_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = [(1, i, 10, -1 if i % 3 else i) for i in range(40)] + [(2, 50 + i, 10, 50) for i in range(5)]
    got = neardup.cells(spark.createDataFrame(rows, "cluster long, cid long, n long, part long")).collect()
    at = [(r.cid, c.block, c.side) for r in got for c in r.cells]
    met = sorted((a, b) for a, x, s in at for b, y, t in at if a < b and x == y and s | t == 3)
    assert met == sorted((a, b) for b in range(40) for a in range(b) if a % 3 == 0 or b % 3 == 0)


def test_empty(spark):
    assert neardup.groups(frame(spark, [])).count() == 0
    assert [tuple(r) for r in neardup.groups(frame(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(4)
    for n, m in ((40, 20), (200, 180), (200, 400)):
        edges = [tuple(map(int, e)) for e in rng.integers(0, n, (m, 2))]
        edges += [(i, i + 1) for i in range(n, n + 60)]
        df = spark.createDataFrame([*edges, (3, 3), edges[0]], "a long, b long")
        got = {r.id: r.root for r in components.components(df, "test").collect()}
        want = helpers.components(n + 61, [e for e in edges])
        assert got == {i: c for i, c in enumerate(want) if c != i}
