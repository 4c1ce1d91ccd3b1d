"""MinHash near-duplicates with an LSH forest, confirmed on full shingle sets.

1. One scan gives each document its set of 5-word shingles as 64-bit hashes, their number, a 128-bit key of
   the set, and a signature of 128 MinHashes. Documents with equal sets form one class.
2. The forest holds each class in 32 sorted orders; order t reads the signature as a ring from MinHash 4t. Neighbours
   in an order that share at least the first 4 MinHashes are candidates. A pair of similarity 0.75 shares those 4 in some
   order with probability 1 - 5e-6. Where a region of equal 4 MinHashes holds more classes than the neighbours read
   (many documents share a passage), deeper MinHashes would divide the pair nearly as fast as the region, so the depth goes on in the
   shingles themselves: such regions' classes are ordered by their rarest shingles, and any two that can be linked get connected exactly.
3. Neighbours whose signatures agree enough, and the pairs from dense regions, join up to clusters. A cluster's full shingle sets come together and all
   its pairs are compared (skipping pairs already joined), so a link between two members needs no order of
   its own. A cluster of more than ``BLOCK`` classes is cut to blocks, with some classes in all of them; if
   it then still falls into parts, the largest part and the classes outside of it are cut to blocks each, and every pair
   of blocks but those inside the largest part meets in a group of its own.
4. The confirmed links' connected components give every document its component.

Defined results: a document of fewer than five words has its whole word sequence as one shingle; null and
wordless texts have no shingles, are linked with nothing and kept; equal rows are copies of each other, and all
rows that carry a component's least doc_id are kept; null ids never become a component's id unless it has no
other. An empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.components import components
from appraise.llm.textcols import BLANK_WORD, Texts, binary, grams, mix, slices

SHINGLE, SHARE = 5, (75, 100)
MINHASHES, PREFIX, DEEPER, NEIGHBOURS = 128, 4, 4, 3
ORDERS = MINHASHES // PREFIX
#: Agreeing MinHashes (of 128) of a candidate that joins two classes to a cluster, and of a pair worth comparing
#: in full. A pair of similarity 0.75 agrees in 96 on average, with a standard deviation of 4.9.
CLUSTER_AGREE, PAIR_AGREE = 72, 74
#: Classes and shingles in a block of a large cluster, and classes that all its blocks share.
BLOCK, BLOCK_SHINGLES, ANCHORS = 256, 2_000_000, 16
#: Bits of the filter that picks the documents whose sets are fetched: 8 for each class, this many at most (32 MB).
MAX_BITS = 1 << 28
#: Shingles that one batch of a class's set has.
ROWS = 1 << 16

_rng = np.random.default_rng(75)
_A = _rng.integers(0, 1 << 31, MINHASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINHASHES, dtype=np.uint32)


def shingle_sets(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, one after another, and each text's number of them."""
    s, e, count = t.spans(BLANK_WORD)
    h = t.hashes(s, e, True)
    g, begin = grams(h, SHINGLE), np.cumsum(count) - count
    sizes = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    out, at = np.empty(int(sizes.sum()), np.uint64), np.cumsum(sizes) - sizes
    for d in range(t.n):
        if count[d] >= SHINGLE:
            part = out[at[d]:at[d] + sizes[d]]
            part[:] = g[begin[d]:begin[d] + sizes[d]]
            part.sort()
        elif count[d]:
            out[at[d]] = mix(grams(h[begin[d]:begin[d] + count[d]], int(count[d])) ^ np.uint64(count[d]))[0]
    if not len(out):
        return out, sizes
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[at[sizes > 0]] = True
    owner = np.repeat(np.arange(t.n), sizes)
    return out[new], np.bincount(owner[new], minlength=t.n)


def set_keys(g: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each non-empty set (0 for empty ones)."""
    full = sizes > 0
    one, two = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    if full.any():
        at = (np.cumsum(sizes) - sizes)[full]
        one[full] = np.add.reduceat(mix(g ^ np.uint64(0x5851F42D4C957F2D)), at).view(np.int64)
        two[full] = np.add.reduceat(mix(g + np.uint64(0x14057B7EF767814F)), at).view(np.int64)
    return one, two


def signatures(g: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 MinHashes of 16 bits for each set, big-endian (zeros for empty sets)."""
    full = sizes > 0
    out = np.zeros((len(sizes), MINHASHES), ">u2")
    if full.any():
        x, at = ((g >> np.uint64(32)) ^ g).astype(np.uint32), (np.cumsum(sizes) - sizes)[full]
        for j in range(MINHASHES):
            out[full, j] = (np.minimum.reduceat(x * _A[j] + _B[j], at) & np.uint32(0xFFFF)).astype(np.uint16)
    return out


def _sketch(batches):
    for batch, t in slices(batches):
        g, sizes = shingle_sets(t)
        one, two = set_keys(g, sizes)
        yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(sizes.astype(np.int64)), pa.array(one), pa.array(two),
                                          binary(signatures(g, sizes))], ["doc_id", *batch.schema.names[2:], "n", "s1", "s2", "sig"])


def _neighbours(batches):
    """Of rows (t, key, cid) in sorted order: pairs of near neighbours whose t and first PREFIX MinHashes agree, and as a pair
    (cid, cid) each row that agrees so with a row further on than its neighbours, or may do so with one of another task."""
    def pairs(x, y):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    far = NEIGHBOURS + 1
    t, head, cid, first = np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)[::(PREFIX + DEEPER) // 4]
        t = np.concatenate([t, batch.column(0).to_numpy()])
        head, cid = np.concatenate([head, keys]), np.concatenate([cid, batch.column(2).to_numpy()])
        fresh = len(t) - batch.num_rows
        first = first or (t[0], head[0])
        if (t[fresh], head[fresh]) == first:
            opening = cid[fresh:][(t[fresh:] == first[0]) & (head[fresh:] == first[1])]
            yield pairs(opening, opening)
        for o in range(1, far + 1):
            b = np.arange(max(o, fresh), len(t))
            b = b[(t[b] == t[b - o]) & (head[b] == head[b - o])]
            if o < far:
                yield pairs(cid[b - o], cid[b])
            else:
                ends = np.unique(np.concatenate([cid[b - o], cid[b]]))
                yield pairs(ends, ends)
        t, head, cid = t[-far:], head[-far:], cid[-far:]
    if len(t):
        closing = cid[(t == t[-1]) & (head == head[-1])]
        yield pairs(closing, closing)


def _agreeing(batches):
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, MINHASHES) for i in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= CLUSTER_AGREE)
            yield batch.select([0, 1]).filter(keep)


def neighbours(classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of classes that stand next to each other in an order, and (cid, cid) of those in a dense region."""
    width = 2 * (PREFIX + DEEPER)
    ring = F.concat("sig", F.substring("sig", 1, width))
    rows = (classes.select("cid", ring.alias("ring"), F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("t"))
            .select("t", F.expr(f"substring(ring, {2 * PREFIX} * t + 1, {width})").alias("key"), "cid"))
    near = rows.repartitionByRange("t", "key", "cid").sortWithinPartitions("t", "key", "cid").mapInArrow(_neighbours, "a long, b long")
    return tables.written(near.distinct(), "neighbours")


def agreeing(near: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of different classes whose signatures agree."""
    sig = classes.select("cid", "sig")
    pairs = (near.where("a <> b").join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
             .select("a", "b", "sig_a", "sig_b"))
    return pairs.mapInArrow(_agreeing, "a long, b long")


def _shingles(batches):
    """Of rows (cid, n, set): a row (cid, n, x) for every shingle of the set."""
    for batch in batches:
        for cid, n, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = np.frombuffer(one, np.int64)
            for at in range(0, len(x), ROWS):
                part = x[at:at + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), cid, np.int64)), pa.array(np.full(len(part), n, np.int64)), pa.array(part)],
                                                 ["cid", "n", "x"])


def dense_pairs(held: DataFrame) -> DataFrame:
    """Pairs (a, b) that join the classes (cid, n, set) so that any two of similarity 0.75 or more are connected.

    Classes' shingles are ordered by the number of classes that have them. Two linked classes of n and m shingles share at
    least 3/7 of n + m, and so one of the first shingles of both; what a class has from the first shared one on bounds the size of
    its partners (``reach``). A shingle's classes of like sizes are hung on the smallest of them that reaches its own size: of two that do not, each
    would have to be smaller than the other."""
    rows = held.select("cid", "n", "set").mapInArrow(_shingles, "cid long, n long, x long")
    many = rows.groupBy("x").agg(F.count("*").alias("f")).where("f > 1")
    by = Window.partitionBy("cid")
    ranked = (rows.join(many, "x").withColumn("m", F.count("*").over(by)).where(SHARE[1] * F.col("m") >= SHARE[0] * F.col("n"))
              .withColumn("rank", F.row_number().over(by.orderBy("f", "x"))))
    least = F.ceil(F.col("n") * SHARE[0] / SHARE[1])  # shingles shared with any partner
    first = ranked.where(F.col("rank") <= F.col("m") - least + 1).select(
        "cid", "n", "x", F.floor((7 * (F.col("m") - F.col("rank") + 1) - 3 * F.col("n")) / 3).alias("reach"),
        F.floor(F.log("n") / float(np.log(1 / 0.74))).alias("size"))  # sizes of ratio 0.75 are at most one bin apart
    first = tables.written(first.withColumn("bin", F.explode(F.array(F.col("size"), F.col("size") + 1))), "dense-shingles")
    centre = first.where("reach >= n").groupBy("x", "bin").agg(F.min(F.struct("n", "cid")).alias("c"))
    return (first.join(centre, ["x", "bin"]).where("cid <> c.cid and c.n <= reach")
            .select(F.least("cid", "c.cid").alias("a"), F.greatest("cid", "c.cid").alias("b")).distinct())


def candidates(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes to be joined to clusters: agreeing neighbours, and what the dense regions' sets need."""
    near = neighbours(classes)
    dense = classes.join(near.where("a = b").select(F.col("a").alias("cid")), "cid").select("cid", "n", "s1", "s2")
    dense = tables.written(dense, "dense")
    held = dense.join(_sets(docs, dense).groupBy("s1", "s2").agg(F.first("set").alias("set")), ["s1", "s2"])
    return agreeing(near, classes).union(dense_pairs(tables.written(held.select("cid", "n", "set"), "dense-sets")))


def _links(rows) -> tuple[list, list]:
    """Confirmed links between different parts among one block's rows (cid, part, side, sig, set): a spanning forest.
    Rows are compared whose sides, as bits, make 3 together."""
    cid, part, side = [r[0] for r in rows], [r[1] for r in rows], np.array([r[2] for r in rows])
    sets, n = [np.frombuffer(r[4], np.uint64) for r in rows], len(rows)
    size = np.array([len(s) for s in sets])
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    if n > 8:
        sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint16).reshape(n, MINHASHES)
        found = []
        for i in range(n - 1):
            agree = (sig[i + 1:] == sig[i]).sum(axis=1)
            j = np.flatnonzero((agree >= PAIR_AGREE) & ((side[i] | side[i + 1:]) == 3))
            found.append((agree[j], np.full(len(j), i), j + i + 1))
        agree, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(-agree, kind="stable")
        left, right = left[order], right[order]
    else:
        left, right = np.triu_indices(n, 1)
    fits = SHARE[1] * np.minimum(size[left], size[right]) >= SHARE[0] * np.maximum(size[left], size[right])
    a, b = [], []
    for i, j in zip(left[fits].tolist(), right[fits].tolist(), strict=True):
        if (side[i] | side[j]) == 3 and (x := find(part[i])) != (y := find(part[j])):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if SHARE[1] * both >= SHARE[0] * (len(sets[i]) + len(sets[j]) - both):
                root[x] = y
                a.append(cid[i])
                b.append(cid[j])
    return a, b


def _confirm(batches):
    """Of rows (cluster, block, cid, part, side, sig, set) sorted by cluster and block: each block's links."""
    at, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        a, b = [], []
        for key, row in zip(zip(*columns[:2], strict=True), zip(*columns[2:], strict=True), strict=True):
            if key != at:
                found = _links(rows) if len(rows) > 1 else ([], [])
                a, b, at, rows = a + found[0], b + found[1], key, []
            rows.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    if len(rows) > 1:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _links(rows)], ["a", "b"])


def _confirmed(rows: DataFrame) -> DataFrame:
    return (rows.select("cluster", "block", "cid", "part", "side", "sig", "set").repartition("cluster", "block")
            .sortWithinPartitions("cluster", "block").mapInArrow(_confirm, "a long, b long"))


def cells(classes: DataFrame) -> DataFrame:
    """cid, part, cells (block, side) of the classes (cluster, cid, n, part) whose cluster has several parts. The largest
    part fills the blocks 0 .. inner - 1, all others the blocks up to total - 1; a cell (i, j) is the number i x total + j. All
    pairs of a cell (i, i) are compared, and in others those of a class of i (side 1) and one of j (side 2)."""
    count = classes.groupBy("cluster", "part").agg(F.count("*").alias("k"), F.sum("n").alias("shingles"))
    order = F.struct("k", "part")
    main = count.groupBy("cluster").agg(F.max_by("part", order).alias("main"), F.max_by("k", order).alias("most"), F.max_by("shingles", order).alias("large"),
                                        F.sum("k").alias("k"), F.sum("shingles").alias("shingles"), F.count("*").alias("parts")).where("parts > 1")

    def blocks(members, shingles):
        return F.greatest(F.ceil(members / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))
    main = main.select("cluster", "main", blocks(F.col("most"), F.col("large")).alias("inner"),
                       blocks(F.col("k") - F.col("most"), F.col("shingles") - F.col("large")).alias("outer"))
    spot = F.xxhash64("cid", F.lit(2))
    dealt = classes.join(main, "cluster").select("cid", "part", "inner", (F.col("inner") + F.col("outer")).alias("total"), F.when(
        F.col("part") == F.col("main"), F.pmod(spot, F.col("inner"))).otherwise(F.col("inner") + F.pmod(spot, F.col("outer"))).alias("own"))
    later = F.transform(F.sequence(F.greatest("own", "inner"), F.col("total") - 1), lambda j: F.struct(
        (F.col("own") * F.col("total") + j).alias("block"), F.when(j == F.col("own"), 3).otherwise(1).alias("side")))
    earlier = F.transform(F.sequence(F.lit(0).cast("long"), F.col("own") - 1), lambda i: F.struct(
        (i * F.col("total") + F.col("own")).alias("block"), F.lit(2).alias("side")))
    return dealt.select("cid", "part", F.when(F.col("own") >= F.col("inner"), F.concat(later, earlier)).otherwise(later).alias("cells"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """s1, s2, set: the shingle hashes of the wanted classes, from a second scan."""
    n, bits = wanted.count(), 1 << 15
    while bits < min(8 * n, MAX_BITS):
        bits <<= 1
    sieve = docs.sparkSession.sparkContext.broadcast(tables.bitmap(wanted, F.col("s1").bitwiseAND(F.lit(bits - 1)), bits))

    def run(batches):
        bit, sent = sieve.value, set()
        for _, t in slices(batches):
            g, sizes = shingle_sets(t)
            one, two = set_keys(g, sizes)
            low, at = one & np.int64(bits - 1), np.cumsum(sizes) - sizes
            hit = np.flatnonzero((bit[low >> 3] >> (low & 7).astype(np.uint8)) & (sizes > 0))
            keep = []
            for i in hit.tolist():
                if (k := (int(one[i]), int(two[i]))) not in sent:
                    sent.add(k)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(one[keep]), pa.array(two[keep]),
                                              pa.array([g[at[i]:at[i] + sizes[i]].tobytes() for i in keep], pa.binary())], ["s1", "s2", "set"])
    return tables.documents(docs).mapInArrow(run, "s1 long, s2 long, set binary")


def groups(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (and key, the row's) for every document row."""
    own = ["key"] if with_key else []
    rows = tables.documents(docs, *([tables.row_key(docs).alias("key")] if with_key else []))
    sketch = tables.written(rows.mapInArrow(_sketch, f"doc_id long{', key binary' if with_key else ''}, n long, s1 long, s2 long, sig binary"), "sketch")
    classes = tables.written(sketch.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("least"), F.first("sig").alias("sig"))
                             .withColumn("cid", F.monotonically_increasing_id()), "classes")
    cluster = components(candidates(docs, classes), "clusters")
    cluster = cluster.union(cluster.select("root", "root").distinct()).toDF("cid", "cluster")
    sized = cluster.join(classes, "cid")
    sizes = sized.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = sized.join(sizes.select("cluster", "members", blocks.alias("blocks")), "cluster").select(
        "cluster", "members", "blocks", "cid", "n", "s1", "s2", "sig", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int").alias("own"),
        (F.pmod(F.xxhash64("cid", F.lit(1)), F.col("members")) < ANCHORS).alias("anchor"))
    placed = tables.written(placed, "placed")
    held = tables.written(placed.join(_sets(docs, placed).groupBy("s1", "s2").agg(F.first("set").alias("set")), ["s1", "s2"]), "sets")
    whole = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = held.select("*", F.col("cid").alias("part"), F.explode(F.when(F.col("anchor"), whole).otherwise(F.array("own"))).alias("block"))
    links = tables.written(_confirmed(first.withColumn("side", F.when(F.col("block") == F.col("own"), 3).otherwise(0))), "links")
    part = components(links, "parts")
    many = placed.where("blocks > 1").select("cluster", "cid", "n").join(part.toDF("cid", "part"), "cid", "left") \
        .withColumn("part", F.coalesce("part", "cid"))
    split = tables.written(cells(many), "split")
    if not split.isEmpty():
        second = held.join(split, "cid").select("cluster", "cid", "part", "sig", "set", F.explode("cells").alias("cell"))
        more = tables.written(_confirmed(second.select("*", F.col("cell.block").alias("block"), F.col("cell.side").alias("side"))), "more-links")
        part = components(links.union(more), "parts-of-all")
    part = part.toDF("cid", "root")
    rooted = classes.select("cid", "s1", "s2", "n", "least").join(part, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    rooted = tables.written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(least, "root").select("s1", "s2", "n", "component_id")
    full = sketch.where("n > 0").select("doc_id", *own, "n", "s1", "s2").join(of_class, ["s1", "s2", "n"]).select("doc_id", *own, "n", "component_id")
    every = full.union(sketch.where("n = 0").select("doc_id", *own, "n", F.col("doc_id").alias("component_id")))
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *own)


ORACLE = r"""
WITH RECURSIVE low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM low WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM low UNION SELECT a, y FROM reach JOIN link ON x = b),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT low.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, low.doc_id = c AS kept
FROM low LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""
