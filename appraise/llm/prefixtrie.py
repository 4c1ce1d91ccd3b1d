"""Conversation prefix trie with totals by depth bands.

A node is a distinct sequence of a conversation's first d turns, keyed by d and the exclusive or of two 64-bit hashes of
(turn, place) over those turns, so a running aggregate gives every prefix its key and a parent's key is the
node's without the last turn. Texts never leave the first scan: a turn travels as its hash and length.

Totals over subtrees go by bands of ``height`` depths. Inside its band a node explodes to its ancestors, at most ``height``
rows; a band's root, once its total is complete, is a single row for the band above, so totals cross bands in
one small round each. Height grows with the square root of the greatest depth: neither rounds nor explosion pass that.

Members that end at a node are digested in order of their ids: a range sort cuts them to strings of bounded length, and
a node's strings stream through one digest, so that no list of a node's members is ever built.

Defined results: rows without a conv_id belong to no conversation; a null turn comes first, turns of equal number go by
role and then by the MD5 of the turn; repeated rows are turns of their own; null and empty role or text are the same; a long text
counts whole; an empty table has no nodes; columns other than the four are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.llm import tables

#: Conversations of one family share their first turns; at most SHARED - 1 turns are taken over.
FAMILY, SHARED = 5, 9
HEIGHT = 32
#: Characters of the ids that one row of the digest carries at most (one id may go beyond).
PIECE = 1 << 16
KEY = ["depth", "x", "y"]


def ranked(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1, 2, ...), m (hash of role and text), bytes (of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("m"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "m")
    return turns.select("conv_id", F.row_number().over(order).alias("pos"), "m", "bytes")


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """From ``ranked`` turns: (conv_id, size) of every rebuilt conversation, and its turns (conv_id, depth, m, bytes, ends)."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    convs = tables.written(convs.withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))), "trie-convs")
    own = turns.join(convs, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "m", "bytes", "size")
    first = turns.where(F.col("pos") < shared).withColumnRenamed("conv_id", "base")
    first = first.join(convs, "base").where("pos <= h").select("conv_id", F.col("pos").cast("long").alias("depth"), "m", "bytes", "size")
    both = own.union(first)
    return convs.select("conv_id", "size"), both.select("conv_id", "depth", "m", "bytes", (F.col("depth") == F.col("size")).alias("ends"))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, x, y (the prefix's key), up_x, up_y (its parent's), bytes, ends: a row for each prefix of each conversation."""
    along = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = turns.select("*", F.xxhash64(F.lit(1), "depth", "m").alias("hx"), F.xxhash64(F.lit(2), "depth", "m").alias("hy"))
    keyed = keyed.select("*", F.bit_xor("hx").over(along).alias("x"), F.bit_xor("hy").over(along).alias("y"))
    return keyed.select("conv_id", *KEY, F.col("x").bitwiseXOR(F.col("hx")).alias("up_x"), F.col("y").bitwiseXOR(F.col("hy")).alias("up_y"), "bytes", "ends")


def _digests(ends: DataFrame) -> DataFrame:
    """depth, x, y, ends_sha256 of the nodes that conversations (conv_id) end at."""
    def rows(columns):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "first", "piece"])

    def pieces(batches):
        node, first, ids, long, out = None, None, [], 0, []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or long >= PIECE:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids, long = key, conv, [], 0
                ids.append(str(conv))
                long += len(ids[-1]) + 1
            if sum(len(r[4]) for r in out) >= PIECE or len(out) >= 4096:
                yield rows(zip(*out))
                out = []
        if ids:
            out.append((*node, first, ",".join(ids)))
        if out:
            yield rows(zip(*out))

    def digest(batches):
        node, state = None, None

        def done():
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in node), pa.array([state.hexdigest()])], [*KEY, "ends_sha256"])

        for batch in batches:
            for *key, _, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        yield done()
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
        if node is not None:
            yield done()

    cut = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    cut = cut.mapInArrow(pieces, "depth long, x long, y long, first long, piece string")
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "depth long, x long, y long, ends_sha256 string")


def _totals(nodes: DataFrame, along: DataFrame, height: int, deepest: int) -> DataFrame:
    """KEY, leaves, saved summed over each node's subtree. ``nodes``: KEY, conv_id, leaves, saved of the node alone; ``along``: conv_id, KEY."""
    band = F.floor(F.col("depth") / height)
    above = along.select("conv_id", band.alias("band"), *KEY)
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]

    def spread(rows: DataFrame) -> DataFrame:
        """conv_id, band, to, leaves, saved given to every ancestor in that band down to depth ``to``."""
        return rows.join(above, ["conv_id", "band"]).where("depth <= to").groupBy(*KEY).agg(*sums)

    inside = spread(nodes.select("conv_id", band.alias("band"), F.col("depth").alias("to"), "leaves", "saved"))
    bands = deepest // height
    if not bands:
        return inside
    inside = tables.written(inside, "trie-inside")
    ups = along.where(F.col("depth") % height == 0).select("conv_id", (F.col("depth") + height).alias("depth"), F.col("x").alias("to_x"), F.col("y").alias("to_y"))
    tops = nodes.where((F.col("depth") > 0) & (F.col("depth") % height == 0)).select("conv_id", *KEY)
    tops = tables.written(tops.join(inside, KEY).join(ups, ["conv_id", "depth"]), "trie-tops")  # a row for each band's root
    complete, done = None, None
    for b in range(bands, 0, -1):
        here = tops.where(F.col("depth") == b * height)
        if complete is not None:
            below = complete.groupBy(F.col("to_x").alias("x"), F.col("to_y").alias("y")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
            none = F.lit(0).cast("long")
            here = here.join(below, ["x", "y"], "left").select(
                "conv_id", *KEY, (F.col("leaves") + F.coalesce("l", none)).alias("leaves"), (F.col("saved") + F.coalesce("s", none)).alias("saved"), "to_x", "to_y")
        complete = tables.written(here.select("conv_id", *KEY, "leaves", "saved", "to_x", "to_y"), "trie-band")
        done = complete if done is None else done.union(complete)
    lifted = spread(done.select("conv_id", (band - 1).alias("band"), F.col("depth").alias("to"), "leaves", "saved"))
    return inside.union(lifted).groupBy(*KEY).agg(*sums)


def trie(conversations: DataFrame, height: int | None = None) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(ranked(conversations))
    path = tables.written(paths(turns), "trie-paths")
    zero = F.lit(0).cast("long")
    along = path.select("conv_id", *KEY).union(convs.select("conv_id", zero, zero, zero))
    nodes = path.groupBy(*KEY).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"),
                                   F.max("up_x").alias("up_x"), F.max("up_y").alias("up_y"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    none = F.lit(None).cast("long")
    nodes = nodes.union(root.select(zero, zero, zero, "n_convs", "conv_id", zero, none, none))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = tables.written(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    height = height or max(HEIGHT, int(deepest ** 0.5) + 1)
    own = nodes.select(*KEY, "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = _totals(own, along, height, deepest)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parent_conv_id"))
    ends = path.where("ends").select(*KEY, "conv_id").union(convs.where("size = 0").select(zero, zero, zero, "conv_id"))
    return (nodes.join(totals, KEY).join(_digests(ends), KEY, "left").join(parents, ["depth", "up_x", "up_y"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


#: CRC-32 over a list in which a byte stands as itself and each of its eight shifts as -1.
_CRC = ("xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(s) + 1), "
        "lambda i: [ord(s[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
        "lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)")

ORACLE = f"""
WITH ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
t AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS m, strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_CRC} % {SHARED} AS h FROM ids),
k AS (SELECT c.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = c.base)) AS taken FROM c),
p AS (SELECT k.conv_id, pos AS d, m, bytes FROM t JOIN k ON t.conv_id = k.base AND pos <= h
  UNION ALL SELECT k.conv_id, pos - h + taken, m, bytes FROM t JOIN k ON t.conv_id = k.conv_id AND pos > h),
path AS MATERIALIZED (SELECT conv_id, d, bytes, string_agg(md5(m), '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS id FROM p
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
fin AS (SELECT arg_max(id, d) AS id, conv_id FROM path GROUP BY conv_id),
ends AS (SELECT id, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM fin GROUP BY id),
n AS MATERIALIZED (SELECT id, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM path GROUP BY id),
kids AS (SELECT left(id, length(id) - 32) AS id, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
own AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (id)),
total AS (SELECT path.id, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * own.bytes) AS saved_tokens
  FROM own JOIN path ON path.conv_id = own.conv_id AND path.d <= own.d GROUP BY path.id)
SELECT own.conv_id, own.d::BIGINT AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN total USING (id) LEFT JOIN ends USING (id) LEFT JOIN n up ON own.d > 0 AND up.id = left(own.id, length(own.id) - 32)"""
