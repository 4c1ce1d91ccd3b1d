"""Token counts of the documents in flat, unindexed token files, by a scan for separators.

A token file is a run of little-endian ids (2 or 4 bytes) in which an end-of-document id closes each document;
nothing says where documents begin. A block is any range of a file, cut without regard to documents; every task
reads its own ranges, so that one file of any length is spread over all tasks. Each block is searched for
separators in one vector operation, which leaves their number and the end of the last one. An exclusive prefix scan (a sum and
a maximum) over the blocks in front gives each block the documents closed before it and where the document begins that
is open before it; the scan has two levels, stretches of ``STRETCH`` tokens and then a file's stretches, so that no task gets all
blocks of a long file. Each block is then read once more and gives its documents, begun at the place found.

Files are read and written by the tasks through pyarrow's file systems (local and mounted folders, HDFS, S3 and the like). A written file
counts only if its task's row is in the table of files: what a lost or repeated attempt leaves behind is never read.

Defined results: two separators in a row enclose a document of no tokens; tokens behind a file's last separator are one
more document; an empty file has none; a partial id at a file's end is an error; blocks may come in any
order. In ``write_files`` a null text is empty; rows may repeat and ids may be null; every row is a document; an empty
table writes no file; a very long text is one document over many blocks; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import slices
from appraise.session import scratch_path

#: Tokens of a block, and of a stretch of blocks in the prefix scan.
BLOCK, STRETCH = 1 << 16, 1 << 28
#: Bytes of files that a task reads. The rows of blocks are small, so their tasks are numbered by what they read.
TASK_BYTES = 1 << 26
WIDTHS = {2: "<u2", 4: "<u4"}


def _system(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs
    if "://" not in uri and uri.startswith("file:"):
        uri = uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def read_files(spark: SparkSession, paths, width: int = 2, block: int = BLOCK) -> DataFrame:
    """file, path, pos, n: the blocks of flat binary files (pos and n in tokens); only the files' names and lengths are read."""
    files = spark.read.format("binaryFile").load(paths).where("length > 0").select(F.col("path").alias("file"), "path", "length")
    return ranges(files, width, block)


def ranges(files: DataFrame, width: int = 2, block: int = BLOCK) -> DataFrame:
    """file, path, pos, n of the blocks of files (file, path, length in bytes)."""
    step = block * width
    cuts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))
    # a last partial id stays in its block, which fails on it
    return (files.select("file", "path", "length", F.explode(cuts).alias("at"))
            .select("file", "path", (F.col("at") / width).cast("long").alias("pos"),
                    F.ceil(F.least(F.lit(step), F.col("length") - F.col("at")) / width).alias("n")))


class _Reader:
    """The ids of blocks, given by their bytes or by a path; the file read last stays open."""

    def __init__(self, width: int):
        self.kind, self.path, self.file = np.dtype(WIDTHS[width]), None, None

    def ids(self, block: dict) -> np.ndarray:
        if "path" not in block:
            return np.frombuffer(block["content"] or b"", self.kind)
        if block["path"] != self.path:
            self.close()
            system, inside = _system(block["path"])
            self.path, self.file = block["path"], system.open_input_file(inside)
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at(block["n"] * width, block["pos"] * width), self.kind)

    def close(self):
        if self.file is not None:
            self.file.close()


def scan(blocks: DataFrame, end: int, width: int = 2) -> DataFrame:
    """file, ordinal, start, n_tokens of every document of blocks: (file, path, pos, n), read from the files, or (file, pos,
    content); pos and n are in tokens. A file's blocks cover it once."""
    file = blocks.schema["file"].dataType.simpleString()
    source = ["path", "n"] if "path" in blocks.columns else ["content"]
    blocks = blocks.select("file", F.col("pos").cast("long").alias("pos"), *source)
    tasks = -(-(blocks.agg(F.sum("n")).first()[0] or 0) * width // TASK_BYTES) if "path" in source else 0

    def spread(rows):
        """Rows of blocks to be read from files, so many to a task, in the files' order."""
        return rows.repartitionByRange(max(tasks, 1), "file", "pos").sortWithinPartitions("file", "pos") if "path" in source else rows

    def summaries(batches):
        reader = _Reader(width)
        for batch in batches:
            closed, ends = [], []
            for block in batch.to_pylist():
                at = np.flatnonzero(reader.ids(block) == end)
                closed.append(len(at))
                ends.append(block["pos"] + int(at[-1]) + 1 if len(at) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(closed, pa.int64()), pa.array(ends, pa.int64())],
                                             ["file", "pos", "closed", "open_from"])
        reader.close()

    def documents(batches):
        reader = _Reader(width)
        for batch in batches:
            for i, block in enumerate(batch.to_pylist()):
                ids = reader.ids(block)
                begin, stop = block["begin"], block["pos"] + len(ids)
                closes = block["pos"] + np.flatnonzero(ids == end)
                if block["last"] and stop > (closes[-1] + 1 if len(closes) else begin):
                    closes = np.append(closes, stop)
                starts = np.append(begin, closes[:-1] + 1)[:len(closes)]
                yield pa.RecordBatch.from_arrays([pa.array([block["file"]] * len(closes), batch.schema.field("file").type),
                                                  pa.array(block["first"] + np.arange(len(closes), dtype=np.int64)),
                                                  pa.array(starts.astype(np.int64)), pa.array((closes - starts).astype(np.int64))],
                                                 ["file", "ordinal", "start", "n_tokens"])
        reader.close()

    found = tables.written(spread(blocks).mapInArrow(summaries, f"file {file}, pos long, closed long, open_from long")
                           .withColumn("stretch", F.floor(F.col("pos") / STRETCH)), "token-blocks")

    def before(*by, order):
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    stretches = found.groupBy("file", "stretch").agg(F.sum("closed").alias("closed"), F.max("open_from").alias("open_from"), F.max("pos").alias("end_pos"))
    over = before("file", order="stretch")
    stretches = stretches.select("file", "stretch", F.coalesce(F.sum("closed").over(over), none).alias("closed_before"),
                                 F.coalesce(F.max("open_from").over(over), none).alias("open_before"),
                                 F.when(F.lead("stretch").over(Window.partitionBy("file").orderBy("stretch")).isNull(), F.col("end_pos")).alias("last_pos"))
    inner = before("file", "stretch", order="pos")
    placed = (found.withColumn("closed_here", F.coalesce(F.sum("closed").over(inner), none)).withColumn("open_here", F.coalesce(F.max("open_from").over(inner), none))
              .join(stretches, ["file", "stretch"])
              .select("file", "pos", (F.col("closed_before") + F.col("closed_here")).alias("first"), F.greatest("open_before", "open_here").alias("begin"),
                      F.col("pos").eqNullSafe(F.col("last_pos")).alias("last")))
    return spread(blocks.join(placed, ["file", "pos"])).mapInArrow(documents, f"file {file}, ordinal long, start long, n_tokens long")


def write_files(docs: DataFrame, ranks: str, pattern: str, end: int) -> tuple[DataFrame, DataFrame]:
    """Tokenises every text to flat token files of 2-byte ids in the shared folder, one for each task. Returns the files
    (file, path, length), and the ids of their documents in order (file, first, doc_ids)."""
    folder = scratch_path(docs.sparkSession, "llm-flat-tokens")

    def run(batches):
        import tiktoken
        from pyspark import TaskContext
        with open(ranks, "rb") as f:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        task, first = TaskContext.get(), 0
        path = f"{folder}/{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex}.bin"
        out = None
        for batch, t in slices(batches):
            if out is None:
                system, inside = _system(path)
                system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(inside, buffer_size=1 << 20)
            for i in range(t.n):
                ids = encoding.encode_ordinary(t.text(i))
                ids.append(end)
                out.write(np.array(ids, "<u2").tobytes())
            yield row(task.partitionId(), None, None, first, batch.column(0).to_pylist())
            first += t.n
        if out is not None:
            length = out.tell()
            out.close()
            yield row(task.partitionId(), path, length, None, None)

    def row(*values):
        kinds = {"file": pa.int64(), "path": pa.string(), "length": pa.int64(), "first": pa.int64(), "doc_ids": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds.values(), strict=True)], list(kinds))
    made = tables.written(tables.documents(docs).mapInArrow(run, "file long, path string, length long, first long, doc_ids array<long>"), "token-files")
    return (made.where("length > 0").select("file", "path", "length"), made.where("path is null and size(doc_ids) > 0").select("file", "first", "doc_ids"))


def document_counts(docs: DataFrame, ranks: str, pattern: str, end: int, block: int = BLOCK) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens: every row of ``docs`` by a scan of the flat token files written from it."""
    files, names = write_files(docs, ranks, pattern, end)
    names = names.select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id")).select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return names.join(scan(ranges(files, block=block), end), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
