"""Benchmark decontamination by winnowing.

The fingerprint of a window of ``window`` words is the least hash of its ``gram``-word grams. Two texts that
share any run of ``window`` words share that window's fingerprint, so no shared run of that length can be
missed. The test set's fingerprints fill a bit filter of bounded size; a document's windows whose fingerprint
passes it are joined to the test set's on fingerprint and exact words, and the joined windows are extended to
the union of words that they cover. A test item shorter than ``window`` words is a single window of its own
length, looked up the same way.

Defined results: null or wordless documents have no words and no hits; null or wordless items have no
windows; repeated item ids count once, a null item id is written as the empty string; each document row is
judged on its own, equal rows and null ids included; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import ALNUM_WORD, grams, mix, slices

WINDOW, GRAM = 10, 5
#: Bits for each fingerprint of the test set, and the largest filter (16 MB); beyond it only more windows pass to the join.
BITS_EACH, MAX_BITS = 16, 1 << 27
_CAND = pa.struct([("start", pa.int32()), ("len", pa.int32()), ("fp", pa.int64()), ("words", pa.string())])


def _windows(h: np.ndarray, count: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``length`` words (none crosses two texts), and their fingerprints."""
    gram = min(gram, length)
    if len(h) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g, w = grams(h, gram), length - gram + 1
    low = g[:len(h) - length + 1].copy()
    for j in range(1, w):
        np.minimum(low, g[j:j + len(low)], out=low)
    last = np.repeat(np.cumsum(count), count)  # the word after the text that a word is in
    at = np.flatnonzero(np.arange(len(low)) + length <= last[:len(low)])
    return at, mix(low[at] ^ np.uint64(length))


def _spelled(t, starts, ends, at, length) -> list[str]:
    lowered = t.data.copy()
    lowered[(lowered >= 65) & (lowered <= 90)] += 32
    body, out = lowered.tobytes(), []
    for i in at.tolist():
        out.append(b" ".join([body[starts[j]:ends[j]] for j in range(i, i + length)]).decode("utf-8", "replace"))
    return out


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """len, fp, words, items (the sorted ids whose text has the window): one row for each distinct window."""
    def run(batches):
        for batch, t in slices(batches):
            s, e, count = t.spans(ALNUM_WORD)
            h = t.hashes(s, e, True)
            owner, names = np.repeat(np.arange(t.n), count), batch.column(0).to_pylist()
            first = np.cumsum(count) - count
            short = np.flatnonzero((count > 0) & (count < window))
            for length in [window, *np.unique(count[short]).tolist()]:
                at, fp = _windows(h, count, length, gram)
                if length < window:
                    keep = np.isin(at, first[short[count[short] == length]])
                    at, fp = at[keep], fp[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[owner[i]] for i in at], pa.string()), pa.array(np.full(len(at), length, np.int32)),
                    pa.array(fp.view(np.int64)), pa.array(_spelled(t, s, e, at, length), pa.string())], ["item", "len", "fp", "words"])
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    got = named.mapInArrow(run, "item string, len int, fp long, words string")
    return got.groupBy("len", "fp", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, key (the row's), n_words, n_hit, items (sorted ids) for each row of ``docs``."""
    against = tables.written(item_windows(items, window, gram), "item-windows")
    lengths = sorted(r.len for r in against.select("len").distinct().collect())  # at most `window` values
    bits = 1 << 15
    n = against.count()
    while bits < min(BITS_EACH * n, MAX_BITS):
        bits <<= 1
    at = F.col("fp").bitwiseAND(F.lit(bits - 1))
    sieve = docs.sparkSession.sparkContext.broadcast(tables.bitmap(against, at, bits))

    def run(batches):
        number, bit = tables.Rows(), sieve.value
        for batch, t in slices(batches):
            s, e, count = t.spans(ALNUM_WORD)
            h = t.hashes(s, e, True)
            begin = np.cumsum(count) - count
            found = []
            for length in lengths:
                first, fp = _windows(h, count, length, gram)
                low = fp & np.uint64(bits - 1)
                keep = (bit[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0
                found.append((first[keep], fp[keep], length))
            where = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            doc = np.searchsorted(begin, where, side="right") - 1
            words = [w for f in found for w in _spelled(t, s, e, f[0], f[2])]
            size = np.concatenate([np.full(len(f[0]), f[2], np.int32) for f in found]) if found else np.zeros(0, np.int32)
            fps = np.concatenate([f[1] for f in found]).view(np.int64) if found else np.zeros(0, np.int64)
            # texts without words share their begin with the next text: searchsorted's right side gives the last, which has them
            order = np.argsort(doc, kind="stable")
            each = pa.StructArray.from_arrays([
                pa.array((where - begin[doc])[order].astype(np.int32)), pa.array(size[order]), pa.array(fps[order]),
                pa.array(words, pa.string()).take(pa.array(order))], fields=list(_CAND))
            off = np.zeros(t.n + 1, np.int32)
            np.cumsum(np.bincount(doc, minlength=t.n), out=off[1:])
            yield pa.RecordBatch.from_arrays([number.take(t.n), batch.column(0), batch.column(2), pa.array(count.astype(np.int64)),
                                              pa.ListArray.from_arrays(pa.array(off), each)], ["rid", "doc_id", "key", "n_words", "cand"])
    kind = "rid long, doc_id long, key binary, n_words long, cand array<struct<start:int,len:int,fp:long,words:string>>"
    seen = tables.written(tables.documents(docs, tables.row_key(docs).alias("key")).mapInArrow(run, kind), "doc-windows")
    sieve.destroy()
    cand = seen.select("rid", F.explode("cand").alias("c")).select("rid", "c.*")
    hit = cand.join(against, ["len", "fp", "words"])
    till = F.max(F.col("start") + F.col("len")).over(
        Window.partitionBy("rid").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest(F.col("start"), F.coalesce("till", F.lit(0))))
    per = (hit.withColumn("till", till).groupBy("rid")
           .agg(F.sum(new).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    return (seen.drop("cand").join(per, "rid", "left")
            .select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return find_hits(docs, items, window, gram).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
lowi AS (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
i AS (SELECT item_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowi),
iw AS (SELECT item_id, least(10, len(w)) AS n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0),
iwt AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS t FROM iw),
lens AS (SELECT DISTINCT n FROM iwt),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n),
dwt AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS t FROM dw),
hit AS (SELECT doc_id, item_id, p, n FROM dwt JOIN iwt USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
