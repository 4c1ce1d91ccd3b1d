"""Removal of repeated passages by external induced sorting of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: at a smaller doc_id, or earlier in
the same document. The suffix order of the whole corpus is not needed to depth beyond ``length``, and not at all where a string
cannot repeat; so the suffixes to sort are found, dealt to shards and sorted as follows.

1. *Sample.* Every window of ``length`` bytes has one sample suffix: the least of its ``gram``-byte grams by hash, the
   leftmost on ties. Equal windows have equal samples at equal places. A window whose sample's gram occurs once
   in the corpus cannot repeat: counts of the grams, as a bit filter of bounded size, leave the others.
2. *Pieces.* A maximal run of windows with one sample is a piece, keyed by the sample's gram. Equal pieces have one first place
   (an aggregate, so copies of any number collapse before anything is sorted); all windows of the others are repeats.
   A key with one distinct piece is finished.
3. *Recursion.* A key with more than ``GROUP`` distinct pieces is split: the half of the windows that reach furthest left shares
   more bytes left of the sample, the other half more bytes right of it; these longer strings are the new keys, and equal
   halves collapse again. After seven levels a key is a whole window. So no group grows with the corpus.
4. *Induction.* Pieces are dealt to shards by key and pass through Spark's disk-backed sorter, the queue from which a task takes
   whole groups in order; a shard can be far larger than memory. In a group the sample suffixes are sorted first.
   Then the suffixes one byte further left are induced, again and again: tuples (first byte, rank of the suffix to the
   right) in stable order, each with its common prefix with the tuple before it, which is one more than the least
   common prefix between the two suffixes it came from. Neighbours with a common prefix of ``length`` are equal windows; all but the
   first of them in the corpus are repeats.
5. A last scan meets each text with its first pieces and the repeats inside of them; every other piece is a repeat.

Defined results: null and empty texts have no bytes and no spans, texts shorter than ``length`` lose nothing; a null doc_id counts as
the least of all; rows of equal doc_id and text get equal results; where texts of one doc_id differ, an earlier start in
any of them is earlier, and at equal starts the text of the smaller 64-bit hash is; a very long text is scanned in
overlapping parts, so that only its bytes and one mask are held; an empty table gives an empty result; other columns are
ignored, whatever their names. Pieces are compared by 64-bit hashes under a 64-bit key, windows inside a group by their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import _BYTES, Texts, _grow, _powers, mix, slices

LENGTH, GRAM = 100, 32
#: Most distinct pieces of a key that are sorted as one group; more are split by longer keys.
GROUP = 1 << 14
#: Bits of a filter for each of its members, and its largest size (32 MB); beyond it only more pieces pass.
BITS_EACH, MAX_BITS = 16, 1 << 28
#: Windows of a long text that are scanned at once.
SPAN = 1 << 22
_U = np.uint64
_PLACE = _U((1 << 24) - 1)
_LEAST = -(1 << 63)
_PIECE = "doc long, rk long, start long, n int, a int, key long, same long"


def _docs(docs: DataFrame, *more) -> DataFrame:
    """doc (the id, null as the least), rk (hash of the text), text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc"), F.xxhash64(text).alias("rk"), text.alias("text"), *more)


def _runs(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """start, n, a, key, same of the pieces of some texts: first window, number of windows, place of the sample after the start,
    hash of the sample's gram, hash of all bytes."""
    size, none = len(data), np.zeros(0, np.int64)
    if size < length:
        return none, none, none, none.view(_U), none.view(_U)
    _grow(size + 1)
    sums = np.zeros(size + 1, _U)
    np.cumsum(_BYTES[data] * _powers["up"][:size], out=sums[1:])
    g = mix((sums[gram:] - sums[:-gram]) * _powers["down"][:size - gram + 1])
    low, have, width = (g & ~_PLACE) | np.arange(len(g), dtype=_U), 1, length - gram + 1
    while have < width:  # the least of `have` grams from each place on
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = (low & _PLACE).astype(np.int64)
    inside = np.arange(len(at)) + length <= np.repeat(off[1:], np.diff(off))[:len(at)]
    cut = np.ones(len(at) + 1, bool)
    cut[1:-1] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]) | ~inside[1:]
    edge = np.flatnonzero(cut)
    start = edge[:-1]
    start, n = start[inside[start]], np.diff(edge)[inside[start]]
    end = start + n + length - 1
    same = mix((sums[end] - sums[start]) * _powers["down"][start] + n.astype(_U) * _U(0xD6E8FEB86659FD93))
    return start, n, at[start] - start, g[at[start]], same


def scan(t: Texts, length: int, gram: int, passes=None):
    """owner (text), start in it, n, a, key, same of the pieces whose key the filter passes; a piece ends where a part of a long text does."""
    parts = []
    for lo in range(0, max(len(t.data) - length + 1, 1), SPAN):
        hi = min(lo + SPAN + length - 1, len(t.data))
        start, *rest = _runs(t.data[lo:hi], np.clip(t.off, lo, hi) - lo, length, gram)
        parts.append((start + lo, *rest))
    start, n, a, key, same = (np.concatenate(c) for c in zip(*parts))
    if passes is not None:
        keep = passes(key)
        start, n, a, key, same = start[keep], n[keep], a[keep], key[keep], same[keep]
    owner = np.searchsorted(t.off, start, side="right") - 1
    return owner, start - t.off[owner], n, a, key, same


def _bits(count: int) -> int:
    bits = 1 << 15
    while bits < min(BITS_EACH * count, MAX_BITS):
        bits <<= 1
    return bits


def _sieve(codes: DataFrame, count: int):
    """A filter of the column ``code`` as a broadcast (bits, bytes)."""
    bits = _bits(count)
    return codes.sparkSession.sparkContext.broadcast((bits, tables.bitmap(codes, F.col("code").bitwiseAND(F.lit(bits - 1)), bits)))


def _in(sieve, code: np.ndarray) -> np.ndarray:
    bits, held = sieve.value
    low = code & _U(bits - 1)
    return (held[low >> _U(3)] >> (low & _U(7)).astype(np.uint8)) & 1 > 0


def _repeating(docs: DataFrame, length: int, gram: int):
    """Filter of the sample grams that occur more than once."""
    def run(batches):
        for _, t in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(scan(t, length, gram)[4].view(np.int64))], ["code"])

    many = docs.select("text").mapInArrow(run, "code long").groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    many = tables.written(many, "repeat-grams")
    return _sieve(many, many.count())


def _first_pieces(docs: DataFrame, length: int, gram: int, live) -> DataFrame:
    """doc, rk, start, n, a, key, same of the first place of every distinct piece that passes ``live``."""
    def run(batches):
        for batch, t in slices(batches):
            owner, start, n, a, key, same = scan(t, length, gram, lambda k: _in(live, k))
            ids, rk = (batch.column(c).to_numpy() for c in (0, 1))
            loc = start << 16 | a << 8 | n
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[owner], rk[owner], loc, key.view(np.int64), same.view(np.int64))],
                                             ["doc", "rk", "loc", "key", "same"])

    found = docs.select("doc", "rk", "text").mapInArrow(run, "doc long, rk long, loc long, key long, same long")
    first = found.groupBy("key", "same").agg(F.min(F.struct("doc", "loc", "rk")).alias("f"))
    loc = F.col("f.loc")
    return tables.written(first.select("f.doc", "f.rk", F.shiftright(loc, 16).alias("start"), loc.bitwiseAND(F.lit(255)).cast("int").alias("n"),
                                       F.shiftright(loc, 8).bitwiseAND(F.lit(255)).cast("int").alias("a"), "key", "same"), "repeat-pieces")


def _of_open_keys(first: DataFrame) -> DataFrame:
    """The pieces whose key has several, with that number (m)."""
    several = first.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    return first.join(several, "key")


def _with_bytes(docs: DataFrame, pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """``pieces`` with their bytes (content), read from the texts."""
    code = F.col("same").bitwiseXOR(F.col("doc")).bitwiseXOR(F.col("start"))
    wanted = _sieve(pieces.select(code.alias("code")), pieces.count())

    def run(batches):
        for batch, t in slices(batches):
            ids, rk = (batch.column(c).to_numpy() for c in (0, 1))
            owner, start, n, a, key, same = scan(t, length, gram)
            keep = _in(wanted, same ^ ids[owner].view(_U) ^ start.view(_U))
            owner, start, n, key, same = owner[keep], start[keep], n[keep], key[keep], same[keep]
            begin = t.off[owner] + start
            lengths = n + length - 1
            off = np.zeros(len(n) + 1, np.int64)
            np.cumsum(lengths, out=off[1:])
            body = t.data[np.repeat(begin - off[:-1], lengths) + np.arange(off[-1])] if len(n) else np.zeros(0, np.uint8)
            content = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(body.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (ids[owner], rk[owner], start, key.view(np.int64), same.view(np.int64))), content],
                                             ["doc", "rk", "start", "key", "same", "content"])

    got = docs.select("doc", "rk", "text").mapInArrow(run, "doc long, rk long, start long, key long, same long, content binary")
    return pieces.join(got.dropDuplicates(["doc", "rk", "start", "key", "same"]), ["doc", "rk", "start", "key", "same"])


def _split(pieces: DataFrame, length: int) -> DataFrame:
    """The two halves of each piece's windows, by the bytes that all windows of that half of the places share."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mid = (r["lo"] + r["hi"]) // 2
                for lo, hi in ((r["lo"], mid), (mid + 1, r["hi"])):
                    last, first = min(r["a"], hi), max(r["a"] - r["n"] + 1, lo)  # places of the sample in the windows
                    if first > last:
                        continue
                    skip = r["a"] - last
                    body = r["content"][skip:r["a"] - first + length]
                    shared = body[last - lo:last + length - hi]
                    key = hashlib.blake2b(shared, digest_size=8, person=f"{lo},{hi}".encode()).digest()
                    same = hashlib.blake2b(body, digest_size=8).digest()
                    out.append((r["doc"], r["rk"], r["start"] + skip, last - first + 1, last, *np.frombuffer(key + same, np.int64).tolist(), lo, hi, body))
            columns = zip(*out) if out else [[]] * 10
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "rk", "start", "n", "a", "key", "same", "lo", "hi", "content"])

    return pieces.select("doc", "rk", "start", "n", "a", "lo", "hi", "content").mapInArrow(run, f"{_PIECE}, lo int, hi int, content binary")


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of x[lo..hi] (both included, lo <= hi) for each pair, by doubling."""
    out = np.empty(len(lo), x.dtype)
    level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    for j in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == j)
        out[at] = np.minimum(x[lo[at]], x[hi[at] - (1 << j) + 1])
        if len(x) > 1 << j:
            x = np.minimum(x[:-(1 << j)], x[1 << j:])
    return out


def induce(group: np.ndarray, a: np.ndarray, n: np.ndarray, place: np.ndarray, data: np.ndarray, off: np.ndarray, length: int):
    """(piece, window) of the windows that equal a window of the same group at an earlier place. ``place`` ranks the pieces' samples in the
    corpus; piece i's bytes are data[off[i]:off[i + 1]]."""
    left = int(a.max())
    there = np.diff(off)
    at = np.arange(left + length)[None, :] + (a - left)[:, None]
    m = data[np.clip(at + off[:-1, None], 0, len(data) - 1)]
    m[(at < 0) | (at >= there[:, None])] = 0
    right = m[:, left:]
    words = np.zeros((len(a), -(-length // 8) * 8), np.uint8)
    words[:, :length] = right
    words = words.view(">u8")
    real = np.minimum(there - a, length)
    # The sample suffixes: by group, bytes, and length where the text of a piece ends.
    order = np.lexsort((real, *(words[:, j] for j in range(words.shape[1] - 1, -1, -1)), group))
    common = np.zeros(len(a), np.int16)
    if len(a) > 1:
        x, y = order[:-1], order[1:]
        differ = right[x] != right[y]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        common[1:] = np.where(group[x] == group[y], np.minimum(first, np.minimum(real[x], real[y])), 0)
    pieces, windows = [], []
    for o in range(left + 1):  # windows that start o bytes left of their sample
        equal = common >= length
        if equal.any():
            head = np.flatnonzero(~equal)
            least = np.repeat(np.minimum.reduceat(place[order], head), np.diff(np.append(head, len(order))))
            later = order[place[order] > least]
            pieces.append(later)
            windows.append(a[later] - o)
        keep = np.flatnonzero(a[order] > o)
        if not len(keep):
            break
        nxt = order[keep]
        code = group[nxt] * 256 + m[nxt, left - 1 - o]
        by = np.argsort(code, kind="stable")
        was, order, code = keep[by], nxt[by], code[by]
        grown = np.zeros(len(order), np.int16)
        near = np.flatnonzero(code[1:] == code[:-1]) + 1
        grown[near] = np.minimum(_range_min(common, was[near - 1] + 1, was[near]) + 1, length)
        common = grown
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *pieces]), np.concatenate([none, *windows])


def _sorted_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """doc, rk, start, n of the runs of windows that repeat an earlier piece's."""
    def block(rows: pa.Table):
        doc, rk, start, n, a, key = (rows.column(c).to_numpy() for c in ("doc", "rk", "start", "n", "a", "key"))
        group = np.cumsum(np.append(0, key[1:] != key[:-1]))
        place = np.empty(len(key), np.int64)
        by = np.lexsort((rk, start + a, doc))
        place[by] = np.arange(len(by))
        content = rows.column("content").cast(pa.large_binary()).combine_chunks()
        content = content.chunk(0) if isinstance(content, pa.ChunkedArray) else content
        off = np.frombuffer(content.buffers()[1], np.int64, len(content) + 1, content.offset * 8)
        data = np.frombuffer(content.buffers()[2], np.uint8)
        i, w = induce(group, a.astype(np.int64), n.astype(np.int64), place, data, off, length)
        by = np.lexsort((w, i))
        i, w = i[by], w[by]
        head = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (w[1:] != w[:-1] + 1))) if len(i) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(i))).astype(np.int32)
        i, w = i[head], w[head]
        return pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(rk[i]), pa.array(start[i] + w), pa.array(size)], ["doc", "rk", "start", "n"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            edges = np.flatnonzero(key[1:] != key[:-1]) + 1
            if held and len(key) and held[-1].column("key")[-1].as_py() != key[0]:
                edges = np.append(0, edges)
            if rows + batch.num_rows >= GROUP and len(edges):  # whole groups only
                last = int(edges[-1])
                yield block(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held, rows = [batch.slice(last)], batch.num_rows - last
            else:
                held.append(batch)
                rows += batch.num_rows
        if rows:
            yield block(pa.Table.from_batches(held))

    dealt = pieces.select("doc", "rk", "start", "n", "a", "key", "content").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc long, rk long, start long, n int")


def repeats_in_first_pieces(docs: DataFrame, first: DataFrame, length: int, gram: int, group: int = GROUP) -> DataFrame:
    """doc, rk, start, n of the runs of windows, in pieces that are the first of their kind, that start earlier elsewhere."""
    open_keys = tables.written(_of_open_keys(first), "repeat-open")
    pieces = _with_bytes(docs, open_keys, length, gram).withColumns({"lo": F.lit(0), "hi": F.lit(length - gram)})
    pieces, out = tables.written(pieces, "repeat-bytes"), None
    while True:
        ready = _sorted_repeats(pieces.where((F.col("m") <= group) | (F.col("lo") == F.col("hi"))), length)
        out = ready if out is None else out.union(ready)
        crowded = pieces.where((F.col("m") > group) & (F.col("lo") < F.col("hi")))
        if crowded.isEmpty():
            return out
        halves = tables.written(_split(crowded, length), "repeat-halves")
        begin = halves.groupBy("key", "same").agg(F.min(F.struct("doc", "start", "rk")).alias("f"))
        halves = tables.written(halves.join(begin, ["key", "same"]).select("*", ((F.col("doc") == F.col("f.doc")) & (F.col("start") == F.col("f.start"))
                                                                                & (F.col("rk") == F.col("f.rk"))).alias("first")).drop("f"), "repeat-halves")
        out = out.union(halves.where("not first").select("doc", "rk", "start", "n"))
        pieces = tables.written(_of_open_keys(halves.where("first").drop("first")), "repeat-bytes")


def _kept(t: Texts, gone: np.ndarray):
    """Spans (their starts and ends in the text, how many each text has) and the remaining bytes of some texts."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[t.off] = True
    before, after = np.append(False, gone[:-1]), np.append(gone[1:], False)
    starts = np.flatnonzero(gone & (~before | edge[:-1]))
    ends = np.flatnonzero(gone & (~after | edge[1:])) + 1
    owner = np.searchsorted(t.off, starts, side="right") - 1
    stay = np.append(0, np.cumsum(~gone))
    return starts - t.off[owner], ends - t.off[owner], np.bincount(owner, minlength=t.n), stay[t.off], t.data[~gone]


def remove(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end: the removed runs of bytes), kept (the remaining bytes) for each row."""
    if not 1 <= gram <= length or length - gram > 254:
        raise ValueError("the sample gram must be at most the length, and at most 254 bytes shorter")
    docs = _docs(documents)
    live = _repeating(docs, length, gram)
    first = _first_pieces(docs, length, gram, live)
    inner = repeats_in_first_pieces(docs, first, length, gram, group)
    # What a text is told: its first pieces as start * 1024, runs of repeats as start * 1024 + windows * 2 + 1.
    told = first.select("doc", "rk", F.shiftleft("start", 10).alias("code")).union(
        inner.select("doc", "rk", (F.shiftleft("start", 10) + F.col("n") * 2 + 1).alias("code")))
    told = told.groupBy("doc", "rk").agg(F.collect_list("code").alias("codes"))

    def run(batches):
        for batch, t in slices(batches, "text"):
            codes = batch.column("codes")
            count = np.diff(np.frombuffer(codes.buffers()[1], np.int32, len(codes) + 1, codes.offset * 4)) if len(codes) else np.zeros(0, np.int32)
            code = codes.flatten().to_numpy()
            holder = np.repeat(np.arange(t.n), count)
            place = t.off[holder] + (code >> 10)
            owner, start, n, *_ = scan(t, length, gram, lambda k: _in(live, k))
            start += t.off[owner]
            is_run = code & 1 > 0
            later = ~np.isin(start, place[~is_run])
            begin = np.concatenate([start[later], place[is_run]])
            end = np.concatenate([(start + n)[later], place[is_run] + (code[is_run] >> 1 & 511)]) + length - 1
            depth = np.bincount(begin, minlength=len(t.data) + 1) - np.bincount(end, minlength=len(t.data) + 1)
            s, e, spans, stay, body = _kept(t, np.cumsum(depth[:-1]) > 0)
            off = np.append(0, np.cumsum(spans)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(s), pa.array(e)], ["start", "end"])
            kept = pa.Array.from_buffers(pa.large_binary(), t.n, [None, pa.py_buffer(stay.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(t.off)), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pairs),
                                              kept.cast(pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    own = _docs(documents, F.col("doc_id").cast("long").alias("doc_id"))
    met = own.join(told.hint("shuffle_hash"), ["doc", "rk"], "left").select("doc_id", "text", F.coalesce("codes", F.array().cast("array<long>")).alias("codes"))
    return met.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    found = remove(documents)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
