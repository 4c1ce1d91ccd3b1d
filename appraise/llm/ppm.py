"""Language-model scores by prediction by partial matching over bytes, pretrained on the training fold.

One scan of the training rows counts all 6-byte grams (five bytes of context and the next byte; a text is
padded in front and ends with an end symbol) and all tokens. The counts of shorter contexts are their sums. A
context has an escape for each byte seen after it. A byte is coded in the longest context that was seen; if it is not
there, an escape leads to the next shorter context, where the bytes of the longer one are excluded; beyond
order 0, the bytes left are equally likely. The log probabilities of all bytes of A-Z lower-cased text and of its end
add up to the score.

A byte's log probability depends on its gram only, so grams are looked up, not walked. Those that make up at least
``TRIE_SHARE`` of all positions, of which any corpus has at most 1 / TRIE_SHARE, are broadcast; a text's other grams are joined to the tables
of the trie, those never seen order by order.

The base score needs every token's count. Tokens that make up at least ``TOKEN_SHARE`` of all are broadcast (at most 1 /
TOKEN_SHARE); the other tokens of a text are joined to the table of all counts.

Defined results: a null text is empty: one end, no words; equal rows are each scored; a null id is held out; with
nothing to learn from, all bytes are equally likely and base_score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import BLANK_WORD, Texts, slices

ORDER, FOLD, SYMBOLS = 5, 10, 257
TRIE_SHARE, TOKEN_SHARE = 2.0 ** -22, 2.0 ** -22
_PAD, _END = 0xFF, 0xFE  # bytes that no UTF-8 text has
END_TOKEN = -1
_HELD = 1_000_000  # distinct grams and tokens that a task gathers before it passes them on
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def gram_codes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code of each symbol with its ORDER bytes of context, text by text, and where each text's codes begin."""
    size, pad = np.diff(t.off), ORDER + 1
    owner = np.repeat(np.arange(t.n), size)
    x = np.full(len(t.data) + pad * t.n, _PAD, np.uint64)
    x[np.arange(len(t.data)) + pad * owner + ORDER] = _LOWER[t.data]
    x[t.off[1:] + pad * np.arange(1, t.n + 1) - 1] = _END
    code = np.zeros(max(len(x) - ORDER, 0), np.uint64)
    for j in range(ORDER + 1):
        code <<= np.uint64(8)
        code |= x[j:len(x) - ORDER + j]
    begin = t.off[:-1] + np.arange(t.n)
    keep = np.repeat(np.arange(t.n) * ORDER, size + 1) + np.arange(len(t.data) + t.n)
    return code[keep], begin


def _tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    s, e, count = t.spans(BLANK_WORD)
    return t.hashes(s, e, True).view(np.int64), count


def counts(docs: DataFrame) -> DataFrame:
    """kind (0 token, 1 gram), key, n: how often each occurs in the given rows."""
    def summed(parts):
        key, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        key, at = np.unique(key, return_inverse=True)
        return key, np.bincount(at, weights=n).astype(np.int64)

    def out(kind, part):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), kind, np.int32)), pa.array(part[0].astype(np.int64)), pa.array(part[1])],
                                          ["kind", "key", "n"])

    def run(batches):
        held = [[], []]
        for _, t in slices(batches):
            grams, _ = gram_codes(t)
            tokens, _ = _tokens(t)
            for kind, keys in enumerate((tokens, grams.view(np.int64))):
                key, n = np.unique(keys, return_counts=True)
                held[kind].append((key, n))
                if kind == 0:
                    held[0].append((np.array([END_TOKEN]), np.array([t.n])))
                if sum(len(p[0]) for p in held[kind]) > _HELD:
                    held[kind] = [summed(held[kind])]
                    if len(held[kind][0][0]) > _HELD // 2:
                        yield out(kind, held[kind].pop())
        for kind in (0, 1):
            if held[kind]:
                yield out(kind, summed(held[kind]))
    made = tables.documents(docs).mapInArrow(run, "kind int, key long, n long")
    return made.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Index:
    """Positions of 64-bit keys by open addressing, looked up many at a time; -1 where a key is absent."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (len(keys) + len(keys) // 2).bit_length())
        self.shift, self.last = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.key, self.at = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys.astype(np.uint64))
        while len(todo):
            free = self.at[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.at[slot[won]], self.key[slot[won]] = todo[won], keys[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, slot = todo[rest], (slot[rest] + np.uint64(1)) & self.last

    def _slot(self, keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        at = self.at[slot]
        todo = np.flatnonzero((self.key[slot] != keys) & (at >= 0))
        while len(todo):
            slot_t = (slot[todo] + np.uint64(1)) & self.last
            slot[todo] = slot_t
            at[todo] = self.at[slot_t]
            todo = todo[(self.key[slot_t] != keys[todo]) & (at[todo] >= 0)]
        return at


class Trie:
    """Every context of the counted grams and every byte seen after it, as tables.

    seen: key, n, log: each whole gram, its count and the log probability of its last byte after the others. grams: k, key, n by
    order k. contexts: k, ctx and, of the context's own bytes, norm (log of their count with the escapes) and escape (its log
    probability); up_norm and up_escape are the same in the next shorter context without these bytes."""

    def __init__(self, grams: DataFrame, share: float):
        total = grams.agg(F.sum("n")).first()[0] or 0
        every = grams.select(F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("k"), "key", "n") \
            .groupBy("k", F.expr("key & (shiftleft(1L, 8 * (k + 1)) - 1)").alias("key")).agg(F.sum("n").alias("n"))
        every = tables.written(every, "ppm-orders")
        self.total, held = total, F.col("n") >= share * total
        self.grams = every.where(held)
        shorter = self.grams.select((F.col("k") + 1).alias("k"), F.col("key").alias("up_key"), F.col("n").alias("up_n"))
        by = every.withColumn("up_key", F.expr("key & (shiftleft(1L, 8 * k) - 1)")).join(shorter, ["k", "up_key"], "left") \
            .groupBy("k", F.shiftright("key", 8).alias("ctx")).agg(
                F.sum("n").alias("total"), F.sum(F.when(held, F.col("n"))).alias("held"), F.count_if(held).alias("kinds"),
                F.sum(F.when(held, F.coalesce("up_n", F.lit(0)))).alias("shared")).where("kinds > 0")
        by = tables.written(by, "ppm-contexts")
        above = by.select((F.col("k") + 1).alias("k"), F.col("ctx").alias("up_ctx"), F.col("held").alias("up_held"),
                          (F.col("total") - F.col("held") + F.col("kinds")).alias("up_out"))
        norm, out = F.log10(F.col("total") + F.col("kinds")), F.col("up_out") - F.col("kinds")
        left = F.col("up_held") - F.col("shared") + out  # 0 where the longer context has all that the shorter one has
        self.contexts = tables.written(by.withColumn("up_ctx", F.expr("ctx & (shiftleft(1L, 8 * (k - 1)) - 1)")).join(above, ["k", "up_ctx"], "left").select(
            "k", "ctx", norm.alias("norm"), (F.log10(F.col("total") - F.col("held") + F.col("kinds")) - norm).alias("escape"),
            F.when(left > 0, F.log10(left)).alias("up_norm"), F.when(left > 0, F.log10(out) - F.log10(left)).otherwise(0.0).alias("up_escape")), "ppm-escapes")
        root = by.where("k = 0").first()
        self.left = SYMBOLS - (root.kinds if root else 0)
        longest = self.contexts.where(F.col("k") == ORDER).select("ctx", "norm")
        self.seen = tables.written(self.grams.where(F.col("k") == ORDER).withColumn("ctx", F.shiftright("key", 8)).join(longest, "ctx")
                                   .select("key", "n", (F.log10("n") - F.col("norm")).alias("log")), "ppm-seen")

    def logs(self, codes: DataFrame) -> DataFrame:
        """key, log of the distinct ``codes`` (key): the log probability of each coded symbol after its context."""
        found = tables.written(codes.join(self.seen.select("key", "log"), "key", "left"), "ppm-looked-up")
        none = F.lit(None).cast("double")
        now = found.where("log is null").select("key", F.lit(0.0).alias("sum"), none.alias("up_norm"), none.alias("up_escape"), none.alias("log"))
        for k in range(ORDER, -1, -1):
            context = self.contexts.where(F.col("k") == k).select("ctx", "norm", "escape", F.col("up_norm").alias("next_norm"), F.col("up_escape").alias("next_escape"))
            now = now.withColumn("ctx", F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * k) - 1))).join(context, "ctx", "left")
            if k < ORDER:
                gram = self.grams.where(F.col("k") == k).select(F.col("key").alias("gram"), "n")
                now = now.withColumn("gram", F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))).join(gram, "gram", "left")
                # the bytes of the longer context, where it is known, are excluded here
                now = now.withColumn("log", F.coalesce("log", F.col("sum") + F.log10("n") - F.coalesce("up_norm", "norm")))
            step = F.when(F.col("norm").isNotNull(), F.coalesce("up_escape", "escape")).otherwise(0.0)
            now = now.select("key", (F.col("sum") + step).alias("sum"), F.col("next_norm").alias("up_norm"), F.col("next_escape").alias("up_escape"), "log")
        rest = now.select("key", F.coalesce("log", F.col("sum") - F.log10(F.lit(float(max(self.left, 1))))).alias("log"))
        return found.where("log is not null").select("key", "log").union(rest)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """Log probability of each of a few coded symbols after its context."""
        spark, codes = self.seen.sparkSession, np.unique(code.astype(np.int64))
        got = self.logs(spark.createDataFrame(pa.table({"key": codes}))).toArrow().sort_by("key")
        return got["log"].to_numpy()[np.searchsorted(codes, code.astype(np.int64))]


def build(grams: DataFrame, share: float = 0.0) -> Trie:
    """The trie of a table of gram counts (key, n). With a ``share``, a context's next byte that makes up less of all positions counts
    as the context's escapes; by default the trie holds them all."""
    return Trie(grams, share)


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``; ``train`` has the texts to learn from."""
    spark = docs.sparkSession
    known = tables.written(counts(train), "ppm-counts")
    tokens, grams = known.where("kind = 0").select("key", "n"), known.where("kind = 1").select("key", "n")
    of = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.count("*").alias("kinds")).first()
    common = tokens.where(F.col("n") >= TOKEN_SHARE * of.all).toArrow()
    common = common["key"].to_numpy(), common["n"].to_numpy()
    over = np.log10(of.all + 0.1 * (of.kinds + 1))
    trie = build(grams)
    often = trie.seen.where(F.col("n") >= TRIE_SHARE * trie.total).select("key", "log").toArrow()
    sent = spark.sparkContext.broadcast((Index(often["key"].to_numpy().view(np.uint64)), often["log"].to_numpy(),
                                         Index(common[0].view(np.uint64)), np.log10(common[1] + 0.1) - over))
    end = dict(zip(*map(np.ndarray.tolist, common), strict=True)).get(END_TOKEN, 0)

    def lists(keys, owner, n):
        off = np.zeros(n + 1, np.int32)
        np.cumsum(np.bincount(owner, minlength=n), out=off[1:])
        return pa.ListArray.from_arrays(pa.array(off), pa.array(keys))

    def run(batches):
        number, (known, known_logs, index, logs) = tables.Rows(), sent.value
        for batch, t in slices(batches):
            code, begin = gram_codes(t)
            of_text = np.repeat(np.arange(t.n), np.diff(np.append(begin, len(code))))
            at = known.find(code)
            met = at >= 0
            model = np.bincount(of_text[met], weights=known_logs[at[met]], minlength=t.n).astype(float)
            grams = lists(code[~met].view(np.int64), of_text[~met], t.n)
            tokens, count = _tokens(t)
            owner = np.repeat(np.arange(t.n), count)
            at = index.find(tokens.view(np.uint64))
            hit = at >= 0
            base = np.bincount(owner[hit], weights=logs[at[hit]], minlength=t.n) + np.log10(end + 0.1) - over
            here = np.bincount(owner[hit], minlength=t.n) + (end > 0)
            yield pa.RecordBatch.from_arrays([
                number.take(t.n), batch.column(0), batch.column(2), pa.array((count + 1).astype(np.int64)), pa.array(here.astype(np.int64)),
                pa.array(base), pa.array(model), lists(tokens[~hit], owner[~hit], t.n), grams],
                ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rest", "grams"])
    rows = tables.documents(docs, (~tables.training("doc_id", FOLD)).alias("held_out")).mapInArrow(
        run, "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, rest array<long>, grams array<long>")
    rows = tables.written(rows, "ppm-scored")
    sent.destroy()
    rare = rows.select("rid", F.explode("rest").alias("key")).join(tokens.where(F.col("n") < TOKEN_SHARE * of.all), "key", "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    more = rare.groupBy("rid").agg(F.sum(F.log10(c + 0.1) - F.lit(float(over))).alias("rest_base"), F.sum((c > 0).cast("long")).alias("rest_known"))
    seldom = rows.select("rid", F.explode("grams").alias("key"))
    found = tables.written(trie.logs(seldom.select("key").distinct()), "ppm-seldom")
    rest = seldom.join(found, "key").groupBy("rid").agg(F.sum("log").alias("rest_score"))
    zero = F.lit(0)
    return rows.drop("rest", "grams").join(more, "rid", "left").join(rest, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", zero)).alias("n_known"),
        F.lit(of.all).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rest_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", F.lit(0.0))).alias("score"))
