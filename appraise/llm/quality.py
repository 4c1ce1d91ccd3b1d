"""Quality rules: counts over the whole text, then a linear-chain CRF over its lines.

Each line of a text is labelled content or boilerplate by Viterbi decoding of a two-label linear-chain
conditional random field over the line's features; a text is kept if content lines hold at least
``CONTENT_SHARE`` of its words and it passes the fixed counts. The field is fitted by maximum likelihood on the
lines of at most ``TRAIN_DOCS`` labelled documents of at most ``TRAIN_LINES`` lines each (lines of a
document of quality 1 as content, of quality 0 as boilerplate), drawn by hash of the id; without labels of
both kinds every line is content. Counting and decoding work on all texts of an Arrow batch at once.

Defined results: a null text has no words and fails; equal rows are each judged; ids may be null; a label that is
null or repeated in contradiction is not learned from; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import BLANK_WORD, Texts, grams, mix, slices

#: The bounded training sample, the fit's steps, and the share of a text's words that content lines must hold.
TRAIN_DOCS, TRAIN_LINES, STEPS, CONTENT_SHARE = 4000, 48, 150, 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_HEAD = np.ones(256, bool)  # the first byte of each code point
_HEAD[0x80:0xC0] = False
_SYMBOL = _class("#*$%&|<>")
_UPPER, _LOWER, _DIGIT = (_class("".join(map(chr, range(*r)))) for r in ((65, 91), (97, 123), (48, 58)))
_LOUD, _STOP, _OTHER = _class("!?"), _class(".,;:"), _class("=_/\\{}[]()@^~+\"")
FEATURES = 11


def line_features(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (a row for each line), words of each line, lines of each text, and later copies of a line with words."""
    s, e, count = t.lines()
    word_start, _, _ = t.spans(BLANK_WORD)
    words = np.searchsorted(word_start, e) - np.searchsorted(word_start, s)

    def sums(table):
        c = np.zeros(len(t.data) + 1, np.int32)
        np.cumsum(table[t.data], out=c[1:], dtype=np.int32)
        return (c[e] - c[s]).astype(np.float32)
    chars = sums(_HEAD)
    owner = np.repeat(np.arange(t.n), count)
    h = mix(t.hashes(s, e, False) ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(h, kind="stable")
    again = np.zeros(len(h), bool)
    again[order[1:]] = h[order[1:]] == h[order[:-1]]
    again &= words > 0
    per = np.maximum(chars, 1)
    w = np.maximum(words, 1).astype(np.float32)
    letters = np.maximum(sums(_UPPER) + sums(_LOWER), 1)
    f = np.stack([np.ones(len(s), np.float32), np.minimum(sums(_SYMBOL) / w, 3), np.minimum(sums(_LOUD) / w, 3), sums(_UPPER) / letters,
                  10 * sums(_DIGIT) / per, np.minimum(sums(_STOP) / w, 2), np.minimum(sums(_OTHER) / w, 3), np.log1p(words).astype(np.float32) / 3,
                  np.minimum(chars / w, 30) / 10, again.astype(np.float32), (words == 0).astype(np.float32)], axis=1)
    return f, words, count, again


def counts(t: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_repeat_words of each text."""
    s, e, n = t.spans(BLANK_WORD)

    def sums(hit):
        c = np.zeros(len(t.data) + 1, np.int64)
        np.cumsum(hit, out=c[1:])
        return c[t.off[1:]] - c[t.off[:-1]]
    owner = np.repeat(np.arange(t.n), n)
    g = grams(t.hashes(s, e, False), 3)
    inside = np.flatnonzero(owner[:len(g)] == owner[2:]) if len(g) else np.zeros(0, np.int64)
    g = mix(g[inside] ^ (owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(g)
    same = g[order[1:]] == g[order[:-1]]
    twice = inside[np.concatenate([order[1:][same], order[:-1][same]])]
    covered = np.zeros(len(s), bool)
    for j in range(3):
        covered[twice + j] = True
    return {"n_words": n.astype(np.int64), "word_chars": sums((BLANK_WORD & _HEAD)[t.data]), "n_symbols": sums(_SYMBOL[t.data]),
            "n_repeat_words": np.bincount(owner[covered], minlength=t.n).astype(np.int64)}


def _chains(count: np.ndarray):
    """Steps over chains laid one after another: at step j, the chains longer than j (longest first)."""
    order = np.argsort(-count, kind="stable")
    begin = (np.cumsum(count) - count)[order]
    long = count[order]
    return begin, [int(np.searchsorted(-long, -j, side="left")) for j in range(int(count.max(initial=0)))]


def viterbi(emission: np.ndarray, count: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best label of each line: emission (lines, 2) scores, trans[from, to], chains of count lines."""
    begin, alive = _chains(count)
    score, back = emission.copy(), np.zeros(emission.shape, np.int8)
    for j in range(1, len(alive)):
        at = begin[:alive[j]] + j
        ways = score[at - 1][:, :, None] + trans
        back[at] = ways.argmax(axis=1)
        score[at] += ways.max(axis=1)
    label = np.zeros(len(emission), np.int8)
    for j in range(len(alive) - 1, -1, -1):
        at = begin[:alive[j]] + j
        longer = alive[j + 1] if j + 1 < len(alive) else 0
        label[at[longer:]] = score[at[longer:]].argmax(axis=1)
        label[at[:longer]] = back[at[:longer] + 1, label[at[:longer] + 1]]
    return label


def fit_crf(x: np.ndarray, y: np.ndarray, count: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, 2) and transitions (2, 2) that maximise the chains' likelihood (Adam on the exact gradient)."""
    begin, alive = _chains(count)
    w, trans, lines = np.zeros((x.shape[1], 2)), np.zeros((2, 2)), len(x)
    params, m, v = [w, trans], [np.zeros_like(w), np.zeros_like(trans)], [np.zeros_like(w), np.zeros_like(trans)]
    own = np.eye(2)[y]
    linked = np.concatenate([begin[:a] + j for j, a in enumerate(alive) if j] or [np.zeros(0, np.int64)])
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[linked - 1], y[linked]), 1)
    for step in range(1, steps + 1):
        emission = x @ w
        fwd, bwd = emission.copy(), np.zeros_like(emission)
        for j in range(1, len(alive)):
            at = begin[:alive[j]] + j
            fwd[at] += np.logaddexp.reduce(fwd[at - 1][:, :, None] + trans, axis=1)
        for j in range(len(alive) - 1, 0, -1):
            at = begin[:alive[j]] + j
            bwd[at - 1] = np.logaddexp.reduce(trans + (emission[at] + bwd[at])[:, None, :], axis=2)
        total = np.logaddexp.reduce(fwd + bwd, axis=1)
        p = np.exp(fwd + bwd - total[:, None])
        q = np.exp(fwd[linked - 1][:, :, None] + trans + (emission[linked] + bwd[linked])[:, None, :] - total[linked][:, None, None])
        grad = [x.T @ (own - p) / lines - 1e-4 * w, (pairs - q.sum(axis=0)) / lines - 1e-4 * trans]
        for k, (value, g) in enumerate(zip(params, grad, strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            value += 0.15 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return w, trans


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES):
    """The field's weights and transitions, or None without labelled documents of both kinds."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("top")).where("quality = top"))
    half = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs // 2).select("doc_id", "quality") for q in (0, 1)]
    sample = tables.documents(docs).join(F.broadcast(half[0].union(half[1])), "doc_id")

    def run(batches):
        for batch, t in slices(batches):
            f, _, count, _ = line_features(t)
            at = np.cumsum(count) - count
            keep = np.flatnonzero(count <= max_lines)
            yield pa.RecordBatch.from_arrays([
                batch.column(2).take(pa.array(keep)), pa.array(count[keep].astype(np.int32)),
                pa.array([f[at[i]:at[i] + count[i]].tobytes() for i in keep.tolist()], pa.binary()), batch.column(0).take(pa.array(keep))],
                ["quality", "lines", "f", "doc_id"])
    got = sorted(sample.mapInArrow(run, "quality int, lines int, f binary, doc_id long").collect(), key=lambda r: (r.doc_id, r.f))
    if {r.quality for r in got} != {0, 1}:
        return None
    x = np.concatenate([np.frombuffer(r.f, np.float32).reshape(-1, FEATURES) for r in got]).astype(float)
    count = np.array([r.lines for r in got])
    return fit_crf(x, np.repeat([1 - r.quality for r in got], count), count)


def _verdicts(t: Texts, model, share: float) -> dict[str, np.ndarray]:
    c = counts(t)
    f, words, lines, again = line_features(t)
    owner = np.repeat(np.arange(t.n), lines)
    label = viterbi(f.astype(float) @ model[0], lines, model[1]) if model is not None else np.zeros(len(f), np.int8)
    content = np.bincount(owner, weights=words * (label == 0), minlength=t.n)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    return {**c, "n_dup_lines": np.bincount(owner[again], minlength=t.n).astype(np.int64), "content_words": content.astype(np.int64),
            "base_failed": failed, "kept": ~failed & (content >= share * c["n_words"])}


def judge(docs: DataFrame, model, share: float = CONTENT_SHARE) -> DataFrame:
    """doc_id, the five counts, content_words, base_failed, kept for each row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words", "base_failed", "kept"]

    def run(batches):
        for batch, t in slices(batches):
            v = _verdicts(t, model, share)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v[n]) for n in names]], ["doc_id", *names])
    return tables.documents(docs).mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                                  "n_repeat_words long, content_words long, base_failed boolean, kept boolean")


def keep(docs: DataFrame, model, share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    def run(batches):
        for batch, t in slices(batches, own):
            yield batch.select(docs_columns).filter(pa.array(_verdicts(t, model, share)["kept"]))
    docs_columns, own = docs.columns, tables.fresh(docs, "__text")
    return docs.withColumn(own, F.col("text").cast("string")).mapInArrow(run, docs.schema)
