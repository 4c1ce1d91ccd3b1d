"""Language identification with string kernels: Nyström landmarks and one-versus-rest kernel ridge regression.

The kernel of two texts is the number of distinct byte n-grams (1 to 3, letters lower-cased, everything that is no
letter as a blank) that both have, over the root of the product of their numbers: the blended-spectrum presence
kernel on the n-grams that occur in a landmark. Landmarks and regression rows are bounded samples of the
training rows, drawn by hash of the id for each language: ``TRAIN_EACH`` texts, of which ``LANDMARKS`` in all are
landmarks. Solving (K_nm' K_nm + ridge K_mm) a = K_nm' Y gives a coefficient for each landmark and language; a batch of
texts is scored by matrix products of its n-gram presence with the landmarks' and of that with a.

Defined results: a null or letterless text is ``und`` with score 0, as is everything if nothing can be learned;
equal rows are each judged and learned from once; further columns are ignored; a very long text is one row of
one task, its n-grams at some 30 bytes for each of its own; a null id is held out; rows with null text or language are not learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import Texts, slices

TRAIN_EACH, LANDMARKS, RIDGE, FOLD = 300, 96, 0.05, 5
_BLOCK = 256  # texts whose presence matrix is made at once
_FOLDED = np.full(256, 0x20, np.uint8)
_FOLDED[0x61:0x7B] = _FOLDED[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLDED[0x80:] = np.arange(0x80, 0x100)
_LETTER = regex.compile(r"\p{L}")


def gram_codes(t: Texts) -> list[np.ndarray]:
    """For each byte of the texts, the codes of the 1-, 2- and 3-gram that begin there (blanks beyond a text's end)."""
    c, full = _FOLDED[t.data], np.diff(t.off) > 0
    ends = t.off[1:][full] - 1
    one, two = np.empty_like(c), np.empty_like(c)
    one[:-1], one[-1:] = c[1:], 0x20
    one[ends] = 0x20
    two[:-1], two[-1:] = one[1:], 0x20
    two[ends] = 0x20
    c, one = c.astype(np.int32), one.astype(np.int32)
    return [c + (1 << 24), (c << 8 | one) + (1 << 25), c << 16 | one << 8 | two]


def _distinct(t: Texts) -> list[np.ndarray]:
    codes = gram_codes(t)
    return [np.unique(np.concatenate([c[a:b] for c in codes])) for a, b in zip(t.off[:-1], t.off[1:], strict=True)]


class Model:
    """Languages, the n-grams of the landmarks, and the products that score a presence row."""

    def __init__(self, languages: list[str], sets: list[np.ndarray], owner: np.ndarray, landmark: np.ndarray):
        self.languages = languages
        self.codes = np.unique(np.concatenate([s for s, l in zip(sets, landmark, strict=True) if l]))
        x = np.zeros((len(sets), len(self.codes)), np.float32)
        for row, s in zip(x, sets, strict=True):
            at = np.searchsorted(self.codes, s)
            at = at[(at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == s)]
            row[at] = 1
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        marks = x[landmark]
        k, kmm = (x @ marks.T).astype(float), (marks @ marks.T).astype(float)
        y = np.eye(len(languages))[owner]
        # a language with few rows weighs as much as one with many
        weight = (1 / np.maximum(np.bincount(owner, minlength=len(languages)), 1))[owner][:, None]
        a = np.linalg.solve(k.T @ (weight * k) + RIDGE * (kmm / len(kmm) + 1e-6 * np.eye(len(kmm))), k.T @ (weight * y))
        self.marks, self.a = marks.T.copy(), a.astype(np.float32)

    def tables(self) -> list[np.ndarray]:
        """Column of each code (0: none) for the three gram lengths."""
        out = []
        for lo, hi in ((1 << 24, (1 << 24) + 256), (1 << 25, (1 << 25) + 65536), (0, 1 << 24)):
            column = np.zeros(hi - lo, np.uint32)
            here = np.flatnonzero((self.codes >= lo) & (self.codes < hi))
            column[self.codes[here] - lo] = here + 1
            out.append(column)
        return out

    def scores(self, t: Texts, columns: list[np.ndarray]) -> np.ndarray:
        codes = gram_codes(t)
        at = [columns[0][codes[0] - (1 << 24)], columns[1][codes[1] - (1 << 25)], columns[2][codes[2]]]
        out, width = np.zeros((t.n, len(self.languages)), np.float32), len(self.codes) + 1
        for lo in range(0, t.n, _BLOCK):
            off = t.off[lo:lo + _BLOCK + 1]
            rows = np.repeat(np.arange(len(off) - 1, dtype=np.int64) * width, np.diff(off))
            has = np.zeros((len(off) - 1) * width, np.float32)
            for a in at:
                has[rows + a[off[0]:off[-1]]] = 1
            has = has.reshape(-1, width)[:, 1:]
            k = has @ self.marks / np.sqrt(np.maximum(has.sum(axis=1, keepdims=True), 1))
            out[lo:lo + _BLOCK] = k @ self.a
        return out


def train(docs: DataFrame, each: int = TRAIN_EACH, landmarks: int = LANDMARKS) -> Model | None:
    """Fits on a bounded sample of the rows whose id is in a training fold."""
    rows = tables.documents(docs, F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null") \
        .where(tables.training("doc_id", FOLD))
    many = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not many:
        return None
    languages = sorted(many)
    share = F.coalesce(F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, 4 * each / many[k]))])[F.col("lang")], F.lit(0.0))
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    # one of the equal rows: however many rows repeat an id, a language gives at most ``each``
    near = rows.withColumn("key", F.xxhash64("text")).select("doc_id", "lang", "key").where(u < share).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "key"))
    ids = near.select("doc_id", "lang", "key", rank.alias("rank")).where(F.col("rank") <= each)

    def run(batches):
        for batch, t in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3),
                                              pa.array([s.tobytes() for s in _distinct(t)], pa.binary())], ["doc_id", "lang", "rank", "codes"])
    found = rows.withColumn("key", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "lang", "key"])
    picked = found.groupBy("rank", "lang").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")).select("doc_id", "text", "lang", "rank")
    got = sorted(picked.mapInArrow(run, "doc_id long, lang string, rank int, codes binary").collect(), key=lambda r: (r.rank, r.lang, r.codes))
    sets = [np.frombuffer(r.codes, np.int32) for r in got]
    owner = np.array([languages.index(r.lang) for r in got])
    landmark = np.zeros(len(got), bool)
    landmark[:max(landmarks, len(languages))] = True  # in order of rank: as many of each language as there are
    return Model(languages, sets, owner, landmark)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row; ids and languages are not looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        columns = model.tables() if model else None
        for batch, t in slices(batches):
            ascii_letter = np.concatenate([[0], np.cumsum((t.data | 32) - 97 < 26)])
            some = ascii_letter[t.off[1:]] > ascii_letter[t.off[:-1]]
            for i in np.flatnonzero(~some & (np.diff(t.off) > 0)).tolist():
                some[i] = _LETTER.search(t.text(i)) is not None
            if model:
                f = model.scores(t, columns)
                best, top = f.argmax(axis=1), np.clip(f.max(axis=1), 0, 1)
                names = [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), some.tolist(), strict=True)]
            else:
                names, top = ["und"] * t.n, np.zeros(t.n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()),
                                              pa.array(np.where(some, top, 0).astype(float))], ["doc_id", "held_out", "lang_pred", "score"])
    return tables.documents(docs, (~tables.training("doc_id", FOLD)).alias("held_out")) \
        .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
