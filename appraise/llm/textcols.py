"""Vectorised work on Arrow text columns: words, lines and rolling hashes of whole batches.

A batch of texts is one byte array and one offset array; every function below works on all texts
of a batch at once and never crosses from one text into the next. Hashes are 64-bit
polynomials over a fixed random byte table, taken from prefix sums, then mixed; the same bytes give
the same hash in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts handed to numpy at once hold about this many bytes (one text may hold more).
CHUNK_BYTES = 1 << 20

_U = np.uint64
_P, _MASK = 0x9E3779B97F4A7C17, (1 << 64) - 1  # odd, and 3 mod 4: P - 1 has one factor of two
_P = _P if _P % 4 == 3 else _P + 2
_PINV = pow(_P, -1, 1 << 64)
_BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words ``[^\x20\x09-\x0D]+``.
BLANK_WORD = ~SPACE
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = {"n": 0, "up": np.zeros(0, _U), "down": np.zeros(0, _U)}


def _grow(n: int) -> None:
    if n > _powers["n"]:
        n = max(n, CHUNK_BYTES)
        for name, base in (("up", _P), ("down", _PINV)):
            out = np.empty(n, _U)
            out[0] = 1
            have, step = 1, base
            while have < n:  # doubling: out[have:2*have] = out[:have] * base**have
                take = min(have, n - have)
                out[have:have + take] = out[:take] * _U(pow(base, have, 1 << 64))
                have += take
            _powers[name] = out
        _powers["n"] = n


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection that spreads every bit)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Texts:
    """Some texts of a batch: ``data`` (uint8) and ``off`` (len + 1 offsets into it)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off, self.n = data, off, len(off) - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes with ``inside[byte]``, and how many each text has."""
        m = inside[self.data]
        edge = np.zeros(len(m) + 1, bool)
        edge[self.off] = True
        before = np.zeros(len(m), bool)
        before[1:] = m[:-1]
        starts = np.flatnonzero(m & (~before | edge[:-1]))
        after = np.zeros(len(m), bool)
        after[:-1] = m[1:]
        ends = np.flatnonzero(m & (~after | edge[1:])) + 1
        return starts, ends, np.diff(np.searchsorted(starts, self.off))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the ``\\n``-split lines (a text without one is one line), and their number."""
        at = np.flatnonzero(self.data == 10)
        count = np.diff(np.searchsorted(at, self.off)) + 1
        starts, ends = np.sort(np.concatenate([self.off[:-1], at + 1])), np.sort(np.concatenate([self.off[1:], at]))
        return starts, ends, count

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
        """A 64-bit hash of each byte span; ``fold`` lower-cases A-Z."""
        _grow(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, _U)
        np.cumsum((_FOLDED if fold else _BYTES)[self.data] * _powers["up"][:len(self.data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * _powers["down"][starts]
        return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))

    def text(self, i: int) -> str:
        return self.data[self.off[i]:self.off[i + 1]].tobytes().decode("utf-8", "replace")


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive items; entry i covers items i..i+k-1 (len(h)-k+1 entries)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out *= _U(0xC2B2AE3D27D4EB4F)
        out += h[j:j + n]
    return mix(out)


def texts_of(column: pa.Array) -> Texts:
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return Texts(data[off[0]:off[-1]], off - off[0])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batches cut to pieces of about CHUNK_BYTES of text, each with its text column as bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = texts_of(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < whole.n:
            hi = int(np.searchsorted(whole.off, whole.off[lo] + CHUNK_BYTES, side="right")) - 1
            hi = min(max(hi, lo + 1), whole.n)
            yield batch.slice(lo, hi - lo), Texts(whole.data[whole.off[lo]:whole.off[hi]], whole.off[lo:hi + 1] - whole.off[lo])
            lo = hi


def binary(rows: np.ndarray) -> pa.Array:
    """Each row of a 2-d array as one binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    off = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(rows.tobytes())])


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))
