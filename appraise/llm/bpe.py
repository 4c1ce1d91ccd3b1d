"""Byte-level BPE through a minimal acyclic transducer of the corpus's frequent words.

1. One scan counts the pieces into which the tokenizer's pattern splits the texts; the ``LEXICON`` most frequent
   are encoded by the merge rules and compiled, in sorted order, into the minimal acyclic automaton of their
   bytes: equal suffixes share states, each transition carries how many words it passes over, and the sum on a
   word's path is its number, under which its ids stand.
2. The automaton is one flat buffer. A task writes it to an unnamed file, memory-maps it, and walks all new
   pieces of a batch through it at once. Pieces that it lacks are merged exactly, by rank.
3. Decoding joins the bytes of the ids and reads them as UTF-8.

Tokens that the file declares as added are cut out of the text first, as the tokenizer does. Defined results:
null and empty texts have no ids; null or unknown ids decode to nothing; bytes that are not UTF-8 decode to U+FFFD; every row
is encoded on its own, equal rows included; other columns pass through untouched.
"""

from __future__ import annotations

import functools
import heapq
import json
import tempfile
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appraise.llm import tables
from appraise.llm.textcols import lists, slices

LEXICON = 1 << 17
#: Longest piece of the lexicon, in bytes: with LEXICON a bound on its size.
LONGEST = 64
#: How the byte-level tokenizer splits a text before its merges (fixed by its file's pre-tokenizer).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_HELD = 200_000  # distinct pieces that a task remembers


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: itself if printable, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """A tokenizer file's vocabulary, merge ranks and added tokens, over bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        byte = _byte_of_char()

        def plain(s):
            return bytes(byte[c] for c in s)
        self.id = {plain(k): v for k, v in file["model"]["vocab"].items() if all(c in byte for c in k)}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"])
        self.rank = {(plain(a), plain(b)): i for i, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of = {v: k for k, v in self.id.items()} | {v: k.encode() for k, v in self.added.items()}
        for content in self.added:
            self.id.pop(content.encode(), None)
        # the library merges by least id of the merged pair: the same if each merge's id grows with its rank
        ids = [self.id.get(a + b, -1) for a, b in self.rank]
        self._fast = None
        if all(x < y for x, y in zip(ids, ids[1:], strict=False)) and all(bytes([b]) in self.id for b in range(256)):
            import tiktoken
            self._fast = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=self.id, special_tokens={})._core_bpe.encode_single_piece
        cut = "|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True))
        self._cut = regex.compile(f"({cut})") if cut else None

    def pieces(self, text: str) -> list:
        """The text's pieces in order; an added token is a tuple of its content."""
        if self._cut is None or not self._cut.search(text):
            return PATTERN.findall(text)
        out = []
        for i, part in enumerate(self._cut.split(text)):
            out += [(part,)] if i % 2 else PATTERN.findall(part)
        return out

    def merged(self, word: bytes) -> list[int]:
        """``encode`` by the compiled merge loop of a public library, where the vocabulary's order is its merges' order."""
        return self._fast(word) if self._fast else self.encode(word)

    def encode(self, word: bytes) -> list[int]:
        """Merges the word's bytes, always the pair of least rank, leftmost first."""
        if len(word) > 48:
            return self._encode_long(word)
        parts = [word[i:i + 1] for i in range(len(word))]
        rank = self.rank
        while len(parts) > 1:
            best, pair = min((rank.get(p, 1 << 60), p) for p in zip(parts, parts[1:], strict=False))
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == pair[0] and parts[i + 1] == pair[1]:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [self.id[p] for p in parts]

    def _encode_long(self, word: bytes) -> list[int]:
        """The same merges from a heap of pairs, for words in which searching all pairs each time would take long."""
        part: list = [word[i:i + 1] for i in range(len(word))]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(part, part[1:], strict=False)) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if part[i] != pair[0] or j >= len(part) or part[j] != pair[1]:
                continue
            part[i], part[j] = pair[0] + pair[1], None
            after[i] = after[j]
            if after[j] < len(part):
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and (b := after[a]) < len(part) and (r := self.rank.get((part[a], part[b]))) is not None:
                    heapq.heappush(heap, (r, a, (part[a], part[b])))
        return [self.id[p] for p in part if p is not None]


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The minimal acyclic transducer of sorted, distinct, non-empty words as one buffer of int64."""
    states, register = [], {}  # a state: (final, edges); an edge: (byte, state)

    def settle(node):
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path, last = [[False, []]], b""  # the states of the last word, not yet shared
    for word in [*words, b""]:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            child = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], child))
        path += [[False, []] for _ in word[same:]]
        if word:
            path[-1][0] = True
        last = word
    root = settle(path[0])
    below, key, target, add = [0] * len(states), [], [], []
    for s, (final, edges) in enumerate(states):  # a state's children were settled before it
        below[s] = int(final)
        for b, child in edges:
            key.append(s << 8 | b)
            target.append(child)
            add.append(below[s])
            below[s] += below[child]
    final = [int(f) for f, _ in states]
    first = np.cumsum([0, *map(len, ids)])
    flat = [i for x in ids for i in x]
    head = [root, len(states), len(key), len(words), len(flat), max(map(len, words), default=0)]
    return np.concatenate([np.array(x, np.int64) for x in (head, key, target, add, final, first, flat)]).tobytes()


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, buffer: bytes):
        with tempfile.TemporaryFile() as f:  # has no name: nothing stays when the task's process ends
            f.write(buffer)
            f.flush()
            data = np.memmap(f, np.int64, "r")
        self.root, states, edges, words, ids, self.longest = data[:6].tolist()
        cuts = np.cumsum([6, edges, edges, edges, states, words + 1, ids])
        self.key, self.target, self.add, self.final, self.first, self.ids = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the lexicon lacks it."""
        size = np.array([len(w) for w in words])
        out = np.full(len(words), -1)
        if not len(self.key):
            return out
        body, begin = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        todo = np.flatnonzero((size > 0) & (size <= self.longest))
        state, number = np.full(len(todo), self.root), np.zeros(len(todo), np.int64)
        for j in range(self.longest):
            if not len(todo):
                break
            want = state << 8 | body[begin[todo] + j]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[at] == want
            todo, state, number = todo[ok], self.target[at[ok]], number[ok] + self.add[at[ok]]
            done = size[todo] == j + 1
            hit = done & (self.final[state] == 1)
            out[todo[hit]] = number[hit]
            todo, state, number = todo[~done], state[~done], number[~done]
        return out


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Encoder:
    """Ids of many texts at once; remembers the pieces it has met, up to a bound."""

    def __init__(self, lexicon: bytes, path: str):
        self.lexicon, self.rules = Lexicon(lexicon), merges(path)
        self._clear()

    def _clear(self):
        self.known, self.first, self.ids = {}, array("q", [0]), array("i")

    def _learn(self, fresh: list) -> None:
        words = [p for p in fresh if isinstance(p, str)]
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        number, book = self.lexicon.numbers(spelled), self.lexicon
        listed = np.flatnonzero(number >= 0)
        if len(listed):  # their ids are copied all at once
            first, last = np.array(book.first[number[listed]]), np.array(book.first[number[listed] + 1])
            size = last - first
            end = np.cumsum(size)
            ids = book.ids[np.repeat(first - (end - size), size) + np.arange(end[-1])]
            self.known.update(zip([words[i] for i in listed.tolist()], range(len(self.first) - 1, len(self.first) - 1 + len(listed)), strict=True))
            self.first.frombytes((self.first[-1] + end).astype(np.int64).tobytes())
            self.ids.frombytes(ids.astype(np.int32).tobytes())
        rest = [(words[i], self.rules.merged(spelled[i])) for i in np.flatnonzero(number < 0).tolist()]
        rest += [(p, [self.rules.added[p[0]]]) for p in fresh if not isinstance(p, str)]
        for p, ids in rest:
            self.known[p] = len(self.first) - 1
            self.ids.extend(ids)
            self.first.append(len(self.ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and each text's number of them."""
        if len(self.known) > _HELD:
            self._clear()
        split = [self.rules.pieces(t) for t in texts]
        flat = [p for s in split for p in s]
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        self._learn([p for p in dict.fromkeys(flat) if p not in self.known])
        k = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        first, ids = np.array(self.first), np.array(self.ids, dtype=np.int32)
        size = first[k + 1] - first[k]
        end = np.cumsum(size)
        out = ids[np.repeat(first[k] - (end - size), size) + np.arange(end[-1])]
        pieces = np.cumsum([0, *map(len, split)])
        return out, np.diff(np.concatenate([[0], end])[pieces])


def frequent(docs: DataFrame, path: str, most: int = LEXICON) -> DataFrame:
    """word: the most frequent pieces of all texts, at most ``most`` in all. Pieces of equal count are in or out together, so the least
    count comes from a table of counts of counts, and only pieces that pass it leave their tasks. Pieces of more than ``LONGEST``
    bytes are left to be merged."""
    def run(batches):
        rules, count = merges(path), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["word", "n"])
        for _, t in slices(batches):
            for i in range(t.n):
                count.update(rules.pieces(t.text(i)))
            for content in rules.added:
                count.pop((content,), None)
            if len(count) > _HELD:
                yield out()
                count.clear()
        yield out()
    each = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    each = each.where(F.octet_length("word") <= LONGEST)
    counted = tables.written(each.groupBy("word").agg(F.sum("n").alias("n")), "bpe-pieces")
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = counted.groupBy("n").agg(F.count("*").alias("m"))  # one row for each different count
    least = sizes.select("n", F.sum("m").over(above).alias("upto")).where(F.col("upto") <= most).agg(F.min("n")).first()[0]
    return counted.where(F.col("n") >= least if least is not None else F.lit(False)).select("word")


def lexicon(docs: DataFrame, path: str, most: int = LEXICON) -> bytes:
    """The compiled automaton of ``frequent``: one task of at most ``most`` short words builds it, the driver gets the bytes."""
    def run(batches):
        words = sorted(w.encode() for batch in batches for w in batch.column(0).to_pylist())
        rules = merges(path)
        yield pa.RecordBatch.from_arrays([pa.array([compile_lexicon(words, [rules.merged(w) for w in words])], pa.binary())], ["compiled"])
    made = frequent(docs, path, most).repartition(1).mapInArrow(run, "compiled binary").first()
    return bytes(made.compiled) if made else compile_lexicon([], [])


def encode(docs: DataFrame, path: str, compiled: bytes, ids: str = "ids") -> DataFrame:
    """``docs`` with its text's ids as the array column ``ids``."""
    sent = docs.sparkSession.sparkContext.broadcast(compiled)
    own = tables.fresh(docs, "__text")
    made = docs.withColumn(own, F.col("text").cast("string"))

    def run(batches):
        encoder = Encoder(sent.value, path)
        for batch, t in slices(batches, own):
            values, count = encoder.encode([t.text(i) for i in range(t.n)])
            rest = [c for c in batch.schema.names if c not in (own, ids)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], lists(values, count, pa.int32())], [*rest, ids])
    kind = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != ids], f"`{ids}` array<int>"])
    return made.mapInArrow(run, kind)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ids as the column ``text``."""
    def run(batches):
        rules = merges(path)
        size = np.zeros(max(rules.bytes_of) + 2, np.int64)
        for i, b in rules.bytes_of.items():
            size[i + 1] = len(b)
        first = np.cumsum(size)
        body = np.frombuffer(b"".join(rules.bytes_of[i] for i in sorted(rules.bytes_of)), np.uint8)
        for batch in batches:
            column = batch.column(ids)
            lo = 0
            while lo < batch.num_rows:
                n = 1 + int(np.searchsorted(np.cumsum(column.slice(lo, 4096).value_lengths().fill_null(0).to_numpy()), 1 << 20))
                part = batch.slice(lo, n)
                lo += n
                col = part.column(ids)
                count = col.value_lengths().fill_null(0).to_numpy().astype(np.int64)
                i = col.flatten().fill_null(-1).to_numpy()
                i = np.where((i >= 0) & (i < len(first) - 1), i, len(first) - 1)
                long = np.append(np.diff(first), 0)[i]
                end = np.cumsum(long)
                flat = body[np.repeat(np.append(first[:-1], 0)[i] - (end - long), long) + np.arange(end[-1] if len(end) else 0)].tobytes()
                cut = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(count)])].tolist()
                made = pa.array([flat[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:], strict=False)], pa.string())
                rest = [c for c in part.schema.names if c != text]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], made], [*rest, text])
    kind = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text], f"`{text}` string"])
    return rows.mapInArrow(run, kind)


def digests(docs: DataFrame, path: str, most: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = encode(narrow, path, lexicon(narrow, path, most)).drop("text")
    return decode(coded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
