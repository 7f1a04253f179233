"""Benchmark decontamination by latent semantic retrieval.

1. Words are lower case, without marks at their ends. Those of the benchmark items have numbers of their own, all others of the corpus
   share ``2**hashed`` numbers; documents are cut into passages.
2. One pass counts documents by number (for the inverse document frequencies), a second one multiplies the TF-IDF matrix A of all
   passages and its transpose with a random matrix: Z = A'A G, summed by blocks of words. From Z, the driver computes the
   leading right singular vectors (randomised SVD in Nystrom form). What of a word lies outside their space, which for rare words is
   most, is kept as a random projection of ``rest`` dimensions.
3. A third pass slides windows over all documents and finds candidates by cosine. Items meet windows of one of three widths, at
   least as long as they are; longer items are cut into pieces. A pair is a candidate if its cosine over all dimensions is ``cosine`` of
   what an item would have among unlike words, or if its cosine in the latent space alone is ``near``.
4. A candidate leaks if the longest common subsequence covers ``lcs`` of the item's words; or ``paraphrase`` of them if it also
   holds ``answer`` of the item's answer, its last sentence; or ``reworded`` and the answer if it is also ``near`` in the latent space.

The benchmark is worked off in blocks of items with at most ``block_bytes`` of text, so what is sent to the executors is bounded
whatever its size; each block meets all documents. Null texts have no words and leak nothing; null ids stay null; rows that
repeat an id are one; empty tables give an empty result; extra columns, whatever their names, are ignored. Long texts are projected in
stretches, but checked as a whole: the subsequence is sought in the candidate's window and, on either side, as many words as the window
or the item has.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import staged
from tamarack.llm.repeats import mixed, stretches

STEP = 8
WIDTHS = (48, 96, 192)
PASSAGE = 48
STRETCH = 1 << 14
PIECE = 1 << 22  # bytes of text that are read at once
ENTRIES = 1 << 17  # of the TF-IDF matrix that are multiplied at once
CELLS = 1 << 18  # numbers of the windows' vectors that are compared at once
GROUP = 1024  # items that are searched for together
DENSE = 1 << 24  # cells of a table of words by items; larger ones are lists
#: What is cut off a word's ends: all characters of the common planes that are neither letters, digits nor underscores. Spaces too, as
#: Arrow looks beyond the last text's end for the end of its white space: if what lies there is no character, a space stays on the word.
MARKS = "".join(c for c in map(chr, range(0x3040)) if not (c.isalnum() or c == "_"))
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


@dataclass(frozen=True)
class Params:
    rank: int = 32
    over: int = 8
    rest: int = 40
    hashed: int = 13
    cosine: float = 0.4
    near: float = 0.9
    lcs: float = 0.8
    paraphrase: float = 0.6
    reworded: float = 0.5
    answer: float = 0.8
    block_bytes: int = 4 << 20
    seed: int = 17


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row (lower case, without marks at their ends; words of marks only are empty), and the text of each."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    return pc.utf8_trim(lists.flatten(), MARKS), np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))


def tokens(text: str) -> list[str]:
    return [w for w in split(pa.array([text], pa.string()))[0].to_pylist() if w]


class Vocabulary:
    """Numbers of words: those of the benchmark, then shared ones for all others, by a hash of their first and last eight bytes and length."""

    def __init__(self, words: list[str], hashed: int):
        self.own = {w: k for k, w in enumerate(words)}
        self.words = pa.array(words, pa.string())
        self.shared = np.uint64((1 << hashed) - 1)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """-1 for empty words."""
        if not len(words):
            return np.zeros(0, np.int32)
        end = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        begin, end = end[:-1], end[1:]
        size = end - begin
        raw = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8)])
        eight = np.ndarray(len(raw) - 7, "<u8", raw, 0, (1,))
        bits = (8 * (8 - np.clip(size, 1, 8))).astype(np.uint64)
        ends = (eight[begin] << bits) * np.uint64(0x9E3779B97F4A7C15) ^ (eight[np.maximum(begin, end - 8)] << bits)
        other = (mixed(ends + size.astype(np.uint64)) & self.shared).astype(np.int32) + np.int32(len(self.own))
        own = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        return np.where(size == 0, -1, np.where(own >= 0, own, other)).astype(np.int32)

    def read(self, text: str | None) -> np.ndarray:
        (out,) = self.read_all(pa.array([text], pa.string()))
        return out

    def read_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The numbers of each text's words; about ``PIECE`` bytes are read at once."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
            some = texts.slice(at, to - at)
            if to == at + 1 and ends[at] - (ends[at - 1] if at else 0) > PIECE:
                pieces = (pa.array([x.decode()], pa.string()) for x in stretches(some[0].as_py().encode(), PIECE))
                yield np.concatenate([x[x >= 0] for x in (self.numbers(split(p)[0]) for p in pieces)])
            else:
                words, of = split(some)
                ids = self.numbers(words)
                ids, of = ids[ids >= 0], of[ids >= 0]
                yield from np.split(ids, np.searchsorted(of, np.arange(1, to - at)))
            at = to


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """Inverse document frequencies; common words weigh little, but something, as an item may have no others left."""
    return np.log1p(n / np.maximum(df, 1))


@dataclass
class Item:
    item_id: int
    ids: np.ndarray
    answer: np.ndarray
    piece: np.ndarray  # what is searched for
    places: dict | None = None

    @staticmethod
    def cut(item_id: int, text: str, number: dict[str, int]) -> list[Item]:
        ids = np.array([number[w] for w in tokens(text)], np.int32)
        sentences = [s for s in map(tokens, _SENTENCE.split(text)) if s]
        answer = np.array([number[w] for w in (sentences[-1] if sentences and len(sentences[-1]) > 1 else tokens(text)[-5:])], np.int32)
        # pieces that windows hold wherever they start, of about one length: one of them has the share that the whole has
        return [Item(item_id, ids, answer, x) for x in np.array_split(ids, -(-len(ids) // (WIDTHS[-1] - WIDTHS[-1] // 3)))]


def width_of(n: int) -> int:
    """The narrowest windows that hold a stretch of n words wherever it starts; windows start at every third of their width."""
    return next((w for w in WIDTHS if n <= w - w // 3), WIDTHS[-1])


def places_of(a: np.ndarray) -> dict[int, int]:
    """For each number, the bits of its places."""
    where: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << k
    return where


def lcs(a: np.ndarray, b: np.ndarray, where: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, by bit-parallel rows; ``where``: the places of ``a``, if known."""
    full = (1 << len(a)) - 1
    v = full
    for m in filter(None, map((where or places_of(a)).get, b.tolist())):
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


_kept: dict = {}


def _once(key, make):
    """Per worker process, the last object of its kind."""
    if _kept.get("key") != key:
        _kept.update(key=key, value=make())
    return _kept["value"]


def _read(docs: DataFrame, words: list[str], hashed: int) -> DataFrame:
    """``doc_id, ids``: each text as numbers of words (32-bit), written once for the passes that follow."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    tag = uuid.uuid4().hex

    def run(batches):
        vocab = _once(("v", tag), lambda: Vocabulary(shared.value, hashed))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in vocab.read_all(batch.column(1))], pa.binary())], names=["doc_id", "ids"])

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary"), "benchmark-words")


def numbers(raw: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), np.int32) if raw.is_valid and raw.as_buffer().size else np.zeros(0, np.int32)


def _distinct(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Each number once, without sorting; ``place`` has room for every number, whatever it holds."""
    at = np.arange(len(ids), dtype=np.int32)
    place[ids] = at
    return ids[place[ids] == at]


def _frequencies(read: DataFrame, size: int) -> tuple[int, np.ndarray]:
    def run(batches):
        n, df, place = 0, np.zeros(size + 1, np.int64), np.zeros(size, np.int32)
        for batch in batches:
            for raw in batch.column(0):
                n += 1
                df[_distinct(numbers(raw), place)] += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["w", "n"])

    df = np.zeros(size + 1, np.int64)
    for r in read.select("ids").mapInArrow(run, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).collect():  # a row for each word at most
        df[r["w"]] = r["n"]
    return int(df[-1]), df[:-1]


def _passages(ids: np.ndarray, idf: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries of normalised TF-IDF rows: row starts, words, values."""
    for x in range(0, len(ids), STRETCH * width):
        part = ids[x : x + STRETCH * width]
        at = np.flatnonzero(idf[part] > 0)
        if not len(at):
            continue
        key, n = np.unique(at // width * len(idf) + part[at], return_counts=True)
        row, word = key // len(idf), key % len(idf)
        value = n * idf[word]
        begin = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1])
        norm = np.sqrt(np.add.reduceat(value * value, begin))
        yield begin, word, value / np.repeat(norm, np.diff([*begin, len(row)]))


def _basis(read: DataFrame, idf: np.ndarray, p: Params) -> np.ndarray:
    """Leading right singular vectors of the passages' TF-IDF matrix, a row for each word."""
    size, cols = len(idf), min(p.rank + p.over, len(idf))
    shared = read.sparkSession.sparkContext.broadcast(np.append(idf, 0.0))
    tag = uuid.uuid4().hex
    rows_of = 128  # words in a block of Z

    def random():
        return np.random.default_rng(p.seed).standard_normal((size, cols)).astype(np.float32)

    def run(batches):
        g, weights = _once(("b", tag), random), shared.value
        z = np.zeros((size, cols), np.float32)
        held, n = [], 0

        def added():
            if not held:
                return
            shift = np.cumsum([0, *(len(w) for _, w, _ in held)])[:-1]
            begin = np.concatenate([b + s for (b, _, _), s in zip(held, shift, strict=True)])
            word, value = np.concatenate([w for _, w, _ in held]), np.concatenate([v for _, _, v in held]).astype(np.float32)
            x, ends = g.take(word, axis=0), [*begin.tolist(), len(word)]
            low = np.stack([value[a:b] @ x[a:b] for a, b in zip(ends, ends[1:], strict=False)])
            row = np.repeat(np.arange(len(begin)), np.diff([*begin, len(word)]))
            order = np.argsort(word, kind="stable")
            first = np.concatenate([[0], np.flatnonzero(np.diff(word[order])) + 1])
            z[word[order][first]] += np.add.reduceat(low[row[order]] * value[order, None], first, axis=0)

        def take(texts):
            nonlocal held, n
            for entry in _passages(np.concatenate(texts), weights, PASSAGE):
                held.append(entry)
                n += len(entry[1])
                if n > ENTRIES:
                    added()
                    held, n = [], 0

        for batch in batches:
            texts, length = [], 0
            for raw in batch.column(0):
                ids = numbers(raw)
                texts += [ids, np.full(-len(ids) % PASSAGE, size, np.int32)]  # each text begins a passage of its own
                length += len(ids)
                if length > STRETCH:
                    take(texts)
                    texts, length = [], 0
            if texts:
                take(texts)
        added()
        for b in range(0, size, rows_of):
            if not z[b : b + rows_of].any():
                continue
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([z[b : b + rows_of].tobytes()], pa.binary())], names=["b", "z"])

    def summed(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, z in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(z.as_py(), np.float32).astype(np.float64)
                total[b] = total[b] + x if b in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["b", "z"])

    z = np.zeros((size, cols))
    # a task's Z has a size of its own, so there are no more of them than the cluster works off in two rounds
    some = read.select("ids").coalesce(2 * read.sparkSession.sparkContext.defaultParallelism)
    parts = some.mapInArrow(run, "b int, z binary").repartition("b").mapInArrow(summed, "b int, z binary")
    for r in parts.collect():  # a row for each word, in blocks
        x = np.frombuffer(bytes(r["z"]), np.float64).reshape(-1, cols)
        z[r["b"] : r["b"] + len(x)] = x
    g = random().astype(np.float64)
    shift = 1e-7 * (np.linalg.norm(z) + 1)
    z += shift * g
    core = g.T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max() * 1e-10
    u, _, _ = np.linalg.svd((z @ vectors[:, good]) / np.sqrt(values[good]), full_matrices=False)
    return u[:, : p.rank].astype(np.float32)


def _projection(idf: np.ndarray, basis: np.ndarray, p: Params) -> np.ndarray:
    """A row for each word: its place in the latent space, and a random projection of the rest; weighted. The last row, for no word, is 0."""
    r = np.random.default_rng(p.seed + 1).choice(np.array([-1, 1], np.float32), (len(idf), p.rest)) / np.float32(np.sqrt(max(1, p.rest)))
    r -= basis @ (basis.T @ r)
    return np.vstack([np.hstack([basis, r]) * idf[:, None].astype(np.float32), np.zeros((1, basis.shape[1] + p.rest), np.float32)])


def _fresh(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which words do not repeat one of the ``WIDTHS[0]`` places before: a word that a text repeats over and over weighs once."""
    order = np.argsort(ids, kind="stable")
    again = (ids[order][1:] == ids[order][:-1]) & (at[order][1:] - at[order][:-1] < WIDTHS[0])
    out = np.ones(len(ids), bool)
    out[order[1:][again]] = False
    return out


class Search:
    """Finds the items of a block in documents."""

    def __init__(self, items: list[Item], idf: np.ndarray, basis: np.ndarray, n_own: int, p: Params):
        self.p = p
        self.n_own = n_own
        self.none = len(idf)
        self.weighs = np.append(idf, 0.0) > 0
        self.low = _projection(idf, basis, p)
        self.rank = basis.shape[1]
        self.groups = []
        for x in items:
            x.places = places_of(x.ids)
        for width in WIDTHS:
            of = [x for x in items if width_of(len(x.piece)) == width]
            for k in range(0, len(of), GROUP):
                own = of[k : k + GROUP]
                n = np.array([len(x.piece) for x in own])
                v = np.stack([self.low[x.piece[_fresh(x.piece, np.arange(len(x.piece)))]].sum(axis=0) for x in own])
                unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                least = (p.cosine * np.sqrt(np.minimum(1.0, n / width))).astype(np.float32)
                keys, times = np.unique(np.concatenate([x.piece.astype(np.int64) + j * n_own for j, x in enumerate(own)]), return_counts=True)
                table = None
                if len(own) * n_own <= DENSE:
                    table = np.zeros((len(own), n_own + 1), np.uint8)  # the last column is for words of no item
                    table[keys // n_own, keys % n_own] = 1
                    table = table.ravel()
                self.groups.append((width, own, n, unit(v).T.copy(), unit(v[:, : self.rank]).T.copy(), least, keys, times, table))

    def found(self, texts: list[np.ndarray]) -> list[dict[int, tuple[float, float, float]]]:
        """For each document: item id -> best (share of the item, share of its answer, latent cosine). Short documents are worked off
        together."""
        out: list[dict] = [{} for _ in texts]
        held, size = [], 0
        for ids, own in zip(texts, out, strict=True):
            for x in range(0, len(ids), STRETCH):
                held.append((ids[max(0, x - WIDTHS[-1]) : x + STRETCH], own, ids, max(0, x - WIDTHS[-1])))
                size += len(held[-1][0])
                if size >= STRETCH:
                    self._stretch(held)
                    held, size = [], 0
        if held:
            self._stretch(held)
        return out

    def _stretch(self, held: list[tuple[np.ndarray, dict, np.ndarray, int]]) -> None:
        # each text begins at a block of its own; what fills its last block weighs nothing
        n_blocks = np.array([-(-len(ids) // STEP) for ids, *_ in held])
        first = np.cumsum(n_blocks) - n_blocks
        blocks = int(n_blocks.sum())
        ids = np.full((blocks + WIDTHS[-1] // STEP) * STEP, self.none, np.int32)
        for (own, *_), b in zip(held, first.tolist(), strict=True):
            ids[b * STEP : b * STEP + len(own)] = own
        at = np.flatnonzero(self.weighs[ids])
        at = at[_fresh(ids[at], at + 2 * WIDTHS[0] * np.searchsorted(first * STEP, at, "right"))]  # texts are far apart
        if not len(at):
            return
        low = self._sums(ids, at, blocks)
        for width, items, n_words, whole, latent, least, keys, times, table in self.groups:
            n = width // STEP
            count = -(-np.maximum(1, n_blocks - n + n // 3) // (n // 3))
            text = np.repeat(np.arange(len(held)), count)
            start = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * (n // 3)
            end = np.minimum(start + n, (first + n_blocks)[text])
            some = max(1, CELLS // max(len(items), self.low.shape[1]))
            for x in range(0, len(start), some):
                v = low[end[x : x + some]] - low[start[x : x + some]]
                square = v * v
                near = v[:, : self.rank] @ latent / np.maximum(np.sqrt(square[:, : self.rank].sum(axis=1, keepdims=True)), 1e-12)
                over = v @ whole >= least * np.maximum(np.sqrt(square.sum(axis=1, keepdims=True)), 1e-12)
                close = near >= self.p.near
                window, item = np.nonzero(over | close)
                if not len(window):
                    continue
                near, close = near[window, item], close[window, item]
                window += x
                # no common subsequence has more words than there are places with a word of the item
                share = np.where(close, min(self.p.reworded, self.p.paraphrase), self.p.paraphrase)
                need = share * n_words[item] - 1e-9
                keep = np.concatenate([self._places(ids, start[window[k : k + 4096]], width, item[k : k + 4096], keys, table) for k in range(0, len(window), 4096)]) >= need
                window, item, near, need = window[keep], item[keep], near[keep], need[keep]
                if not len(window):
                    continue
                keep = self._shared(ids, start[window], width, item, keys, times) >= need
                window, item, near = window[keep], item[keep], near[keep]
                self._check(held, items, first, text, start, end, window, item, near)

    def _sums(self, ids: np.ndarray, at: np.ndarray, blocks: int) -> np.ndarray:
        """Sums of the vectors of the words at ``at`` over all blocks before each block, and over all."""
        word = np.full(blocks * STEP, self.none, np.int32)
        word[at] = ids[at]
        low = np.zeros((blocks + 1, self.low.shape[1]), np.float32)
        for k in range(STEP):  # rows of a block one by one, as numpy's sums over stretches of rows go by columns
            low[1:] += self.low.take(word[k::STEP], axis=0)
        return np.cumsum(low, axis=0, out=low)

    def _places(self, ids: np.ndarray, start: np.ndarray, width: int, item: np.ndarray, keys: np.ndarray, table: np.ndarray | None) -> np.ndarray:
        """For each pair of window and item, how many of the window's places have a word of the item."""
        if table is not None:
            word = np.lib.stride_tricks.sliding_window_view(np.minimum(ids, self.n_own), width)[start * STEP]
            return table.take(word + (item[:, None] * (self.n_own + 1)).astype(np.int32)).sum(axis=1, dtype=np.int16)
        word = ids[start[:, None] * STEP + np.arange(width)]
        key = item[:, None].astype(np.int64) * self.n_own + word
        own = word < self.n_own
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return ((keys[at] == key) & own).sum(axis=1)

    def _shared(self, ids: np.ndarray, start: np.ndarray, width: int, item: np.ndarray, keys: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each pair of window and item, how many of the item's words the window has, repeats in the item included."""
        word = np.sort(ids[start[:, None] * STEP + np.arange(width)], axis=1)
        new = np.concatenate([np.ones((len(word), 1), bool), word[:, 1:] != word[:, :-1]], axis=1) & (word < self.n_own)
        key = item[:, None].astype(np.int64) * self.n_own + word
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return (times[at] * ((keys[at] == key) & new)).sum(axis=1)

    def _check(self, held, items, first, text, start, end, window, item, near) -> None:
        done = set()
        for k in np.argsort(-near, kind="stable").tolist():  # the nearest first: an item found whole is not checked again
            w, i = int(window[k]), int(item[k])
            t = int(text[w])
            _, own, whole, shift = held[t]
            a, b = (int(x - first[t]) * STEP + shift for x in (start[w], end[w]))
            n = len(items[i].ids)
            if n > WIDTHS[-1]:  # its pieces' windows within a cell of the item's length share one check
                cell = (t, id(items[i].ids), a // n)
                if cell in done:
                    continue
                done.add(cell)
                a, b = a // n * n, a // n * n + n + WIDTHS[-1]
            reach = max(b - a, n) if n <= WIDTHS[-1] else n
            self._checked(items[i], whole[max(0, a - reach) : b + reach], float(near[k]), own)

    def _checked(self, item: Item, around: np.ndarray, near: float, out: dict) -> None:
        p = self.p
        if out.get(item.item_id, (0.0,))[0] == 1.0:
            return
        share = lcs(item.ids, around, item.places) / len(item.ids)
        if share < (p.reworded if near >= p.near else p.paraphrase):
            return
        answer = lcs(item.answer, around) / len(item.answer)
        if share >= p.lcs or answer >= p.answer:
            out[item.item_id] = max(out.get(item.item_id, (0.0, 0.0, 0.0)), (share, answer, near))


def leaks(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, item_id, lcs_share, answer_share, cosine``: a row for each document and each item that it holds; the cosine is that of
    the latent space."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // p.block_bytes))
    out = None
    for b in range(blocks):
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = [(r["item_id"], r["text"]) for r in block.collect() if tokens(r["text"])]  # about ``block_bytes``
        if rows:
            found = _leaks(docs, sorted(rows, key=lambda r: (r[0] is None, r)), p)
            out = found if out is None else out.unionAll(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, lcs_share double, answer_share double, cosine double")
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("lcs_share", "answer_share", "cosine")])


def _leaks(docs: DataFrame, rows: list[tuple], p: Params) -> DataFrame:
    words = sorted({w for _, t in rows for w in tokens(t)})
    number = {w: k for k, w in enumerate(words)}
    read = _read(docs, words, p.hashed)
    n, df = _frequencies(read, len(words) + (1 << p.hashed))
    items = [x for k, t in rows for x in Item.cut(k, t, number)]
    idf = weights(n, df)
    shared = docs.sparkSession.sparkContext.broadcast((items, idf, _basis(read, idf, p), len(words)))
    tag = uuid.uuid4().hex

    def run(batches):
        search = _once(("s", tag), lambda: Search(*shared.value, p))
        for batch in batches:
            texts = [numbers(t) for t in batch.column(1)]
            got = [(d, i, *s) for d, own in zip(batch.column(0).to_pylist(), search.found(texts), strict=True) for i, s in own.items()]
            if got:
                d, i, *scores = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), *(pa.array(x, pa.float64()) for x in scores)], names=["doc_id", "item_id", "lcs_share", "answer_share", "cosine"])

    return read.mapInArrow(run, "doc_id long, item_id long, lcs_share double, answer_share double, cosine double")


def decontaminated(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The documents that hold no item. Rows are told apart by id and text, so of rows that share an id, or have none, only those that
    leak go."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.xxhash64(F.col("doc_id").cast("long"), text, F.lit(10))
    named = docs.select(name.alias("doc_id"), "text")
    bad = staged(leaks(named, benchmark, p).select(F.col("doc_id").alias("__tk_name")).distinct(), "leaking")
    return docs.withColumn("__tk_row", name).join(bad, F.col("__tk_row") == F.col("__tk_name"), "left_anti").drop("__tk_row")
