"""Windows of ``length`` symbols that occur more than once: the passes that suffix-array and suffix-tree dedup share.

Symbols are the bytes or the words of a text. A suffix is kept only at *anchors*: in every window, the q-gram with the smallest
hash (the leftmost of equals) owns the window. Equal windows have the same owner at the same place, so no repeat is lost, and only
one position in dozens is sent. Buckets are named by content fingerprints, so a bucket has the same name everywhere and no ranks
are exchanged.

1. Initial buckets: the q-grams at all anchors, counted over the corpus. Buckets of one are finished.
2. Refinement: an anchor in a larger bucket is told apart by its *context*, all symbols that windows which it can own
   reach. Anchors with equal context (a class) repeat each other in full.
3. In buckets of several classes, where a class has one member only, one member of each class sends its context, as text. A bucket
   fits in memory, and ``solve`` finds the windows that two of its classes share, comparing the text itself; as a class's windows
   overlap, the first and the last suffice. Buckets of more than ``BUCKET`` classes send each window by itself to ``resolve``
   instead, which deals them out by content.
4. Each document gets the results of its classes and turns them into covered spans.

Documents travel only if they have an anchor in a bucket of two or more. Short documents are worked off together, long ones in
blocks, so that memory is bounded whatever the lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import WS, dropped, released, staged

BLOCK = 1 << 18
BUCKET = 8_192
ROWS = 2_048
WINDOWS = 1 << 18
PIECE = 1 << 18
_ONE = np.uint64(1)
FULL = -(1 << 30)


@dataclass(frozen=True)
class Shape:
    """Window length and q-gram length, in symbols."""

    length: int
    gram: int

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base, and of its inverse, modulo 2**64."""
    if seed not in _powers or len(_powers[seed][0]) < n:
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1) + 2 * seed) | 1
        size = max(n, 2 * BLOCK)
        grow = lambda b: np.cumprod(np.concatenate([[_ONE], np.full(size - 1, b & (1 << 64) - 1, np.uint64)]), dtype=np.uint64)
        _powers[seed] = grow(base), grow(pow(base, -1, 1 << 64))
    return _powers[seed]


class Sums:
    """Fingerprints of any stretch of a symbol array, from prefix sums."""

    def __init__(self, symbols: np.ndarray, seed: int = 1):
        up, self.down = _power(len(symbols) + 1, seed)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        x = symbols if seed == 1 else mixed(symbols + np.uint64(seed))
        np.cumsum(x * up[: len(x)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def slid(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every stretch of ``width`` values."""
    k = 1
    while 2 * k <= width:
        x = op(x[:-k], x[k:])
        k *= 2
    return op(x[: len(x) - (width - k)], x[width - k :]) if k < width else x


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.isin(np.arange(256), list(WS.encode()))


class Bytes:
    """Symbols are the bytes of the UTF-8 text."""

    @staticmethod
    def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Random values of all texts' symbols, and where each text ends among them."""
        return _BYTES[np.frombuffer(b"".join(texts), np.uint8)], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))

    @staticmethod
    def stretch(text: bytes) -> Callable[[int, int], bytes]:
        return lambda b, e: text[b:e]

    @staticmethod
    def grid(texts: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The texts as blocks of ``size`` symbols in a row, the block that begins at ``left`` in each, and ``size``. What fills the first
        and the last block of a text is zero; a block of zeros is at each text's end."""
        pad = -left % 8
        raw = b"".join(bytes(p) + t + bytes(-(p + len(t)) % 8 + 8) for p, t in zip(pad.tolist(), texts, strict=True))
        blocks = np.fromiter(map(len, texts), np.int64, len(texts)) + pad
        blocks = -(-blocks // 8) + 1
        return np.frombuffer(raw, "<u8").astype(np.uint64), np.cumsum(blocks) - blocks + (left + pad) // 8, 8

    @staticmethod
    def rest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
        return b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True))

    kept = rest


class Words:
    """Symbols are the words of the text."""

    @staticmethod
    def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(texts) == 1 and len(texts[0]) > PIECE:  # by stretches, as the sums take many times the text's memory
            own = np.concatenate([Words._line(x)[0] for x in stretches(texts[0], PIECE)])
            return own, np.array([len(own)])
        own, begin = Words._line(b"\n".join(texts))
        return own, np.searchsorted(begin, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))

    @staticmethod
    def _line(line: bytes) -> tuple[np.ndarray, np.ndarray]:
        """A fingerprint of each word, and where it begins."""
        x = np.frombuffer(line, np.uint8)
        edge = np.flatnonzero(np.diff(_SPACE[x], prepend=True, append=True))
        return Sums(_BYTES[x]).of(edge[::2], edge[1::2]), edge[::2]

    @staticmethod
    def stretch(text: bytes) -> Callable[[int, int], bytes]:
        own = text.split()
        return lambda b, e: b" ".join(own[b:e])

    @staticmethod
    def grid(texts: list[bytes], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The words' numbers in a row, the place of the word ``left`` of each text, and 1."""
        number: dict[bytes, int] = {b"": 0}
        own = [[number.setdefault(w, len(number)) for w in t.split()] for t in texts]
        size = np.fromiter(map(len, own), np.int64, len(own)) + 1
        return np.array([x for t in own for x in (*t, 0)], np.uint64), np.cumsum(size) - size + left, 1

    @staticmethod
    def rest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
        """The kept words, joined by one space."""
        own = text.split()
        return b" ".join(w for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(own)], strict=True) for w in own[a:b])

    @staticmethod
    def kept(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
        """The text without the removed words and the white space between them."""
        edge = np.flatnonzero(np.diff(_SPACE[np.frombuffer(text, np.uint8)], prepend=True, append=True))
        return Bytes.rest(text, edge[::2][starts], edge[1::2][ends - 1])


def stretches(text: bytes, size: int) -> Iterator[bytes]:
    """Cut at white space after every ``size`` bytes; a longer word stays whole."""
    at = 0
    while at < len(text):
        to = at + size
        while to < len(text) and not _SPACE[text[to]]:
            to += 1
        yield text[at:to]
        at = to


def bucketed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers from the values of ``x`` to the begin of their bucket in sorted order, and the places whose bucket has others too."""
    order = np.argsort(x, kind="stable")
    new = np.diff(x[order], prepend=x[order[:1]] ^ x.dtype.type(1)) != 0
    begin = np.flatnonzero(new)
    size = np.diff([*begin, len(x)])
    out = np.empty(len(x), np.int64)
    out[order] = np.repeat(begin, size)
    return out, order[np.repeat(size > 1, size)]


@dataclass
class Part:
    """Anchors of a stretch of texts in a row: the text ``doc`` of each, its place ``at``; ``low`` and ``high``: the first and last
    window that each owns. Places count from ``offset``."""

    doc: np.ndarray
    at: np.ndarray
    gram: np.ndarray
    context: np.ndarray | None
    left: np.ndarray | None
    end: np.ndarray | None
    low: np.ndarray
    high: np.ndarray
    symbols: np.ndarray
    sums: Sums
    offset: int

    def key(self) -> np.ndarray:
        """A name of text and class."""
        return mixed(self.gram) ^ self.context ^ mixed(self.doc.astype(np.uint64) + _ONE)


def parts(symbols: np.ndarray, ends: np.ndarray, shape: Shape, contexts: bool = True) -> Iterator[Part]:
    """The anchors of texts in a row, by blocks that bound the memory whatever their lengths."""
    n, length, width = len(symbols), shape.length, shape.width
    begins = np.concatenate([[0], ends[:-1]])
    for b0 in range(0, n if n >= length else 0, BLOCK):
        lo, hi = max(0, b0 - 2 * length), min(n, b0 + BLOCK + 3 * length)
        if hi - lo < length:
            continue
        sums = Sums(symbols[lo:hi])
        gram = sums.all(shape.gram)
        least = slid(gram, width, np.minimum)  # by window
        for e in ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, hi)].tolist():
            least[max(0, e - lo - length + 1) : e - lo] = 0  # windows that two texts share are none
        edge = np.zeros(width - 1, np.uint64)
        most = slid(np.concatenate([edge, least, edge]), width, np.maximum)
        at = np.flatnonzero((most == gram) & (gram > 0))
        if not len(at):
            continue
        at, low, high = _owners(at, gram, least)
        own = (at + lo >= b0) & (at + lo < b0 + BLOCK)
        at, low, high = at[own], low[own], high[own]
        doc = np.searchsorted(ends, at + lo, "right")
        context = left = end = None
        if contexts:
            left = np.minimum(width - 1, at + lo - begins[doc])
            end = np.minimum(at + shape.gram + width - 1, ends[doc] - lo)
            context = mixed(sums.of(at - left, end) ^ (left.astype(np.uint64) << np.uint64(32)) ^ (end - at).astype(np.uint64))
        yield Part(doc, at, gram[at], context, left, end, low, high, symbols[lo:hi], sums, lo)


def _owners(at: np.ndarray, gram: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors that own windows, with the first and last of those. Windows of value zero have no owner."""
    value = gram[at]
    order = np.lexsort((at, value))
    names, rank = np.unique(value, return_inverse=True)
    size = len(gram) + 1
    keys = rank[order].astype(np.int64) * size + at[order]
    begin = np.unique(np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, (at + 1)[at + 1 < len(least)]]))
    end = np.concatenate([begin[1:], [len(least)]]) - 1
    owned = least[begin] > 0
    begin, end = begin[owned], end[owned]
    found = order[np.searchsorted(keys, np.searchsorted(names, least[begin]).astype(np.int64) * size + begin)]
    low, high = np.full(len(at), size), np.full(len(at), -1)
    np.minimum.at(low, found, begin)
    np.maximum.at(high, found, end)
    own = high >= 0
    return at[own], low[own], high[own]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, k``: ``k`` names a document; rows that repeat an id and a text share it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("long"), text, F.lit(8)).alias("k"))


def pieces(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch, some ``PIECE`` bytes at a time, and the row of the first."""
    own, size, first = [], 0, 0
    for k, text in enumerate(column):
        raw = text.as_py().encode()
        if own and size + len(raw) > PIECE:
            yield first, own
            own, size, first = [], 0, k
        own.append(raw)
        size += len(raw)
    if own:
        yield first, own


def listed(lists: pa.Array, first: int, n: int) -> tuple[pa.Array, np.ndarray]:
    """The values of ``n`` lists from ``first`` on, and the list (from 0) that each is in."""
    own = lists.slice(first, n)
    size = np.diff(np.asarray(own.offsets))
    return own.flatten(), np.repeat(np.arange(n, dtype=np.uint64), size)


@dataclass
class Bucketful:
    """Classes of whole buckets: bucket numbers, texts around the anchors, symbols of these before the anchor, owned windows from the anchor."""

    bucket: np.ndarray
    texts: list[bytes]
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Class and start (from the anchor) of all owned windows, some starts at a time; windows of unlike starts are not equal."""
        step = max(1, WINDOWS // max(1, len(self.low)))
        for s in range(int(self.low.min(initial=0)), int(self.high.max(initial=-1)) + 1, step):
            low, high = np.maximum(self.low, s), np.minimum(self.high, s + step - 1)
            size = np.maximum(0, high - low + 1)
            cls = np.repeat(np.arange(len(size)), size)
            yield cls, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[cls]


@dataclass(frozen=True)
class Finder:
    """``unit``: what symbols are. ``solve``: classes of whole buckets -> class and start of the windows that two share.
    ``resolve``: table of windows -> classes with their first and last shared window; ``window`` makes more columns for it."""

    shape: Shape
    unit: type
    solve: Callable[[Bucketful, type, Shape], Iterator[tuple[np.ndarray, np.ndarray]]]
    resolve: Callable[[DataFrame], DataFrame]
    window: Callable[[Sums, np.ndarray, np.ndarray], list[pa.Array]] | None = None

    def anchors(self, docs: DataFrame) -> DataFrame:
        """``k, a, n``: the initial buckets of each document."""
        shape, unit = self.shape, self.unit

        def run(batches):
            for batch in batches:
                k = np.asarray(batch.column(1))
                for first, texts in pieces(batch.column(0)):
                    found = [(p.doc, p.gram) for p in parts(*unit.symbols(texts), shape, False)]
                    if found:
                        doc, gram, n = counted(*(np.concatenate(x) for x in zip(*found, strict=True)))
                        yield pa.RecordBatch.from_arrays([pa.array(k[first + doc]), _signed(gram), pa.array(n)], names=["k", "a", "n"])

        return docs.filter(F.octet_length("text") >= shape.length).select("text", "k").mapInArrow(run, "k long, a long, n int")

    def classes(self, docs: DataFrame) -> DataFrame:
        """Documents that have anchors in shared buckets, with the classes ``cls`` of those anchors."""
        shape, unit = self.shape, self.unit
        kind = pa.list_(pa.struct([("a", pa.int64()), ("g", pa.int64()), ("n", pa.int32())]))

        def run(batches):
            for batch in batches:
                for first, texts in pieces(batch.column(1)):
                    shared, of = listed(batch.column(3), first, len(texts))
                    shared = np.sort(np.asarray(shared).view(np.uint64) ^ mixed(of + _ONE))
                    found = []
                    for p in parts(*unit.symbols(texts), shape):
                        name = p.gram ^ mixed(p.doc.astype(np.uint64) + _ONE)
                        own = shared[np.minimum(np.searchsorted(shared, name), len(shared) - 1)] == name
                        found.append((p.doc[own], p.gram[own], p.context[own]))
                    doc, gram, context, n = counted(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    rows = pa.StructArray.from_arrays([_signed(gram), _signed(context), pa.array(n)], names=["a", "g", "n"])
                    sizes = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(texts)) for c in range(3)), pa.ListArray.from_arrays(pa.array(sizes), rows).cast(kind)], names=["doc_id", "text", "k", "cls"])

        found = staged(self.anchors(docs), "repeats-anchors")
        shared = found.groupBy("a").agg(F.sum("n").alias("all")).filter("all > 1").select("a")
        mine = found.join(shared, "a").groupBy("k").agg(F.collect_list("a").alias("shared"))
        out = staged(docs.join(mine, "k").select("doc_id", "text", "k", "shared").mapInArrow(run, "doc_id long, text string, k long, cls array<struct<a:long,g:long,n:int>>"), "repeats-classes")
        dropped(found)
        released(docs.sparkSession)
        return out

    def wanted(self, batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], np.ndarray, Part, np.ndarray]]:
        """Of the columns ``text, want``: texts and where each begins, parts, and of each part one anchor of each wanted class that no part
        before had."""
        for first, texts in pieces(batch.column(0)):
            want, of = listed(batch.column(1), first, len(texts))
            key = np.sort(mixed(np.asarray(want.field("a")).view(np.uint64)) ^ np.asarray(want.field("g")).view(np.uint64) ^ mixed(of + _ONE))
            done = np.zeros(len(key), bool)
            symbols, ends = self.unit.symbols(texts)
            for p in parts(symbols, ends, self.shape):
                at = np.minimum(np.searchsorted(key, p.key()), len(key) - 1)
                own = np.flatnonzero((key[at] == p.key()) & ~done[at])
                own = own[np.sort(np.unique(at[own], return_index=True)[1])]
                done[at[own]] = True
                if len(own):
                    yield texts, np.concatenate([[0], ends[:-1]]), p, own

    def contexts(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """For each class ``k, a, g``: its owned windows (from the anchor) and the text around the anchor."""

        def run(batches):
            for batch in batches:
                for texts, begins, p, own in self.wanted(batch):
                    near, doc, stretch = [], -1, None
                    for d, b, e in zip(p.doc[own].tolist(), (p.at - p.left)[own].tolist(), p.end[own].tolist(), strict=True):
                        if d != doc:
                            doc, stretch = d, self.unit.stretch(texts[d])
                        shift = p.offset - int(begins[d])
                        near.append(stretch(b + shift, e + shift))
                    cols = [_signed(p.gram[own]), _signed(p.context[own]), *(pa.array(x[own].astype(np.int32)) for x in (p.low - p.at, p.high - p.at, p.left)), pa.array(near, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["a", "g", "low", "high", "left", "near"])

        lists = wanted.groupBy("k").agg(F.collect_list(F.struct("a", "g")).alias("want"))
        return docs.join(lists, "k").select("text", "want").mapInArrow(run, "a long, g long, low int, high int, left int, near binary")

    def solved(self, contexts: DataFrame) -> DataFrame:
        """``a, g, first, last`` of the classes that share a window with another class of their bucket."""
        shape, solve, unit = self.shape, self.solve, self.unit

        def run(batches):
            held, n = [], 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= ROWS:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    cut = yield from whole(rows, int(np.searchsorted(a := rows.column(0).to_numpy(), a[-1])))  # the last bucket may go on
                    held, n = rows.slice(cut).combine_chunks().to_batches(), n - cut
            if held:
                rows = pa.Table.from_batches(held).combine_chunks()
                yield from whole(rows, rows.num_rows)

        def whole(rows, end):
            """Buckets up to row ``end``, about ``ROWS`` classes at a time."""
            begin = np.flatnonzero(np.diff(rows.column(0).to_numpy()[:end], prepend=-1, append=-1)) if end else np.zeros(1, np.int64)
            begin = np.unique([0, *begin.tolist(), end])
            at = 0
            while at < end:
                to = max(int(begin[np.searchsorted(begin, at + ROWS, "right") - 1]), int(begin[np.searchsorted(begin, at, "right")]))
                yield found(rows.slice(at, to - at))
                at = to
            return end

        def found(rows):
            a, g, low, high, left = (rows.column(k).to_numpy() for k in range(5))
            part = Bucketful(np.cumsum(np.concatenate([[0], a[1:] != a[:-1]])), rows.column(5).to_pylist(), left.astype(np.int64), low.astype(np.int64), high.astype(np.int64))
            first, last = np.full(len(a), 1 << 30), np.full(len(a), FULL)
            for cls, start in solve(part, unit, shape):
                np.minimum.at(first, cls, start)
                np.maximum.at(last, cls, start)
            i = np.flatnonzero(last > FULL)
            return pa.RecordBatch.from_arrays([pa.array(a[i]), pa.array(g[i]), pa.array(first[i].astype(np.int32)), pa.array(last[i].astype(np.int32))], names=["a", "g", "first", "last"])

        return contexts.repartition("a").sortWithinPartitions("a").mapInArrow(run, "a long, g long, first int, last int")

    def windows(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """The windows of the classes ``k, a, g``: ``a, g, at`` (from the anchor), and what ``window`` makes of each."""
        shape, window = self.shape, self.window
        names = ["a", "g", "at", "w1", "w2"] + (["prefix"] if window else [])

        def run(batches):
            for batch in batches:
                for _, _, p, own in self.wanted(batch):
                    second = Sums(p.symbols, 2)
                    for some in np.array_split(own, -(-len(own) * shape.width // BLOCK)):  # bounds the rows at once
                        size = p.high[some] - p.low[some] + 1
                        rep = np.repeat(some, size)
                        start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + p.low[rep]
                        end = start + shape.length
                        cols = [_signed(p.gram[rep]), _signed(p.context[rep]), pa.array((start - p.at[rep]).astype(np.int32)), _signed(p.sums.of(start, end)), _signed(second.of(start, end))]
                        yield pa.RecordBatch.from_arrays(cols + (window(p.sums, start, end) if window else []), names=names)

        kinds = "a long, g long, at int, w1 long, w2 long" + (", prefix array<long>" if window else "")
        lists = wanted.groupBy("k").agg(F.collect_list(F.struct("a", "g")).alias("want"))
        return docs.join(lists, "k").select("text", "want").mapInArrow(run, kinds)

    def cut(self, docs: DataFrame, finish: Callable[[bytes, np.ndarray, np.ndarray], tuple], kinds: str, types: list[pa.DataType]) -> DataFrame:
        """``doc_id, k`` and the columns ``kinds`` that ``finish`` makes of a text and the covered spans (ascending, apart), for
        each document that shares a q-gram at an anchor; other documents have no repeated window. A written table; the tables on the way
        to it are deleted."""
        shape, unit = self.shape, self.unit
        own = self.classes(docs)
        rows = own.select("k", F.explode("cls").alias("c")).select("k", "c.a", "c.g", "c.n")
        cls = staged(rows.groupBy("a", "g").agg(F.sum("n").alias("n"), F.min("k").alias("k")), "repeats-buckets")
        bucket = cls.groupBy("a").agg(F.count("*").alias("classes"), F.min("n").alias("least")).filter("classes > 1 AND least = 1").select("a", "classes")
        bucket = staged(bucket, "repeats-open")
        wanted = cls.join(bucket, "a").select("k", "a", "g", "classes")
        some = self.solved(self.contexts(own, wanted.filter(F.col("classes") <= BUCKET).drop("classes")))
        large = bucket.filter(F.col("classes") > BUCKET)
        rows_of = None
        if not large.isEmpty():
            rows_of = staged(self.windows(own, cls.join(large, "a").select("k", "a", "g")), "repeats-windows")
            some = some.unionAll(self.resolve(rows_of).select("a", "g", "first", "last"))
        full = cls.filter("n > 1").select("a", "g", F.lit(FULL).alias("first"), F.lit(FULL).alias("last"))
        found = staged(full.unionAll(some.join(full, ["a", "g"], "left_anti").select("a", "g", "first", "last")), "repeats-found")
        dropped(cls, *[x for x in (rows_of,) if x is not None])
        released(docs.sparkSession)
        mine = rows.join(found, ["a", "g"]).groupBy("k").agg(F.collect_set(F.struct("a", "g", "first", "last")).alias("got"))

        names = ["doc_id", "k", *[x.split()[0] for x in kinds.split(", ")]]

        def run(batches):
            for batch in batches:
                rows = []
                for at, texts in pieces(batch.column(2)):
                    got, of = listed(batch.column(3), at, len(texts))
                    rows += [finish(t, *spans) for t, spans in zip(texts, covered(texts, got, of), strict=True)]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=names)

        def covered(texts, got, of):
            """The covered spans of each text."""
            a, g, first, last = (np.asarray(got.field(x)) for x in ("a", "g", "first", "last"))
            name = mixed(a.view(np.uint64)) ^ g.view(np.uint64) ^ mixed(of + _ONE)
            order = np.argsort(name)
            name, first, last = name[order], first[order].astype(np.int64), last[order].astype(np.int64)
            low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            symbols, ends = unit.symbols(texts)
            for p in parts(symbols, ends, shape):
                mine = p.key()
                i = np.minimum(np.searchsorted(name, mine), len(name) - 1)
                hit = name[i] == mine
                i, at, lo, hi = i[hit], p.at[hit], p.low[hit], p.high[hit]
                whole = first[i] == FULL
                low.append(np.where(whole, lo, at + first[i]) + p.offset)
                high.append(np.where(whole, hi, at + last[i]) + p.offset + shape.length)
            low, high = np.concatenate(low), np.concatenate(high)
            order = np.argsort(low, kind="stable")
            low, high = low[order], high[order]
            begin = np.concatenate([[0], ends[:-1]])
            edge = np.searchsorted(low, [*begin, len(symbols)])
            for b, x, y in zip(begin.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if x == y:
                    yield np.zeros(0, np.int64), np.zeros(0, np.int64)
                    continue
                reach = np.maximum.accumulate(high[x:y])
                new = np.concatenate([[True], low[x:y][1:] > reach[:-1]])
                yield low[x:y][new] - b, np.concatenate([reach[:-1][new[1:]], reach[-1:]]) - b

        out = staged(own.join(mine, "k").select("doc_id", "k", "text", "got").mapInArrow(run, f"doc_id long, k long, {kinds}"), "repeats-cut")
        dropped(own, found, bucket)
        return out


def counted(*cols: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of the columns, ascending, and how often each occurs."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    at = np.flatnonzero(new)
    return [*(c[at] for c in cols), np.diff([*at, len(order)]).astype(np.int32)]
