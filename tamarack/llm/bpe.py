"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

1. All documents are counted by *unit* (a stretch of text whose tokens do not depend on what stands around it).
2. The most frequent units, ``lexicon_size`` at most (a cache size: it never changes a result), are encoded once and
   compiled into a minimal acyclic transducer: states share suffixes, and the numbers on the way to a final state add up
   to the unit's place in a table of ids. The file is published to the executors and memory-mapped there.
3. Units that the transducer does not accept are merged exactly, by merge rank.

Null texts are empty; empty texts have no ids. Repeated rows keep their own result rows, an empty table gives an empty
result, extra columns are ignored. Very long texts are split into units like any other.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import struct
from collections import Counter

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.llm.common import dropped, published, staged

#: The published split pattern of the byte-level model.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts outside this plain form go through the whole pattern; in plain texts each space and line feed stands alone.
_ODD = re.compile(r"\s\s|[\x00\x01\t\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
LEXICON_SIZE = 50_000
CACHE_UNITS = 800_000
COUNT_UNITS = 300_000
#: Marks that never join letters before them in a piece.
_WORD = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")  # letters in every version of Unicode
_MARKS = frozenset(".,;:!?")


class Transducer:
    """Built from sorted keys by incremental minimisation; ``find`` gives a key's rank or -1."""

    MAGIC = b"TMKT1\0\0\0"

    @staticmethod
    def built(entries: dict[bytes, bytes]) -> bytes:
        keys = sorted(entries)
        register: dict[tuple, int] = {}
        done: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []  # final, edges, words below

        def closed(node) -> int:
            key = (node[0], tuple(node[1]))
            if (at := register.get(key)) is None:
                at = register[key] = len(done)
                done.append((*key, node[0] + sum(done[t][2] for _, t in node[1])))
            return at

        path: list[list] = [[False, []]]  # open nodes along the last key
        last = b""

        def shrunk(to: int) -> None:
            while len(path) - 1 > to:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], closed(node)))

        for key in keys:
            common = 0
            while common < min(len(key), len(last)) and key[common] == last[common]:
                common += 1
            shrunk(common)
            path.extend([False, []] for _ in key[common:])
            path[-1][0] = True
            last = key
        shrunk(0)
        root = closed(path[0])
        first, labels, targets, skips, at = [], bytearray(), [], [], 0
        for final, edges, _ in done:
            first.append(at | final << 31)
            below = int(final)
            for label, t in edges:
                labels.append(label)
                targets.append(t)
                skips.append(below)
                below += done[t][2]
            at += len(edges)
        first.append(at)
        places, ids = [0], bytearray()
        for key in keys:
            ids += entries[key]
            places.append(len(ids))
        labels += bytes(-len(labels) % 4)
        nums = [root, len(first), len(labels), len(targets), len(places)]
        return Transducer.MAGIC + struct.pack("<5I", *nums) + struct.pack(f"<{len(first)}I", *first) + bytes(labels) + struct.pack(f"<{len(targets)}I", *targets) + struct.pack(f"<{len(skips)}I", *skips) + struct.pack(f"<{len(places)}I", *places) + bytes(ids)

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[:8] != self.MAGIC:
            raise ValueError("not a transducer file")
        self.root, n_first, n_labels, n_edges, n_places = struct.unpack_from("<5I", self.map, 8)
        at = 28
        whole = memoryview(self.map)

        def ints(n):
            nonlocal at
            at += 4 * n
            return whole[at - 4 * n : at].cast("I")

        self.first = ints(n_first)
        self.labels, at = at, at + n_labels
        self.targets, self.skips, self.places = ints(n_edges), ints(n_edges), ints(n_places)
        self.ids = at

    def find(self, key: bytes) -> int:
        state, rank, first, find, low = self.root, 0, self.first, self.map.find, self.labels
        for k in range(len(key)):
            e = find(key[k : k + 1], low + (first[state] & 0x7FFFFFFF), low + (first[state + 1] & 0x7FFFFFFF))
            if e < 0:
                return -1
            rank += self.skips[e - low]
            state = self.targets[e - low]
        return rank if first[state] >> 31 else -1

    def ids_of(self, key: bytes) -> bytes | None:
        k = self.find(key)
        return None if k < 0 else self.map[self.ids + self.places[k] : self.ids + self.places[k + 1]]


def units(text: str) -> list[str]:
    """Stretches that are encoded apart. In a plain text: what stands between spaces, which take the space before them; \\x01 marks
    a stretch without one. Otherwise the pieces of the pattern, each marked with \\x01."""
    if not text:
        return []
    if _ODD.search(text) or text[-1] in " \n":
        return ["\x01" + x for x in _pieces(text)]
    out = text.replace("\n", " \x00").split(" ")
    if out[0]:
        out[0] = out[0] if out[0][0] == "\x00" else "\x01" + out[0]
    else:
        del out[0]
    return out


def _pieces(text: str) -> list[str]:
    global _split
    if _split is None:
        import regex

        _split = regex.compile(PATTERN)
    return _split.findall(text)


_split = None
_coders: dict = {}


def spelled(unit: str) -> str:
    """The text of a unit."""
    if unit[0] == "\x01":
        return unit[1:]
    return "\n" + unit[1:] if unit[0] == "\x00" else " " + unit


class Coder(dict):
    """unit -> its ids as little-endian 32-bit integers; filled from the transducer or by exact merges as units come up."""

    def __init__(self, model: str, lexicon: str | None = None):
        import tiktoken

        with open(model, encoding="utf-8") as f:
            raw = json.load(f)
        chars = _byte_chars()
        back = {c: b for b, c in chars.items()}
        vocab = {bytes(back[c] for c in t): i for t, i in raw["model"]["vocab"].items()}
        added = {t["content"]: t["id"] for t in raw["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, added))) if added else None
        self.added = added
        self.core = tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self.bytes_of = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for b, i in vocab.items():
            self.bytes_of[i] = b
        for t, i in added.items():
            self.bytes_of[i] = t.encode()
        self.lexicon = Transducer(lexicon) if lexicon else None

    def merged(self, unit: str) -> bytes:
        """Exact merges, by rank."""
        if _WORD.fullmatch(unit):
            ids = self.core._encode_single_piece(b" " + unit.encode())
        else:
            ids = [i for p in _pieces(spelled(unit)) for i in self.core._encode_single_piece(p.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, unit: str) -> bytes:
        if unit[-1:] in _MARKS and _WORD.fullmatch(word := unit[:-1]):
            ids = self[word] + self["\x01" + unit[-1]]  # the pattern parts letters from marks
        else:
            ids = self.lexicon.ids_of(unit.encode()) if self.lexicon else None
            if ids is None:
                ids = self.merged(unit)
        if len(unit) < 100:
            if len(self) >= CACHE_UNITS:
                self.clear()
            self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; strings of added tokens in it are those tokens."""
        if self.specials and "<|" in text and self.specials.search(text):
            out, at = [], 0
            for m in self.specials.finditer(text):
                out += [self.encode(text[at : m.start()]), struct.pack("<I", self.added[m[0]])]
                at = m.end()
            return b"".join([*out, self.encode(text[at:])])
        return b"".join(map(self.__getitem__, units(text)))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def _byte_chars() -> dict[int, str]:
    """Byte-level models write each byte as one visible character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


def coder(model: str, lexicon: str | None) -> Coder:
    """One per worker process and lexicon."""
    if (model, lexicon) not in _coders:
        _coders.clear()
        _coders[model, lexicon] = Coder(model, SparkFiles.get(lexicon) if lexicon else None)
    return _coders[model, lexicon]


def counted_units(docs: DataFrame) -> DataFrame:
    """``unit, n`` over all documents; each task sums what it has before rows are sent."""

    def count(batches):
        got: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    got.update(units(text))
                if len(got) > COUNT_UNITS:
                    yield from sent(got)
                    got.clear()
        yield from sent(got)

    def sent(got):
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([u.encode() for u in got], pa.binary()), pa.array(list(got.values()), pa.int64())], names=["unit", "n"])

    return docs.select("text").mapInArrow(count, "unit binary, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, model: str, size: int = LEXICON_SIZE) -> str:
    """Compile and publish the transducer of the ``size`` most frequent units."""
    counts = staged(counted_units(docs), "bpe-units")
    by_count = counts.groupBy("n").agg(F.count("*").alias("units")).withColumn("above", F.sum("units").over(W.orderBy(F.desc("n"))))
    least = by_count.filter(F.col("above") <= size).agg(F.min("n")).first()[0]
    top = counts.filter(F.col("n") >= F.lit(least)).select("unit").collect() if least is not None else []  # ``size`` rows at most
    dropped(counts)
    c = Coder(model)
    return published(docs.sparkSession, "lexicon", Transducer.built({bytes(r["unit"]): c.merged(bytes(r["unit"]).decode()) for r in top if len(r["unit"])}))


def encoded(docs: DataFrame, model: str, size: int = LEXICON_SIZE, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian 32-bit) and, if asked for, ``decoded``."""
    name = lexicon(docs, model, size)

    def run(batches):
        c = coder(model, name)
        for batch in batches:
            ids = [c.encode(t.as_py() or "") for t in batch.column(1)]
            cols = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([*cols, *([pa.array(map(c.decode, ids), pa.string())] if keep_text else [])], names=["doc_id", "n_tokens", "ids", *["decoded"] * keep_text])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", decoded string" * keep_text)


def digests(docs: DataFrame, model: str, size: int = LEXICON_SIZE, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``: encodes and decodes every whole text."""
    name = lexicon(docs, model, size)

    def run(batches):
        c = coder(model, name)
        for batch in batches:
            n, of_ids, of_text, kept = [], [], [], []
            for text in batch.column(1):
                ids = c.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                kept += [ids] * keep_ids
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string()), *[pa.array(kept, pa.binary())] * keep_ids], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids)
