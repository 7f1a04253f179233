"""Token ids as binary segments, coded by a static range asymmetric numeral system (rANS).

Documents are dealt by ranges of their id, tokenized, and cut at document ends into segments of about ``SEGMENT`` ids. A
segment is one binary value of the written table (columns ``part, seg, n_docs, n_ids, payload``):

    magic "TMRANS1\\0" | u32 sizes: header, frequency table, documents | header (JSON) | frequency table | documents | blocks

* frequency table (zlib): symbols and their frequencies, which sum to 2**SCALE; all blocks of the segment share it.
* documents (zlib): ids (a null mask and i64) and numbers of token ids.
* blocks: independent. Each has LANES interleaved 64-bit states and one stream of 32-bit words. The header lists for each
  block its checkpoint: offset, words, ids, the index of its first id, and the CRC-32 of its ids and of its bytes.

So any block of any segment decodes by itself. A wrong checksum raises an error.

Null texts are empty (only the end id). Ties of ids are ordered by text; null ids come first. An empty table gives an empty result;
extra columns are ignored. A very long text makes a long segment, never a cut document.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.llm.common import workdir

MAGIC = b"TMRANS1\0"
SCALE, LANES, STEPS = 18, 256, 512
SEGMENT = 1 << 21
END = 1
CACHE_WORDS = 1_100_000
MARKS = 1 << 14  # runs of marks whose ids are kept
PIECE = 1 << 23  # bytes of text whose words are looked up together
PART_BYTES = 16 << 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least one for each symbol with a count."""
    free = (1 << SCALE) - np.count_nonzero(counts)
    if free < 0:
        raise ValueError("more symbols than the scale holds")
    exact = counts * (free / counts.sum())
    out = np.floor(exact).astype(np.int64)
    rest = free - int(out.sum())
    out[np.argsort(-(exact - out), kind="stable")[:rest]] += 1
    return out + (counts > 0)


def _coded(ids: np.ndarray, lanes: int, freq: np.ndarray, cum: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """``ids``: (steps, blocks * lanes), each block a run of ``lanes`` columns. Final states and each block's words."""
    steps, width = ids.shape
    x = np.full(width, _LOW)
    words = np.zeros((steps, width), np.uint32)
    sent = np.zeros((steps, width), bool)
    top = np.uint64(63 - SCALE)
    for t in range(steps - 1, -1, -1):
        f = freq[ids[t]]
        full = x >= f << top
        sent[t] = full
        words[t] = x.astype(np.uint32)
        x = np.where(full, x >> _WORD, x)
        q = x // f
        x = (q << np.uint64(SCALE)) + (x - q * f) + cum[ids[t]]
    return x, [words[:, b : b + lanes][sent[:, b : b + lanes]] for b in range(0, width, lanes)]


def _decoded(states: np.ndarray, words: list[np.ndarray], steps: int, lanes: int, symbol: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> np.ndarray:
    blocks = len(words)
    x = states.copy()
    flat = np.concatenate([*words, np.zeros(1, np.uint32)])
    at = np.cumsum([0, *map(len, words)])[:-1]
    out = np.empty((steps, blocks * lanes), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    for t in range(steps):
        slot = x & mask
        s = symbol[slot]
        out[t] = s
        x = freq[s] * (x >> np.uint64(SCALE)) + slot - cum[s]
        low = (x < _LOW).reshape(blocks, lanes)
        rank = np.cumsum(low, axis=1)
        need = low.reshape(-1)
        place = (rank - 1 + at[:, None]).reshape(-1)[need]
        x[need] = (x[need] << _WORD) | flat[place]
        at = at + rank[:, -1]
    return out


def packed(ids: np.ndarray, doc_ids: list, doc_sizes: list[int], lanes: int = LANES, steps: int = STEPS) -> bytes:
    """One segment."""
    counts = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    body, blocks = [], []
    table = b""
    if len(ids):
        freq = frequencies(counts)
        cum = np.cumsum(freq) - freq
        shown = np.flatnonzero(freq)
        table = np.concatenate([np.diff(shown, prepend=0), freq[shown]]).astype("<u4").tobytes()
        f, c = freq.astype(np.uint64), cum.astype(np.uint64)
        size = lanes * steps
        whole = len(ids) // size
        runs = [(ids[: whole * size].reshape(whole, steps, lanes).transpose(1, 0, 2).reshape(steps, -1), whole)] if whole else []
        if rest := len(ids) - whole * size:
            depth = -(-rest // lanes)
            runs.append((np.concatenate([ids[whole * size :], np.full(depth * lanes - rest, shown[0], ids.dtype)]).reshape(depth, lanes), 1))
        at = first = 0
        for grid, n in runs:
            states, streams = _coded(grid, lanes, f, c)
            for b, words in enumerate(streams):
                own = ids[first : first + min(size, len(ids) - first)]
                raw = states[b * lanes : (b + 1) * lanes].astype("<u8").tobytes() + words.astype("<u4").tobytes()
                blocks.append([at, len(words), len(own), first, zlib.crc32(own.astype("<u4").tobytes()), zlib.crc32(raw)])
                body.append(raw)
                at += len(raw)
                first += len(own)
    known = np.array([d is not None for d in doc_ids], bool)
    docs = np.packbits(known).tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(doc_sizes, "<i8").tobytes()
    head = json.dumps({"lanes": lanes, "steps": steps, "scale": SCALE, "docs": len(doc_ids), "ids": len(ids), "blocks": blocks}).encode()
    table, docs = zlib.compress(table), zlib.compress(docs)
    return b"".join([MAGIC, struct.pack("<3I", len(head), len(table), len(docs)), head, table, docs, *body])


class Segment:
    """Reads a segment; ``block(b)`` decodes one block by itself, ``ids()`` all of them side by side."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token segment")
        a, b, c = struct.unpack_from("<3I", raw, 8)
        self.head = json.loads(raw[20 : 20 + a])
        table = np.frombuffer(zlib.decompress(raw[20 + a : 20 + a + b]), "<u4").astype(np.int64)
        docs = zlib.decompress(raw[20 + a + b : 20 + a + b + c])
        self.raw, self.base = raw, 20 + a + b + c
        shown, given = np.cumsum(table[: len(table) // 2]), table[len(table) // 2 :]
        size = int(shown[-1]) + 1 if len(shown) else 1
        freq = np.zeros(size, np.int64)
        freq[shown] = given
        self.symbol = np.repeat(np.arange(size, dtype=np.uint32), freq)
        self.freq, self.cum = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
        n = self.head["docs"]
        k = -(-n // 8)
        known = np.unpackbits(np.frombuffer(docs[:k], np.uint8))[:n].astype(bool)
        self.doc_ids = [int(d) if ok else None for d, ok in zip(np.frombuffer(docs[k : k + 8 * n], "<i8"), known, strict=True)]
        self.doc_sizes = np.frombuffer(docs[k + 8 * n :], "<i8").astype(np.int64)

    def _read(self, b: int):
        at, words, n, _, check, stored = self.head["blocks"][b]
        lanes, at = self.head["lanes"], self.base + at
        if zlib.crc32(self.raw[at : at + 8 * lanes + 4 * words]) != stored:
            raise ValueError(f"block {b}: damaged")
        return np.frombuffer(self.raw, "<u8", lanes, at).astype(np.uint64), np.frombuffer(self.raw, "<u4", words, at + 8 * lanes).astype(np.uint32), n, check

    def _run(self, which: list[int]) -> list[np.ndarray]:
        lanes = self.head["lanes"]
        read = [self._read(b) for b in which]
        steps = -(-read[0][2] // lanes)
        grid = _decoded(np.concatenate([r[0] for r in read]), [r[1] for r in read], steps, lanes, self.symbol, self.freq, self.cum)
        out = []
        for k, (_, _, n, check) in enumerate(read):
            ids = np.ascontiguousarray(grid[:, k * lanes : (k + 1) * lanes]).reshape(-1)[:n]
            if zlib.crc32(ids.astype("<u4").tobytes()) != check:
                raise ValueError(f"block {which[k]}: wrong checksum")
            out.append(ids)
        return out

    def block(self, b: int) -> np.ndarray:
        return self._run([b])[0]

    def ids(self) -> np.ndarray:
        n = len(self.head["blocks"])
        full = [b for b in range(n) if self.head["blocks"][b][2] == self.head["lanes"] * self.head["steps"]]
        out = (self._run(full) if full else []) + [self.block(b) for b in range(len(full), n)]
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Words:
    """Encodes texts with the tokenizers library, which the words between white space do not leave: what a word gives is kept, and the
    words of several texts are looked up together, each once. New Latin words go to the library in one call, as their last tokens
    show where each ends; marks after letters, and digits, are pieces of their own."""

    LATIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\[-`{-~]*)")
    WHOLE = r"[\x1c-\x1f]|<\|"

    def __init__(self, model: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        self.library = Tokenizer.from_file(model)
        self.library.no_padding()
        self.library.no_truncation()
        # for words of lower-case letters of LATIN, which the normalizer does not change
        self.lower = Tokenizer.from_str(self.library.to_str())
        self.lower.normalizer = normalizers.Sequence([])
        vocab = self.library.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.digits = {d: self.plain(d) for d in "0123456789"}
        self.marks = {"": b""}
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return array("I", self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(x.tobytes() for x, _ in self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts in a row, and how many each text has; about ``PIECE`` bytes are worked off at once."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        whole = pc.match_substring_regex(texts, self.WHOLE).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(texts):
            if whole[at]:
                ids = np.frombuffer(self.plain(texts[at].as_py()), "<u4")
                yield ids, np.array([len(ids)])
                at += 1
                continue
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
            if whole[at:to].any():
                to = at + int(np.argmax(whole[at:to]))
            yield self._encode(texts.slice(at, to - at))
            at = to

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        # no word holds a line feed; many times faster than to_pylist
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary), "\n")
        own = self._known(joined[0].as_py().split("\n"))
        flat, size = np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) // 4
        which = words.indices.to_numpy()
        n = size[which]
        end = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - end[:-1], n) + np.arange(end[-1])]
        return ids, np.diff(end[np.asarray(lists.offsets)])

    def _known(self, own: list[str]) -> list[bytes]:
        got = list(map(self.known.get, own))
        new = [w for w, x in zip(own, got, strict=True) if x is None]
        if not new:
            return got
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = own
        self._learn(new)
        return list(map(self.known.__getitem__, own))

    def _learn(self, new: list[str]) -> None:
        known, match, all_marks = self.known, self.LATIN.fullmatch, self.marks
        parts, todo, others = [], {}, []
        for w in new:
            if w.isascii() and w.isalpha():
                low, mark = w.lower(), ""
            elif m := match(w):
                low, mark = m[1].lower(), m[2]
                if mark not in all_marks:
                    if len(all_marks) > MARKS:
                        all_marks.clear()
                    all_marks[mark] = self.plain(mark)
            elif w.isascii() and w.isdigit():
                known[w] = b"".join(map(self.digits.__getitem__, w))
                continue
            else:
                others.append(w)
                continue
            if mark or low != w:
                parts.append((w, low, mark))
            if low not in known:
                todo[low] = None
        for w in others:
            known[w] = self.plain(w)
        if todo:
            ids = np.array(self.lower.encode_batch_fast([" ".join(todo)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(ends) == len(todo):
                known.update(zip(todo, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
            else:
                known.update((w, self.plain(w)) for w in todo)
        for w, low, mark in parts:
            known[w] = known[low] + (all_marks[mark] if mark in all_marks else self.plain(mark))


_words: dict[str, Words] = {}


def words(model: str) -> Words:
    if model not in _words:
        _words[model] = Words(model)
    return _words[model]


def written(docs: DataFrame, model: str, path: str | None = None) -> str:
    """Encode all documents, in the order of their ids, into segments under ``path``; returns it."""
    spark = docs.sparkSession
    path = path or f"{workdir(spark)}/tamarack-tokens-{uuid.uuid4().hex}"
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(1, min(100_000, size // PART_BYTES + 1))

    def run(batches):
        coder, part, seg = words(model), TaskContext.get().partitionId(), 0
        ids, keys, sizes, n = [], [], [], 0
        for batch in batches:
            at, doc_ids = 0, batch.column(0).to_pylist()
            for own, size in coder.encode_all(batch.column(1)):
                own, size = np.insert(own, np.cumsum(size), END), size + 1  # a copy
                ends = np.cumsum(size)
                a = x = 0
                while a < len(size):
                    b = min(len(size), int(np.searchsorted(ends, x + SEGMENT - n)) + 1)  # up to the document that fills the segment
                    y = int(ends[b - 1])
                    ids.append(own[x:y])
                    keys += doc_ids[at + a : at + b]
                    sizes += size[a:b].tolist()
                    n += y - x
                    a, x = b, y
                    if n >= SEGMENT:
                        yield segment(part, seg, ids, keys, sizes, n)
                        ids, keys, sizes, n, seg = [], [], [], 0, seg + 1
                at += len(size)
        if keys:
            yield segment(part, seg, ids, keys, sizes, n)

    def segment(part, seg, ids, keys, sizes, n):
        raw = packed(np.concatenate(ids).astype(np.int64), keys, sizes)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([n], pa.int64()), pa.array([raw], pa.binary())], names=["part", "seg", "n_docs", "n_ids", "payload"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text", F.lit(7)).alias("h"))
    # rows that share an id, or have none, go by their text's hash, so that no part gets them all
    rows = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    rows.mapInArrow(run, "part int, seg int, n_docs long, n_ids long, payload binary").write.option("compression", "uncompressed").parquet(path)
    return path


def read(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the segments under ``path``."""
    files = spark.read.schema("part int, seg int, n_docs long, n_ids long, payload binary").parquet(path)
    segs = files.select("part", "seg", "n_ids")
    of_part = segs.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = of_part.select("part", (F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")).alias("p"))
    inside = segs.select("part", "seg", (F.sum("n_ids").over(W.partitionBy("part").orderBy("seg").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n_ids")).alias("q"))
    base = inside.join(before, "part").select("part", "seg", (F.col("p") + F.col("q")).alias("base"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                s = Segment(batch.column(2)[k].as_py())
                ids = s.ids().astype("<u4")
                at = np.cumsum(s.doc_sizes) - s.doc_sizes
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), s.doc_sizes.tolist(), strict=True)]
                m = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, batch.column(0)[k].as_py(), np.int32)), pa.array(np.full(m, batch.column(1)[k].as_py(), np.int32)), pa.array(s.doc_ids, pa.int64()), pa.array(at), pa.array(s.doc_sizes), pa.array(crc, pa.int64())], names=["part", "seg", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = files.select("part", "seg", "payload").mapInArrow(run, "part int, seg int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(base, ["part", "seg"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def digests(docs: DataFrame, model: str) -> DataFrame:
    return read(docs.sparkSession, written(docs, model))
