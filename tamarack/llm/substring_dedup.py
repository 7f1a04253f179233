"""Exact substring dedup over words: suffix trees partitioned by variable-length prefixes.

Each suffix that starts a window belongs to the prefix that ends with the window's owner, the q-gram with the smallest hash (see
``repeats``): a prefix of 10 to 35 words, the same wherever the window occurs. Prefixes with one suffix cannot hold a repeat. The
prefixes of one owner form a group that fits in memory, and its subtrees are built from the top: a node is split by
the next word of its suffixes, those that are alone become leaves, and an inner node that is still shared at a depth of 35 words is a
repeat; inner nodes are followed no deeper, as the windows behind them have nodes of their own. The words themselves are compared.
Groups with too many suffixes are split further: each window is then a suffix of its own, grouped by its first four words, which
are lengthened to 8, 16, 24 and 32 words where a group would exceed ``GROUP`` suffixes, and named by fingerprints of 128 bits. A node
with very many leaves is read as a stream: only its first leaf is held until a second one shows the repeat.

Null texts have no words. Texts with fewer words than a window stay whole. Rows that repeat a text repeat each other and
are removed in full. An empty table gives an empty result; extra columns, whatever their names, are ignored. Long texts are worked off
in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import WS
from tamarack.llm.repeats import Bucketful, Finder, Shape, Sums, Words, bucketed, keyed

LENGTH, GRAM = 35, 10
DEPTHS = (4, 8, 16, 24, 32)
GROUP = 1_000_000


def subtrees_in_memory(part: Bucketful, unit: type, shape: Shape):
    """The owned windows that are leaves under an inner node which is deep enough."""
    words, anchor, _ = unit.grid(part.texts, part.left)
    many = int(words.max(initial=0)) + 1
    words = words.astype(np.int64)
    for cls, start in part.windows():
        at = anchor[cls] + start
        # the roots: prefixes of one owner that end with it differ in length
        node, several = bucketed(part.bucket[cls] * shape.width - start)
        for depth in range(shape.length):
            if not len(several):
                break
            node[several], shared = bucketed(node[several] * many + words[at[several] + depth])
            several = several[shared]
        yield cls[several], start[several]


def _paths(sums: Sums, start: np.ndarray, end: np.ndarray) -> list[pa.Array]:
    """A window's prefixes of the given depths."""
    rows = np.stack([sums.of(start, np.minimum(start + d, end)) for d in DEPTHS], axis=1).reshape(-1)
    return [pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1, dtype=np.int32) * len(DEPTHS)), pa.array(rows.view(np.int64)))]


def subtrees(windows: DataFrame) -> DataFrame:
    """Classes that have a leaf under a deep inner node, with the first and last of these leaves."""
    rows = windows.withColumn("pre", F.element_at("prefix", 1))
    for level in range(2, len(DEPTHS) + 1):
        large = rows.groupBy("pre").agg(F.count("*").alias("size")).filter(F.col("size") > GROUP)
        if large.isEmpty():
            break
        rows = rows.join(large, "pre", "left").withColumn("pre", F.when(F.col("size").isNull(), F.col("pre")).otherwise(F.xxhash64(F.element_at("prefix", level), F.lit(level)))).drop("size")
    rows = rows.select("pre", "prefix", "w1", "w2", "a", "g", "at").repartition("pre").sortWithinPartitions("pre", "prefix", "w1", "w2")

    def run(batches):
        last = None  # the node that may go on: its path, least and greatest class, leaves not sent yet
        for batch in batches:
            if not batch.num_rows:
                continue
            w1, w2, a, g, at = (np.asarray(batch.column(k)) for k in range(2, 7))
            path = np.asarray(batch.column(1).flatten()).reshape(-1, len(DEPTHS))
            shared = np.cumprod(path[1:] == path[:-1], axis=1).sum(axis=1)  # inner nodes above each pair of neighbours
            same = (shared == len(DEPTHS)) & (w1[1:] == w1[:-1]) & (w2[1:] == w2[:-1])
            begin = np.concatenate([[0], np.flatnonzero(~same) + 1])
            size = np.diff([*begin, len(g)])
            low, high = np.minimum.reduceat(g, begin), np.maximum.reduceat(g, begin)
            out = []
            if last is not None:
                if last[0] == (w1[0], w2[0]):
                    low[0], high[0] = min(low[0], last[1]), max(high[0], last[2])
                    if low[0] != high[0]:
                        out.append(last[3])
                        last = None
            deep = np.repeat(low != high, size)
            tail = slice(begin[-1], len(g))
            wait = low[-1] == high[-1]
            held = [np.concatenate(x) for x in zip(last[3], (a[tail], g[tail], at[tail]), strict=True)] if wait and last is not None and len(begin) == 1 and last[0] == (w1[0], w2[0]) else [a[tail], g[tail], at[tail]]
            last = ((w1[-1], w2[-1]), low[-1], high[-1], held if wait else [x[:0] for x in held])
            out.append([a[deep], g[deep], at[deep]])
            cols = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["a", "g", "at"])

    return rows.mapInArrow(run, "a long, g long, at int").groupBy("a", "g").agg(F.min("at").alias("first"), F.max("at").alias("last"))


def finder(length: int = LENGTH) -> Finder:
    return Finder(Shape(length, max(1, length * GRAM // LENGTH)), Words, subtrees_in_memory, subtrees, _paths)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row."""
    own = keyed(docs)

    def finish(text, starts, ends):
        return int((ends - starts).sum()), hashlib.sha256(Words.rest(text, starts, ends)).hexdigest()

    found = finder(length).cut(own, finish, "n_removed long, sha string", [pa.int64(), pa.string()])
    found = found.filter("n_removed > 0").dropDuplicates(["doc_id", "k"]).withColumnsRenamed({"doc_id": "_id", "k": "_k"})
    line = F.regexp_replace(F.btrim("text", F.lit(WS)), "[ \\x09-\\x0D]+", " ")
    base = own.select("doc_id", "k", line.alias("line")).select("doc_id", "k", F.when(F.col("line") == "", 0).otherwise(1 + F.length("line") - F.length(F.replace("line", F.lit(" ")))).cast("long").alias("n_words"), F.sha2(F.col("line").cast("binary"), 256).alias("whole"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"))


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text``: the kept words, joined by one space."""
    own = keyed(docs)
    found = finder(length).cut(own, lambda t, s, e: (Words.rest(t, s, e).decode() if len(s) else None,), "rest string", [pa.string()])
    found = found.filter("rest IS NOT NULL").dropDuplicates(["doc_id", "k"]).withColumnsRenamed({"doc_id": "_id", "k": "_k"})
    out = own.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    return out.select("doc_id", F.coalesce("rest", F.regexp_replace(F.btrim("text", F.lit(WS)), "[ \\x09-\\x0D]+", " ")).alias("text"))
