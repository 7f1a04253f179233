"""Exact substring dedup over bytes or words: suffix-array buckets refined by bucket pointers of later offsets.

Suffixes start in q-gram buckets. A bucket of one is final. The others are refined in memory, together for all texts around the
anchors of some buckets (see ``repeats``). These texts are blocks of eight bytes (or single words), counted from the anchor, as equal
windows lie alike around it; each suffix that starts a block holds a pointer to its bucket, first that of its block. Suffixes
that are not alone are sorted by their own pointer and that of the suffix ``h`` blocks later, which tells 2 h blocks apart; the new
pointers stay inside the old bucket's range, so those of all other suffixes remain valid, and later rounds sort by them at once. The
rounds end at the blocks that a window holds whole; a last sort tells windows apart by these and by the bytes at either end.
The symbols themselves are compared, so equality is exact.

Null texts are empty. Texts shorter than the window stay whole. Rows that repeat a text repeat each other and are removed
in full. An empty table gives an empty result; extra columns, whatever their names, are ignored or kept as they are. Very long
texts are worked off in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.repeats import Bucketful, Bytes, Finder, Shape, Words, bucketed, keyed

LENGTH, GRAM = 400, 160
#: Words of a passage, where its length is meant in words.
PASSAGE = 50


def refined_in_memory(part: Bucketful, unit: type, shape: Shape):
    """The owned windows that another class has too."""
    blocks, anchor, size = unit.grid(part.texts, part.left)
    whole = (shape.length - size) // size
    pointer, several = bucketed(blocks)
    end = len(pointer)
    pointer = np.append(pointer, end)
    h = 1
    while h < whole and len(several):
        far = min(h, whole - h)
        own, later = pointer[several], pointer[np.minimum(several + far, end)]
        order = np.argsort(own * (end + 1) + later, kind="stable")
        several, own, later = several[order], own[order], later[order]
        new = np.concatenate([[True], own[1:] != own[:-1]])
        split = new | np.concatenate([[True], later[1:] != later[:-1]])
        first = np.flatnonzero(split)
        n = np.diff([*first, len(own)])
        pointer[several] = own + np.repeat(first, n) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
        several = several[np.repeat(n > 1, n)]
        h += far
    shared = np.zeros(end, bool)
    shared[several] = True
    for cls, start in part.windows():
        block, into = anchor[cls] + start // size, start % size
        open_ = np.flatnonzero(shared[block + 1])
        cls, start, block, into = cls[open_], start[open_], block[open_], into[open_]
        # the begin of the window, before its whole blocks, and its end; the zeros that shifts leave are alike for equal starts
        bits = (8 * into).astype(np.uint64)
        begin, rest = blocks[block] >> bits, shape.length - (size - into) - whole * size
        keys = [pointer[block + 1] * (2 * shape.width) + start + shape.width, begin]
        for k in range(2 if size > 1 else 0):
            keep = np.clip(rest - k * size, 0, size)
            edge = blocks[np.minimum(block + 1 + whole + k, end - 1)] << np.uint64(8) * (size - np.maximum(keep, 1)).astype(np.uint64)
            keys.append(np.where(keep > 0, edge, 0))
        order = np.lexsort(keys[::-1])
        same = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in keys]) if len(order) else np.zeros(0, bool)
        both = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
        yield cls[both], start[both]


def refined(windows: DataFrame) -> DataFrame:
    """For buckets too large for memory: classes with a window that another class has too, and the first and last of these windows."""
    shared = windows.groupBy("w1", "w2").agg(F.min("g").alias("x"), F.max("g").alias("y")).filter("x <> y").select("w1", "w2")
    return windows.join(shared, ["w1", "w2"]).groupBy("a", "g").agg(F.min("at").alias("first"), F.max("at").alias("last"))


def finder(length: int = LENGTH, unit: type = Bytes) -> Finder:
    return Finder(Shape(length, max(1, length * GRAM // LENGTH)), unit, refined_in_memory, refined)


def digests(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row, by strings of ``length`` bytes; and ``n_passage_words``, by
    the same method over words: those in passages of ``passage`` words that start anywhere else too, however few bytes they have."""
    own = keyed(docs)

    def finish(text, starts, ends):
        return int((ends - starts).sum()), len(starts), hashlib.sha256(Bytes.rest(text, starts, ends)).hexdigest()

    cut = finder(length).cut(own, finish, "n_removed long, n_spans long, sha string", [pa.int64(), pa.int64(), pa.string()])
    said = finder(passage, Words).cut(own, lambda t, s, e: (int((e - s).sum()),), "n_passage_words long", [pa.int64()])
    none = F.lit(None).cast("long")
    found = cut.select("*", none.alias("n_passage_words")).unionByName(said.select("*", none.alias("n_removed"), none.alias("n_spans"), F.lit(None).cast("string").alias("sha")))
    found = found.filter("n_spans > 0 OR n_passage_words > 0").groupBy(F.col("doc_id").alias("_id"), F.col("k").alias("_k")).agg(*[F.max(c).alias(c) for c in ("n_removed", "n_spans", "sha", "n_passage_words")])
    base = own.select("doc_id", "k", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    no = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", *[F.coalesce(c, no).alias(c) for c in ("n_removed", "n_spans")], F.coalesce("sha", "whole").alias("kept_sha256"), F.coalesce("n_passage_words", no).alias("n_passage_words"))


def deduplicated(docs: DataFrame, length: int = LENGTH, unit: type = Bytes) -> DataFrame:
    """``docs`` without the repeated symbols (``n_chars``, if there, follows): strings of ``length`` bytes, where what a cut leaves of a
    character at an edge goes too, or passages of ``length`` words with the white space inside. Documents of which nothing is left stay."""
    own = keyed(docs)

    def finish(text, starts, ends):
        return (unit.kept(text, starts, ends).decode("utf-8", "ignore") if len(starts) else None,)

    found = finder(length, unit).cut(own, finish, "rest string", [pa.string()])
    found = found.filter("rest IS NOT NULL").dropDuplicates(["doc_id", "k"]).withColumnsRenamed({"doc_id": "__tk_id", "k": "__tk_k", "rest": "__tk_rest"})
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("__tk_key", F.xxhash64(F.col("doc_id").cast("long"), text, F.lit(8)))
    out = rows.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__tk_id")) & (F.col("__tk_key") == F.col("__tk_k")), "left")
    new = {"text": F.coalesce("__tk_rest", "text")} | ({"n_chars": F.when(F.col("__tk_rest").isNull(), F.col("n_chars")).otherwise(F.length("__tk_rest").cast(docs.schema["n_chars"].dataType))} if "n_chars" in docs.columns else {})
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])
