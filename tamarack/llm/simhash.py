"""SimHash near-duplicates: a segment-popcount grid finds candidates, Hamming distance decides.

Fingerprints are cut into 32 segments of two bits. The vector of segment bit counts embeds a fingerprint in a grid;
the Manhattan distance of two vectors never exceeds the Hamming distance. Written in unary (00, 01, 11), a segment's
count makes the Manhattan distance of two packed vectors the bit count of their XOR. The 32 dimensions form
``blocks`` blocks: vectors within Manhattan distance d differ in at most d blocks, so every pair shares the cells of
some ``blocks - d`` blocks, which are the keys of the range join. Candidates of a cell are filtered by the Manhattan bound,
then verified exactly. A cell with more than ``HOT`` fingerprints is joined through neighbours instead: every
fingerprint is listed under all values within one bit and within two bits; a value with a one-bit entry links all of its
entries (they are within three bits of that one), in rows linear in the cell.

Null texts are empty: fingerprint zero, linked like any other. Null ids stay in the result but are nobody's smallest id.
Repeated rows keep their own result rows; equal fingerprints are one node, so ties and copies cost nothing more. An empty table gives
an empty result; extra columns, whatever their names, are ignored or kept as they are. Very long texts are hashed as a whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import dropped, released, staged
from tamarack.llm.graph import components

SEED, WORDS, BITS = 42, 3, 3
HOT = 20_000
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority vote of the hashes of all word shingles, repeats included."""
    import xxhash

    own = (text or "").encode().lower().split()
    if not own:
        return 0
    line, n = b" ".join(own), max(1, len(own) - words + 1)
    if len(own) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, own), np.int64, len(own)) + 1
    ends = np.cumsum(sizes)
    begin, end = (ends - sizes)[:n].tolist(), (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return voted(np.fromiter([digest(line[b:e], SEED) for b, e in zip(begin, end, strict=True)], np.uint64, n))


def voted(hashes: np.ndarray) -> int:
    """Majority vote of hashes, bit by bit."""
    n, votes = len(hashes), np.zeros(64, np.int64)
    # each byte of a sum counts one of eight bits; 255 terms fit
    pad = -n % 255
    rows = np.concatenate([hashes, np.zeros(pad, np.uint64)]).reshape(-1, 255) if n > 255 else hashes.reshape(1, -1)
    for b in range(8):
        sums = ((rows >> np.uint64(b)) & _LANES).sum(axis=1, dtype=np.uint64)
        votes[b::8] = np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def row_name(docs: DataFrame) -> Column:
    """A name of a row's id and text: rows that share an id are told apart by their texts."""
    return F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")), F.lit(3))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, row, fp`` (the fingerprint as a signed long)."""

    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "row", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_name(docs).alias("row"), docs["text"]).mapInArrow(run, "doc_id long, row long, fp long")


def embedded(fp: np.ndarray) -> np.ndarray:
    """Packed segment bit counts in unary."""
    pairs = np.uint64(0x5555555555555555)
    low, high = fp & pairs, (fp >> np.uint64(1)) & pairs
    return (low | high) | ((low & high) << np.uint64(1))


def block_masks(blocks: int) -> list[int]:
    cuts = [round(32 * k / blocks) for k in range(blocks + 1)]
    return [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(cuts, cuts[1:], strict=False)]


def blocks_for(n: int) -> int:
    """More and so narrower cells as the table grows: 20, 56 or 120 keys for each fingerprint."""
    return 6 if n < 1 << 24 else 8 if n < 1 << 31 else 10


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that connect all pairs within ``bits``: no link is lost, but within a cell
    a pair that others already connect is left out. A written table."""
    masks = block_masks(blocks_for(fps.count()))
    shared = [sum(c) for c in combinations(masks, len(masks) - bits)]
    low = F.col("fp").bitwiseAND(0x5555555555555555)
    high = F.expr("shiftrightunsigned(fp, 1)").bitwiseAND(0x5555555555555555)
    cell = F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))
    keys = fps.withColumn("u", cell).select("fp", F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("u").bitwiseAND(_signed(m))) for k, m in enumerate(shared)])).alias("key"))
    keys = staged(keys, "simhash-cells")
    hot = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("key")
    hot = staged(hot, "simhash-hot")
    some_hot = not hot.isEmpty()
    cool = keys.join(hot, "key", "left_anti") if some_hot else keys
    found = cool.select("fp", "key").repartition("key").sortWithinPartitions("key").mapInArrow(_compared(bits), "a long, b long")
    if some_hot:
        found = found.unionAll(_by_neighbours(keys.join(hot, "key", "left_semi").select("fp").distinct(), bits))
    out = staged(found.distinct(), "simhash-links")
    dropped(keys, hot)
    return out


def _compared(bits: int):
    def run(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            fp = np.concatenate([fp, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            key = np.concatenate([key, batch.column(1).to_numpy(zero_copy_only=False)])
            if len(key) and (cut := int(np.searchsorted(key, key[-1]))) >= HOT:  # whole cells; the last may go on
                yield from pairs(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        yield from pairs(key, fp)

    def pairs(key, fp):
        grid, root = embedded(fp), np.arange(len(fp))
        at, out = np.arange(len(fp)), []
        for d in range(1, len(fp)):
            at = at[at + d < len(fp)]
            at = at[key[at] == key[at + d]]
            if not len(at):
                break
            i = at[np.bitwise_count(grid[at] ^ grid[at + d]) <= bits]
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= bits]
            i = i[root[i] != root[i + d]]
            for x in i.tolist():
                a, b = _top(root, x), _top(root, x + d)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((x, x + d))
            if len(i):
                while (nxt := root[root]).tobytes() != root.tobytes():
                    root = nxt
        if out:
            x = np.array(out)
            yield pa.RecordBatch.from_arrays([pa.array(fp[x[:, 0]].view(np.int64)), pa.array(fp[x[:, 1]].view(np.int64))], names=["a", "b"])

    return run


def _top(root: np.ndarray, x: int) -> int:
    while root[x] != x:
        x = root[x]
    return int(x)


def _by_neighbours(fps: DataFrame, bits: int) -> DataFrame:
    """Links within ``bits`` (three, two or one) in rows linear in the number of fingerprints."""
    near, far = bits // 2, bits - bits // 2

    def masks(most: int) -> list[int]:
        return [_signed(sum(1 << b for b in c)) for k in range(most + 1) for c in combinations(range(64), k)]

    listed = [F.transform(F.array(*[F.lit(m) for m in masks(n)]), lambda m: F.col("fp").bitwiseXOR(m)) for n in (near, far)]
    rows = fps.select("fp", F.explode(listed[0]).alias("at"), F.lit(1).alias("close")).unionAll(fps.select("fp", F.explode(listed[1]).alias("at"), F.lit(0).alias("close")))
    centre = rows.filter("close = 1").groupBy("at").agg(F.min("fp").alias("a"))
    return rows.join(centre, "at").filter("fp <> a").select("a", F.col("fp").alias("b"))


def _joined(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """``doc_id, row, fp, component_id, root``, a written table; ``root`` names the component."""
    spark = docs.sparkSession
    own = staged(fingerprints(docs, words), "simhash")
    least = staged(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    links = linked(least.select("fp"), bits)
    roots = components(links)
    released(spark)
    joined = least.join(roots.withColumnRenamed("node", "fp"), "fp")
    first = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of = joined.join(first, "root").select("fp", "root", "component_id")
    of = least.join(of, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))
    out = staged(own.join(of, "fp").select("doc_id", "row", "fp", "component_id", "root"), "simhash-groups")
    dropped(own, least, links, roots)
    return out


def grouped(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``; a component's id is the smallest ``doc_id`` that links reach."""
    return _joined(docs, words, bits).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words: int = WORDS, bits: int = BITS, similarity: float | None = None) -> DataFrame:
    """One document of each component: the one with the smallest id (a null one last), of several with this id the one whose id and text
    have the smallest hash; of rows that repeat id and text, one. With a ``similarity``, documents link by the Jaccard similarity of
    their shingles: the grid's pairs are checked exactly, and pairs whose fingerprints differ more are looked for afterwards, see
    ``near_copies``."""
    if similarity is None:
        return one_each(docs, _joined(docs, words, bits))
    from tamarack.llm import near_copies

    return near_copies.deduplicated(docs, words, similarity)


def one_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their component in ``groups`` (``doc_id, row, root``, a written table that is then
    deleted)."""
    each = groups.groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    first = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "n")).alias("first"))
    keep = staged(first.select(F.col("first.row").alias("__tk_row"), F.col("first.n").alias("__tk_n")), "simhash-keep")
    rows = docs.withColumn("__tk_own", row_name(docs)).join(keep, F.col("__tk_own") == F.col("__tk_row"))
    once = rows.filter("__tk_n = 1")
    if not keep.filter("__tk_n > 1").isEmpty():
        once = once.unionAll(rows.filter("__tk_n > 1").dropDuplicates(["__tk_own"]))
    dropped(groups)
    return once.select(*[F.col(c) for c in docs.columns])
