"""Near copies by exact Jaccard similarity of word shingles.

Each text is the set of the hashes of its shingles (``WORDS`` words, lower case; a shorter text is one shingle). Texts with
equal sets are one.

First SimHash: the fingerprints of the sets go through the grid of ``simhash`` (segment counts, Manhattan bound, exact Hamming distance)
at its three bits, and each set is compared exactly with the nearest of those that the grid links it to (``near_bits``). But at a similarity
of 0.8 some ten of 64 bits differ, and cells of a grid that hold all such pairs also hold most unrelated ones. So what the grid has not
connected is looked for in cells of another kind: minima of the set under ``ROWS * BANDS`` multipliers, hashed band by band. A pair of
similarity 0.8 shares no such cell with a probability of 3e-6, a closer one with less.

Pairs of these cells are compared exactly, but only where links do not connect them yet. In rounds, a few sets of each cell's largest
component (``TRIED``) are compared with the cell's sets outside it, and the components are joined anew: this connects nearly all that
belong together. Then the sets outside the largest component of a cell are gathered in blocks of bounded size; each block is an index
of shingles that all members of its cells, in shares of bounded size, are looked up in. So no pairs are sent, no cell or component is
held by one task, and no link between components is lost.

Null texts are empty, and all empty texts are alike. Null ids are nobody's smallest id. An empty table gives an empty result; extra
columns, whatever their names, are ignored or kept as they are. Very long texts are hashed as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.llm import simhash
from tamarack.llm.common import dropped, released, staged
from tamarack.llm.graph import components
from tamarack.llm.simhash import SEED, one_each, row_name

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 32
TRIED = (1, 4, 4)
BLOCK, SHARE = 200_000, 20_000  # shingles of a block; members that one task looks up in it
_TIMES = np.random.default_rng(SEED).integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(SEED + 1).integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the shingles, ascending."""
    import xxhash

    own = (text or "").encode().lower().split()
    line, digest = b" ".join(own), xxhash.xxh64_intdigest
    if len(own) <= words:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    begin = np.concatenate([[0], ends[:-words]]).tolist()
    return np.unique(np.fromiter((digest(line[b:e], SEED) for b, e in zip(begin, (ends[words - 1 :] - 1).tolist(), strict=True)), np.uint64, len(begin)))


def cells(own: np.ndarray) -> np.ndarray:
    """A key for each band."""
    least = np.full(len(_TIMES), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(own), 4096):
        least = np.minimum(least, (own[k : k + 4096, None] * _TIMES).min(axis=0))
    x = (least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))).sum(axis=1, dtype=np.uint64)
    return (x ^ (x >> np.uint64(32))) * _TIMES[:BANDS]


def sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, row, sid, n, fp, cells``: the row's name, the set's name, size, SimHash fingerprint and cells. The set itself is not
    kept."""

    def run(batches):
        import xxhash

        for batch in batches:
            sid, fp, n, keys = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, BANDS), np.int64)
            for k, t in enumerate(batch.column(2)):
                own = shingles(t.as_py(), words)
                sid[k], fp[k], n[k], keys[k] = xxhash.xxh64_intdigest(own.tobytes(), SEED), simhash.voted(own), len(own), cells(own).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sid.view(np.int64)), pa.array(n), pa.array(fp.view(np.int64)), lists], names=["doc_id", "row", "sid", "n", "fp", "cells"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_name(docs).alias("row"), docs["text"]).mapInArrow(run, "doc_id long, row long, sid long, n long, fp long, cells array<long>")


def members(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``sid, own``: the sets of the rows ``row, sid``, one for each."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t.as_py(), words).tobytes() for t in batch.column(1)], pa.binary())], names=["sid", "own"])

    rows = docs.select(row_name(docs).alias("_row"), docs["text"]).join(wanted, F.col("_row") == F.col("row")).dropDuplicates(["sid"])
    return rows.select("sid", "text").mapInArrow(run, "sid long, own binary")


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def verified(pairs: DataFrame, own: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar."""

    def run(batches):
        for batch in batches:
            good = [similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), least) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    one = own.select(F.col("sid").alias("a"), F.col("own").alias("x")), own.select(F.col("sid").alias("b"), F.col("own").alias("y"))
    return pairs.join(one[1], "b").join(one[0], "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_bits(sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the sets ``sid, n, fp`` by SimHash, a written table: each set and, of those that the grid links it to, one whose
    fingerprint is nearest. At most one pair for each set; of sets with one fingerprint, all are paired with the first."""
    one = staged(sets.groupBy("fp").agg(F.min("sid").alias("first")), "near-fingerprints")
    edges = simhash.linked(one.select("fp"))
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    both = edges.select(F.col("a").alias("fp"), F.struct(bits.alias("bits"), F.col("b").alias("other")).alias("to")).unionAll(edges.select(F.col("b").alias("fp"), F.struct(bits.alias("bits"), F.col("a").alias("other")).alias("to")))
    nearest = both.groupBy("fp").agg(F.min("to").alias("to")).select("fp", "to.other")
    apart = nearest.join(one, "fp").join(one.select(F.col("fp").alias("other"), F.col("first").alias("b")), "other").select(F.col("first").alias("a"), "b")
    equal = sets.select("sid", "fp").join(one, "fp").filter("sid <> first").select(F.col("first").alias("a"), F.col("sid").alias("b"))
    pairs = apart.unionAll(equal).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    out = staged(pairs, "near-bits")
    dropped(one, edges)
    return out


def linked(cells: DataFrame, sets: DataFrame, least: float, links: DataFrame | None = None) -> DataFrame | None:
    """``node, root`` of all sets that have links, a written table; null if there are none. ``cells``: ``cell, sid, n`` with the sets'
    sizes; ``sets``: ``sid, own``; ``links``: ``a, b``, those that are known, a written table that is then deleted."""
    roots, tested = None if links is None else components(links), None
    for turn in range(len(TRIED) + 1):
        m = cells.withColumn("root", F.col("sid")) if roots is None else cells.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        kinds = m.groupBy("cell", "root").agg(F.count("*").alias("size"))
        mixed = kinds.groupBy("cell").agg(F.count("*").alias("kinds"), F.max(F.struct("size", "root")).alias("top")).filter("kinds > 1").select("cell", F.col("top.root").alias("top"))
        open_ = staged(m.join(mixed, "cell"), "near-open")
        if open_.isEmpty():
            dropped(open_)
            break
        if turn < len(TRIED):
            own = open_.filter("root = top").select("cell", F.col("sid").alias("c"), F.col("n").alias("c_n"))
            place = F.row_number().over(W.partitionBy("cell").orderBy(F.xxhash64("c", F.lit(turn))))
            centres = own.withColumn("place", place).filter(F.col("place") <= TRIED[turn]).drop("place")
            pairs = open_.filter("root <> top").join(centres, "cell").filter(F.least("n", "c_n") >= least * F.greatest("n", "c_n") - 1e-9)
            pairs = pairs.select(F.least("sid", "c").alias("a"), F.greatest("sid", "c").alias("b")).distinct()
            pairs = staged(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
            found = staged(verified(pairs, sets, least), "near-links")
            tested = _more(tested, pairs)
        else:
            found = _looked_up(open_, sets, least)
        links = _more(links, found)
        dropped(open_, *[x for x in (roots,) if x is not None])
        roots = components(links)
        released(cells.sparkSession)
    dropped(*[x for x in (links, tested) if x is not None])
    return roots


def _looked_up(open_: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` of the sets outside the largest component of a cell with sets of that cell and other components, a written table."""
    outside = open_.filter("root <> top")
    # by the component that they are outside of, and in as many blocks as their shingles need
    home = outside.groupBy("sid", "root", "n").agg(F.min("top").alias("home"))
    parts = home.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    blocks = staged(home.join(parts, "home").select("sid", "root", F.xxhash64("home", F.pmod(F.xxhash64("sid", F.lit(3)), F.col("parts"))).alias("block")), "near-outside")
    reach = outside.join(blocks.select("sid", "block"), "sid").select("block", "cell").distinct()
    members = staged(reach.join(open_.select("cell", "sid", "root"), "cell").select("block", "sid", "root").distinct(), "near-reached")
    shares = members.groupBy("block").agg((F.floor(F.count("*") / SHARE) + 1).cast("int").alias("shares"))
    index = blocks.join(shares, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), "sid", "root")
    rows = members.join(shares, "block").select("block", F.pmod(F.xxhash64("sid"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("kind"), "sid", "root")

    def run(batches):
        now, index, held = None, None, []
        for batch in batches:
            block, share, kind, sid, root = (batch.column(k).to_numpy() for k in range(5))
            out = []
            for k, own in enumerate(batch.column(5)):
                if now != (block[k], share[k]):
                    now, index, held = (block[k], share[k]), None, []
                if not kind[k]:
                    held.append((int(sid[k]), int(root[k]), np.frombuffer(own.as_py(), np.uint64)))
                    continue
                index = index or Index(held)
                out += index.similar(int(sid[k]), int(root[k]), np.frombuffer(own.as_py(), np.uint64), least)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])

    all_ = index.unionAll(rows).join(sets, "sid").select("block", "share", "kind", "sid", "root", "own")
    out = staged(all_.repartition("block", "share").sortWithinPartitions("block", "share", "kind", "sid").mapInArrow(run, "a long, b long"), "near-links")
    dropped(blocks, members)
    return out


class Index:
    """Sets by their shingles: which of them are similar to another one, of another component. One link for each set and component."""

    def __init__(self, sets: list[tuple[int, int, np.ndarray]]):
        self.sid, self.root = (np.array([x[k] for x in sets], np.int64) for k in (0, 1))
        self.n = np.array([len(x[2]) for x in sets])
        hashes, owner = np.concatenate([x[2] for x in sets]), np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.seen: set[tuple[int, int]] = set()

    def similar(self, sid: int, root: int, own: np.ndarray, least: float) -> list[tuple[int, int]]:
        first, last = np.searchsorted(self.hashes, own), np.searchsorted(self.hashes, own, "right")
        n = last - first
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        both = np.bincount(self.owner[at], minlength=len(self.n))
        out = []
        for k in np.flatnonzero((both >= least * (self.n + len(own) - both) - 1e-9) & (self.root != root)).tolist():
            if (k, root) not in self.seen:
                self.seen.add((k, root))
                out.append((int(self.sid[k]), sid))
        return out


def _more(table: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Both as one written table; theirs are deleted."""
    if table is None:
        return rows
    both = staged(table.unionAll(rows), "near-more")
    dropped(table, rows)
    return both


def _joined(docs: DataFrame, words: int, least: float) -> DataFrame:
    """``doc_id, row, component_id, root``, a written table; ``root`` names the component."""
    every = staged(sets(docs, words), "near-sets")
    first = staged(every.groupBy("sid").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("cells").alias("cells")), "near-distinct")
    close = near_bits(first.select("sid", "n", "fp"))
    released(docs.sparkSession)
    keys = staged(first.select("sid", "n", F.posexplode("cells").alias("band", "key")).select(F.xxhash64("band", "key").alias("cell"), "sid", "n"), "near-keys")
    shared = keys.groupBy("cell").agg(F.count("*").alias("all")).filter("all > 1").select("cell")
    cells = staged(keys.join(shared, "cell").select("cell", "sid", "n"), "near-cells")
    dropped(keys)
    wanted = cells.select("sid").unionAll(close.select(F.explode(F.array("a", "b")).alias("sid"))).distinct()
    own = staged(members(docs, first.join(wanted, "sid", "left_semi").select("row", "sid"), words), "near-members")
    released(docs.sparkSession)
    links = staged(verified(close, own, least), "near-links")
    roots = linked(cells, own, least, links)
    named = first.select("sid", "least")
    named = named.withColumn("root", F.col("sid")) if roots is None else named.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(ids, "root").select("sid", "root", "component_id")
    out = staged(every.select("doc_id", "row", "sid").join(of, "sid").select("doc_id", "row", "component_id", "root"), "near-groups")
    dropped(every, first, close, cells, own, *[x for x in (roots,) if x is not None])
    return out


def grouped(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, component_id``; a component's id is the smallest ``doc_id`` that links reach."""
    return _joined(docs, words, least).select("doc_id", "component_id")


def deduplicated(docs: DataFrame, words: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """One document of each component, by the rules of ``simhash.deduplicated``."""
    return one_each(docs, _joined(docs, words, least))
