"""Closest names by longest common subsequence: names as a tree, so that those with a common beginning share its work.

For one name, bit-parallel rows of all nodes of a level are made from those of the level before, in one array; a name costs its own last
characters only. No pair of names is a row. Names of each side are dealt in parts of bounded size within their province, so neither a large
province nor a long list is held by one task. Every name of a part is compared, whatever its length or characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART, SHARE = 50_000, 1_000  # names of a tree; names that one task looks for in it
CELLS = 1 << 22  # characters of a tree, its names padded to one length
SLACK = 1e-5  # scores this close to the best are left to the exact rounding of the caller


class Tree:
    """Distinct names of about one length. ``at`` gives their places in the list that they are from."""

    def __init__(self, names: list[str], at: np.ndarray):
        n = np.array([len(x) for x in names])
        width = max(1, int(n.max()))
        codes = np.array(names, f"<U{width}").view(np.uint32).reshape(len(names), width).astype(np.int64)
        codes = np.where(np.arange(width) < n[:, None], codes + 1, 0)  # 0: after the end
        number = np.zeros(int(codes.max()) + 1, np.int64)
        number[codes] = 1
        number[0] = 0
        self.ids = {int(c): k for k, c in enumerate(np.flatnonzero(number), 1)}
        number = np.cumsum(number) * number
        own = number[codes].astype("u1" if len(self.ids) < 256 else ">u4")
        order = np.argsort(np.ascontiguousarray(own).view(f"S{own.itemsize * width}").reshape(-1), kind="stable")
        own, self.at, self.n = own[order].astype(np.int64), at[order], n[order]
        differ = (own[1:] != own[:-1]).argmax(axis=1)
        self.levels, last = [], np.zeros(len(own), np.int64)
        for j in range(width):
            begin = np.concatenate([[True], differ <= j])
            nodes = np.flatnonzero(begin)
            up = last[nodes]
            self.levels.append((None if j and len(nodes) == last[-1] + 1 else up, own[nodes, j]))
            last = np.cumsum(begin) - 1

    def common(self, name: str) -> np.ndarray:
        """The length of the longest common subsequence with each name of the tree."""
        masks = [0] * (len(self.ids) + 1)
        for k, ch in enumerate(name):
            if i := self.ids.get(ord(ch) + 1):
                masks[i] |= 1 << k
        full = (1 << len(name)) - 1
        if len(name) <= 64:
            by = np.array(masks, np.uint64)
            v = np.array([full], np.uint64)
            for up, chars in self.levels:
                v = v if up is None else v[up]
                u = v & by[chars]
                v = (v + u) | (v ^ u)
            return len(name) - np.bitwise_count(v & np.uint64(full)).astype(np.int64)
        rows = [full]
        for up, chars in self.levels:
            rows = [(v + u) & full | v ^ u for v, m in zip(rows if up is None else [rows[k] for k in up.tolist()], [masks[c] for c in chars.tolist()], strict=True) for u in (v & m,)]
        return np.array([len(name) - v.bit_count() for v in rows])


class Names:
    """Distinct names in the order in which they are preferred."""

    def __init__(self, names: list[str]):
        n = np.array([len(x) for x in names], np.int64)
        order, self.trees, k = np.argsort(n, kind="stable"), [], 0
        while k < len(order):
            own = order[k : k + max(1, int(np.searchsorted(np.arange(1, len(order) - k + 1) * n[order[k:]], CELLS, "right")))]
            self.trees.append(Tree([names[i] for i in own.tolist()], own))
            k += len(own)
        self.empty = names.index("") if n.size and not n.min() else None

    def best(self, name: str, threshold: float) -> list[tuple[int, int]]:
        """Place and common length of the first of the best names, for each length of theirs that can have the best score."""
        if not name:
            return [] if self.empty is None else [(self.empty, 0)]
        least, found = max(threshold, SLACK) - SLACK, []
        for tree in self.trees:
            both = tree.common(name)
            score = 200.0 * both / (tree.n + len(name))
            if (top := score.max()) < least or top <= 0:
                continue
            least = max(least, top - SLACK)
            near = np.flatnonzero(score >= least)
            found.append((score[near], tree.n[near], tree.at[near], both[near]))
        first: dict[tuple[int, int], int] = {}
        for score, n, at, both in found:
            keep = score >= least
            if (n == n[0]).all() and keep.all() and (both == both[0]).all():  # nearly always
                n, at, both, keep = n[:1], at.min(keepdims=True), both[:1], keep[:1]
            for of, place, k in zip(zip(n[keep].tolist(), both[keep].tolist(), strict=True), at[keep].tolist(), range(len(n)), strict=False):
                first[of] = min(first.get(of, place), place)
        return [(place, both) for (_, both), place in first.items()]


def closest(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """``province, _a, _b, lcs`` of ``a`` (``province, _a``) and ``b`` (``province, _b, ord``), both distinct: for each ``_a`` the best ``_b``
    of its province, of several the first by ``ord``, as long as it reaches the threshold; also those that may round to the same."""
    spark = a.sparkSession
    shares = a.groupBy("province").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    sizes = b.groupBy("province").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).join(shares, "province")
    one = a.join(sizes, "province").select("province", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("_a"), "shares").cast("int").alias("share"), F.lit(1).alias("kind"), F.lit(None).cast(b.schema["ord"].dataType).alias("ord"), F.col("_a").alias("name"))
    two = b.join(sizes, "province").select("province", F.pmod(F.xxhash64("_b"), "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), "ord", F.col("_b").alias("name"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    kind = a.schema["province"].dataType
    rows = one.unionAll(two).repartition(n, "province", "part", "share").sortWithinPartitions("province", "part", "share", "kind", "ord", "name").drop("ord")

    def run(batches):
        now, names, index = None, [], None
        for batch in batches:
            out = []
            for *key, own, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    now, names, index = key, [], None
                if not own:
                    names.append(name)
                    continue
                index = index or Names(names)
                out += [(key[0], name, names[k], both) for k, both in index.best(name, threshold)]
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int32())], names=["province", "_a", "_b", "lcs"])

    return rows.mapInArrow(run, f"province {kind.simpleString()}, _a string, _b string, lcs int")
