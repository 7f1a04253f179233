"""K-d tree sharding, DataFrame functions only: shards of near-equal bytes, equal texts together.

Equal texts form a group with one weight and one place in the metadata space (size, source, language). Groups above one
per cent of a shard (fewer than 100 for each shard) are dealt first, largest to the emptiest shard; a group larger than a
shard cannot stay together and is dealt in pieces. The others are split recursively: a node splits along its widest
dimension at the weighted quantile that fits the room left in the shards on either side (the weighted median if nothing
was dealt), until a node is one shard. Quantiles come from histograms of 2**13 bins that are refined inside the bin in question,
so only bounded histograms reach the driver. Ties in a dimension are ordered by a hash of the text.

Null texts are empty; null sources, languages and ids are values like others. Rows that repeat an id and a text count as
two. An empty table gives an empty result; extra columns, whatever their names, are ignored. A very long text is a heavy group like a
frequent one; only its size and hashes travel.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.llm.common import dropped, staged

SHARDS = 16
HEAVY = 100  # groups over 1/HEAVY of a shard are dealt first
PIECES = 8  # pieces for each shard's worth of a group larger than a shard
DIMS = ("x_size", "x_source", "x_lang")
_VALUE, _HASH, _BINS = 20, 43, 13
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Node:
    first: int  # shards first..last
    last: int


def described(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"), "source", "lang")


def _case(of: str, by: dict, kind: str = "long") -> Column:
    out = F.lit(None).cast(kind)
    for k, v in by.items():
        out = F.when(F.col(of) == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row."""
    rows = staged(described(docs), "shard-rows")
    coordinate = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << _VALUE))
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.max("size").alias("size"), F.min("source").alias("source"), F.min("lang").alias("lang"))
    groups = staged(groups.select("g", "bytes", F.floor(F.log2(F.col("size")) * (1 << 14)).cast("long").alias("x_size"), coordinate("source").alias("x_source"), coordinate("lang").alias("x_lang")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    target = total / shards
    dealt, room = _dealt(rows, groups, target, shards)
    light = groups.filter(F.col("bytes") * HEAVY <= target).withColumn("node", F.lit(0).cast("long"))
    light = _split(light, room, shards)
    # pieces of groups larger than a shard go by id, all else by group
    spark = docs.sparkSession
    heavy = spark.createDataFrame([(g, n, p, s) for g, n, p, s in dealt], "g long, n int, piece int, shard int")
    sizes = heavy.select("g", "n").distinct()
    placed = rows.join(F.broadcast(sizes), "g", "left")  # fewer than 100 groups a shard
    placed = placed.withColumn("piece", F.when(F.col("n").isNotNull(), _piece(F.col("n"))))
    own = placed.filter("n IS NOT NULL").join(F.broadcast(heavy.drop("n")), ["g", "piece"])
    rest = placed.filter("n IS NULL").join(light.select("g", F.col("node").cast("int").alias("shard")), "g")
    cols = ["doc_id", "size", "text_crc32", "shard"]
    out = staged(own.select(*cols).unionAll(rest.select(*cols)), "shard-placed")
    dropped(rows, groups, light)
    return _slots(out)


def _piece(n: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(5)), n.cast("long")).cast("int")


def _dealt(rows: DataFrame, groups: DataFrame, target: float, shards: int) -> tuple[list, list[float]]:
    """Places of heavy groups and pieces, and the room that is left in each shard."""
    heavy = groups.filter(F.col("bytes") * HEAVY > target).select("g", "bytes").collect()
    parts = {r["g"]: max(1, -(-int(r["bytes"] * PIECES) // max(1, int(target)))) if r["bytes"] > target else 1 for r in heavy}
    pieces = [(r["bytes"], r["g"], 0) for r in heavy if parts[r["g"]] == 1]
    if huge := {g: n for g, n in parts.items() if n > 1}:
        by = rows.filter(F.col("g").isin(list(huge))).withColumn("piece", _piece(_case("g", huge)))
        pieces += [(r["bytes"], r["g"], r["piece"]) for r in by.groupBy("g", "piece").agg(F.sum("size").alias("bytes")).collect()]
    load = [(0, s) for s in range(shards)]
    out = []
    for size, g, piece in sorted(pieces, key=lambda x: (-x[0], x[1], x[2])):
        used, s = heapq.heappop(load)
        out.append((g, parts[g], piece, s))
        heapq.heappush(load, (used + size, s))
    used = {s: u for u, s in load}
    return out, [max(0.0, target - used[s]) for s in range(shards)]


def _split(light: DataFrame, room: list[float], shards: int) -> DataFrame:
    nodes = {0: Node(0, shards - 1)}
    whole = last = None
    while any(n.last > n.first for n in nodes.values()):
        stats = {r["node"]: r for r in light.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[f(d).alias(f"{k}_{d}") for d in DIMS for k, f in (("lo", F.min), ("hi", F.max))]).collect()}
        whole = whole or {d: max([1, *(r[f"hi_{d}"] - r[f"lo_{d}"] for r in stats.values())]) for d in DIMS}
        open_ = {k: n for k, n in nodes.items() if n.last > n.first}
        wide = {k: max(DIMS, key=lambda d: ((stats[k][f"hi_{d}"] - stats[k][f"lo_{d}"]) / whole[d], -DIMS.index(d))) for k in open_ if k in stats}
        key = _case("node", {k: F.shiftleft(F.col(d), _HASH) + F.pmod(F.col("g"), F.lit(1 << _HASH)) for k, d in wide.items()})
        keyed = light.withColumn("c", key)
        middle = {k: (n.first + n.last) // 2 for k, n in open_.items()}
        share = {k: sum(room[n.first : middle[k] + 1]) / (sum(room[n.first : n.last + 1]) or 1) for k, n in open_.items()}
        cut = _quantiles(keyed, {k: share[k] * stats[k]["bytes"] for k in wide}, {k: stats[k]["bytes"] / 2000 / (nodes[k].last - nodes[k].first + 1) for k in wide})
        # a node is named by its first shard
        light = keyed.withColumn("node", F.coalesce(F.when(F.col("c") >= _case("node", cut), _case("node", {k: middle[k] + 1 for k in cut})), F.col("node"))).drop("c")
        light, before = staged(light, "shard-nodes"), last
        if before is not None:
            dropped(before)
        last = light
        nodes = {k: n for k, n in nodes.items() if k not in open_} | {n.first: Node(n.first, middle[k]) for k, n in open_.items()} | {middle[k] + 1: Node(middle[k] + 1, n.last) for k, n in open_.items()}
    return light if last is not None else staged(light, "shard-nodes")


def _quantiles(keyed: DataFrame, goal: dict, slack: dict) -> dict:
    """For each node the least key that goes right, so that about ``goal`` bytes go left."""
    prefix, shift, cut = dict.fromkeys(goal, 0), _VALUE + _HASH, {}
    left = dict(goal)
    while left and shift > 0:
        above, shift = shift, max(0, shift - _BINS)
        within = keyed.filter(F.shiftright("c", above) == _case("node", {k: prefix[k] for k in left})) if above < _VALUE + _HASH else keyed.filter(F.col("node").isin(list(left)))
        bins = within.groupBy("node", F.shiftright("c", shift).alias("b")).agg(F.sum("bytes").alias("bytes")).collect()
        for k in list(left):
            below = 0
            for b, size in sorted((r["b"], r["bytes"]) for r in bins if r["node"] == k):
                if below + size > left[k]:
                    break
                below += size
            else:
                cut[k] = (b + 1) << shift
                del left[k]
                continue
            if size <= slack[k] or not shift:
                cut[k] = (b + (left[k] - below > size / 2)) << shift
                del left[k]
            else:
                left[k] -= below
                prefix[k] = b
    return cut


def _slots(placed: DataFrame) -> DataFrame:
    """Numbers without gaps in each shard: rows are numbered in buckets of bounded size, which start where the ones before end."""
    n = placed.count()
    buckets = max(1, n // SLOT_ROWS)
    rows = placed.withColumn("b", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "b").agg(F.count("*").alias("n"))
    start = sizes.select("shard", "b", (F.sum("n").over(W.partitionBy("shard").orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")).alias("start"))
    number = F.row_number().over(W.partitionBy("shard", "b").orderBy("doc_id", "text_crc32", "size"))
    out = rows.withColumn("i", number).join(start, ["shard", "b"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("i") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
