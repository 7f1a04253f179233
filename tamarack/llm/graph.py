"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import dropped, staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``a, b`` (longs), a written table; ``root`` is the smallest node of the component.

    Every round is written to the shared folder. A star's centre may have any number of leaves: minima are summed before
    rows are sent, and leaves meet their centre in a join that can be split. Isolated nodes do not occur; no edges, no rows.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    mark = _mark(now)
    while True:
        if mark[0] == 0:
            break
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        centre = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(centre, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        after = staged(small, "components")
        dropped(now)
        now, was, mark = after, mark, _mark(after)
        if mark == was:
            break
    out = staged(now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "component-roots")
    dropped(now)
    return out


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
