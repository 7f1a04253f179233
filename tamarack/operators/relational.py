"""Joins, windows and set operations beyond those of the text pipeline, as table functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """Each left row with the last right row of its key at or before its time: one union and one window instead of a join."""
    a = left.withColumns({f"_{v}": F.lit(None).cast(right.schema[v].dataType) for v in values} | {"_side": F.lit(1)})
    b = right.select(*keys, time, *[F.col(v).alias(f"_{v}") for v in values], F.lit(0).alias("_side"))
    last = W.partitionBy(*keys).orderBy(time, "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = a.unionByName(b, allowMissingColumns=True).withColumns({v: F.last(f"_{v}", ignorenulls=True).over(last) for v in values})
    return both.filter("_side = 1").drop("_side", *[f"_{v}" for v in values])


def in_ranges(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: float) -> DataFrame:
    """Points within ranges: both are cut to cells of ``width``, joined by cell, then compared."""
    p = points.withColumn("_cell", F.floor(F.col(value) / width))
    r = ranges.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, "_cell").filter((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("_cell")


def sessions(df: DataFrame, key: str, time: str, gap_seconds: int) -> DataFrame:
    """Numbers sessions of a key: a new one after a gap."""
    order = W.partitionBy(key).orderBy(time)
    at = F.col(time).cast("timestamp").cast("double")
    gap = at - F.lag(at).over(order)
    return df.withColumn("_new", F.when(gap.isNull() | (gap > gap_seconds), 1).otherwise(0)).withColumn("session", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("long")).drop("_new")


def moving(df: DataFrame, keys: list[str], order: str, value: str, before: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumns({"previous": F.lag(value).over(w), "moving_avg": F.round(F.avg(value).over(w.rowsBetween(-before, 0)), 4), "rank": F.rank().over(w).cast("int")})


def containing(texts: DataFrame, text: str, words: DataFrame, word: str) -> DataFrame:
    """Texts with the words they contain, by equality on words that stand alone: no nested loop."""
    own = texts.withColumn("_w", F.explode(F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))))
    return own.join(words, F.col("_w") == F.lower(F.col(word))).drop("_w")


def weighted_total(df: DataFrame, hot: Column, salts: int, keys: list[str], value: str) -> DataFrame:
    """A sum by key in two steps, hot keys salted in the first."""
    salt = F.when(hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0)
    return df.groupBy(*keys, salt.alias("_salt")).agg(F.sum(value).alias("_s")).groupBy(*keys).agg(F.sum("_s").alias("total"))
