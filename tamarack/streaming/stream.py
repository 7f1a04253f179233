"""The same table functions over streams: files in, watermarked de-duplication, windows, custom state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).load(path)


def _timed(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need a time with a zone."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(df: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of a key within the watermark; state older than that goes."""
    return _timed(df, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(df: DataFrame, time: str, keys: list[str], value: str, size: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    window = F.window(time, size, slide) if slide else F.window(time, size)
    g = _timed(df, time).withWatermark(time, delay).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(df: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    g = _timed(df, time).withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def running_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's count and sum so far, kept as state; a row for each batch in which the key occurs."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = df.schema[key].dataType.simpleString()
    return df.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long, total double", "n long, total double", "update", "NoTimeout")


def to_table(df: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append"):
    """Runs all that is there, then stops; each batch is written once."""
    out = transform(df) if transform else df
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
