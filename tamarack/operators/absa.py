"""Aspect sentiment: segments, sentences or clauses are scored once each and joined back to the aspects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.config import TextConfig
from tamarack.functions.text import clauses, hash16
from tamarack.operators.scoring import apply_negation, score_distinct, stub_scorer
from tamarack.schemas import fields

#: A sentence's key; its id alone repeats between places.
KEY = ("source", "place_id", "comment_id", "sentence_idx")
Scorer = Callable[[DataFrame], DataFrame]


stub = stub_scorer()


def _done(df: DataFrame) -> DataFrame:
    label, flag = apply_negation(F.col("label"), F.col("aspect_negated"))
    return df.withColumns({"sentiment": label, "negation_applied": flag, "confidence_score": F.col("score")}).drop("label", "score")


def by_segment(s6: DataFrame, scorer: Scorer = stub) -> DataFrame:
    """Each distinct segment once; the sentence stays whole."""
    text = F.coalesce(F.nullif("segment_text", F.lit("")), F.nullif("clause_text", F.lit("")), F.col("sentence_text"))
    df = s6.withColumn("segment_hash", F.coalesce(F.nullif("segment_hash", F.lit("")), hash16(text)))
    return _done(score_distinct(df, "segment_hash", text, scorer)).withColumn("sentence", F.col("sentence_text"))


def by_sentence(s6: DataFrame, scorer: Scorer = stub) -> DataFrame:
    """Each sentence once; its aspects share the label."""
    df = s6.withColumn("_sentence", F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in KEY]))
    out = score_distinct(df, "_sentence", F.col("sentence_text"), scorer).drop("_sentence")
    return _done(out).withColumns({"sentence": F.col("sentence_text"), "clause_idx": F.lit(0), "segment_type": F.lit("sentence")})


def by_clause(s6: DataFrame, scorer: Scorer = stub, cfg: TextConfig = TextConfig()) -> DataFrame:
    """An aspect takes the label of the first clause with its keyword; the output sentence is that clause. A sentence without
    clauses counts as one."""
    own = clauses(F.col("sentence_text"), cfg)
    df = s6.withColumn("_all", F.when(F.size(own) > 0, own).otherwise(F.array("sentence_text")))
    word = F.lower(F.coalesce("aspect_keyword", F.lit("")))
    hit = F.array_position(F.transform("_all", lambda c: (word != "") & F.contains(F.lower(c), word)), F.lit(True))
    df = df.withColumn("clause_idx", F.greatest(hit - 1, F.lit(0)).cast("int"))
    df = df.withColumn("_clause", F.get("_all", F.col("clause_idx"))).withColumn("_hash", hash16(F.col("_clause")))
    out = _done(score_distinct(df, "_hash", F.col("_clause"), scorer))
    return out.withColumns({"sentence": F.col("_clause"), "segment_type": F.lit("clause")}).drop("_all", "_clause", "_hash")


def assembled(s6: DataFrame, granularity: str = "aspect_span", scorer: Scorer = stub, cfg: TextConfig = TextConfig()) -> DataFrame:
    if granularity in ("aspect_span", "segment", "aspect"):
        return by_segment(s6, scorer)
    return by_clause(s6, scorer, cfg) if granularity == "clause" else by_sentence(s6, scorer)


def with_sentence_scores(s6: DataFrame, s3: DataFrame) -> DataFrame:
    """S6 with the label of its sentence from S3; neutral, 0.5 where there is none."""
    last = W.partitionBy(*KEY).orderBy(F.desc("sentence_id"))
    one = s3.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    one = one.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("label").alias("_label"), F.col("score").alias("_score"), F.col("model_version").alias("_version"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    out = s6.join(one, on, "left").drop(*[f"_{k}" for k in KEY])
    return out.withColumns({"sentence_label": F.coalesce("_label", F.lit("neutral")), "sentence_score": F.coalesce("_score", F.lit(0.5)), "sentence_model": F.coalesce("_version", F.lit(""))}).drop("_label", "_score", "_version")


def record_id() -> Column:
    return F.concat(F.concat_ws("_", "source", "comment_id", "sentence_id", "aspect"), F.lit("_c"), F.col("clause_idx").cast("string"))


def s7_rows(rows: DataFrame, run_id: str = "", created_at: Column | None = None) -> DataFrame:
    """The 24 published columns."""
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if created_at is None else created_at
    own = {"record_id": record_id(), "entity_id": F.col("place_id"), "platform": F.col("source"), "created_at": at, "processed_at": at, "run_id": F.lit(run_id)}
    return rows.withColumns(own).select(*fields("s7_absa"))


def from_clauses(rows: DataFrame, texts: str, labels: str) -> DataFrame:
    """A row for each pair of two parallel arrays, up to the end of the shorter."""
    n = F.least(F.size(texts), F.size(labels))
    pair = F.arrays_zip(F.slice(F.col(texts), F.lit(1), F.greatest(n, F.lit(0))).alias("t"), F.slice(F.col(labels), F.lit(1), F.greatest(n, F.lit(0))).alias("l"))
    return rows.select("*", F.posexplode(pair).alias("clause_idx", "_p")).select("*", F.col("_p.t").alias("clause_text"), F.col("_p.l").alias("sentiment")).drop("_p")


def ml_rows(s7: DataFrame) -> DataFrame:
    return s7.select(*fields("ml_absa"))
