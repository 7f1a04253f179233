"""Sentiment scores: a deterministic stub of built-in expressions, and model providers over Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.config import LABEL_NAMES, LABELS

#: Softmax of a one-hot row of three.
STUB_SCORE = math.e / (math.e + 2)


def label_name(label_id: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in LABELS]), label_id)


def label_of(c: Column) -> Column:
    """Names and model labels in any case; unknown ones are neutral."""
    table = F.create_map(*[F.lit(x) for kv in LABEL_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(table, F.upper(F.trim(c))), F.lit("neutral"))


def stub_label_id(c: Column) -> Column:
    return F.pmod(F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("long"), F.lit(3)).cast("int")


def with_stub(df: DataFrame, text: str, version: str = "stub") -> DataFrame:
    n = stub_label_id(F.col(text))
    return df.withColumns({"label": label_name(n), "score": F.lit(STUB_SCORE), "label_id": n, "model_version": F.lit(version)})


def stub_scorer(version: str = "stub") -> Callable[[DataFrame], DataFrame]:
    """``with_stub`` over ``_text``, as an expression."""

    def score(df: DataFrame) -> DataFrame:
        return with_stub(df, "_text", version)

    score.inline = True
    return score


_loaded: dict = {}


def with_model(df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[tuple[int, float]]]], key: str, version: str, batch_size: int = 32, barrier: bool = False) -> DataFrame:
    """``load`` gives a function from texts to (label id, score). It runs once per worker process and ``key``."""
    own = (("label", T.StringType()), ("score", T.DoubleType()), ("label_id", T.IntegerType()), ("model_version", T.StringType()))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, k) for n, k in own]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _loaded:
            _loaded[key] = load()
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            scored = [x for k in range(0, len(texts), batch_size) for x in _loaded[key](texts[k : k + batch_size])]
            yield frame.assign(label=[LABELS[i] for i, _ in scored], score=[s for _, s in scored], label_id=[i for i, _ in scored], model_version=version)

    return df.mapInPandas(run, schema, barrier=barrier)


def transformers_model(directory: str, max_length: int = 256) -> Callable[[], Callable[[list[str]], list[tuple[int, float]]]]:
    """An optional provider; its libraries are only needed where it runs."""

    def load():
        import torch
        from transformers import AutoModelForSequenceClassification, AutoTokenizer

        tokenizer, model = AutoTokenizer.from_pretrained(directory), AutoModelForSequenceClassification.from_pretrained(directory).eval()

        def predict(texts: list[str]) -> list[tuple[int, float]]:
            with torch.no_grad():
                logits = model(**tokenizer(texts, padding=True, truncation=True, max_length=max_length, return_tensors="pt")).logits
            best = torch.softmax(logits, dim=-1).max(dim=-1)
            return list(zip(best.indices.tolist(), best.values.tolist(), strict=True))

        return predict

    return load


def score_distinct(df: DataFrame, key: str, text: Column, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Scores by key; rows without a score are neutral, 0.5. A scorer that is an expression (its ``inline`` is true) costs less than a
    join and scores each row's own text. Others, models, see each distinct key once, and the result is joined back: the text of a key is
    the smallest of its rows' texts, so that the result does not depend on their order. They read ``df`` twice: give them a written
    table."""
    if getattr(scorer, "inline", False):
        out = scorer(df.withColumn("_text", text))
        return out.withColumns({"label": F.coalesce("label", F.lit("neutral")), "score": F.when(F.col("label").isNull(), 0.5).otherwise(F.col("score"))}).drop("_text", "label_id")
    own = df.groupBy(F.col(key).alias("_key")).agg(F.min(text).alias("_text"))
    scored = scorer(own).select("_key", F.col("label").alias("_label"), F.col("score").alias("_score"), F.col("model_version").alias("_version"))
    out = df.join(scored, F.col(key) == F.col("_key"), "left")
    return out.withColumns({"label": F.coalesce("_label", F.lit("neutral")), "score": F.when(F.col("_label").isNull(), 0.5).otherwise(F.col("_score")), "model_version": F.coalesce("_version", F.lit(""))}).drop("_key", "_label", "_score", "_version")


def apply_negation(label: Column, negated: Column) -> tuple[Column, Column]:
    """The label, turned round where an opinion is negated, and whether it was."""
    flag = F.coalesce(negated, F.lit(False)) & label.isin("positive", "negative")
    turned = F.when(flag & (label == "positive"), "negative").when(flag, "positive").otherwise(label)
    return turned, flag
