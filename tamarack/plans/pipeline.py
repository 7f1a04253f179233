"""Stages S1 to S7 as table functions, and their composition in one session."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.config import PipelineConfig, provider_of
from tamarack.functions.text import hash16, normalize, sentences
from tamarack.operators import absa, aspects, metrics, quality, scoring
from tamarack.schemas import fields
from tamarack.sources import adapters, readers, sinks

STAGES = ("s1", "s2", "s3", "s4", "s5", "s6", "s7")


def now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def s1(comments: DataFrame, run_id: str, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Comments with their normalized text; those without any go."""
    some = comments.orderBy("comment_id").limit(cfg.limit) if cfg.limit else comments
    df = some.withColumn("normalized_text", normalize(F.col("raw_text"), cfg.text)).filter(F.length("normalized_text") > 0)
    return df.withColumns({"run_id": F.lit(run_id), "processed_at": now()}).select(*fields("s1_comments"))


def s2(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Sentences, once in each comment: the first stays, ids keep their gaps. No shuffle: the comment's array is reduced in place."""
    df = rows.withColumn("_s", sentences(F.col("normalized_text"), cfg.text))
    numbered = F.transform("_s", lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    first = F.filter(numbered, lambda s: F.array_position(F.col("_s"), s["x"]) == s["i"] + 1)
    df = df.select("*", F.explode(first).alias("_e")).withColumns({"sentence_idx": F.col("_e.i").cast("int"), "sentence_text": F.col("_e.x")})
    df = df.withColumns({"sentence_id": F.concat("comment_id", F.lit("_s"), F.col("sentence_idx").cast("string")), "sentence_hash": hash16(F.col("sentence_text"))})
    return df.select(*fields("s2_sentences"))


def s3(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Scores of sentences; with a limit, of the first ones by id."""
    rows = rows.orderBy("sentence_id").limit(cfg.limit) if cfg.limit else rows
    if provider_of(cfg) == "stub":
        return scoring.with_stub(rows, "sentence_text", cfg.model_version).select(*fields("s3_predictions"))
    load = scoring.transformers_model(cfg.model_dir, cfg.max_length)
    return scoring.with_model(rows, "sentence_text", load, f"{cfg.provider}:{cfg.model_dir}", cfg.model_version, cfg.batch_size).select(*fields("s3_predictions"))


def s4(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> tuple[DataFrame, DataFrame]:
    return quality.split(rows, cfg.quality, pin=True)


def s6(rows: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    return aspects.s6_rows(rows, cfg.aspects, cfg.text)


def _scorer(cfg: PipelineConfig) -> Callable[[DataFrame], DataFrame]:
    if provider_of(cfg) == "stub":
        return scoring.stub_scorer(cfg.model_version)
    load = scoring.transformers_model(cfg.model_dir, cfg.max_length)
    return lambda df: scoring.with_model(df, "_text", load, f"{cfg.provider}:{cfg.model_dir}", cfg.model_version, cfg.batch_size)


def s7(rows: DataFrame, run_id: str, cfg: PipelineConfig = PipelineConfig(), created_at: Column | None = None) -> DataFrame:
    return absa.s7_rows(absa.assembled(rows, cfg.aspects.granularity, _scorer(cfg), cfg.text), run_id, created_at)


def one_row(df: DataFrame) -> dict:
    return df.first().asDict()


def run(spark: SparkSession, source: str, run_id: str, cfg: PipelineConfig = PipelineConfig(), comments: DataFrame | None = None, first: str = "s1", last: str = "s7") -> dict:
    """Runs a range of stages; each reads what the one before wrote, for this run only. Stops at the first failure. Returns and writes
    the summary."""
    root, wanted = cfg.output_root, STAGES[STAGES.index(first) : STAGES.index(last) + 1]
    got = lambda stage: sinks.read_stage(spark, root, stage, run_id, source)
    summary: dict = {"run_id": run_id, "source": source, "status": "ok", "jobs": []}

    def do(stage: str) -> dict:
        if stage == "s1":
            raw = comments if comments is not None else adapters.comments(readers.raw_comments(spark, cfg.raw_root, source, _raw_schema(source)), source)
            sinks.write_stage(s1(raw, run_id, cfg), root, "s1_comments")
            return {"rows_out": got("s1_comments").count()}
        if stage == "s2":
            sinks.write_stage(s2(got("s1_comments"), cfg), root, "s2_sentences")
            return {"rows_out": got("s2_sentences").count()}
        if stage == "s3":
            sinks.write_stage(s3(got("s2_sentences"), cfg), root, "s3_predictions", ("source", "run_id", "model_version"))
            return {"rows_out": got("s3_predictions").count()}
        if stage == "s4":
            good, bad = s4(got("s3_predictions"), cfg)
            sinks.write_stage(good, root, "s4_final")
            sinks.write_stage(bad.withColumn("stage", F.lit("s4")), root, "quarantine", ("source", "run_id", "stage"))
            return {"rows_out": got("s4_final").count()}
        if stage == "s5":
            judged = quality.judged(got("s3_predictions"), cfg.quality)
            report = one_row(metrics.compute(judged)) | {"reasons": {r["reason"]: r["n"] for r in metrics.reason_histogram(judged).collect()}, "consistency": one_row(metrics.label_consistency(got("s4_final")))}
            report["warnings"] = quality.warnings({k: report[f"{k}_share"] for k in cfg.quality.labels}, set(), 0, cfg=cfg.quality)
            sinks.write_report(spark, root, run_id, report)
            return {"rows_out": report["valid"], "metrics": report}
        if stage == "s6":
            if not cfg.aspects.enabled:
                return {"status": "skipped", "rows_out": 0}
            sinks.write_stage(s6(got("s2_sentences"), cfg), root, "s6_aspects")
            return {"rows_out": got("s6_aspects").count()}
        if not cfg.aspects.enabled:
            return {"status": "skipped", "rows_out": 0}
        good, bad = quality.split(s7(got("s6_aspects"), run_id, cfg), cfg.quality, absa=True, pin=True)
        sinks.write_stage(good, root, "s7_absa")
        sinks.write_stage(bad.withColumn("stage", F.lit("s7")), root, "quarantine_absa", ("source", "run_id", "stage"))
        sinks.publish(absa.ml_rows(got("s7_absa")), f"{root}/ml_absa")
        report = one_row(metrics.absa_summary(got("s7_absa"), got("s2_sentences").count()))
        report["warnings"] = quality.warnings(*one_row(metrics.warning_inputs(got("s7_absa"))).values(), coverage=report["aspect_coverage"], cfg=cfg.quality)
        sinks.write_report(spark, root, run_id, report, absa=True)
        return {"rows_out": report["total"], "metrics": report}

    for stage in wanted:
        began = datetime.now(UTC)
        try:
            result = {"job": stage, "status": "ok"} | do(stage)
        except Exception as e:
            result = {"job": stage, "status": "error", "error": str(e)[:500], "rows_out": 0}
        ended = datetime.now(UTC)
        sinks.log_run(spark, root, run_id, stage, result["status"], 0, result["rows_out"], began.replace(tzinfo=None), ended.replace(tzinfo=None), {"source": source}, result.get("metrics"), result.get("error", ""))
        summary["jobs"].append(result | {"seconds": round((ended - began).total_seconds(), 2)})
        if result["status"] == "error":
            summary["status"] = "error"
            break
    summary["config"] = {k: v for k, v in asdict(cfg).items() if k not in ("aspects",)}
    sinks.write_text(spark, f"{root.rstrip('/')}/reports/{run_id}_summary.json", json.dumps(summary, ensure_ascii=False, indent=2, default=str))
    return summary


def _raw_schema(source: str):
    from tamarack import schemas

    return {"tripadvisor": schemas.TRIPADVISOR_RAW, "tiktok": schemas.TIKTOK_RAW}[source]


def bootstrap(spark: SparkSession, directory: str, download: Callable[[str], None] | None = None) -> dict:
    """Makes sure that a model directory is there: exists, downloaded, or skipped where nothing can download."""
    if directory and readers.exists(spark, directory):
        return {"status": "exists", "path": directory}
    if download is None:
        return {"status": "skipped", "path": directory}
    download(directory)
    sinks.write_text(spark, f"{directory}/registry.json", f'{{"path": "{directory}"}}')
    return {"status": "downloaded", "path": directory}
