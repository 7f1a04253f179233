"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib.util

from tamarack.llm.common import table


def _vocab(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf_dir):
    from tamarack.llm import quality_rules

    return quality_rules.query(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    from tamarack.llm import substring_dedup

    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    from tamarack.llm import simhash

    return simhash.grouped(table(spark, sf_dir, "documents"))


def op4_html_extract(spark, sf_dir):
    from tamarack.llm import html_extract

    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op5_url_filters(spark, sf_dir):
    from tamarack.llm import url_filters

    return url_filters.judged(table(spark, sf_dir, "pages"))


def op6_sharding(spark, sf_dir):
    from tamarack.llm import sharding

    return sharding.sharded(table(spark, sf_dir, "documents"))


def op7_token_output(spark, sf_dir):
    from tamarack.llm import token_output

    return token_output.digests(table(spark, sf_dir, "documents"), _vocab("word_bpe_49k.json"))


def op8_suffix_dedup(spark, sf_dir):
    from tamarack.llm import suffix_dedup

    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op9_bpe(spark, sf_dir):
    from tamarack.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), _vocab("byte_bpe_50k.json"))


def op10_decontaminate(spark, sf_dir):
    from tamarack.llm import decontaminate

    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark, sf_dir):
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict:
    own = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    if importlib.util.find_spec("corpus_pipeline"):
        own["pipeline"] = pipeline
    return own


def oracle_sql() -> dict[str, str]:
    from tamarack.llm import quality_rules, url_filters

    return {"op1_quality_rules": quality_rules.oracle(), "op5_url_filters": url_filters.oracle()}
