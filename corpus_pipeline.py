"""A training corpus in five stages: quality rules, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage works on all that the one before kept. ``run`` writes every stage's rows to the shared folder and reads them
again, so a lost executor never repeats an earlier stage. Near duplicates are texts whose sets of
five-word shingles have a Jaccard similarity of 0.8 or more; the SimHash query keeps its own rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamarack.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from tamarack.llm.common import dropped, staged, table
from tamarack.llm.repeats import Words


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filtered(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a Jaccard similarity of 0.8 or more."""
    return simhash.deduplicated(docs, words=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words and more that occur elsewhere too."""
    return suffix_dedup.deduplicated(docs, suffix_dedup.PASSAGE, Words)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of these and of the decoded texts."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", tokenize),
]

#: SQL cannot express these stages on whole tables; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the tables of the stages before it are deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return docs
