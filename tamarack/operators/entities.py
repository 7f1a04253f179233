"""Entity resolution: names, fuzzy mapping within blocks, typing, de-duplication by explicit order."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.config import NAME_PREFIXES
from tamarack.functions.text import strip_accents
from tamarack.operators import names
from tamarack.session import pinned


def first_by(df: DataFrame, keys: list[Column | str], *order: Column | str) -> DataFrame:
    """The first row of each key in an explicit order."""
    own = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*own).orderBy(*order))).filter("_n = 1").drop("_n")


def top_by(df: DataFrame, keys: list[str], most: int, *order: Column | str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")


def normalize_name(c: Column, prefixes: tuple[str, ...] = NAME_PREFIXES) -> Column:
    """Lower case; each listed prefix goes, in turn, so several can."""
    out = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    for p in prefixes:
        out = F.trim(F.regexp_replace(out, "^" + re.escape(p), ""))
    return out


def token_sort(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")), " ")


def _lcs(a: str | None, b: str | None) -> int:
    """Longest common subsequence by bit-parallel rows."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for k, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        if m := where.get(ch):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def lcs_length(a: Column, b: Column) -> Column:
    """Spark has no such function. Nested array aggregates can build the table of cells; bit-parallel rows, by Arrow batches, need no
    table."""

    @F.pandas_udf("int")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_lcs(p, q) for p, q in zip(x, y, strict=True)], dtype="int32")

    return run(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """100 times twice the longest common subsequence of the sorted words, by the length of both; two empty names are equal."""
    x, y = token_sort(a), token_sort(b)
    n = F.length(x) + F.length(y)
    return F.when(n == 0, 100.0).otherwise(F.round(200.0 * lcs_length(x, y) / n, 6))


def best_matches(left: DataFrame, right: DataFrame, threshold: float = 60.0, prefixes: tuple[str, ...] = NAME_PREFIXES) -> DataFrame:
    """Each left row with its best right row of the same province, or nulls and 0. Both have ``ord, name, province``; right also
    ``source_url``. Among equal scores the first by ``ord`` wins. Distinct names are compared within a province, see ``names``."""
    key = token_sort(normalize_name(F.col("name"), prefixes))
    a = left.filter("province IS NOT NULL").select("province", key.alias("_a")).distinct()
    b = right.filter("province IS NOT NULL").withColumn("_b", key).groupBy("province", "_b").agg(F.min(F.struct("ord", "name", "source_url")).alias("_first"))
    pairs = names.closest(a, b.select("province", "_b", "_first.ord"), threshold).join(b, ["province", "_b"])
    n = F.length("_a") + F.length("_b")
    pairs = pairs.withColumn("match_score", F.when(n == 0, 100.0).when(F.col("_a") == F.col("_b"), 100.0).otherwise(F.round(200.0 * F.col("lcs") / n, 6)))
    best = pairs.filter((F.col("match_score") >= threshold) & (F.col("match_score") > 0)).groupBy(F.col("province").alias("_p"), F.col("_a").alias("_k")).agg(F.min(F.struct(-F.col("match_score"), "_first.ord", "_first")).alias("m"))
    out = left.withColumn("_a", key).join(best, (F.col("province") == F.col("_p")) & (F.col("_a") == F.col("_k")), "left").withColumn("name_vn", F.col("name"))
    return out.withColumns({"name_en": F.col("m._first.name"), "source_url_en": F.col("m._first.source_url"), "match_score": F.coalesce(-F.col("m.col1"), F.lit(0.0))}).drop("m", "_p", "_k", "_a")


def match_stats(mapped: DataFrame) -> DataFrame:
    return mapped.agg(F.count("*").alias("total"), F.count_if(F.col("name_en").isNotNull()).alias("matched"), F.count_if(F.col("name_en").isNull()).alias("unmatched"))


#: Types by a word in the text, in order of preference; case counts.
ENTITY_WORDS = (("PROVINCE", "province", " จังหวัด"), ("DISTRICT", "district", " เขต"), ("DESTINATION", "destination", " ที่ไป"), ("HOTEL", "hotel", " โรงแรม"), ("RESTAURANT", "restaurant", " ร้านอาหาร"), ("BEACH", "beach", " ชายหาด"), ("MUSEUM", "museum", " พิพิธภัณฑ์"))


def entity_type(c: Column, words=ENTITY_WORDS) -> Column:
    out = F.lit("OTHER")
    for kind, *own in reversed(words):
        hit = F.lit(False)
        for w in own:
            hit = hit | c.contains(w)
        out = F.when(hit, kind).otherwise(out)
    return out


def masked(c: Column) -> Column:
    return F.regexp_replace(c, "([A-Z][a-z]+ [A-Z][a-z]+)", "<ENTITY>")


def mentions(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("([A-Z][a-z]+ [A-Z][a-z]+)"), F.lit(1))


def entities(posts: DataFrame) -> DataFrame:
    """The entity table of social posts: one row for each name and type, the one with the smallest record id."""
    name = F.regexp_replace(F.trim("raw_text"), r"\s+", " ")
    rows = posts.select("record_id", name.alias("entity_name"), entity_type(F.col("raw_text")).alias("entity_type"), "province", "specific_place", F.lit("tourism").alias("source"), F.lit(1.0).alias("confidence"), "collected_at")
    return first_by(rows, ["entity_name", "entity_type"], "record_id")


def candidates(df: DataFrame) -> DataFrame:
    """The first candidate of each province and name, by ``ord``."""
    return first_by(df, [F.coalesce("province", F.lit("")), F.trim(F.lower(F.coalesce("name", F.lit(""))))], "ord")


def combined(df: DataFrame) -> DataFrame:
    """Candidates of all files once each, sorted by province and name and numbered from 1; blank names go."""
    rows = df.filter(F.trim(F.coalesce("name", F.lit(""))) != "")
    one = first_by(rows, [F.lower("name"), F.lower(F.coalesce("province", F.lit("")))], "ord")
    return numbered(one, F.lower("province"), F.lower("name"), name="stt")


def numbered(df: DataFrame, *order: Column | str, name: str = "n") -> DataFrame:
    """Rows numbered from 1 in a total order, without one task for all: sorted ranges are counted, then numbered apart."""
    rows = pinned(df.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    sizes = rows.groupBy("_p").agg(F.count("*").alias("_size"))
    start = sizes.select(F.col("_p").alias("_q"), (F.sum("_size").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_size")).alias("_before"))  # a row for each range
    at = F.col("_i").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(start), F.col("_p") == F.col("_q")).withColumn(name, (at + 1 + F.col("_before")).cast("long")).drop("_p", "_q", "_i", "_size", "_before")


def upserted(old: DataFrame, new: DataFrame, key: str = "source_url") -> DataFrame:
    """Old and new records (both with ``ord``) by address without its fragment: the last record at the place of the first, numbered
    anew from 1."""
    from tamarack.functions.parse import norm_url

    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True).withColumn("_key", norm_url(F.col(key)))
    fields = [c for c in both.columns if c not in ("_side", "_key", "ord", "record_id")]
    one = both.groupBy("_key").agg(F.min(F.struct("_side", "ord")).alias("_first"), F.max_by(F.struct(*fields), F.struct("_side", "ord")).alias("r"))
    return numbered(one.select("_first", "r.*"), "_first", name="record_id").drop("_first")


def provinces_wanted(df: DataFrame, wanted: list[str], most: int = 0) -> DataFrame:
    """Rows ``ord, name, slug`` whose name or slug is wanted, whatever the accents and case; with ``most``, the first by ``ord``."""
    out = df
    if wanted:
        plain = strip_accents
        names = [F.replace(F.lit(w), F.lit("-"), F.lit(" ")) for w in wanted]
        keys = F.array(*[plain(n) for n in names])
        out = df.filter(F.array_contains(keys, plain(F.col("name"))) | F.array_contains(keys, plain(F.replace("slug", F.lit("-"), F.lit(" ")))))
    return out.orderBy("ord").limit(most) if most else out


def registry(mapped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows ``ord, name, name_vn, entity_type, province, source, source_entity_id``: the entities (id, canonical name, type,
    province: the first of each id by ``ord``), and the ids that sources give them, once each. Rows without a source map nothing."""
    from tamarack.functions.parse import entity_id

    name = F.coalesce(F.nullif("name_vn", F.lit("")), "name")
    rows = mapped.withColumns({"canonical_name": name, "entity_id": entity_id(name, F.coalesce("province", F.lit("")))})
    one = first_by(rows, ["entity_id"], "ord").select("entity_id", "canonical_name", "entity_type", "province")
    sources = rows.filter(F.coalesce("source", F.lit("")) != "").select("entity_id", "source", F.coalesce("source_entity_id", F.lit("")).alias("source_entity_id")).distinct()
    return one, sources


def kept_records(df: DataFrame, required: list[str], key: str = "source_url", order: str = "ord") -> DataFrame:
    """What a resumed run keeps of an earlier result: records with all required fields and a key, the first of each key."""
    ok = F.coalesce(F.col(key), F.lit("")) != ""
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return first_by(df.filter(ok), [key], order)


def capped_comments(df: DataFrame, videos: int = 3, each: int = 10) -> DataFrame:
    """Comments ``keyword, video_id, ord, author, text``, each once by author and text within its video: the first ``each`` of the first
    ``videos`` videos of a keyword, by ``ord``."""
    from tamarack.functions.parse import md5_id

    named = df.withColumn("comment_id", md5_id(F.col("author"), F.col("text")))
    first = named.groupBy("keyword", "video_id").agg(F.min("ord").alias("_first"))
    own = top_by(first, ["keyword"], videos, "_first", "video_id").select(F.col("keyword").alias("_k"), F.col("video_id").alias("_v"))
    one = first_by(named, ["keyword", "video_id", "comment_id"], "ord")
    rows = one.join(own, F.col("keyword").eqNullSafe(F.col("_k")) & F.col("video_id").eqNullSafe(F.col("_v")), "left_semi")
    return top_by(rows, ["keyword", "video_id"], each, "ord", "comment_id")


def unseen(wanted: DataFrame, have: DataFrame, keys: list[str], retry_partial: bool = False) -> DataFrame:
    """Rows that still have to be collected: not there, or there with another status than ok if partial ones are retried."""
    done = have.filter(F.col("status") == "ok") if retry_partial else have
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def between_marks(df: DataFrame, order: str, start: Column, stop: Column) -> DataFrame:
    """Rows from the first that ``start`` holds for up to, without it, the first later one that ``stop`` holds for. The two places are
    found by aggregation; no row waits for another."""
    first = df.agg(F.min(F.when(start, F.col(order))).alias("_from"))
    marks = df.filter(stop).join(F.broadcast(first)).agg(F.min("_from").alias("_from"), F.min(F.when(F.col(order) > F.col("_from"), F.col(order))).alias("_to"))
    ends = first.join(marks.select("_to"))
    return df.join(F.broadcast(ends)).filter((F.col(order) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(order) < F.col("_to")))).drop("_from", "_to")
