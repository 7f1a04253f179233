"""Aspect detection and segments, as array expressions: one row per sentence until the segments are exploded."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.config import AspectConfig, TextConfig
from tamarack.functions.text import clauses, hash16, let, window_segment

WORD = r"[\p{L}\p{N}]"


def keyword_table(spark, cfg: AspectConfig) -> DataFrame:
    """``ord, keyword, aspect``, for joins with other tables."""
    return spark.createDataFrame([tuple(k) for k in cfg.keywords], "ord int, keyword string, aspect string")


def negated(text: Column, start: Column, cfg: AspectConfig) -> Column:
    """A negator among the last words before ``start`` (from 0)."""
    before = F.substr(text, F.lit(1), start)
    for word in cfg.protected:
        before = F.replace(before, F.lit(word), F.lit(re.sub(r"\S+", "_", word)))
    words = F.filter(F.split(F.trim(before), r"(?U)\s+"), lambda w: w != "")
    last = let(words, lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - cfg.negation_window, F.lit(0)) + 1, F.lit(cfg.negation_window)), " "))
    pattern = r"(?iU)\b(?:" + "|".join(re.escape(w) for w in sorted(cfg.negators, key=len, reverse=True)) + r")\b"
    return last.rlike(pattern)


def matches(text: Column, cfg: AspectConfig) -> Column:
    """All keyword occurrences, overlapping ones too, as ``struct(start, ord, keyword, aspect, end, negated)``, by place and
    dictionary order. A keyword starts where no letter or digit stands before; with ``strict_boundary`` it ends likewise."""
    by: dict[str, list[Column]] = {}
    for o, k, a in cfg.keywords:
        by.setdefault(k[:2], []).append(F.struct(F.lit(o).alias("ord"), F.lit(k).alias("keyword"), F.lit(a).alias("aspect"), F.lit(len(k)).alias("n")))
    # a keyword is looked up by its first two characters; those of one character, of which there are few, are tried everywhere
    short = [x for k, own in by.items() if len(k) == 1 for x in own]
    long = [y for k, own in by.items() if len(k) == 2 for y in (F.lit(k), F.array(*own))]
    return let(F.lower(text), lambda low: _matches(low, F.create_map(*long) if long else None, F.array(*short) if short else None, cfg))


def _matches(low: Column, long: Column | None, short: Column | None, cfg: AspectConfig) -> Column:
    # places after a character that is neither letter nor digit, from the lengths of what stands between these
    none = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("out"))
    begins = F.aggregate(F.split(low, r"[^\p{L}\p{N}]", -1), none, lambda acc, t: F.struct((acc["at"] + F.length(t) + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def at(i: Column) -> Column:
        """The keywords that start at ``i``."""
        own = F.element_at(long, F.substr(low, i, F.lit(2))) if long is not None else None
        if short is not None:
            own = short if own is None else F.coalesce(F.concat(short, own), short)

        def fits(k: Column) -> Column:
            ok = F.substr(low, i, k["n"]) == k["keyword"]
            return ok & ~F.substr(low, i + k["n"], F.lit(1)).rlike(WORD) if cfg.strict_boundary else ok

        return F.transform(F.filter(own, fits), lambda k: F.struct((i - 1).cast("int").alias("start"), k["ord"].alias("ord"), k["keyword"].alias("keyword"), k["aspect"].alias("aspect"), (i - 1 + k["n"]).cast("int").alias("end")))

    kind = "array<struct<start:int,ord:int,keyword:string,aspect:string,end:int>>"
    if long is None and short is None:
        return F.array().cast("array<struct<start:int,ord:int,keyword:string,aspect:string,end:int,negated:boolean>>")
    own = F.flatten(F.filter(F.transform(begins, at), lambda x: x.isNotNull())).cast(kind)
    if cfg.prefer_longest:
        own = let(own, _longest)
    return F.transform(F.array_sort(own), lambda m: F.struct(m["start"].alias("start"), m["ord"].alias("ord"), m["keyword"].alias("keyword"), m["aspect"].alias("aspect"), m["end"].alias("end"), negated(low, m["start"], cfg).alias("negated")))


def _longest(own: Column) -> Column:
    """Longer keywords first; a match that overlaps one taken before goes."""
    first = F.array_sort(F.transform(own, lambda m: F.struct((m["start"] - m["end"]).alias("size"), m["ord"].alias("ord"), m["start"].alias("start"), m.alias("m"))))
    none = F.filter(own, lambda m: F.lit(False))
    return F.aggregate(first, none, lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] < x["m"]["end"]) & (x["m"]["start"] < y["end"])), acc).otherwise(F.concat(acc, F.array(x["m"]))))


def deduplicated(found: Column) -> Column:
    """One match per aspect: the first that is not negated, else the first; by place."""
    better = lambda a, b: (a["aspect"] == b["aspect"]) & (F.struct(a["negated"], a["start"], a["ord"]) < F.struct(b["negated"], b["start"], b["ord"]))
    return let(found, lambda all_: F.filter(all_, lambda m: ~F.exists(all_, lambda o: better(o, m))))


def sentiment_modifier(negated: Column) -> Column:
    return F.when(negated, -1).otherwise(1)


def segments(text: Column, cfg: AspectConfig, text_cfg: TextConfig = TextConfig(), own_clauses: Column | None = None) -> Column:
    """Segments of a sentence, in order: ``struct(aspect, keyword, clause_idx, clause_text, segment_text, segment_type,
    char_start, char_end, keyword_start, keyword_end, negated)``."""
    parts = clauses(text, TextConfig(use_clause_split=text_cfg.use_clause_split, min_clause_len=cfg.min_clause_len, connectors=text_cfg.connectors)) if own_clauses is None else own_clauses
    none = F.array().cast("array<struct<i:int,clause:string,at:int>>")
    start = F.struct(F.lit(1).alias("pos"), none.alias("out"))

    def placed(acc: Column, x: Column) -> Column:
        clause = x["clause"]
        ahead = F.call_function("locate", clause, text, acc["pos"])
        at = F.when(ahead > 0, ahead).otherwise(F.call_function("locate", clause, text))
        return F.struct(F.when(at > 0, at + F.length(clause)).otherwise(acc["pos"]).cast("int").alias("pos"), F.concat(acc["out"], F.array(F.struct(x["i"].alias("i"), clause.alias("clause"), F.greatest(at - 1, F.lit(0)).cast("int").alias("at")))).alias("out"))

    numbered = F.filter(F.transform(parts, lambda c, i: F.struct(i.cast("int").alias("i"), F.trim(c).alias("clause"))), lambda x: F.length(x["clause"]) >= cfg.min_clause_len)
    located = F.aggregate(numbered, start, placed, lambda acc: acc["out"])
    described = F.transform(located, lambda c: F.struct(c.alias("c"), deduplicated(matches(c["clause"], cfg)).alias("m")))

    def one(d: Column, m: Column) -> Column:
        clause, at = d["c"]["clause"], d["c"]["at"]
        multi = F.size(F.array_distinct(F.transform(d["m"], lambda x: x["aspect"]))) > 1
        windowed = F.lit(cfg.strategy == "window") | (F.lit(cfg.strategy == "hybrid") & multi)
        return let(window_segment(clause, m["start"], m["end"], cfg.window_before, cfg.window_after, cfg.include_keyword), lambda w: let(windowed, lambda v: built(d["c"]["i"], clause, at, m, w, v)))

    def built(i: Column, clause: Column, at: Column, m: Column, w: Column, windowed: Column) -> Column:
        seg = F.when(windowed, w["text"]).otherwise(clause)
        short = F.length(F.trim(seg)) < cfg.min_segment_len
        return F.struct(
            m["aspect"].alias("aspect"), m["keyword"].alias("keyword"), i.alias("clause_idx"), clause.alias("clause_text"),
            F.when(short, clause).otherwise(seg).alias("segment_text"), F.when(short, "fallback").when(windowed, "window").otherwise("clause").alias("segment_type"),
            (at + F.when(windowed, w["start"]).otherwise(m["start"])).cast("int").alias("char_start"), (at + F.when(windowed, w["end"]).otherwise(m["end"])).cast("int").alias("char_end"),
            (at + m["start"]).cast("int").alias("keyword_start"), (at + m["end"]).cast("int").alias("keyword_end"), m["negated"].alias("negated"),
        )

    def other(d: Column) -> Column:
        clause, at, no = d["c"]["clause"], d["c"]["at"], F.lit(None).cast("int")
        return F.struct(
            F.lit("other").alias("aspect"), F.lit("").alias("keyword"), d["c"]["i"].alias("clause_idx"), clause.alias("clause_text"), clause.alias("segment_text"), F.lit("fallback").alias("segment_type"),
            at.alias("char_start"), (at + F.length(clause)).cast("int").alias("char_end"), no.alias("keyword_start"), no.alias("keyword_end"), F.lit(False).alias("negated"),
        )

    fallback = lambda d: F.array(other(d)) if cfg.keep_unmatched else F.filter(F.array(other(d)), lambda x: F.lit(False))
    own = F.flatten(F.transform(described, lambda d: F.when(F.size(d["m"]) > 0, F.transform(d["m"], lambda m: one(d, m))).otherwise(fallback(d))))
    if cfg.max_per_sentence > 0:
        own = F.slice(own, 1, cfg.max_per_sentence)
    if cfg.dedupe_by_hash:
        key = lambda s: F.struct(s["aspect"], s["segment_text"])
        own = let(own, lambda a: let(F.transform(a, key), lambda keys: F.filter(a, lambda s, i: F.array_position(keys, key(s)) == i + 1)))
    return own


def s6_rows(s2: DataFrame, cfg: AspectConfig, text_cfg: TextConfig = TextConfig()) -> DataFrame:
    """S2 rows by their segments; an empty result where aspects are switched off."""
    cols = [F.col(c) for c in s2.columns]
    out = s2.filter(F.lit(cfg.enabled)).select(*cols, F.posexplode(segments(F.col("sentence_text"), cfg, text_cfg)).alias("segment_idx", "seg"))
    seg = lambda n: F.col(f"seg.{n}")
    return out.select(
        *cols, "segment_idx", seg("aspect").alias("aspect"), seg("keyword").alias("aspect_keyword"), seg("negated").alias("aspect_negated"),
        seg("clause_idx").alias("clause_idx"), seg("clause_text").alias("clause_text"), seg("segment_text").alias("segment_text"), hash16(seg("segment_text")).alias("segment_hash"),
        seg("segment_type").alias("segment_type"), seg("char_start").alias("aspect_char_start"), seg("char_end").alias("aspect_char_end"),
        seg("keyword_start").alias("keyword_start"), seg("keyword_end").alias("keyword_end"), F.lit(False).alias("negation_applied"),
    )
