"""Quality rules with adaptive thresholds, DataFrame functions only.

Each document gets a few counts and, from them, integer metrics. Per language and source a mergeable quantile sketch
holds the metrics: counts by bucket, where buckets are exact below 1,024 and keep the ten leading bits above, so the
relative error is under 0.1 % and a sketch has a bounded number of buckets; two sketches merge by adding counts. Groups
with fewer than ``min_group`` documents use the merged sketch of their language, then that of the corpus. Upper limits
are ``q3 + spread * max(q3 - q1, least)``, where ``least`` is a metric's least spread: a group whose middle half is all alike, as
with counts that are mostly zero, is not taken to have no spread at all. The limits are then joined to the documents and filter them.

Null texts have no words and fail the base rule; null languages or sources are groups of their own. Repeated rows are
judged one by one and alike; a document at its limit stays. Texts are read whole, very long ones in one row's memory. An empty table
gives an empty result; extra columns, whatever their names, are ignored (``scored`` and ``filtered`` keep them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamarack.llm.common import WS, staged

#: metric -> least spread between its quartiles, in its own unit (thousandths; hundredths for the word length).
SPREADS = {"symbols": 10, "dup_lines": 60, "repeats": 50, "word_length": 20, "upper": 5}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    spread: int = 6
    min_group: int = 200
    min_words: int = 50
    max_repeat_pct: int = 50
    spreads: tuple = tuple(SPREADS.items())


def _per(a: Column, b: Column, unit: int) -> Column:
    return F.when(b > 0, F.floor(a * unit / b)).otherwise(0).cast("long")


def scored(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``_q`` of counts and metrics.

    The words of a repeated three-word window are counted on the sorted list of window hashes with their places: equal
    neighbours mark the places, and each place adds the words that the place before has not covered. Documents without
    an equal pair skip the sort.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.withColumn("__tk_t", F.btrim(text, F.lit(WS)))
    step = step.withColumn("__tk_w", F.when(F.col("__tk_t") == "", F.array().cast("array<string>")).otherwise(F.split("__tk_t", "[ \\x09-\\x0D]+")))
    step = step.withColumn("__tk_n", F.size("__tk_w").cast("long"))
    w = F.col("__tk_w")
    step = step.withColumn("__tk_h", F.when(F.col("__tk_n") > 2, F.transform(F.slice(w, 3, F.greatest(F.col("__tk_n").cast("int") - 2, F.lit(1))), lambda x, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), x))).otherwise(F.array().cast("array<bigint>")))
    h = F.col("__tk_h")
    step = step.withColumn("__tk_s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__tk_s")
    step = step.withColumn("__tk_p", F.array_sort(F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["i"])))
    none = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
    repeats = F.aggregate("__tk_p", none, lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")), lambda a: a["n"])
    step = step.withColumn("__tk_l", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]")))
    chars = F.length(F.translate("__tk_t", WS, ""))
    upper = F.length("__tk_t") - F.length(F.translate("__tk_t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    step = step.withColumn("__tk_c", F.struct(
        F.col("__tk_n").alias("n_words"), chars.cast("long").alias("word_chars"),
        (F.length("__tk_t") - F.length(F.translate("__tk_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__tk_l") - F.size(F.array_distinct("__tk_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__tk_l").cast("long").alias("n_lines"), upper.cast("long").alias("n_upper"),
    ))
    c = F.col("__tk_c")
    q = F.struct(
        *[c[k].alias(k) for k in BASE],
        _per(c["n_symbols"], c["word_chars"], 1000).alias("symbols"), _per(c["n_dup_lines"], c["n_lines"], 1000).alias("dup_lines"),
        _per(c["n_repeat_words"], c["n_words"], 1000).alias("repeats"), _per(c["word_chars"], c["n_words"], 100).alias("word_length"),
        _per(c["n_upper"], c["word_chars"], 1000).alias("upper"),
    )
    return step.select(*[F.col(x) for x in docs.columns], q.alias("__tk_q"))


def bucket(v: Column) -> Column:
    """Exact below 1,024; above, the ten leading bits."""
    return v - F.pmod(v, F.pow(F.lit(2.0), F.greatest(F.length(F.bin(v)) - 10, F.lit(0))).cast("long"))


def limits(rows: DataFrame, rules: Rules) -> DataFrame:
    """``lang, source`` and the upper limit of each metric, from the sketches of all rows."""
    spreads = dict(rules.spreads)
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"__tk_q.{m}").alias("v")) for m in spreads]))
    sketch = rows.select("lang", "source", pairs.alias("x")).groupBy("lang", "source", F.col("x.metric").alias("metric"), bucket(F.col("x.v")).alias("b")).agg(F.count("*").alias("n"))
    sketch = staged(sketch, "quality-sketch")
    by_lang = sketch.groupBy("lang", "metric", "b").agg(F.sum("n").alias("n"))
    whole = by_lang.groupBy("metric", "b").agg(F.sum("n").alias("n"))

    def quartiles(of: DataFrame, *keys: str) -> DataFrame:
        below = W.partitionBy(*keys, "metric").orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
        ranked = of.withColumn("below", F.sum("n").over(below)).withColumn("all", F.sum("n").over(W.partitionBy(*keys, "metric")))
        at = lambda k: F.min(F.when(F.col("below") * 4 >= F.col("all") * k, F.col("b")))
        return ranked.groupBy(*keys, "metric").agg(F.max("all").alias("size"), at(1).alias("q1"), at(3).alias("q3"))

    own, lang, top = quartiles(sketch, "lang", "source"), quartiles(by_lang, "lang"), quartiles(whole)
    big = F.col("size") >= rules.min_group
    l2 = lang.select(F.col("lang").alias("_lang"), F.col("metric").alias("_m"), *[F.when(big, F.col(k)).alias(f"l_{k}") for k in ("q1", "q3")])
    t2 = top.select(F.col("metric").alias("_tm"), F.col("q1").alias("t_q1"), F.col("q3").alias("t_q3"))
    joined = own.join(l2, own["lang"].eqNullSafe(l2["_lang"]) & (own["metric"] == l2["_m"]), "left").join(t2, F.col("metric") == F.col("_tm"), "left")
    q = {k: F.coalesce(F.when(big, F.col(k)), F.col(f"l_{k}"), F.col(f"t_{k}")) for k in ("q1", "q3")}
    least = F.element_at(F.create_map(*[x for m, f in spreads.items() for x in (F.lit(m), F.lit(f))]), F.col("metric"))
    upper = (q["q3"] + rules.spread * F.greatest(q["q3"] - q["q1"], least)).cast("long")
    return joined.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == m, upper)).alias(f"max_{m}") for m in spreads])


def judged(rows: DataFrame, rules: Rules = Rules(), prefix: str = "") -> DataFrame:
    """Scored rows (a written table: they are read twice) with ``base_failed`` and ``kept``."""
    of = limits(rows, rules)
    of = of.select(F.col("lang").alias("__tk_jl"), F.col("source").alias("__tk_js"), *[F.col(f"max_{m}").alias(f"__tk_max_{m}") for m, _ in rules.spreads])
    out = rows.join(of, F.col("lang").eqNullSafe(F.col("__tk_jl")) & F.col("source").eqNullSafe(F.col("__tk_js")), "left")
    q = lambda k: F.col(f"__tk_q.{k}")
    base = (q("n_words") < rules.min_words) | (100 * q("n_repeat_words") > rules.max_repeat_pct * q("n_words"))
    over = [F.coalesce(q(m) > F.col(f"__tk_max_{m}"), F.lit(False)) for m, _ in rules.spreads]
    bad = base
    for x in over:
        bad = bad | x
    reasons = F.filter(F.array(*[F.when(x, F.lit(m)) for x, (m, _) in zip(over, rules.spreads, strict=True)]), lambda x: x.isNotNull())
    return out.withColumns({f"{prefix}base_failed": base, f"{prefix}kept": ~bad, f"{prefix}reasons": reasons}).drop("__tk_jl", "__tk_js", *[f"__tk_max_{m}" for m, _ in rules.spreads])


def query(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: the base counts and the verdict."""
    rows = staged(scored(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-scores")
    return judged(rows, rules).select("doc_id", *[F.col(f"__tk_q.{k}").alias(k) for k in BASE], "base_failed", "kept", *[F.col(f"__tk_q.{m}").alias(m) for m, _ in rules.spreads])


def filtered(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, columns unchanged."""
    rows = staged(scored(docs), "quality-scored")
    return judged(rows, rules, "__tk_").filter("__tk_kept").select(*[F.col(c) for c in docs.columns])


def oracle(rules: Rules = Rules()) -> str:
    """The same in DuckDB's SQL."""
    spreads = dict(rules.spreads)
    ms = list(spreads)
    ws = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS x, trim(coalesce(text, ''), {ws}) AS t FROM documents),
w AS (SELECT *, row_number() OVER () AS k, CASE WHEN t = '' THEN [] ELSE regexp_split_to_array(t, '[ \\x09-\\x0D]+') END AS w FROM t),
g AS (SELECT k, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
d AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM g) WHERE n > 1),
r AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY k),
l AS (SELECT k, list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^ \\x09-\\x0D]')) AS l FROM w),
c AS (SELECT w.k, doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(t, {ws}, ''))::BIGINT AS word_chars,
 (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
 coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper
 FROM w LEFT JOIN r USING (k) LEFT JOIN l USING (k)),
q AS (SELECT *, CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols, CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
 CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats, CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length,
 CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper FROM c),
m AS ({' UNION ALL '.join(f"SELECT lang, source, '{m}' AS metric, {m} AS v FROM q" for m in ms)}),
s AS (SELECT lang, source, metric, v - v % (1::BIGINT << greatest(length(bin(v)) - 10, 0)) AS b, count(*) AS n FROM m GROUP BY ALL),
s2 AS (SELECT lang, metric, b, sum(n) AS n FROM s GROUP BY ALL), s3 AS (SELECT metric, b, sum(n) AS n FROM s2 GROUP BY ALL),
{', '.join(f"q{k} AS (SELECT {keys} metric, max(a) AS size, min(b) FILTER (4 * below >= a) AS q1, min(b) FILTER (4 * below >= 3 * a) AS q3 FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} metric ORDER BY b ROWS UNBOUNDED PRECEDING) AS below, sum(n) OVER (PARTITION BY {keys} metric) AS a FROM {of}) GROUP BY ALL)" for k, keys, of in ((1, 'lang, source,', 's'), (2, 'lang,', 's2'), (3, '', 's3')))},
z AS (SELECT q1.lang, q1.source, q1.metric,
 CASE WHEN q1.size >= {rules.min_group} THEN q1.q1 WHEN q2.size >= {rules.min_group} THEN q2.q1 ELSE q3.q1 END AS lo,
 CASE WHEN q1.size >= {rules.min_group} THEN q1.q3 WHEN q2.size >= {rules.min_group} THEN q2.q3 ELSE q3.q3 END AS hi
 FROM q1 JOIN q2 ON q1.lang IS NOT DISTINCT FROM q2.lang AND q1.metric = q2.metric JOIN q3 ON q1.metric = q3.metric),
u AS (SELECT lang, source, {', '.join(f"max(CASE WHEN metric = '{m}' THEN hi + {rules.spread} * greatest(hi - lo, {f}) END) AS max_{m}" for m, f in spreads.items())} FROM z GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT (base_failed OR {' OR '.join(f'{m} > max_{m}' for m in ms)}) AS kept, {', '.join(f'{m}::BIGINT AS {m}' for m in ms)}
FROM (SELECT q.*, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words AS base_failed, {', '.join(f'max_{m}' for m in ms)}
 FROM q JOIN u ON q.lang IS NOT DISTINCT FROM u.lang AND q.source IS NOT DISTINCT FROM u.source)"""
