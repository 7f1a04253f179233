"""All queries of the library by name, and their SQL. Each runs over its whole tables.

The driver's tables stand in for collected data: documents for comments, conversations for nested comments, labels for
ratings, parts and suppliers for entities. Word lists are parameters; here they are common words of the test languages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.config import AspectConfig, PipelineConfig, QualityConfig, TextConfig, dictionary
from tamarack.functions import parse, text
from tamarack.operators import absa, aspects, gold, metrics, quality, scoring
from tamarack.plans import pipeline
from tamarack.session import spread

TEXT = TextConfig(nfc=False, connectors=("and", "und", "et", "y", "que", ";", ":"))
KEYWORDS = {"food": ("the", "of", "er"), "service": ("and", "was", "la"), "price": ("for", "que", "der"), "location": ("to", "in", "die")}
NEGATORS = ("no", "not", "on", "en", "un", "pas")
ASPECTS = AspectConfig(keywords=tuple(dictionary(KEYWORDS)), negators=NEGATORS, strategy="hybrid", window_before=2, window_after=2)
QUALITY = QualityConfig(max_len=120)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _counted(sql: str) -> str:
    """DuckDB's ``count_if`` gives 128-bit numbers; ``count`` of a case gives longs."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(CASE WHEN {sql[at + 9 : end - 1]} THEN 1 END){sql[end:]}"
    return sql


def query(sql: str | None = None):
    def keep(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = _counted(sql)
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"))
    ratings = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_d"), F.when(F.col("toxic") == 1, 1.0).when(F.col("quality") == 1, 5.0).otherwise(3.0).alias("rating"))
    rows = d.join(ratings, d["doc_id"] == ratings["_d"], "left")
    return rows.select("source", F.col("doc_id").cast("string").alias("comment_id"), F.col("lang").alias("place_id"), F.col("lang").alias("place_name"), F.col("text").alias("raw_text"), "rating", F.lit("").alias("collected_at"), F.to_json(F.struct("lang")).alias("meta"))


CFG = PipelineConfig(text=TEXT, aspects=ASPECTS, quality=QUALITY)


def s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.s2(pipeline.s1(comments(spark, sf_dir), "r1", CFG), CFG)


def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.s3(s2(spark, sf_dir), CFG)


def s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.s6(s2(spark, sf_dir), CFG)


def s7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows; the comment's number stands for its day."""
    day = F.lpad((F.pmod(F.col("comment_id").cast("long"), F.lit(28)) + 1).cast("string"), 2, "0")
    return pipeline.s7(s6(spark, sf_dir), "r1", CFG, created_at=F.concat(F.lit("2024-01-"), day, F.lit("T00:00:00Z")))


# SQL parts: the same tables in DuckDB.
_WS = r"[ \t\n\r\f\x{0b}]"
_NORM = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), 'https?://\S+|www\.\S+', ' ', 'g'), '\S+@\S+\.\S+', ' ', 'g'), '{_WS}+', ' ', 'g'))"
_S1 = f"s1 AS (SELECT source, doc_id::VARCHAR AS comment_id, lang AS place_id, t AS normalized_text, CASE WHEN toxic = 1 THEN 1.0::DOUBLE WHEN quality = 1 THEN 5.0::DOUBLE WHEN quality = 0 THEN 3.0::DOUBLE END AS rating FROM (SELECT *, {_NORM} AS t FROM documents LEFT JOIN labels USING (doc_id)) WHERE t <> '')"
_SENT = "list_filter(list_transform(string_split(regexp_replace({}, '([.!?…])[ \\t\\n\\r]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_replace(trim(x), '[.!?…]+$', '')), lambda x: length(x) >= 3)"
_S2 = f"""{_S1}, e AS (SELECT source, comment_id, place_id, rating, unnest(s) AS sentence_text, generate_subscripts(s, 1) - 1 AS i FROM (SELECT *, {_SENT.format('normalized_text')} AS s FROM s1)),
s2 AS (SELECT source, comment_id, place_id, comment_id || '_s' || sentence_idx AS sentence_id, substr(sha256(sentence_text), 1, 16) AS sentence_hash, sentence_text, sentence_idx, rating
 FROM (SELECT source, comment_id, place_id, rating, sentence_text, min(i)::INT AS sentence_idx FROM e GROUP BY ALL))"""
_STUB = "(('0x' || substr(sha256({}), 1, 8))::BIGINT % 3)::INT"
_LABEL = "['negative', 'neutral', 'positive'][{} + 1]"
_SCORE = repr(scoring.STUB_SCORE)
_S3 = f"{_S2}, s3 AS (SELECT *, {_LABEL.format('label_id')} AS label, {_SCORE}::DOUBLE AS score FROM (SELECT *, {_STUB.format('sentence_text')} AS label_id FROM s2))"
_CONN = "(?i)(" + _WS + r"+|^)(and|und|et|y|que|;|:)(" + _WS + "+|$)"


def _clauses(c: str, least: int) -> str:
    """A separator that stands where the one before ended shares its space, so a first pass marks all that do not."""
    parts = f"list_transform(string_split(regexp_replace({c}, '{_CONN}', chr(2), 'g'), chr(2)), lambda x: trim(x))"
    own = f"list_filter(list_transform({parts}, lambda x: regexp_replace(x, '[.!?…;:,]+$', '')), lambda x: length(x) >= {least})"
    return f"CASE WHEN len({own}) > 0 THEN {own} WHEN len({parts}) = 1 AND length({c}) >= {least} THEN [regexp_replace({c}, '[.!?…;:,]+$', '')] ELSE [] END"


def _dict(raw: dict) -> str:
    return "k(ord, keyword, kw_aspect) AS (VALUES " + ", ".join(f"({o}, '{k}', '{a}')" for o, k, a in dictionary(raw)) + ")"


_DICT = _dict(KEYWORDS)
_NEG = "(^|[^\\pL\\pN_])(" + "|".join(sorted(NEGATORS, key=len, reverse=True)) + ")($|[^\\pL\\pN_])"


def _matches(of: str, key: str, t: str, words: str = _DICT) -> str:
    """CTEs ``m`` (all matches) and ``dm`` (one for each aspect) of the texts ``t`` of table ``of`` by ``key``."""
    return f"""{words}, o AS (SELECT {key}, {t} AS t, ord, keyword, kw_aspect, unnest(range(1, length({t}) - length(keyword) + 2)) AS i FROM {of}, k WHERE contains({t}, keyword)),
f AS (SELECT {key}, t, ord, keyword, kw_aspect AS aspect, (i - 1)::INT AS start, (i - 1 + length(keyword))::INT AS "end" FROM o WHERE substr(t, i, length(keyword)) = keyword AND (i = 1 OR NOT regexp_matches(substr(t, i - 1, 1), '[\\pL\\pN]'))),
b AS (SELECT *, list_filter(string_split(trim(substr(t, 1, start)), ' '), lambda w: w <> '') AS w FROM f),
m AS (SELECT {key}, t, ord, keyword, aspect, start, "end", regexp_matches(array_to_string(w[greatest(len(w) - 3, 1):], ' '), '(?i){_NEG}') AS negated FROM b),
dm AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY {key}, aspect ORDER BY negated, start, ord) = 1)"""


_S6 = f"""{_S2}, c AS (SELECT comment_id, source, place_id, sentence_idx, sentence_text, unnest(cl) AS clause, generate_subscripts(cl, 1) - 1 AS clause_idx FROM (SELECT *, {_clauses('sentence_text', 3)} AS cl FROM s2)),
cc AS (SELECT *, row_number() OVER () AS ck FROM c WHERE length(trim(clause)) >= 3), {_matches('cc', 'ck', 'clause')},
j AS (SELECT cc.*, coalesce(dm.aspect, 'other') AS aspect, coalesce(dm.keyword, '') AS aspect_keyword, coalesce(dm.negated, false) AS aspect_negated, dm.start, dm.ord, count(DISTINCT dm.aspect) OVER (PARTITION BY cc.ck) > 1 AS multi FROM cc LEFT JOIN dm USING (ck)),
w AS (SELECT *, string_split(clause, ' ') AS words, length(substr(clause, 1, start)) - length(replace(substr(clause, 1, start), ' ', '')) AS p FROM j),
g AS (SELECT *, CASE WHEN multi THEN array_to_string(words[greatest(p - 2, 0) + 1:p + 3], ' ') ELSE clause END AS seg FROM w),
h AS (SELECT *, CASE WHEN length(trim(seg)) < 3 THEN clause ELSE seg END AS segment_text, CASE WHEN start IS NULL OR length(trim(seg)) < 3 THEN 'fallback' WHEN multi THEN 'window' ELSE 'clause' END AS segment_type FROM g),
s6 AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY comment_id, source, sentence_idx, aspect, segment_text ORDER BY clause_idx, start, ord) = 1)"""
_TURN = "CASE WHEN aspect_negated AND l = 'positive' THEN 'negative' WHEN aspect_negated AND l = 'negative' THEN 'positive' ELSE l END"
_S7 = f"{_S6}, s7 AS (SELECT *, place_id AS entity_id, source AS platform, comment_id || '_s' || sentence_idx AS sentence_id, {_TURN} AS sentiment, {_SCORE}::DOUBLE AS confidence_score, aspect_negated AND l <> 'neutral' AS negation_applied, make_date(2024, 1, (comment_id::BIGINT % 28 + 1)::INT) AS day FROM (SELECT *, {_LABEL.format(_STUB.format('segment_text'))} AS l FROM s6))"


@query(f"WITH {_S3} SELECT label, label_id, count(*) AS n, count(DISTINCT sentence_hash) AS n_hashes, sum(sentence_idx)::BIGINT AS sum_idx, count_if(length(sentence_text) > 120) AS n_long FROM s3 GROUP BY ALL")
def flagship(spark, sf_dir):
    """Sentences of all documents, scored, by label."""
    return s3(spark, sf_dir).groupBy("label", "label_id").agg(F.count("*").alias("n"), F.countDistinct("sentence_hash").alias("n_hashes"), F.sum("sentence_idx").alias("sum_idx"), F.count_if(F.length("sentence_text") > 120).alias("n_long"))


# text


@query(f"SELECT doc_id, {_NORM} AS normalized FROM documents")
def text_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text"), TEXT).alias("normalized"))


@query("SELECT doc_id, nfc_normalize(text) AS composed, length(nfc_normalize(text)) AS n FROM documents")
def text_nfc(spark, sf_dir):
    c = text.nfc(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", c.alias("composed")).withColumn("n", F.length("composed").cast("long"))


@query(f"SELECT doc_id, unnest(s) AS sentence, (generate_subscripts(s, 1) - 1)::INT AS idx FROM (SELECT doc_id, {_SENT.format('text')} AS s FROM documents)")
def sentence_split(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("idx", "sentence"))


@query(f"WITH {_S2} SELECT source, comment_id, place_id, sentence_id, sentence_hash, sentence_text, sentence_idx, rating FROM s2")
def s2_sentences(spark, sf_dir):
    return s2(spark, sf_dir).select("source", "comment_id", "place_id", "sentence_id", "sentence_hash", "sentence_text", "sentence_idx", "rating")


@query(f"WITH {_S2}, c AS (SELECT comment_id, source, sentence_idx, {_clauses('sentence_text', 5)} AS cl FROM s2) SELECT comment_id, source, sentence_idx, unnest(cl) AS clause, (generate_subscripts(cl, 1) - 1)::INT AS clause_idx FROM c")
def clause_split(spark, sf_dir):
    return s2(spark, sf_dir).select("comment_id", "source", "sentence_idx", F.posexplode(text.clauses(F.col("sentence_text"), TEXT)).alias("clause_idx", "clause"))


@query("SELECT p_partkey, substr(sha256(p_name), 1, 16) AS hash, md5(p_name || '|' || p_brand) AS comment_id, substr(base64(encode(concat_ws('|', p_name, p_brand, p_type))), 1, 32) AS card_id FROM part")
def hashes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.hash16(F.col("p_name")).alias("hash"), parse.md5_id(F.col("p_name"), F.col("p_brand")).alias("comment_id"), parse.card_id(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("card_id"))


@query(f"""WITH {_S2}, p AS (SELECT comment_id, source, sentence_idx, sentence_text AS t, instr(sentence_text, 'the') - 1 AS start, string_split(sentence_text, ' ') AS w FROM s2 WHERE contains(sentence_text, 'the')),
q AS (SELECT *, length(substr(t, 1, start)) - length(replace(substr(t, 1, start), ' ', '')) AS i FROM p)
SELECT comment_id, source, sentence_idx, array_to_string(w[greatest(i - 2, 0) + 1:i + 3], ' ') AS segment, CASE WHEN i > 2 THEN length(array_to_string(w[1:i - 2], ' ')) + 1 ELSE 0 END::INT AS start FROM q""")
def window_segments(spark, sf_dir):
    df = s2(spark, sf_dir).filter(F.contains("sentence_text", F.lit("the")))
    at = F.instr("sentence_text", "the") - 1
    w = text.window_segment(F.col("sentence_text"), at, at + 3, 2, 2)
    return df.select("comment_id", "source", "sentence_idx", w["text"].alias("segment"), w["start"].alias("start"))


@query("SELECT p_partkey, trim(regexp_replace(strip_accents(lower(p_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug, strip_accents(lower(p_type)) AS plain FROM part")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), text.strip_accents(F.col("p_type")).alias("plain"))


# aspects


@query(f"WITH {_DICT} SELECT ord, keyword, kw_aspect AS aspect FROM k")
def aspect_dictionary(spark, sf_dir):
    return aspects.keyword_table(spark, ASPECTS).select("ord", "keyword", "aspect")


@query(f"WITH {_S2}, x AS (SELECT *, row_number() OVER () AS ck FROM s2), {_matches('x', 'ck', 'sentence_text')} SELECT comment_id, source, sentence_idx, m.ord, keyword, aspect, start, \"end\", negated FROM m JOIN x USING (ck)")
def aspect_detect(spark, sf_dir):
    df = s2(spark, sf_dir).select("comment_id", "source", "sentence_idx", F.explode(aspects.matches(F.col("sentence_text"), ASPECTS)).alias("m"))
    return df.select("comment_id", "source", "sentence_idx", "m.ord", "m.keyword", "m.aspect", "m.start", "m.end", "m.negated")


@query(f"WITH {_S2}, x AS (SELECT *, row_number() OVER () AS ck FROM s2), {_matches('x', 'ck', 'sentence_text')} SELECT comment_id, source, sentence_idx, keyword, aspect, start, negated, CASE WHEN negated THEN -1 ELSE 1 END AS modifier FROM dm JOIN x USING (ck)")
def aspect_dedupe(spark, sf_dir):
    df = s2(spark, sf_dir).select("comment_id", "source", "sentence_idx", F.explode(aspects.deduplicated(aspects.matches(F.col("sentence_text"), ASPECTS))).alias("m"))
    return df.select("comment_id", "source", "sentence_idx", "m.keyword", "m.aspect", "m.start", "m.negated", aspects.sentiment_modifier(F.col("m.negated")).alias("modifier"))


LONGER = {"food": ("the", "the an", "an"), "price": ("of", "of the", "er")}


@query(f"""WITH RECURSIVE {_S2}, x AS (SELECT *, row_number() OVER () AS ck FROM s2), {_matches('x', 'ck', 'sentence_text', _dict(LONGER))},
q AS (SELECT ck, keyword, aspect, start, "end" AS e, row_number() OVER (PARTITION BY ck ORDER BY length(keyword) DESC, ord, start) AS r FROM m),
g AS (SELECT ck, 0::BIGINT AS r, []::STRUCT(s INT, e INT)[] AS taken FROM q GROUP BY ck
 UNION ALL SELECT g.ck, g.r + 1, CASE WHEN len(list_filter(g.taken, lambda y: y.s < q.e AND q.start < y.e)) > 0 THEN g.taken ELSE list_append(g.taken, struct_pack(s := q.start, e := q.e)) END FROM g JOIN q ON g.ck = q.ck AND q.r = g.r + 1),
z AS (SELECT ck, unnest(taken) AS p FROM (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY ck ORDER BY r DESC) = 1))
SELECT comment_id, source, sentence_idx, keyword, aspect, start, q.e AS "end" FROM z JOIN q ON z.ck = q.ck AND z.p.s = q.start AND z.p.e = q.e JOIN x ON x.ck = q.ck""")
def aspect_longest(spark, sf_dir):
    """Longest match first, without overlaps."""
    cfg = AspectConfig(keywords=tuple(dictionary(LONGER)), negators=NEGATORS, prefer_longest=True)
    df = s2(spark, sf_dir).select("comment_id", "source", "sentence_idx", F.explode(aspects.matches(F.col("sentence_text"), cfg)).alias("m"))
    return df.select("comment_id", "source", "sentence_idx", "m.keyword", "m.aspect", "m.start", "m.end")


@query(f"WITH {_S6} SELECT source, comment_id, sentence_idx, clause_idx::INT AS clause_idx, aspect, aspect_keyword, aspect_negated, clause AS clause_text, segment_text, substr(sha256(segment_text), 1, 16) AS segment_hash, segment_type FROM s6")
def s6_segments(spark, sf_dir):
    return s6(spark, sf_dir).select("source", "comment_id", "sentence_idx", "clause_idx", "aspect", "aspect_keyword", "aspect_negated", "clause_text", "segment_text", "segment_hash", "segment_type")


@query(f"WITH {_S6} SELECT count(*) AS rows_out, count(DISTINCT (source, comment_id, sentence_idx, clause_idx)) AS clauses_out FROM s6")
def s6_counts(spark, sf_dir):
    return s6(spark, sf_dir).agg(F.count("*").alias("rows_out"), F.count_distinct(F.struct("source", "comment_id", "sentence_idx", "clause_idx")).alias("clauses_out"))


# scores and assembly


@query(f"WITH {_S3} SELECT source, comment_id, sentence_idx, label_id, label, score FROM s3")
def s3_stub_scores(spark, sf_dir):
    return s3(spark, sf_dir).select("source", "comment_id", "sentence_idx", "label_id", "label", "score")


@query("SELECT p_partkey, ['negative', 'neutral', 'positive'][(p_size % 3) + 1] AS label, round(1 / (1 + p_size::DOUBLE), 6) AS score FROM part")
def model_scores(spark, sf_dir):
    """The provider interface, with a model that reads the text's number."""
    df = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("t"))
    out = scoring.with_model(df, "t", lambda: lambda texts: [(int(t) % 3, 1 / (1 + int(t))) for t in texts], "number", "v1")
    return out.select("p_partkey", "label", F.round("score", 6).alias("score"))


@query(f"WITH {_S7} SELECT source || '_' || comment_id || '_' || sentence_id || '_' || aspect || '_c' || clause_idx AS record_id, aspect, sentiment, confidence_score, negation_applied, segment_type, sentence_text AS sentence FROM s7")
def absa_segment(spark, sf_dir):
    return s7(spark, sf_dir).select("record_id", "aspect", "sentiment", "confidence_score", "negation_applied", "segment_type", "sentence")


@query(f"WITH {_S6} SELECT source, comment_id, sentence_idx, aspect, aspect_keyword, {_TURN} AS sentiment, aspect_negated AND l <> 'neutral' AS negation_applied FROM (SELECT *, {_LABEL.format(_STUB.format('sentence_text'))} AS l FROM s6)")
def absa_sentence(spark, sf_dir):
    return absa.by_sentence(s6(spark, sf_dir)).select("source", "comment_id", "sentence_idx", "aspect", "aspect_keyword", "sentiment", "negation_applied")


@query(f"""WITH {_S6}, a AS (SELECT *, {_clauses('sentence_text', 5)} AS own FROM s6), a2 AS (SELECT *, CASE WHEN len(own) > 0 THEN own ELSE [sentence_text] END AS al FROM a),
a3 AS (SELECT *, greatest(coalesce(list_position(list_transform(al, lambda x: aspect_keyword <> '' AND contains(lower(x), aspect_keyword)), true), 0) - 1, 0) AS ci FROM a2)
SELECT source, comment_id, sentence_idx, aspect, aspect_keyword, ci::INT AS clause_idx, al[ci + 1] AS sentence, {_TURN} AS sentiment FROM (SELECT *, {_LABEL.format(_STUB.format('al[ci + 1]'))} AS l FROM a3)""")
def absa_clause(spark, sf_dir):
    return absa.by_clause(s6(spark, sf_dir), cfg=TEXT).select("source", "comment_id", "sentence_idx", "aspect", "aspect_keyword", "clause_idx", "sentence", "sentiment")


@query(f"WITH {_S6}, p AS (SELECT source, place_id, comment_id, sentence_idx, {_LABEL.format(_STUB.format('sentence_text'))} AS l FROM s2) SELECT source, comment_id, sentence_idx, aspect, aspect_keyword, l AS sentence_label, {_SCORE}::DOUBLE AS sentence_score FROM s6 JOIN p USING (source, place_id, comment_id, sentence_idx)")
def s6_join_s3(spark, sf_dir):
    return absa.with_sentence_scores(s6(spark, sf_dir), s3(spark, sf_dir)).select("source", "comment_id", "sentence_idx", "aspect", "aspect_keyword", "sentence_label", "sentence_score")


@query(f"WITH {_S7} SELECT source || '_' || comment_id || '_' || sentence_id || '_' || aspect || '_c' || clause_idx AS record_id, entity_id, source, sentence_text AS sentence, aspect, sentiment, confidence_score, platform, strftime(day, '%Y-%m-%d') || 'T00:00:00Z' AS created_at FROM s7")
def ml_projection(spark, sf_dir):
    return absa.ml_rows(s7(spark, sf_dir))


# quality and metrics


_QSQL = f"""WITH {_S3}, r AS (SELECT source, comment_id, sentence_idx, l AS label, score, list_filter([CASE WHEN l IS NULL THEN 'MISSING_FIELDS' END,
CASE WHEN length(sentence_text) > {QUALITY.max_len} THEN 'TOO_LONG' END, CASE WHEN l IS NULL THEN 'INVALID_LABEL' END], lambda x: x IS NOT NULL) AS reasons
FROM (SELECT *, CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3 THEN 'neutral' WHEN rating IS NOT NULL THEN 'positive' END AS l FROM s3))"""


def _quality_rows(spark, sf_dir):
    """Scored sentences, whole, with the label of their document's rating; many have none. Other reasons are tested on small tables."""
    return s3(spark, sf_dir).withColumn("label", metrics.rating_label(F.col("rating")))


@query(f"{_QSQL} SELECT source, comment_id, sentence_idx, array_to_string(reasons, ',') AS reasons FROM r")
def quarantine_reasons(spark, sf_dir):
    return quality.judged(_quality_rows(spark, sf_dir), QUALITY).select("source", "comment_id", "sentence_idx", F.array_join("quarantine_reasons", ",").alias("reasons"))


@query(f"{_QSQL} SELECT source, comment_id, sentence_idx, len(reasons) = 0 AS valid FROM r")
def quality_split(spark, sf_dir):
    good, bad = quality.split(_quality_rows(spark, sf_dir), QUALITY, pin=True)
    cols = ["source", "comment_id", "sentence_idx"]
    return good.select(*cols, F.lit(True).alias("valid")).unionAll(bad.select(*cols, F.lit(False).alias("valid")))


@query(f"""WITH {_S7} SELECT aspect_keyword = '' AS no_keyword, array_to_string(list_filter([CASE WHEN sentiment IS NULL THEN 'INVALID_LABEL' END, CASE WHEN trim(segment_text) = '' THEN 'EMPTY_SEGMENT' END], lambda x: x IS NOT NULL), ',') AS reasons, count(*) AS n FROM s7 GROUP BY ALL""")
def absa_quality(spark, sf_dir):
    rows = quality.judged(s7(spark, sf_dir), QUALITY, absa=True)
    return rows.groupBy((F.col("aspect_keyword") == "").alias("no_keyword"), F.array_join("quarantine_reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query(f"""{_QSQL} SELECT count(*) AS total, count_if(len(reasons) = 0) AS valid, count_if(len(reasons) > 0) AS quarantined, round(count_if(len(reasons) > 0)::DOUBLE / count(*), 4) AS quarantine_rate,
{', '.join(f"count_if(len(reasons) = 0 AND label = '{k}') AS {k}_count, round(count_if(len(reasons) = 0 AND label = '{k}')::DOUBLE / count_if(len(reasons) = 0), 4) AS {k}_share" for k in ('negative', 'neutral', 'positive'))},
round(avg(score) FILTER (len(reasons) = 0), 4) AS avg_score, round(min(score) FILTER (len(reasons) = 0), 4) AS min_score, round(max(score) FILTER (len(reasons) = 0), 4) AS max_score FROM r""")
def s5_metrics(spark, sf_dir):
    return metrics.compute(quality.judged(_quality_rows(spark, sf_dir), QUALITY))


@query(f"{_QSQL} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY reason")
def reason_histogram(spark, sf_dir):
    return metrics.reason_histogram(quality.judged(_quality_rows(spark, sf_dir), QUALITY))


@query(f"WITH {_S3} SELECT count(rating) AS with_rating, count_if(e = label) AS matched, round(count_if(e = label)::DOUBLE / count(rating), 4) AS match_rate FROM (SELECT *, CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3 THEN 'neutral' WHEN rating IS NOT NULL THEN 'positive' END AS e FROM s3)")
def label_consistency(spark, sf_dir):
    return metrics.label_consistency(s3(spark, sf_dir))


@query(f"WITH {_S7} SELECT aspect, sentiment, grouping(aspect, sentiment)::INT AS level, count(*) AS n FROM s7 GROUP BY GROUPING SETS ((aspect), (sentiment), (aspect, sentiment), ())")
def absa_counts(spark, sf_dir):
    return metrics.absa_counts(s7(spark, sf_dir))


@query(f"""WITH {_S7}, z AS (SELECT *, source || '/' || entity_id || '/' || comment_id || '#' || substr(sha256(sentence_text), 1, 16) AS sk, substr(sha256(segment_text), 1, 16) AS sh FROM s7)
SELECT count(*) AS total, count(DISTINCT sk) AS sentences, round(count(DISTINCT CASE WHEN aspect <> 'other' THEN sk END)::DOUBLE / (SELECT count(*) FROM s2), 4) AS aspect_coverage, round(count_if(aspect <> 'other')::DOUBLE / count(DISTINCT CASE WHEN aspect <> 'other' THEN sk END), 4) AS avg_aspects_per_sentence, round(count(*)::DOUBLE / count(DISTINCT sk), 4) AS avg_segments_per_sentence,
count(DISTINCT sh) AS unique_segments, round(count(DISTINCT sh)::DOUBLE / count(*), 4) AS unique_segment_ratio, count_if(negation_applied) AS negations FROM z""")
def absa_summary(spark, sf_dir):
    total = s2(spark, sf_dir).agg(F.count("*").alias("_total"))
    return metrics.absa_summary(s7(spark, sf_dir).join(F.broadcast(total)), F.col("_total"))


@query(f"WITH {_S7} SELECT segment_type, count(*) AS n FROM s7 GROUP BY ALL")
def segment_types(spark, sf_dir):
    return metrics.segment_types(s7(spark, sf_dir))


@query("SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS field, unnest([100.0, 100.0, 100.0, 100.0, round(avg((value IS NOT NULL)::INT) * 100, 2), round(avg((coalesce(props, '') <> '')::INT) * 100, 2)])::DOUBLE AS rate FROM events")
def fill_rates(spark, sf_dir):
    return metrics.fill_rates(table(spark, sf_dir, "events"))


@query("""SELECT 'user_id' AS field, count(DISTINCT user_id) AS n_unique, count_if(user_id IS NULL) AS n_missing FROM events UNION ALL SELECT 'event_type', count(DISTINCT event_type), count_if(event_type IS NULL) FROM events
UNION ALL SELECT '*', count(DISTINCT (user_id, event_type)), count(*) - count(DISTINCT (user_id, event_type)) FROM events""")
def profile(spark, sf_dir):
    return metrics.profile(table(spark, sf_dir, "events").select("user_id", "event_type"), ["user_id", "event_type"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def counts_by_type(spark, sf_dir):
    return metrics.counts_by(table(spark, sf_dir, "events"), "event_type")


# gold


@query(f"WITH {_S7} SELECT aspect, sentiment, n, avg_confidence, round(n / sum(n) OVER (PARTITION BY aspect), 4) AS share FROM (SELECT aspect, sentiment, count(*) AS n, round(avg(confidence_score), 4) AS avg_confidence FROM s7 GROUP BY ALL)")
def gold_aspect_sentiment(spark, sf_dir):
    return gold.aspect_sentiment(s7(spark, sf_dir))


@query(f"""WITH {_S7}, gg AS (SELECT entity_id, count(*) AS n, count_if(sentiment = 'negative') AS negative, count_if(sentiment = 'neutral') AS neutral, count_if(sentiment = 'positive') AS positive FROM s7 GROUP BY ALL)
SELECT *, dense_rank() OVER (ORDER BY net_score DESC)::INT AS rank FROM (SELECT *, round((positive - negative)::DOUBLE / n, 4) AS net_score FROM gg)""")
def gold_destination_sentiment(spark, sf_dir):
    return gold.destination_sentiment(s7(spark, sf_dir))


@query(f"WITH {_S7} SELECT platform, sentiment, grouping(platform, sentiment)::INT AS level, count(*) AS n, round(avg(confidence_score), 4) AS avg_confidence FROM s7 GROUP BY ROLLUP (platform, sentiment)")
def gold_platform_sentiment(spark, sf_dir):
    return gold.platform_sentiment(s7(spark, sf_dir))


@query(f"WITH {_S7}, gg AS (SELECT day, sentiment, count(*) AS n FROM s7 GROUP BY ALL) SELECT day::VARCHAR AS day, sentiment, n, round(avg(n) OVER (PARTITION BY sentiment ORDER BY gg.day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS avg_7 FROM gg")
def gold_sentiment_daily(spark, sf_dir):
    return gold.sentiment_daily(s7(spark, sf_dir)).withColumn("day", F.col("day").cast("string"))


@query(f"WITH {_S3} SELECT sentence_id, sentence_text, label, score FROM s3 WHERE length(sentence_text) <= {QUALITY.max_len}")
def sentiment_dataset(spark, sf_dir):
    return gold.sentiment_dataset(quality.split(s3(spark, sf_dir), QUALITY)[0])


@query("""WITH RECURSIVE e AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Z][a-z]+ [A-Z][a-z]+') AS l FROM documents),
g AS (SELECT doc_id, 0 AS i, 1::BIGINT AS pos, NULL::VARCHAR AS entity, NULL::INT AS start, NULL::INT AS "end" FROM e WHERE len(l) > 0
 UNION ALL SELECT doc_id, i, p + length(m), m, (p - 1)::INT, (p - 1 + length(m))::INT FROM (SELECT g.doc_id, g.i + 1 AS i, l[g.i + 1] AS m, g.pos - 1 + instr(substr(text, g.pos), l[g.i + 1]) AS p FROM g JOIN e ON g.doc_id = e.doc_id WHERE g.i < len(l)))
SELECT doc_id, entity, start, "end" FROM g WHERE i > 0""")
def ner_dataset(spark, sf_dir):
    """Mentions with their places."""
    return gold.ner_dataset(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tamarack.plans import catalog_io, catalog_more  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from tamarack.plans import catalog_io, catalog_more  # noqa: F401

    return dict(_SQL)
