"""More queries of the catalogue: cleaning, entities, parsers, sources and sinks, relational forms, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.functions import parse, text
from tamarack.operators import clean, entities, relational
from tamarack.plans.catalog import query, table
from tamarack.session import shared_folder
from tamarack.sources import adapters, readers, sinks
from tamarack.streaming import stream


def _work(spark) -> str:
    return f"{shared_folder(spark)}/tamarack-{uuid.uuid4().hex}"


# adapters and cleaning


@query("SELECT 'tiktok' AS source, conv_id::VARCHAR || '-' || turn AS comment_id, conv_id::VARCHAR AS place_id, 'tiktok_' || conv_id AS place_name, text AS raw_text FROM conversations WHERE coalesce(text, '') <> ''")
def adapter_nested_comments(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    one = F.struct(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("cid"), F.col("text").alias("text"), F.lit("").alias("create_time"))
    raw = c.groupBy(F.col("conv_id").cast("string").alias("aweme_id")).agg(F.collect_list(one).alias("comments"))
    return adapters.comments(raw, "tiktok").select("source", "comment_id", "place_id", "place_name", "raw_text")


@query("SELECT 'tripadvisor' AS source, '1' AS comment_id, doc_id::VARCHAR AS place_id, text AS raw_text, n_chars::DOUBLE AS rating FROM documents WHERE text <> ''")
def adapter_reviews(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    review = F.array(F.struct(F.lit(1).alias("index"), F.lit("").alias("key_review"), F.col("text").alias("detail_review")), F.struct(F.lit(2).alias("index"), F.lit("").alias("key_review"), F.lit("").alias("detail_review")))
    raw = d.select(F.col("doc_id").alias("record_id"), F.col("lang").alias("province"), F.col("n_chars").cast("string").alias("rating"), review.alias("reviews"))
    return adapters.comments(raw, "tripadvisor").select("source", "comment_id", "place_id", "raw_text", "rating")


@query("SELECT c_custkey, nullif(trim(c_mktsegment), '') AS segment, nullif(trim(c_name), '') AS name FROM customer WHERE c_custkey IS NOT NULL")
def clean_flat(spark, sf_dir):
    return clean.cleaned(table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\n")).alias("segment"), F.col("c_name").alias("name")))


@query("SELECT conv_id, list_filter(list(nullif(trim(text), '') ORDER BY turn), lambda x: x IS NOT NULL) AS texts FROM conversations GROUP BY conv_id")
def clean_nested(spark, sf_dir):
    nested = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.struct(F.concat(F.lit(" "), "text").alias("text"), F.lit("  ").alias("blank")).alias("r")))).alias("turns"))
    out = clean.cleaned(nested)
    return out.select("conv_id", F.transform("turns", lambda t: t["r"]["text"]).alias("texts"))


@query("""WITH c AS (SELECT conv_id, CASE turn % 4 WHEN 0 THEN ' ' || text WHEN 1 THEN ' ' WHEN 2 THEN text END AS a, CASE WHEN turn % 3 > 0 THEN role END AS b FROM conversations)
SELECT count(*) AS total, count(*) * 2 - count(a) - count(b) AS null_strings, count(CASE WHEN trim(a) = '' THEN 1 END) AS blank_strings, count(CASE WHEN trim(a) <> '' AND trim(a) <> a THEN 1 END) AS trimmed_strings,
count(CASE WHEN coalesce(trim(a), '') <> '' OR b IS NOT NULL THEN 1 END) AS kept, count(*) - count(CASE WHEN coalesce(trim(a), '') <> '' OR b IS NOT NULL THEN 1 END) AS removed FROM c""")
def clean_counters(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    k = F.col("turn") % 4
    return clean.counters(c.select(F.when(k == 0, F.concat(F.lit(" "), "text")).when(k == 1, " ").when(k == 2, F.col("text")).alias("a"), F.when(F.col("turn") % 3 > 0, F.col("role")).alias("b")))


@query("SELECT conv_id, count(*) AS n FROM conversations WHERE turn < 3 GROUP BY conv_id")
def clean_with_text(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", F.when(F.col("turn") < 2, F.col("text")).otherwise(" ").alias("detail_review"), F.when(F.col("turn") == 2, F.array("text")).otherwise(F.array().cast("array<string>")).alias("reviews"))
    return clean.with_text(rows).groupBy("conv_id").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN (SELECT round(median(CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END), 1) FROM supplier) ELSE s_acctbal END AS balance FROM supplier")
def median_impute(spark, sf_dir):
    return clean.median_imputed(table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("balance")), ["balance"])


@query("SELECT o_orderkey, CASE WHEN o_totalprice / 50000 BETWEEN 1 AND 5 THEN '' ELSE 'rating' END AS errors FROM orders")
def contract_errors(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.array_join(clean.contract_errors((F.col("o_totalprice") / 50000).cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")), ",").alias("errors"))


@query("SELECT conv_id, count(*)::INT AS review_count, count(CASE WHEN turn % 2 = 0 THEN 1 END)::INT AS images_downloaded, arg_min(text, turn) AS key_review, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS detail_review, 'ok' AS status FROM conversations GROUP BY conv_id")
def record_sync(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    turn = F.struct(F.col("turn").cast("int").alias("index"), F.col("text").alias("key_review"), F.col("text").alias("detail_review"))
    image = F.struct((F.col("turn") % 2 == 0).alias("downloaded"), F.lit("p").alias("local_path"), F.lit("u").alias("original_url"))
    raw = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("reviews"), F.collect_list(image).alias("images"))
    raw = raw.withColumns({"key_review": F.lit(""), "detail_review": F.lit(""), "status": F.lit("ok"), "original_image_urls": F.array().cast("array<string>")})
    return clean.synced(raw).select("conv_id", "review_count", "images_downloaded", "key_review", "detail_review", "status")


@query("SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN round(p_retailprice / (p_size % 10), 4) END AS ratio FROM part")
def compression_ratio(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", parse.compression_ratio(F.col("p_retailprice"), F.col("p_size") % 10).alias("ratio"))


# entities


@query("SELECT min(c_custkey) AS ord, c_mktsegment AS province, lower(trim(substr(c_name, 1, 13))) AS key FROM customer GROUP BY ALL")
def candidate_dedupe(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("province"), F.substring("c_name", 1, 13).alias("name"))
    return entities.candidates(c).select("ord", "province", F.lower(F.trim("name")).alias("key"))


@query("SELECT row_number() OVER (ORDER BY lower(p), lower(n)) AS STT, trim(n || ' ' || p) AS Key_word FROM (SELECT p_brand AS p, p_type AS n FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_brand), lower(p_type) ORDER BY p_partkey) = 1)")
def keywords_numbered(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("name"), F.col("p_brand").alias("province"))
    return sinks.keyword_list(p)


@query("SELECT p_partkey, CASE WHEN starts_with(lower(trim(p_type)), 'promo') THEN trim(substr(lower(trim(p_type)), 6)) ELSE lower(trim(p_type)) END AS name FROM part")
def name_normalize(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", entities.normalize_name(F.col("p_type"), ("promo",)).alias("name"))


@query("""WITH RECURSIVE p AS (SELECT s_suppkey AS ord, c_custkey AS o2, c_name, lower(s_name) AS a, lower(c_name) AS b FROM supplier JOIN customer ON s_nationkey = c_nationkey),
d AS (SELECT ord, o2, c_name, a, b, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0::BIGINT) AS cells FROM p
 UNION ALL SELECT ord, o2, c_name, a, b, i + 1, list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda j: list_max(c[1:j])))
 FROM (SELECT *, list_transform(range(1, length(b) + 1), lambda j: CASE WHEN substr(b, j, 1) = substr(a, i + 1, 1) THEN cells[j] + 1 ELSE cells[j + 1] END) AS c FROM d WHERE i < length(a))),
m AS (SELECT ord, c_name, round(200.0::DOUBLE * cells[length(b) + 1] / (length(a) + length(b)), 6) AS s, o2 FROM d WHERE i = length(a)),
best AS (SELECT * FROM m WHERE s >= 30 QUALIFY row_number() OVER (PARTITION BY ord ORDER BY s DESC, o2) = 1)
SELECT s_suppkey AS ord, s_name AS name_vn, c_name AS name_en, coalesce(s, 0)::DOUBLE AS match_score FROM supplier LEFT JOIN best ON s_suppkey = ord""")
def fuzzy_map(spark, sf_dir):
    """Best names within a block; the SQL fills the table of common subsequences row by row."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("province"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("province"), F.lit("u").alias("source_url"))
    return entities.best_matches(s, c, 30.0).select("ord", "name_vn", "name_en", "match_score")


@query("SELECT p_partkey, lower(replace(trim(p_brand), ' ', '_')) || '__' || lower(replace(trim(p_name), ' ', '_')) AS entity_id FROM part")
def entity_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", parse.entity_id(F.col("p_name"), F.col("p_brand")).alias("entity_id"))


_WORDS = (("THAT", "that", "que"), ("HAND", "hand", "der"), ("OTHER_WORD", "other"))


@query("SELECT doc_id, CASE WHEN contains(text, 'that') OR contains(text, 'que') THEN 'THAT' WHEN contains(text, 'hand') OR contains(text, 'der') THEN 'HAND' WHEN contains(text, 'other') THEN 'OTHER_WORD' ELSE 'OTHER' END AS entity_type FROM documents")
def entity_typing(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", entities.entity_type(F.col("text"), _WORDS).alias("entity_type"))


@query("SELECT doc_id, regexp_replace(text, '([A-Z][a-z]+ [A-Z][a-z]+)', '<ENTITY>', 'g') AS masked, len(regexp_extract_all(text, '([A-Z][a-z]+ [A-Z][a-z]+)', 1))::INT AS n FROM documents")
def entity_mask(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", entities.masked(F.col("text")).alias("masked"), F.size(entities.mentions(F.col("text"))).alias("n"))


@query("SELECT min(conv_id * 1000 + turn) AS record_id, trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')) AS entity_name, role AS province FROM conversations GROUP BY ALL")
def entity_table(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    posts = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("record_id"), F.col("text").alias("raw_text"), F.col("role").alias("province"), F.lit("").alias("specific_place"), F.lit("").alias("collected_at"))
    rows = entities.entities(posts.withColumn("raw_text", F.concat_ws("\x1f", "province", "raw_text")))
    return rows.select("record_id", F.trim(F.split_part("entity_name", F.lit("\x1f"), F.lit(2))).alias("entity_name"), "province")


@query("SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 10")
def group_top_k(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return entities.top_by(o, ["o_orderpriority"], 10, F.desc("o_totalprice"), "o_orderkey")


@query("SELECT l_orderkey, l_suppkey, l_quantity FROM (SELECT l_orderkey, l_suppkey, l_quantity, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_quantity) <= 3")
def ticket_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    one = entities.first_by(rows, ["l_orderkey", "l_suppkey", "l_quantity"], "l_linenumber")
    return entities.top_by(one, ["l_orderkey"], 3, "l_linenumber", "l_suppkey", "l_quantity").select("l_orderkey", "l_suppkey", "l_quantity")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def resume_anti_join(spark, sf_dir):
    want = table(spark, sf_dir, "customer").select("c_custkey")
    have = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "O", "ok").otherwise("partial").alias("status"))
    return entities.unseen(want, have, ["c_custkey"], retry_partial=True)


@query("SELECT row_number() OVER (ORDER BY s, f) AS record_id, u AS source_url, v FROM (SELECT k AS u, min(side) AS s, arg_min(ord, side * 1000000000 + ord) AS f, arg_max(v, side * 1000000000 + ord) AS v FROM (SELECT 'u' || o_custkey AS k, 0 AS side, o_orderkey AS ord, o_orderpriority AS v FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'u' || o_custkey, 1, o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F') GROUP BY k)")
def upsert_latest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("#x")).alias("url"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("v"), "o_orderstatus")
    rows = o.withColumn("source_url", parse.norm_url(F.col("url"))).drop("url")
    old, new = rows.filter("o_orderstatus = 'F'"), rows.filter("o_orderstatus <> 'F'")
    return entities.upserted(old.drop("o_orderstatus"), new.drop("o_orderstatus")).select("record_id", "source_url", "v")


@query("WITH f AS (SELECT min(event_id) AS a FROM events WHERE event_type = 'purchase'), t AS (SELECT min(event_id) AS b FROM events, f WHERE event_id > a AND value > 9) SELECT event_id, event_type FROM events, f, t WHERE event_id >= a AND (b IS NULL OR event_id < b)")
def ordered_range_scan(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return entities.between_marks(e, "event_id", F.col("event_type") == "purchase", F.col("value") > 9).select("event_id", "event_type")


# parsers: numbers and names from the tables, written as collected text


def _parser(name: str, source: str, key: str, made, result, sql: str) -> None:
    def run(spark, sf_dir):
        return table(spark, sf_dir, source).withColumn("_t", made()).select(key, *result(F.col("_t")))

    run.__name__ = name
    query(sql)(run)


_c = lambda c: F.col(c).cast("string")
_parser("rating_parse", "part", "p_partkey", lambda: F.concat(F.lit("* "), _c("p_size"), F.lit(",5 sao")), lambda c: [parse.parse_rating(c).alias("rating"), parse.to_float(c).alias("number"), parse.to_int(c).alias("digits")], "SELECT p_partkey, CASE WHEN p_size + 0.5 BETWEEN 1 AND 5 THEN p_size + 0.5 END::DOUBLE AS rating, (p_size + 0.5)::DOUBLE AS number, (p_size * 10 + 5)::BIGINT AS digits FROM part")
_parser("count_parse", "part", "p_partkey", lambda: F.concat(_c("p_size"), F.lit(",5"), F.get(F.array(F.lit("K"), F.lit(" m"), F.lit("")), F.col("p_size") % 3), F.lit(" views")), lambda c: [parse.parse_count(c).alias("n"), parse.parse_count_rounded(c).alias("n_rounded")], "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size * 1000 + 500 WHEN 1 THEN p_size * 1000000 + 500000 ELSE p_size * 10 + 5 END::BIGINT AS n, CASE p_size % 3 WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size * 1000000 ELSE p_size * 10 + 5 END::BIGINT AS n_rounded FROM part")
_parser("price_parse", "part", "p_partkey", lambda: F.concat(F.lit("Giá "), _c("p_size"), F.lit(".000đ - "), _c("p_partkey"), F.lit("k")), lambda c: [parse.parse_price(c).alias("price"), parse.price_range(c)["low"].alias("low"), parse.price_range(c)["high"].alias("high")], "SELECT p_partkey, p_size * 1000::BIGINT AS price, least(nullif(p_size, 0), nullif(p_partkey, 0)) * 1000::BIGINT AS low, CASE WHEN p_size > 0 AND p_partkey > 0 THEN greatest(p_size, p_partkey) * 1000::BIGINT END AS high FROM part")
_parser("duration_parse", "part", "p_partkey", lambda: F.concat(_c("p_size"), F.lit("h "), (F.col("p_partkey") % 60).cast("string"), F.lit("p, "), F.lit("05:0"), (F.col("p_size") % 10).cast("string"), F.lit(" - 21:45")), lambda c: [parse.parse_duration(c).alias("minutes"), parse.opening_hours(c)["open"].alias("opens"), parse.opening_hours(c)["close"].alias("closes"), parse.is_time(parse.opening_hours(c)["open"]).alias("ok")], "SELECT p_partkey, (p_size * 60 + p_partkey % 60)::INT AS minutes, '05:0' || p_size % 10 AS opens, '21:45' AS closes, true AS ok FROM part")
_parser("address_split", "supplier", "s_suppkey", lambda: F.concat_ws(", ", F.col("s_name"), F.lit("P. 1"), _c("s_nationkey"), F.lit(" City ")), lambda c: [parse.address(c)["address"].alias("address"), parse.address(c)["district"].alias("district"), parse.address(c)["city"].alias("city")], "SELECT s_suppkey, s_name || ', P. 1' AS address, s_nationkey::VARCHAR AS district, 'City' AS city FROM supplier")
_parser("hashtag_parse", "part", "p_partkey", lambda: F.concat(F.lit("x #"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_"), F.lit(" #"), _c("p_size"), F.lit(" y#"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_"), F.lit("!")), lambda c: [parse.hashtags(c).alias("tags")], "SELECT p_partkey, '#' || regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g') || '|#' || p_size AS tags FROM part")
_parser("photo_parse", "part", "p_partkey", lambda: F.concat(F.lit("https://x/media/photo-s/1a/"), _c("p_partkey"), F.lit("/n-150x100.jpg, https://x/b.jpg 2x")), lambda c: [parse.upgrade_photo(F.split_part(c, F.lit(","), F.lit(1))).alias("photo"), parse.photo_key(c).alias("key"), parse.srcset_last(c).alias("last")], "SELECT p_partkey, 'https://x/media/photo-o/1a/' || p_partkey || '/n.jpg' AS photo, NULL::VARCHAR AS key, 'https://x/b.jpg' AS last FROM part")
_parser("path_parse", "part", "p_partkey", lambda: F.concat(F.lit("https://f.vn/(S(abc))/slug-"), _c("p_size"), F.lit("/food?x=1#y")), lambda c: [parse.province_slug(c).alias("slug"), parse.norm_url(c).alias("url"), parse.apply_domain(c, "https://new.vn").alias("moved"), parse.video_id(F.concat(F.lit("https://t/video/"), F.regexp_extract(c, "slug-([0-9]+)", 1))).alias("video")], "SELECT p_partkey, 'slug-' || p_size AS slug, 'https://f.vn/(S(abc))/slug-' || p_size || '/food?x=1' AS url, 'https://new.vn/(S(abc))/slug-' || p_size || '/food?x=1#y' AS moved, p_size::VARCHAR AS video FROM part")
_parser("rank_parse", "part", "p_partkey", lambda: F.concat(_c("p_size"), F.lit(". "), F.col("p_name")), lambda c: [parse.rank_and_name(c)["rank"].alias("rank"), parse.rank_and_name(c)["name"].alias("name")], "SELECT p_partkey, p_size::INT AS rank, p_name AS name FROM part")
_parser("comment_residue", "part", "p_partkey", lambda: F.concat(F.lit("An good "), F.col("p_brand"), F.lit("x 12-29 2025 Reply 3 Like ")), lambda c: [parse.comment_residue(c, F.lit("An")).alias("body")], "SELECT p_partkey, 'good ' || p_brand || 'x 12-29 2025 Reply' AS body FROM part")
_parser("booking_url", "part", "p_partkey", lambda: F.concat(F.lit("https://v.com/r-"), _c("p_size"), F.lit("?a=1&date=x&lt=2#f")), lambda c: [parse.booking_url(c, F.lit("05-10-2026"), F.lit("bus")).alias("bus"), parse.booking_url(c, F.lit("05-10-2026"), F.lit("train")).alias("train")], "SELECT p_partkey, 'https://v.com/r-' || p_size || '?a=1&date=05-10-2026&lt=1#f' AS bus, 'https://v.com/r-' || p_size || '?a=1&date%5Bdepart%5D=2026-10-05&passenger%5Badt%5D=1&passenger%5Bchd%5D=0&passenger%5Beld%5D=0&passenger%5Bstu%5D=0&passenger%5Buni%5D=0#f' AS train FROM part")
_parser("train_cards", "part", "p_partkey", lambda: F.concat(F.lit("18:05  Ga A  6h 20p  00:25  Ga B  Tàu SE"), _c("p_size"), F.lit("  Ngồi cứng Từ 215K")), lambda c: [parse.train_card(c)[k].alias(k) for k in ("departure_time", "arrival_time", "operator_name", "vehicle_type", "price_vnd", "duration_min")], "SELECT p_partkey, '18:05' AS departure_time, '00:25' AS arrival_time, 'Tàu SE' || p_size AS operator_name, 'Ngồi cứng' AS vehicle_type, 215000::BIGINT AS price_vnd, 380 AS duration_min FROM part")
_parser("flight_cards", "part", "p_partkey", lambda: F.concat(F.lit("Bamboo Airways  Eco  Embraer QH"), _c("p_partkey"), F.lit("  11:15  AAA  1h35  12:50  BBB  980.500đ")), lambda c: [parse.flight_card(c)[k].alias(k) for k in ("departure_time", "arrival_time", "operator_name", "vehicle_type", "price_vnd", "duration_min")], "SELECT p_partkey, '11:15' AS departure_time, '12:50' AS arrival_time, 'Bamboo Airways' AS operator_name, 'QH' || p_partkey AS vehicle_type, 980500::BIGINT AS price_vnd, 60 AS duration_min FROM part")
_parser("rating_labels", "part", "p_partkey", lambda: F.get(F.array(F.lit("Chất lượng"), F.lit("Giá cả"), F.lit("Phục vụ"), F.lit("khác")), F.col("p_size") % 4), lambda c: [parse.rating_field(c).alias("field"), text.slug(c).alias("slug")], "SELECT p_partkey, ['rating_quality', 'rating_price', 'rating_service', NULL][p_size % 4 + 1] AS field, ['chat-luong', 'gia-ca', 'phuc-vu', 'khac'][p_size % 4 + 1] AS slug FROM part")
_parser("province_suffixes", "nation", "n_nationkey", lambda: F.concat(F.lit("food in "), F.lower("n_name")), lambda c: [parse.province_suffix(c, ["Nation", "China", "ia"]).alias("province")], "SELECT n_nationkey, CASE WHEN ends_with(lower(n_name), 'nation') THEN 'Nation' WHEN ends_with(lower(n_name), 'china') THEN 'China' WHEN ends_with(lower(n_name), 'ia') THEN 'ia' ELSE '' END AS province FROM nation")


@query("SELECT event_id, json_valid(props) AS ok, len(json_keys(props))::INT AS n_keys FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$").isNotNull().alias("ok"), F.size(F.json_object_keys("props")).alias("n_keys"))


# sources and sinks: written, read again


@query("SELECT doc_id, source, 'r2' AS run_id, n_chars FROM documents")
def stage_rewrite(spark, sf_dir):
    """A stage written twice under one run id holds each row once."""
    root = _work(spark)
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit("r2").alias("run_id"), "n_chars")
    sinks.write_stage(rows, root, "s1")
    sinks.write_stage(rows, root, "s1")
    return sinks.read_stage(spark, root, "s1", "r2").select("doc_id", F.col("source").cast("string").alias("source"), F.col("run_id").cast("string").alias("run_id"), "n_chars")


@query("SELECT conv_id, turn, text FROM conversations")
def json_lines_round_trip(spark, sf_dir):
    path = f"{_work(spark)}/lines"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    sinks.append_lines(rows, path)
    return readers.json_lines(spark, path, T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("text", T.StringType())]))


@query("SELECT conv_id::VARCHAR AS conv_id, role, text FROM conversations")
def csv_round_trip(spark, sf_dir):
    path = f"{_work(spark)}/csv"
    sinks.write_csv(table(spark, sf_dir, "conversations").select("conv_id", "role", "text"), path)
    return readers.csv_table(spark, path)


@query("SELECT p_partkey, p_name, p_size, NULL::VARCHAR AS s_name FROM part UNION ALL SELECT NULL, NULL, NULL, s_name FROM supplier")
def union_of_fields(spark, sf_dir):
    return sinks.union_of_fields(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), table(spark, sf_dir, "supplier").select("s_name"))


# relational forms


@query("SELECT e.event_id, e.user_id, (SELECT max_by(p.value, p.ts) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) AS last_value FROM events e WHERE e.event_type = 'click'")
def as_of_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    bought = e.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("last_value"))
    return relational.as_of(e.filter("event_type = 'click'").select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", ["last_value"]).select("event_id", "user_id", "last_value")


@query("SELECT p_partkey, low FROM part, (SELECT DISTINCT p_size * 40.0 AS low, p_size * 40.0 + 60 AS high FROM part) r WHERE p_retailprice >= low AND p_retailprice < high")
def range_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    r = p.select((F.col("p_size") * 40.0).alias("low")).distinct().withColumn("high", F.col("low") + 60)
    return relational.in_ranges(p, r, "p_retailprice", "low", "high", 100.0).select("p_partkey", F.col("low"))


@query("SELECT event_id, user_id, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM (SELECT event_id, user_id, ts, CASE WHEN coalesce(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 7200, true) THEN 1 ELSE 0 END AS n FROM events)")
def sessionize(spark, sf_dir):
    return relational.sessions(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 7200).select("event_id", "user_id", "session")


@query("SELECT o_orderkey, o_custkey, lag(o_totalprice) OVER w AS previous, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg, (rank() OVER w)::INT AS rank FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def moving_windows(spark, sf_dir):
    return relational.moving(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], "o_orderkey", "o_totalprice", 2).select("o_orderkey", "o_custkey", "previous", "moving_avg", "rank")


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders UNION ALL (SELECT s_suppkey FROM supplier INTERSECT SELECT p_partkey FROM part)")
def set_operations(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").select("o_custkey"))
    return a.unionAll(table(spark, sf_dir, "supplier").select("s_suppkey").intersect(table(spark, sf_dir, "part").select("p_partkey")))


@query("SELECT l_returnflag, sum(l_quantity) AS total FROM lineitem GROUP BY ALL")
def salted_sum(spark, sf_dir):
    return relational.weighted_total(table(spark, sf_dir, "lineitem"), F.col("l_returnflag") == "N", 16, ["l_returnflag"], "l_quantity")


@query("SELECT region, flag, sum(n)::BIGINT AS n, grouping(region, flag)::INT AS level FROM (SELECT r_name AS region, l_returnflag AS flag, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) GROUP BY CUBE (region, flag)")
def star_cube(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    flat = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return flat.cube(F.col("r_name").alias("region"), F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


# streams


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling(spark, sf_dir):
    """All files as a stream, by day; complete as the sink is closed by a last watermark-free batch."""
    static = table(spark, sf_dir, "events")
    path = _work(spark)
    static.write.parquet(f"{path}/in")
    events = stream.files(spark, f"{path}/in", static.schema)
    name = f"t{uuid.uuid4().hex}"
    out = stream.tumbling(events, "ts", ["event_type"], "value", "1 day", delay="60 days").select(F.col("start").cast("timestamp_ntz").alias("day"), "event_type", "n", "total")
    q = out.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{path}/ck").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf_dir):
    static = table(spark, sf_dir, "events")
    path = _work(spark)
    static.select("user_id", "event_type", "ts").coalesce(1).write.parquet(f"{path}/in")
    events = stream.files(spark, f"{path}/in", T.StructType([static.schema[c] for c in ("user_id", "event_type", "ts")]))
    q = stream.to_table(stream.deduplicated(events, ["user_id", "event_type"], "ts", "90 days").select("user_id", "event_type"), f"{path}/out", f"{path}/ck")
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY ALL")
def stream_state(spark, sf_dir):
    static = table(spark, sf_dir, "events").select("user_id", "value")
    path = _work(spark)
    static.coalesce(1).write.parquet(f"{path}/in")
    name = f"t{uuid.uuid4().hex}"
    q = stream.running_totals(stream.files(spark, f"{path}/in", static.schema), "user_id", "value").writeStream.format("memory").queryName(name).option("checkpointLocation", f"{path}/ck").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).groupBy("user_id").agg(F.max("n").alias("n"))
