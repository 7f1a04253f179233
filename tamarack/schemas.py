"""Tables as Spark types. Fields are nullable; names without a type of their own are strings."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    **dict.fromkeys(("rating", "score", "confidence_score", "confidence", "rating_avg", "rating_quality", "rating_price", "rating_service", "rating_space", "rating_location", "lat", "lng", "match_score"), T.DoubleType()),
    **dict.fromkeys(("sentence_idx", "label_id", "clause_idx", "aspect_char_start", "aspect_char_end", "rank", "images_downloaded", "review_count", "duration_min"), T.IntegerType()),
    **dict.fromkeys(("price_min", "price_max", "price_vnd", "view_count", "like_count", "comment_count", "share_count", "rows_in", "rows_out"), T.LongType()),
    **dict.fromkeys(("aspect_negated", "negation_applied"), T.BooleanType()),
    **dict.fromkeys(("quarantine_reasons", "hashtags", "missing_fields", "original_image_urls", "local_image_paths"), T.ArrayType(T.StringType())),
}
_S2 = "source comment_id place_id place_name sentence_id sentence_hash sentence_text sentence_idx rating run_id processed_at"
_S3 = _S2.replace(" run_id", " label score label_id model_version run_id")
TABLES = {
    "s1_comments": "source comment_id place_id place_name raw_text normalized_text rating collected_at meta run_id processed_at",
    "s2_sentences": _S2,
    "s3_predictions": _S3,
    "s4_final": _S3,
    "quarantine": _S3 + " quarantine_reasons",
    "s6_aspects": "source comment_id place_id place_name sentence_id sentence_hash sentence_text sentence_idx aspect aspect_keyword aspect_negated clause_idx clause_text segment_text segment_hash segment_type aspect_char_start aspect_char_end negation_applied rating run_id processed_at",
    "s7_absa": "record_id entity_id source sentence aspect sentiment confidence_score platform created_at comment_id sentence_id sentence_hash sentence_idx clause_idx segment_text segment_hash segment_type negation_applied aspect_keyword aspect_negated rating model_version run_id processed_at",
    "ml_absa": "record_id entity_id source sentence aspect sentiment confidence_score platform created_at",
    "foody_raw": "name entity_type province address district city rating_avg rating_quality rating_price rating_service rating_space rating_location review_count open_time close_time price_min price_max lat lng source_url source",
    "transport_raw": "origin destination operator_name transport_type vehicle_type departure_time arrival_time duration_min price_vnd crawl_date source source_url",
    "entity_candidates": "name entity_type province source_url rank source",
    "entity_mapped": "name entity_type province source_url rank source name_vn name_en source_url_en match_score",
    "social_bronze": "record_id platform data_type content_raw location_province location_place category engagement_like engagement_comment engagement_share rating scraped_at",
}


def fields(name: str) -> list[str]:
    return TABLES[name].split()


def struct(name: str) -> T.StructType:
    return T.StructType([T.StructField(f, _KINDS.get(f, T.StringType())) for f in fields(name)])


def _nested(spec: str, **inner: T.DataType) -> T.StructType:
    """``name:kind`` words; kinds not known here are given by name."""
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "b": T.BooleanType(), "texts": T.ArrayType(T.StringType()), **inner}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (w.split(":") for w in spec.split())])


_REVIEW = _nested("index:i key_review:s detail_review:s")
_IMAGE = _nested("index:i original_url:s thumbnail_url:s downloaded:b local_path:s bytes_original:l bytes_compressed:l width:i height:i")
TRIPADVISOR_RAW = _nested(
    "record_id:s entity_name:s entity_type:s province:s rank:i source_url:s source:s rating:s images:images original_image_urls:texts key_review:s detail_review:s reviews:reviews status:s scraped_at:s",
    images=T.ArrayType(_IMAGE), reviews=T.ArrayType(_REVIEW),
)
_COMMENT = _nested("cid:s comment_id:s text:s content:s create_time:s createTime:s author:s like_count:l")
TIKTOK_RAW = _nested("aweme_id:s video_id:s desc:s description:s title:s comments:comments", comments=T.ArrayType(_COMMENT))
