import pytest
from pyspark.sql import functions as F

from tamarack.config import PipelineConfig, QualityConfig
from tamarack.functions import parse
from tamarack.operators import absa, clean, entities, metrics, quality, scoring
from tamarack.plans import pipeline
from tamarack.sources import adapters, readers, sinks
from tamarack.schemas import TRIPADVISOR_RAW, fields, struct


def val(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(("f", "raw", "want"), [
    (parse.parse_rating, "4,5", 4.5), (parse.parse_rating, "9,0", None), (parse.parse_rating, "N/A", None), (parse.parse_rating, None, None), (parse.to_float, "_._", None), (parse.to_int, "1,459", 1459),
    (parse.parse_count, "1,2K", 1200), (parse.parse_count, "3.5M views", 3500000), (parse.parse_count, "12 345", 12345), (parse.parse_count, "", None), (parse.parse_count_rounded, "1,2K", 1000),
    (parse.parse_price, "08:55 Đông Hà", 55), (parse.parse_price, "2.045.600đ", 2045600), (parse.parse_duration, "3h25", 180), (parse.parse_duration, "6h 40p", 400), (parse.parse_duration, "90", 90), (parse.is_time, "5:30", True), (parse.is_time, None, False),
    (parse.norm_url, " https://x/A#REVIEWS", "https://x/A"), (parse.normalize_path, "/(S(abc))/ha-noi/x", "/ha-noi/x"), (parse.normalize_path, "//a", "/a"), (parse.province_slug, "https://f.vn/ho-chi-minh/food", "ho-chi-minh"),
    (parse.upgrade_photo, "https://x/media/photo-s/1/n.jpg", "https://x/media/photo-o/1/n.jpg"), (parse.srcset_last, "a 1x, b 2x", "b"), (parse.video_id, "https://t/video/12?x", "12"), (parse.hashtags, "a #x #y #x", "#x|#y"), (parse.rating_field, "Giá cả", "rating_price"), (parse.comment_residue, "xem thích thật 11-02 2024", "xem thích thật"), (parse.comment_residue, "Reply", None),
])
def test_parsers(spark, f, raw, want):
    assert val(spark, raw, f) == want


def test_struct_parsers(spark):
    assert tuple(val(spark, "Mở từ 07:15 - 19:45", parse.opening_hours)) == ("07:15", "19:45")
    assert tuple(val(spark, "35.000đ - 85.000đ", parse.price_range)) == (35000, 85000)
    assert tuple(val(spark, "15k - 40k", parse.price_range)) == (15000, 40000)
    assert tuple(val(spark, "5 Ngõ Gạch, tầng 2, Quận Tây, TP. Mới", parse.address)) == ("5 Ngõ Gạch, tầng 2", "Quận Tây", "TP. Mới")
    assert tuple(val(spark, "x", parse.address)) == ("x", "", "")
    card = val(spark, "19:20  Ga Bắc  6h 40p  02:00  Ga Nam  Tàu SE31  Giường nằm Từ 512K", parse.train_card)
    assert (card["operator_name"], card["price_vnd"], card["duration_min"]) == ("Tàu SE31", 512000, 400)
    assert parse.parse_index_tokens(["0-4", "9"], 10) == [0, 1, 2, 3, 4, 9] and parse.parse_index_tokens(["9-5"], 10) == [5, 6, 7, 8, 9]
    for bad in (["x"], ["12"]):
        with pytest.raises(IndexError):
            parse.parse_index_tokens(bad, 10)
    assert readers.detect_delimiter("a;b;c,d") == ";" and readers.detect_delimiter("a") == "\t"


def test_adapters(spark):
    raw = spark.createDataFrame([("1", "P", "4.5", [(1, "", ""), (2, "Valid", "Good")]), ("2", "Q", "x", [(None, "Key", "")])], "record_id string, entity_name string, rating string, reviews array<struct<index:int,key_review:string,detail_review:string>>")
    got = adapters.comments(raw, "tripadvisor").orderBy("place_id").collect()
    assert [(r["comment_id"], r["raw_text"], r["rating"]) for r in got] == [("2", "Good", 4.5), ("ta_2_0", "Key", None)]
    tok = spark.createDataFrame([("v", "D", [("c1", "Quay đẹp thật!"), (None, "x"), ("c3", "")])], "video_id string, description string, comments array<struct<comment_id:string,text:string>>")
    assert [(r["comment_id"], r["place_name"]) for r in adapters.comments(tok, "tiktok").collect()] == [("c1", "D"), ("tt_v_1", "D")]
    with pytest.raises(ValueError):
        adapters.comments(tok, "foody")
    assert struct("s2_sentences").names == fields("s2_sentences") and TRIPADVISOR_RAW["reviews"] is not None


def test_quality_reasons(spark):
    base = "sentence_id string, sentence_text string, sentence_hash string, label string, score double, label_id int"
    df = spark.createDataFrame([("a", "text one", "h", "positive", 0.9, 2), ("b", "ok", "h", "odd", 0.1, 2), ("c", "", "h", "neutral", 1.5, 1), ("d", None, None, None, None, None)], base)
    got = {r["sentence_id"]: r["quarantine_reasons"] for r in quality.judged(df).collect()}
    assert got["a"] == [] and got["b"] == ["TOO_SHORT", "INVALID_LABEL", "LOW_CONFIDENCE"] and got["c"] == ["MISSING_FIELDS", "EMPTY_TEXT", "HIGH_CONFIDENCE"]
    assert got["d"] == ["MISSING_FIELDS"] * 5 + ["EMPTY_TEXT", "INVALID_LABEL"]
    good, bad = quality.split(df)
    assert good.count() + bad.count() == 4 and "quarantine_reasons" not in good.columns
    only = spark.createDataFrame([("a",)], "sentence_id string")
    assert quality.judged(only).first()["quarantine_reasons"] == ["MISSING_FIELDS"] * 5 + ["EMPTY_TEXT", "INVALID_LABEL"]
    m = metrics.compute(quality.judged(df)).first()
    assert (m["total"], m["valid"], m["quarantine_rate"], m["positive_count"]) == (4, 1, 0.75, 1)
    assert quality.warnings({"negative": 0.0, "neutral": 0.5, "positive": 0.5}, set(), 1, 1.0, QualityConfig()) == ["label negative: 0.0000 of the rows"]
    empty = metrics.compute(quality.judged(df.limit(0))).first()
    assert (empty["total"], empty["quarantine_rate"], empty["avg_score"]) == (0, 0.0, 0.0)


def test_negation_turns_labels(spark):
    rows = spark.createDataFrame([("positive", True), ("negative", True), ("neutral", True), ("positive", False), ("positive", None)], "l string, n boolean")
    a, b = scoring.apply_negation(F.col("l"), F.col("n"))
    assert [tuple(r) for r in rows.select(a, b).collect()] == [("negative", True), ("positive", True), ("neutral", False), ("positive", False), ("positive", False)]
    pairs = absa.from_clauses(spark.createDataFrame([(["a", "b", "c"], ["x", "y"])], "t array<string>, l array<string>"), "t", "l").collect()
    assert [(r["clause_text"], r["sentiment"]) for r in pairs] == [("a", "x"), ("b", "y")]


def test_clean(spark):
    df = spark.createDataFrame([(" a ", ["", " x "], (" ", None)), ("", [], ("", "")), (None, None, None)], "s string, l array<string>, r struct<p:string,q:string>")
    got = clean.cleaned(df).collect()
    assert len(got) == 1 and got[0]["s"] == "a" and got[0]["l"] == ["x"] and got[0]["r"] is None
    n = spark.createDataFrame([(1.0,), (4.0,), (None,)], "v double")
    assert sorted(r["v"] for r in clean.median_imputed(n, ["v"]).collect()) == [1.0, 2.5, 4.0]


def plain_ratio(a, b):
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            t[i + 1][j + 1] = t[i][j] + 1 if x[i] == y[j] else max(t[i][j + 1], t[i + 1][j])
    return 100.0 if not x + y else 200 * t[-1][-1] / (len(x) + len(y))


def test_entities(spark):
    left = spark.createDataFrame([(1, "Chùa Ba Mái", "Hanoi"), (2, "Zzz", "Hanoi"), (3, "Hồ Tây", "Hue")], "ord int, name string, province string")
    right = spark.createDataFrame([(1, "Mái Ba", "Hanoi", "u1"), (2, "ba mái", "Hanoi", "u2"), (3, "Tây", "Hanoi", "u3")], "ord int, name string, province string, source_url string")
    got = {r["ord"]: (r["name_en"], r["match_score"]) for r in entities.best_matches(left, right).collect()}
    assert got == {1: ("Mái Ba", 100.0), 2: (None, 0.0), 3: (None, 0.0)}
    for a, b in (("hello world", "yellow"), ("", ""), ("a", ""), ("x y", "y x")):
        x = spark.createDataFrame([(a, b)], "a string, b string").select(entities.token_sort_ratio(F.col("a"), F.col("b")).alias("r")).first()["r"]
        assert abs(x - plain_ratio(a, b)) < 1e-5
    assert val(spark, "Di tích chùa Cả", entities.normalize_name) == "cả"
    assert val(spark, "see Big Town now", entities.masked) == "see <ENTITY> now" and val(spark, "the hotel", entities.entity_type) == "HOTEL"
    marks = spark.createDataFrame([(i, x) for i, x in enumerate("abScdEfS")], "i int, x string")
    assert [r["x"] for r in entities.between_marks(marks, "i", F.col("x") == "S", F.col("x") == "E").orderBy("i").collect()] == list("Scd")


def test_pipeline_and_sinks(spark, tmp_path):
    raw = spark.createDataFrame([("1", "P", "5", [(1, "", "Bánh giòn, trà thơm. Chủ quán vui tính! Bánh giòn, trà thơm."), (2, "", "Ghế hơi cứng. Đợi khá lâu.")])], "record_id string, entity_name string, rating string, reviews array<struct<index:int,key_review:string,detail_review:string>>")
    cfg = PipelineConfig(output_root=f"file://{tmp_path}/out")
    for _ in range(2):  # the second run replaces the first
        out = pipeline.run(spark, "tripadvisor", "r1", cfg, adapters.comments(raw, "tripadvisor"))
        assert out["status"] == "ok", out
    s2 = sinks.read_stage(spark, cfg.output_root, "s2_sentences", "r1")
    assert s2.count() == 4 and s2.select("comment_id", "sentence_hash").distinct().count() == 4
    s7 = sinks.read_stage(spark, cfg.output_root, "s7_absa", "r1", "tripadvisor")
    assert s7.count() > 0 and set(s7.columns) == set(fields("s7_absa"))
    assert sinks.read_log(spark, cfg.output_root, "r1").count() == 14
    assert readers.exists(spark, f"{cfg.output_root}/reports/latest_quality.json")
    assert pipeline.bootstrap(spark, "")["status"] == "skipped"
    with pytest.raises(FileNotFoundError):
        readers.required(spark, f"{cfg.output_root}/none")


def test_csv_sources(spark, tmp_path):
    (tmp_path / "k.csv").write_text("\ufeffSTT;province;Key_word\n1;;ăn ở Hà Nội\n2;Huế;a;b\n", encoding="utf-8")
    got = {r["keyword"]: (r["province"], r["category"]) for r in readers.keyword_csv(spark, f"file://{tmp_path}/k.csv", ["Hà Nội", "Nội"]).collect()}
    assert got == {"ăn ở Hà Nội": ("Hà Nội", "travel"), "a;b": ("Huế", "travel")}
    (tmp_path / "r.csv").write_text("\ufefforigin,destination,url,transport_type\nA,B,u,Flight\nA,,u,bus\nC,D,v,boat\n", encoding="utf-8")
    assert [(r["origin"], r["transport_type"]) for r in readers.routes(spark, f"file://{tmp_path}/r.csv").collect()] == [("A", "flight"), ("C", "bus")]
    (tmp_path / "p.yaml").write_text("provinces:\n  - name: Da Nang\n    code: DN\n", encoding="utf-8")
    assert readers.lookup(spark, f"file://{tmp_path}/p.yaml", "provinces", "name string, code string").first()["code"] == "DN"
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    assert readers.json_lines(spark, f"file://{tmp_path}/x.jsonl", struct("ml_absa").add("a", __import__("pyspark").sql.types.IntegerType())).count() == 2


def test_ner_dataset(spark):
    import re

    from tamarack.operators import gold

    texts = ["We saw Big Town and Old Port, then Big Town again.", "none here", "", None, "Ab Cd Ef Gh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = sorted((i, m[0], m.start(), m.end()) for i, t in enumerate(texts) for m in re.finditer("[A-Z][a-z]+ [A-Z][a-z]+", t or ""))
    assert sorted((r["i"], r["entity"], r["start"], r["end"]) for r in gold.ner_dataset(df, "t").collect()) == want


def test_sentence_provider_falls_back(spark):
    from tamarack.functions import text

    def load():
        def split(t):
            if "bad" in t:
                raise RuntimeError("no model")
            return [] if "none" in t else [f" {t}! ", "ab"]

        return split

    df = spark.createDataFrame([(1, "Good one. Two of it."), (2, "A bad one. Two of it."), (3, "None: none. Two of it."), (4, None), (5, "")], "i int, t string")
    got = {r["i"]: r["sentences"] for r in text.with_sentences(df, "t", load, "test").collect()}
    assert got == {1: ["Good one. Two of it.!"], 2: ["A bad one", "Two of it"], 3: ["None: none", "Two of it"], 4: [], 5: []}


def test_reports_are_replaced_as_a_whole(spark, tmp_path):
    path = f"file://{tmp_path}/r.json"
    for text in ("one", "two: é"):
        sinks.write_text(spark, path, text)
        assert (tmp_path / "r.json").read_text(encoding="utf-8") == text
    assert [f for f in __import__("os").listdir(tmp_path) if f.endswith(".tmp")] == []


def test_asset_order(spark):
    from tamarack.plans import assets

    order = assets.order(["gold_aspect_sentiment"], {"records", "config"})
    assert order == ["bronze_tripadvisor", "silver_tripadvisor", "sentences", "absa_result", "gold_aspect_sentiment"]
    with pytest.raises(ValueError):
        assets.order(["gold_aspect_sentiment"], {"config"})


def test_model_scores_are_joined_by_key(spark):
    """A model sees each key once; an expression scores in place; both give the same."""
    from tamarack.operators.absa import stub

    df = spark.createDataFrame([("k1", "one"), ("k2", "two"), ("k1", "one"), ("k3", None)], "k string, t string")
    plain = lambda d: sorted((r["k"], r["label"], round(r["score"], 6)) for r in d.collect())
    assert plain(scoring.score_distinct(df, "k", F.col("t"), stub)) == plain(scoring.score_distinct(df, "k", F.col("t"), lambda d: scoring.with_stub(d, "_text")))


def test_warnings_reach_the_report(spark, tmp_path):
    import json
    from dataclasses import replace

    raw = spark.createDataFrame([("1", "P", "5", [(1, "", "Bánh giòn, trà thơm. Chủ quán vui tính!")])], "record_id string, entity_name string, rating string, reviews array<struct<index:int,key_review:string,detail_review:string>>")
    cfg = PipelineConfig(output_root=f"file://{tmp_path}/out")
    cfg = replace(cfg, quality=replace(cfg.quality, required_aspects=("price",), min_aspect_coverage=1.01, label_distribution_min_pct=0.01))
    assert pipeline.run(spark, "tripadvisor", "r1", cfg, adapters.comments(raw, "tripadvisor"))["status"] == "ok"
    report = json.loads((tmp_path / "out/reports/latest_absa.json").read_text(encoding="utf-8"))
    assert "aspect price: no row" in report["warnings"] and any(w.startswith("aspect coverage") for w in report["warnings"]) and any(w.startswith("label ") for w in report["warnings"])
    assert any(w.startswith("label ") for w in json.loads((tmp_path / "out/reports/latest_quality.json").read_text(encoding="utf-8"))["warnings"])
