"""Plans: what must not appear in them, and what must."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tamarack.operators import entities, relational
from tamarack.plans import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentences_need_no_shuffle(spark):
    p = plan(catalog.s2(spark, DIR).select("sentence_hash"))
    assert p.count("Exchange hashpartitioning") <= 2 and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "ArrowEvalPython" not in p


def test_segments_stay_in_the_jvm(spark):
    p = plan(catalog.s6(spark, DIR))
    assert "Python" not in p and "NestedLoop" not in p and "Window" not in p


def test_columns_and_filters_reach_the_scan(spark):
    p = plan(catalog.table(spark, DIR, "documents").filter(F.col("lang") == "en").groupBy("source").count())
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p and "ReadSchema: struct<lang:string,source:string>" in p


def test_range_and_as_of_joins_compare_within_keys(spark):
    a = spark.createDataFrame([(1, 5.0), (2, 15.0), (3, 25.0)], "id int, v double")
    r = spark.createDataFrame([(0.0, 10.0), (4.0, 16.0)], "lo double, hi double")
    out = relational.in_ranges(a, r, "v", "lo", "hi", 7.0)
    assert sorted((x["id"], x["lo"]) for x in out.collect()) == [(1, 0.0), (1, 4.0), (2, 4.0)] and "NestedLoop" not in plan(out)
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50)], "k string, t int, v int")
    assert sorted((x["k"], x["t"], x["v"]) for x in relational.as_of(left, right, ["k"], "t", ["v"]).collect()) == [("a", 1, None), ("a", 5, 50), ("b", 9, None)]


def test_numbers_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(7)
    got = {r["x"]: r["n"] for r in entities.numbered(df, "x").collect()}
    assert got == {x: x + 1 for x in range(1000)}


def test_scores_read_their_input_once(spark):
    p = plan(catalog.s7(spark, DIR))
    assert p.count("FileScan") + p.count("Scan parquet") <= 2 * 2 and p.count("documents.parquet") == plan(catalog.s6(spark, DIR)).count("documents.parquet") and "Python" not in p


def test_medians_are_exact_in_ranges(spark):
    import random
    import statistics

    from tamarack.operators import clean

    draw = random.Random(4)
    for own in ([1.0], [1.0, 2.0], [5.0] * 9 + [-1e9, 1e9], [draw.gauss(0, 1) for _ in range(501)], [round(draw.expovariate(1), 2) for _ in range(400)], [-1.7e308, 1.7e308, 3.0]):
        df = spark.createDataFrame([(x,) for x in own] + [(None,), (float("nan"),)], "x double")
        assert clean.exact_median(df, "x") == pytest.approx(statistics.median(own), rel=1e-15)
        ordered = sorted(own)
        values = df.select(F.col("x").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
        assert all(clean._ranked(values, k, ordered[0], ordered[-1], 4, 3) == ordered[k] for k in {0, len(own) // 3, len(own) - 1})
    assert clean.exact_median(spark.createDataFrame([(None,)], "x double"), "x") is None


def test_pruned_names_lose_no_match(spark):
    import random

    from test_operators import plain_ratio

    draw = random.Random(6)
    name = lambda: " ".join("".join(draw.choice("abcáo") for _ in range(draw.randrange(0, 6))) for _ in range(draw.randrange(1, 4))).strip()
    left = [(i, name(), f"p{i % 3}") for i in range(60)]
    right = [(i, name(), f"p{i % 3}", f"u{i}") for i in range(80)]
    got = {r["ord"]: (r["source_url_en"], round(r["match_score"], 4)) for r in entities.best_matches(spark.createDataFrame(left, "ord int, name string, province string"), spark.createDataFrame(right, "ord int, name string, province string, source_url string"), 60.0).collect()}
    for i, a, p in left:
        scored = [(-round(plain_ratio(a, b), 6), j, u) for j, b, q, u in right if q == p and round(plain_ratio(a, b), 6) >= 60]
        best = min(scored, default=(0.0, 0, None))
        assert got[i] == (best[2], round(-best[0], 4)), (a, best)


def test_names_are_compared_in_trees(spark, monkeypatch):
    """No pair of names is a row, and neither parts nor long names change a match."""
    from tamarack.operators import names
    from test_operators import plain_ratio

    monkeypatch.setattr(names, "PART", 70)
    monkeypatch.setattr(names, "SHARE", 10)
    monkeypatch.setattr(names, "CELLS", 1500)
    left = [(i, f"Supplier#{i * 37:06d}" if i % 5 else "", "p") for i in range(40)] + [(40, "a\x00b " * 20, "p"), (41, "Supplier#000001", None), (42, "Supplier#000001", "q")]
    right = [(i, f"Customer#{i * 911 % 10000:06d}", "p", f"u{i}") for i in range(300)] + [(300, "a\x00b " * 19 + "c", "p", "long"), (301, " ", "p", "blank"), (302, "Supplier#000001", None, "none")]
    got = entities.best_matches(spark.createDataFrame(left, "ord int, name string, province string"), spark.createDataFrame(right, "ord int, name string, province string, source_url string"), 30.0)
    p = plan(got)
    assert "MapInArrow" in p and "ArrowEvalPython" not in p and "NestedLoop" not in p
    for r in got.collect():
        scored = [(-round(plain_ratio(r["name"].lower(), b.lower()), 6), j, u) for j, b, q, u in right if q is not None and q == r["province"]]
        best = min((x for x in scored if x[0] <= -30), default=(0.0, 0, None))
        assert (r["source_url_en"], round(r["match_score"], 4)) == (best[2], round(-best[0], 4)), r


ON_A_CLUSTER = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
conf = {"spark.master": "local-cluster[1,1,1024]", "spark.executor.memory": "600m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": "file://" + sys.argv[3] + "/shared", "spark.sql.warehouse.dir": sys.argv[3] + "/warehouse"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
for r in sorted(entry.queries()["jdbc_round_trip"](spark, sys.argv[2]).collect()):
    print("ROW", *r, sep="|")
spark.stop()
"""


def test_jdbc_round_trip_with_executors_apart(tmp_path):
    """The database is in the driver's memory; executors of their own must not be asked for it."""
    import duckdb
    import pyspark

    home, top = tmp_path / "home", os.path.dirname(pyspark.__file__)
    (home / "work").mkdir(parents=True)
    for name in set(os.listdir(top)) - {"work"}:
        (home / name).symlink_to(f"{top}/{name}")
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    run = subprocess.run([sys.executable, "-c", ON_A_CLUSTER, os.path.dirname(os.path.dirname(os.path.abspath(__file__))), DIR, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240)
    got = [tuple(x.split("|")[1:]) for x in run.stdout.splitlines() if x.startswith("ROW")]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW supplier AS SELECT * FROM '{DIR}/supplier.parquet'")
    assert got == [tuple(map(str, r)) for r in sorted(duck.execute(catalog.oracle_sql()["jdbc_round_trip"]).fetchall())], run.stderr[-2000:]
