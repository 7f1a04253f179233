"""Every registered query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tamarack.plans import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def shown(x):
    if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
        return "NULL"
    if isinstance(x, float):
        return str(int(x)) if x.is_integer() else repr(round(x, 9))
    return repr([str(y) for y in x]) if hasattr(x, "__iter__") and not isinstance(x, str) else str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(zip(*[[shown(x) for x in df[c]] for c in df], strict=True))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DIR).toPandas()
    if name in catalog.oracle_sql():
        want = duck.execute(catalog.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0


def test_html_fields_on_odd_pages(spark, tmp_path):
    """References that the SQL leaves as they are, cut ones, no-break spaces, pages without elements and null pages."""
    odd = [None, "", "<title>x</title>", "<li></li>", "<p>no</p>", "<title>a &amp;&amp</title><h1>b&amp;lt; &quot;q &lt;&gt; &nbsp;&copy;\xa0 c</h1>", "<ul><li>a <b>b</b>\n c &amp;</li><li> d\t&#39;e</li></ul>", "<li>x <script>1 && '&quot;'</script></li>"]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    got = catalog.queries()["html_fields"](spark, f"file://{tmp_path}").toPandas()
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = c.execute(catalog.oracle_sql()["html_fields"]).df()
    assert rows(got) == rows(want)


def test_entry_without_the_training_data_part(spark):
    import __spark_entry__ as entry

    assert set(catalog.queries()) <= set(entry.queries())
    assert entry.entry(spark).count() == 3
