"""Small fixtures for the event engine, and every SQL counterpart on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from eventloom.functions import keys, urls
from eventloom.functions import text as T
from eventloom.operators import dedup, graph, market, selection
from eventloom.plans import registry
from eventloom.sources import records

DATA = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, T.normalize_text(F.lit(" A  b\n"))) == "a b"
    assert one(spark, T.first_sentence(F.lit("One. Two."))) == "One."
    assert one(spark, T.norm_date(F.lit("1999-01-01T00"))) == ""
    assert one(spark, T.date_gap_days(F.lit("2025-01-01T00:00:00Z"), F.lit("2025-01-14T12:00:00Z"))) == 14
    assert one(spark, T.days_apart(F.lit("2025-01-01"), F.lit("2025/01/05"))) == 999
    assert one(spark, T.skeleton(F.lit("Acme Corp cuts 300 jobs"))) == "@ cuts # jobs"
    assert T.set_ratio("a b c", "c b a d") == 100.0 and T.set_ratio("", "a") == 0.0
    assert one(spark, T.case_id(F.lit("x"), F.lit(None), F.lit("E1"))) == "MACRO_E1"


def test_urls(spark):
    u = F.lit("HTTPS://X.com/a/?utm_source=f&b=2&a=1#t")
    assert one(spark, urls.normalize_url(u)) == "https://x.com/a?a=1&b=2"
    assert one(spark, urls.normalize_url(F.lit("ftp://x"))) is None
    assert one(spark, urls.reject_reason(F.lit(""))) == "missing_url"
    assert one(spark, urls.reject_reason(F.lit("https://x.com/sitemap.xml"))) == "sitemap_url"
    assert one(spark, urls.reject_reason(F.lit("https://x.com/my-sitemap-guide"))) is None
    assert one(spark, urls.reject_reason(F.lit("https://x.com/a?Limit="))) == "feed_or_list_query"
    assert one(spark, urls.normalize_url(F.lit("http://x.com//?b&a=%7E+%2A%zz&a=1=2"))) == "http://x.com?a=1%3D2&a=~+%2A%25zz&b="


def test_titles_and_names(spark):
    assert one(spark, T.skeleton(F.lit('"Sale", says A&B/C: Acme Corp\'s (300) UP'))) == "@ says a&b/c @ # @"
    assert one(spark, T.subjects(F.lit("Acme, Beta rise"))) == "acme beta"
    pattern = lambda x: one(spark, T.title_pattern(F.lit(x)))
    assert [pattern(x) for x in ("Ionis Pharmaceuticals, Inc.", "Big Red Dog Group Holdings", "AT&T Inc", "Inc", "Acme Trust")] == ["Ionis", r"Big\s+Red", r"AT\&T", "", r"Acme\s+Trust"]
    assert one(spark, T.literal_dict(F.lit("""{'a': "it's", 'b': None}""")))["a"] == "it's"


def test_ingest_rejects_and_keys(spark):
    good = '{"_id":"1","businessCode":"US_NEWS","type":1,"title":"T","content":"<p>Body</p>","ctime":1700000000}'
    rows = [("f", 1, good), ("f", 2, "{bad"), ("f", 3, "[1]"), ("f", 4, '{"businessCode":"US_NEWS"}'), ("f", 5, good.replace("<p>Body</p>", "")), ("f", 6, good.replace("1700000000", "0"))]
    out = records.transform(spark.createDataFrame(rows, "file string, line_no int, raw string"))
    got = {r["line_no"]: r["reject_reason"] for r in out.collect()}
    assert got == {1: None, 2: "invalid_json", 3: "invalid_record", 4: "missing_id", 5: "empty_body", 6: "missing_published_at"}
    key = out.filter("line_no = 1").select(keys.dedup_key(F.col).alias("d")).first()["d"]
    assert key["method"] == "content_hash" and key["key"].startswith("hash:sha256:")


def test_exact_dedup_keeps_longest(spark):
    rows = [("a", "k", 5), ("b", "k", 9), ("c", "m", 1), ("c", "m", 3)]
    df = spark.createDataFrame(rows, "id string, dedup_key string, body_len int").withColumns({"dedup_method": F.lit("x"), "published_at": F.lit("t"), "batch": F.lit("b"), "line_no": F.col("body_len")})
    winners, losers = dedup.exact(df)
    assert {r["id"] for r in winners.collect()} == {"b", "c"}
    assert sorted((r["id"], r["canonical_id"], r["method"]) for r in losers.collect()) == [("a", "b", "x"), ("c", "c", "id")]


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8)], "a long, b long")
    assert {r["node"]: r["comp"] for r in graph.components(edges).collect()} == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8}


def test_base_session_and_cap(spark):
    panel = spark.createDataFrame([("S", f"2025-01-0{i}", 1.0, float(i)) for i in range(1, 6)], "symbol string, date string, open double, close double")
    ev = spark.createDataFrame([(1, "S", "2025-01-03", "pre_market"), (2, "S", "2025-01-03", "after"), (3, "S", "2025-01-01", "pre_market")], "event_id long, symbol string, event_date string, bucket string")
    assert {r["event_id"]: r["date"] for r in market.base_sessions(ev, panel).collect()} == {1: "2025-01-02", 2: "2025-01-03"}
    rows = spark.createDataFrame([(1, 3, 1.0, ["A"]), (2, 4, 1.0, ["A"]), (3, 3, 1.0, [])], "event_id long, significance int, score double, primary_symbols array<string>")
    assert {r["event_id"] for r in selection.cap_by_symbol(rows, 1).collect()} == {2, 3}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = registry.queries()[name](spark, DATA).toPandas()
    want = con.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(df):
        cells = lambda x: "" if x is None or x != x else repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
        return sorted(tuple(map(cells, r)) for r in df[sorted(df.columns)].astype(object).values.tolist())

    assert rows(got) == rows(want)
