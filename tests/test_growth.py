"""Steps that must not move more rows, or do more work, than their input grows by."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import assembly, cluster, dedup, market
from eventloom.operators.graph import components
from eventloom.plans import registry
from eventloom.session import settle

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def bars(spark, n, symbols=("A",)):
    days = spark.range(n).select(F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("date"), F.col("id").cast("double").alias("x"))
    return days.crossJoin(spark.createDataFrame([(s,) for s in symbols], "symbol string")).select("symbol", "date", *[(F.col("x") + 1).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("long").alias("volume"))


def test_windows_are_listed_for_bases_alone(spark):
    panel = bars(spark, 120, ("A", "B"))
    labelled = spark.createDataFrame([(1, "A", "2025-02-15"), (2, "A", "2025-02-20"), (3, "A", "2025-02-15"), (4, "A", "2025-01-03")], "event_id long, symbol string, base_close_date string")
    w = market.price_windows(labelled, panel)
    got = {r["event_id"]: ([b["date"] for b in r["model_input"]], [b["date"] for b in r["label_audit"]]) for r in w.collect()}
    days = [r["date"] for r in panel.filter("symbol = 'A'").orderBy("date").collect()]
    for e, base in ((1, "2025-02-15"), (2, "2025-02-20"), (3, "2025-02-15"), (4, "2025-01-03")):
        k = days.index(base)
        assert got[e] == (days[max(k - 14, 0) : k + 1], days[k + 1 : k + 21])
    below = "".join(plan(w).split("collect_list")[-1].split("\n")[1:3])  # what the lists are made of
    assert "Filter" in below and "near" in below


def test_base_sessions_move_once(spark):
    ev = spark.createDataFrame([(1, "A", "2025-02-15", "after"), (2, "A", "2025-02-15", "pre_market"), (3, "B", "2024-01-01", "after"), (4, "Z", "2025-02-15", "after"), (5, None, "2025-02-15", "after")], "event_id long, symbol string, event_date string, bucket string")
    found = market.base_sessions(ev, bars(spark, 120, ("A", "B")).localCheckpoint())
    assert {r["event_id"]: (r["date"], r["first_date"], r["date_5d"]) for r in found.collect()} == {1: ("2025-02-15", "2025-02-16", "2025-02-20"), 2: ("2025-02-14", "2025-02-15", "2025-02-19")}
    assert found._jdf.queryExecution().sparkPlan().toString().count("RepartitionByExpression") == 0
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2


def test_labels_are_worked_out_once_for_unpriced(spark):
    q = registry.queries()["c15_unpriced"](spark, DATA)
    assert plan(q).count("last(") == 1  # the as-of step of labels
    known = spark.createDataFrame([(1, "A"), (2, "B"), (None, "A")], "event_id long, symbol string")
    ev = spark.createDataFrame([(1, "A"), (1, "C"), (1, "C"), (1, None), (3, "A"), (None, "X")], "event_id long, symbol string")
    assert {(r["event_id"], r["symbol"]) for r in market.unpriced(ev, known).collect()} == {(1, "C"), (1, None)}


@pytest.mark.parametrize("name", ["c18_cases", "c18_summary"])
def test_cases_move_no_bars_that_nobody_reads(spark, name):
    assert "model_input_ohlcv" not in plan(registry.queries()[name](spark, DATA))


def test_cases_tell_unsound_bars(spark):
    one = lambda close, n=20: f"transform(sequence(1, {n}), i -> named_struct('date', '2025-01-01', 'open', 1.0D, 'high', 1.0D, 'low', 1.0D, 'close', {close}, 'volume', 1L))"
    rows = [f"SELECT {e} AS event_id, '{s}' AS symbol, {one('1.0D', 15)} AS model_input, {one(*audit)} AS label_audit" for e, s, audit in (
        (1, "A", ("1.0D",)), (1, "B", ("1.0D",)), (1, "C", ("1.0D",)), (2, "A", ("1.0D",)), (2, "B", ("1.0D",)), (3, "A", ("1.0D",)), (3, "B", ("0.0D",)), (3, "C", ("1.0D",)),
        (4, "A", ("1.0D",)), (4, "B", ("1.0D",)), (4, "c", ("1.0D",)), (5, "A", ("1.0D", 19)), (5, "B", ("1.0D",)), (5, "C", ("1.0D",)), (6, "A", ("CAST(NULL AS DOUBLE)",)), (6, "B", ("1.0D",)), (6, "C", ("1.0D",)),
    )]
    got = assembly.priced_bars(spark.sql(" UNION ALL ".join(rows)))
    assert {r["event_id"]: r["priced"] for r in got.collect()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    assert len(got.filter("event_id = 1").first()["bars"]["A"]["label_audit_ohlcv_adjusted_daily"]) == 20


def test_shared_tokens_are_counted_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sets = [sorted(set(rng.integers(0, 60, rng.integers(0, 30)).tolist())) for _ in range(40)]
    codes, row = np.array([t for s in sets for t in s]), np.array([i for i, s in enumerate(sets) for _ in s])
    want = [[len(set(a) & set(b)) for b in sets[15:]] for a in sets]
    for columns in (4096, 7):
        monkeypatch.setattr(cluster, "COLUMNS", columns)
        got = cluster.shared_counts(codes, row, 40, 15, 60)
        assert all(got[i, j] == want[i][j] for i in range(40) for j in range(25) if i != j + 15)
    assert "array_intersect" not in plan(registry.queries()["j08_band_pairs"](spark, DATA))  # no pair is a row before it is compared


def test_edges_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4)], "a long, b long").mapInArrow(count, "a long, b long")
    assert {r["node"]: r["comp"] for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert seen.value == 3


def test_reactions_by_blocks_of_days(spark):
    symbols = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (3, "A"), (4, "A")], "event_id long, sym string")
    stats = spark.createDataFrame([(1, 2, "2025-01-10"), (2, 5, "1969-12-28"), (3, 1, "2025-01-10"), (4, 2, None)], "event_id long, n_articles long, peak_date string")
    docs = [("A", 10, "2025-01-08"), ("A", 11, "2025-01-09"), ("A", 12, "2025-01-17"), ("A", 13, "2025-01-18"), ("B", 12, "2025-01-11"), ("B", 14, "2025-01-12"), ("C", 15, "2025-01-10"), ("A", 16, "1969-12-27"), ("A", 17, "1970-01-04"), ("A", 18, "1970-01-05")]
    hits = cluster.corroboration(symbols, stats, spark.createDataFrame(docs, "sym string, doc_id long, d string"))
    assert {r["event_id"]: r["n_v2_reactions"] for r in hits.collect()} == {1: 3, 2: 2}
    assert "date_sub" not in plan(hits) and "block" in plan(hits)  # no row for each day of a window


def test_stats_are_worked_out_once(spark):
    assert plan(registry.queries()["c10_scored_candidates"](spark, DATA)).count("mode(") == 0  # they are a table by then


def test_blank_and_missing_texts_as_in_sql(spark, tmp_path):
    con = duckdb.connect()
    rows = "(1, 'A  b'), (2, 'a b'), (3, ''), (4, '  '), (5, NULL), (6, NULL), (7, 'x')"
    con.execute(f"COPY (SELECT CAST(i AS BIGINT) AS doc_id, t AS text, 'en' AS lang, 's' AS source, CAST(length(t) AS BIGINT) AS n_chars FROM (VALUES {rows}) v(i, t)) TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet'")
    for name in ("n02_content_winners", "u01_duplicates", "a04_summary"):
        want = con.execute(registry.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        assert {tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).select(columns).collect()} == set(want.fetchall()), name


def test_signatures_are_worked_out_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(dedup, "settle", lambda df, label: made.append((label, plan(df))) or settle(df, label))
    text = " ".join(f"word{i}" for i in range(60))
    rows = [("a", "k1", text), ("b", "k2", text + " more"), ("c", "k3", "other " * 60)]
    df = spark.createDataFrame(rows, "id string, dedup_key string, body string").withColumns({c: F.lit("x") for c in ("title", "host", "batch")} | {"published_at": F.lit("2025-01-01T00:00:00Z"), "content_type": F.lit("US_NEWS"), "body_len": F.length("body"), "line_no": F.lit(1)})
    _, losers = dedup.near(df)
    assert [(r["loser"], r["canonical_id"]) for r in losers.collect()] == [("a", "b")]
    assert [name for name, _ in made] == ["signatures", "decided"] and ["signature(" in p for _, p in made] == [True, False]
    assert "token_set_ratio" not in plan(losers)
