"""Verbs of the event engine on small fixtures: files, exports, filings, pools, cases and settings."""

import json

import pytest
from pyspark.sql import functions as F

from eventloom.operators import assembly, cluster, dedup, filings, selection
from eventloom.plans import registry
from eventloom.settings import Settings
from eventloom.sources import records, sinks

DATA = "/root/testdata/sf0.001"


def test_settings_name_what_is_out_of_range():
    assert Settings().bucket_most == 250
    with pytest.raises(ValueError, match="near_threshold = 0"):
        Settings(near_threshold=0)


def test_files_are_found_and_indexed_once(spark, tmp_path):
    assert records.discover(spark, f"file://{tmp_path}") == []
    for name in ("b.jsonl", "a.jsonl"):
        (tmp_path / name).write_text("{}")
    found = records.discover(spark, f"file://{tmp_path}")
    assert [f.rsplit("/", 1)[-1] for f in found] == ["a.jsonl", "b.jsonl"]
    assert records.without_indexed(found, ["x/a.parquet"]) == found[1:] and records.without_indexed(found, ["a.parquet"], fresh=True) == found
    (tmp_path / "cleaned_batch1.jsonl").write_text("{}")
    assert [f.rsplit("/", 1)[-1] for f in records.discover(spark, f"file://{tmp_path}")] == ["cleaned_batch1.jsonl"]


def test_export_takes_the_place_of_the_earlier_one(spark, tmp_path):
    base = f"file://{tmp_path}/out"
    rows = lambda *ids: spark.createDataFrame([(i, "", "t") for i in ids], "id string, title string, published_at string")
    sinks.export(spark, base, records.pruned(rows("1", "2", "3")), rejects=rows("9"), part_size=2)
    assert len(list((tmp_path / "out/cleaned").glob("part-*"))) >= 2
    sinks.export(spark, base, records.pruned(rows("4")))
    lines = [json.loads(x) for f in (tmp_path / "out/cleaned").glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"id": "4", "published_at": "t"}]
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"cleaned", "rejects"}


def test_lines_by_kind_and_log(spark, tmp_path):
    df = spark.createDataFrame([("A", "x"), (None, "y"), ("", "z")], "kind string, raw string")
    sinks.write_by_kind(df, f"file://{tmp_path}/k", "kind", "raw")
    got = {p.name: sorted("".join(f.read_text() for f in p.glob("part-*")).split()) for p in (tmp_path / "k").iterdir() if p.is_dir()}
    assert got == {"kind=A": ["x"], "kind=_unknown": ["y", "z"]}
    log = lambda rows: spark.createDataFrame(rows, "k int, at int, _error string")
    sinks.append_log(log([(1, 1, "bad")]), f"file://{tmp_path}/log")
    sinks.append_log(log([(1, 2, None), (2, 1, "bad")]), f"file://{tmp_path}/log")
    seen = sinks.latest(spark.read.parquet(f"file://{tmp_path}/log"), "k", "at")
    assert sorted(tuple(r) for r in seen.collect()) == [(1, 2, None), (2, 1, "bad")]
    work = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert [r["k"] for r in sinks.pending(work, seen, "k").collect()] == [3]
    assert sorted(r["k"] for r in sinks.pending(work, seen, "k", retry_errors=True).collect()) == [2, 3]
    assert sinks.result_rows(seen).count() == 1


def test_read_lines_counts_blank_lines(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text(' {"a":1}\r\n\n{"b":2}\n')
    got = [tuple(r) for r in records.read_lines(spark, f"file://{tmp_path}/f.jsonl").orderBy("line_no").collect()]
    assert got == [("f.jsonl", 1, '{"a":1}'), ("f.jsonl", 3, '{"b":2}')]


def test_line_numbers_across_splits(spark, tmp_path):
    want = []
    for f in ("a", "b"):
        lines = [f"{f}{i}" * (i % 50) for i in range(3000)]
        (tmp_path / f"{f}.jsonl").write_text("\n".join(lines))
        want += [(f"{f}.jsonl", i + 1, line) for i, line in enumerate(lines) if line]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = records.read_lines(spark, [f"file://{tmp_path}/a.jsonl", f"file://{tmp_path}/b.jsonl"])
        assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pruned_at_any_depth(spark):
    row = spark.sql("SELECT ' x ' AS a, array('', null) AS b, map('k', ' ', 'l', 'v') AS c, named_struct('p', '', 'q', array(named_struct('r', ''))) AS d, 0 AS e, false AS f, '' AS _g")
    got = records.pruned(row).first().asDict(recursive=True)
    assert got == {"a": "x", "b": None, "c": {"l": "v"}, "d": None, "e": 0, "f": False}


def test_filings_become_events_and_members(spark):
    files = "array<struct<url:string,file_type:string>>"
    kind = f"id string, title string, published_at string, body string, source struct<url:string>, entities struct<stocks:array<struct<symbol:string>>>, notice struct<declare_date:string,attachments:{files}>"
    url = "https://www.sec.gov/Archives/edgar/data/320193/000032019325000001/x.htm"
    stocks = ([("AAPL",)],)
    rows = [
        ("1", "", "2025-01-02T00:00:00Z", "", (None,), stocks, ("", [(url, "8-K")])),
        ("2", "T", "2025-01-02T00:00:00Z", "Native text. More.", (None,), stocks, ("2025-01-03", [(url.replace("25000001", "25000002"), "8-K")])),
        ("3", "T", "2025-01-02T00:00:00Z", "x", (None,), stocks, ("", [(url, "8-K/A")])),
    ]
    paragraphs = spark.createDataFrame([("000032019325000001", 1, "Item 5.02 Departure of Directors. On May 1"), ("other", 0, "no")], "accession string, paragraph_index int, text string")
    events = filings.filing_events(spark.createDataFrame(rows, kind), paragraphs)
    got = {r["id"]: r.asDict() for r in events.collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["summary_source"], got["1"]["item"], got["1"]["summary"], got["1"]["declare_date"]) == ("v2", "5.02", "Departure of Directors", "2025-01-02")
    assert (got["2"]["summary_source"], got["2"]["summary"], got["2"]["declare_date"]) == ("native", "Native text.", "2025-01-03")
    members = {r["id"]: r.asDict() for r in filings.as_member(filings.usable(events)).collect()}
    assert members["1"]["title"] == "Form 8-K Item 5.02" and members["2"]["title"] == "T" and members["1"]["source_name"] == "SEC EDGAR 8-K"
    wanted = filings.usable(events).select("event_id")
    none = spark.createDataFrame([], "event_id string, id string, source_name string, title string, pub_date string, body_len int")
    given = selection.structure_inputs(wanted, none, none.select("id", F.lit("").alias("body")), filings.as_member(filings.usable(events)))
    assert sorted(r["n_members"] for r in given.collect()) == [1, 1]


def test_pool_tracks(spark):
    base = {"content_type": "US_NEWS", "pub_date": "2025-01-01", "body_len": 300, "title": "Fed cuts rates", "tags": "", "symbols": "", "n_symbols": 0, "has_crypto": False}
    cases = {
        "macro": {}, "company": {"symbols": "AAPL,bad!", "n_symbols": 2}, "short": {"body_len": 199}, "crypto": {"has_crypto": True}, "noise": {"tags": "today_mover"},
        "many": {"symbols": ",".join("ABCDEFGHI"), "n_symbols": 9}, "plain": {"title": "Nothing here"}, "notice": {"content_type": "US_NOTICE"},
    }
    df = spark.createDataFrame([{"id": k, **base, **v} for k, v in cases.items()])
    assert sorted((r["id"], r["bucket"], r["track"]) for r in cluster.pool(df).collect()) == [("company", "AAPL", "company"), ("macro", "fed_policy", "macro")]


def test_similar_pairs_as_all_pairs(spark):
    """Blocks, bounds and day counts leave out no pair: the same as a plain look at all pairs."""
    import random

    rnd = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(rnd.choice("ab"), i, f"2025-01-{rnd.randint(1, 9):02d}", " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 8, 30])))) for i in range(150)]
    df = spark.createDataFrame(rows, "bucket string, id int, day string, title string").withColumn("day", F.col("day").cast("date"))
    got = {(r["a"], r["b"]) for r in cluster.similar_pairs(df, ratio=None, jaccard=0.3, days=2, look_back=7).collect()}
    want = set()
    for bucket in "ab":
        mine = sorted((day, i, set(t.split())) for b, i, day, t in rows if b == bucket)
        for x in range(len(mine)):
            for y in range(x + 1, min(x + 8, len(mine))):
                (d, i, s), (e, j, t) = mine[x], mine[y]
                if int(e[-2:]) - int(d[-2:]) <= 2 and s | t and len(s & t) / len(s | t) >= 0.3:
                    want.add((i, j))
    assert got == want and want


def test_near_losers_carry_debug(spark):
    rows = [("l", "w", "near:w", (0.95123456789, 97.0, 91.0))]
    df = spark.createDataFrame(rows, "loser string, canonical_id string, dedup_key string, best struct<jaccard:double,fuzzy:double,title_score:double>")
    assert json.loads(dedup.with_debug(df).first()["debug"]) == {"method": "near_minhash", "cluster": "near:w", "scores": {"jaccard": 0.951235, "fuzzy": 97.0, "title_score": 91.0}}


def test_company_of_the_first_symbol(spark):
    df = spark.sql("SELECT array(named_struct('symbol', 'B', 'company', 'Beta'), named_struct('symbol', 'A', 'company', ''), named_struct('symbol', 'A', 'company', 'Acme')) AS r, 'Subject' AS s")
    name = lambda symbols: df.select(assembly.company("r", symbols, "s").alias("x")).first()["x"]
    assert name(F.array(F.lit("A"))) == "Acme" and name(F.array(F.lit("Z"))) == "Subject" and name(F.array().cast("array<string>")) == "Subject"


def test_case_as_json(spark):
    structured, labelled, prices, minutes = registry._cases(spark, DATA)
    found = structured.select("event_id", F.lit("Flash").alias("category"), F.lit(1).alias("rk"), F.lit("t").alias("title"), F.lit("p").alias("published_at"), F.lit("u").alias("url"))
    out = assembly.assemble(structured, labelled, prices, found, minutes).filter("drop_reason IS NULL").orderBy("event_id")
    case = json.loads(out.select(F.to_json("case", {"ignoreNullFields": "false"}).alias("j")).first()["j"])
    assert list(case)[:4] == ["schema", "case_id", "case_title", "event_family"] and case["event_family"] == "other"
    assert set(case["associatin_search"]) == {"News", "Flash", "Robot", "Post", "Article", "Report", "teleconference", "AI_search"}
    assert case["associatin_search"]["Flash"] == [{"title": "t", "summary": "", "published_at": "p", "url": "u"}] and case["associatin_search"]["News"] == []
    label = case["supervised_targets_hidden_labels"]["labels"][0]
    bars = case["market_data"]["symbols"][label["symbol"]]
    assert bars["model_input_ohlcv_adjusted_daily"][-1]["date"] == label["base_close_date"] < label["first_tradable_session"] == bars["label_audit_ohlcv_adjusted_daily"][0]["date"]
    assert bars["label_audit_ohlcv_adjusted_daily"][19]["date"] == label["horizon_dates"]["20d"]
    assert list(case["intraday_volume_panel"]["symbols"]) == ["S1"] and case["time_dimension_calibration"]["label_window"].count("..") == 1
    row = case["target_relation_evidence"]["rows"][0]
    assert row["relation_path"][-1] == row["symbol"] and row["evidence_ids"] == ["SRC_d1"]


def test_allowed_without_minutes(spark):
    structured, labelled, prices, _ = registry._cases(spark, DATA)
    found = structured.select("event_id", F.lit("News").alias("category"), F.lit(1).alias("rk"), F.lit("t").alias("title"), F.lit("p").alias("published_at"), F.lit(None).cast("string").alias("url"))
    got = assembly.assemble(structured, labelled, prices, found, None, allow_missing=True)
    reasons = {r["drop_reason"] for r in got.select("drop_reason").distinct().collect()}
    assert "no_intraday" not in reasons and None in reasons
    assert got.filter("drop_reason IS NULL").select("case.intraday_volume_panel.provider").distinct().first()["provider"] == "missing"
