"""Training cases: related search, gates, audits and the nested result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.functions import vocab
from eventloom.operators.market import sound_bars


def related(events: DataFrame, index: DataFrame, before: int = 3, after: int = 1, most: int = 10) -> DataFrame:
    """The earliest `most` index rows of each event and category in its days, by a shared symbol or
    by the title pattern; one for each title key. Symbols and patterns are two joins on the day, so
    neither needs a nested loop over all pairs. events: event_id, event_date, symbols, pattern."""
    days = events.select("*", F.explode(F.sequence(F.date_sub(F.col("event_date").cast("date"), before), F.date_add(F.col("event_date").cast("date"), after))).alias("day"))
    rows = index.filter("pub_date <> ''").withColumn("day", F.col("pub_date").cast("date"))
    kinds = F.create_map(*[F.lit(x) for pair in vocab.CATEGORIES.items() for x in pair])
    columns = ["event_id", "id", "published_at", "title", "category"]
    rows = rows.withColumn("category", kinds[F.col("content_type")]).filter("category IS NOT NULL")  # other types are not searched
    by_symbol = days.select("event_id", "day", F.explode("symbols").alias("sym")).join(rows.withColumn("sym", F.explode(F.split("symbols", ","))), ["day", "sym"])
    by_title = days.filter("pattern <> ''").select("event_id", "day", "pattern").join(rows, "day").filter(F.rlike("title", F.concat(F.lit(r"(?i)\b"), "pattern", F.lit(r"\b"))))
    found = by_symbol.select(columns).union(by_title.select(columns)).distinct()
    one = Window.partitionBy("event_id", "category", T.title_key("title", 80)).orderBy("published_at", "id")
    top = Window.partitionBy("event_id", "category").orderBy("published_at", "id")
    found = found.withColumn("k", F.row_number().over(one)).filter("k = 1").drop("k")
    return found.withColumn("rk", F.row_number().over(top)).filter(F.col("rk") <= most)


def company(relations, primary_symbols, subject) -> Column:
    """The name to search an event by: the company that its relations give its first symbol, else the subject."""
    named = F.filter(relations, lambda r: (r["symbol"] == F.get(primary_symbols, F.lit(0))) & (T.blank(r["company"]) != ""))
    return F.coalesce(F.get(named, F.lit(0))["company"], T.blank(subject))


def with_sources(found: DataFrame, used: DataFrame, most: int = 10) -> DataFrame:
    """Related rows joined with the sources that a model was given (event_id, id, published_at, title,
    content_type, url): of each event and category the earliest `most`, one for each title key, a used
    source before a found one of the same time. Unknown types of used sources count as News."""
    kinds = F.create_map(*[F.lit(x) for pair in vocab.SOURCE_KINDS.items() for x in pair])
    mine = used.select("event_id", F.col("id").cast("string").alias("id"), "published_at", T.blank("title").alias("title"), "url", F.coalesce(kinds[F.upper("content_type")], F.lit("News")).alias("category"), F.lit(0).alias("turn"))
    other = found.select("event_id", F.col("id").cast("string").alias("id"), "published_at", T.blank("title").alias("title"), (F.col("url") if "url" in found.columns else F.lit(None).cast("string")).alias("url"), "category", F.lit(1).alias("turn"))
    order = [T.blank("published_at"), "turn", "id"]
    one = Window.partitionBy("event_id", "category", T.title_key("title", 80)).orderBy(*order)
    top = Window.partitionBy("event_id", "category").orderBy(*order)
    kept = mine.unionByName(other).withColumn("k", F.row_number().over(one)).filter("k = 1").drop("k")
    return kept.withColumn("rk", F.row_number().over(top)).filter(F.col("rk") <= most).drop("turn")


ITEMS = "array<struct<title:string,summary:string,published_at:string,url:string>>"


def associations(found: DataFrame) -> DataFrame:
    """One struct of all categories with their rows in order for each event; a category without rows is empty."""
    item = F.struct("rk", "title", F.lit("").alias("summary"), "published_at", "url")
    rows = found.groupBy("event_id", "category").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("rk")).alias("r"))
    by_kind = rows.groupBy("event_id").agg(F.map_from_entries(F.collect_list(F.struct("category", "r"))).alias("m"))
    return by_kind.select("event_id", F.struct(*[F.coalesce(F.try_element_at("m", F.lit(k)), F.from_json(F.lit("[]"), ITEMS)).alias(k) for k in vocab.CASE_KINDS]).alias("associations"))


def drop_reason(facts, channels, relations, priced, intraday, allow_missing: bool = False):
    """Why a case is dropped; null if it is complete."""
    return (
        F.when(facts < 2, "few_facts").when(channels < 2, "few_channels").when(relations < 5, "few_relations").when(priced < 3, "few_priced")
        .when(F.lit(not allow_missing) & ~F.coalesce(intraday, F.lit(False)), "no_intraday")
    )


def audit(cases: DataFrame) -> DataFrame:
    """Cases (event_date, facts array of structs) with `leaks`, the dates later than the event."""
    text = F.array_join(F.transform("facts", lambda f: F.concat_ws(" ", f["metric"], f["value"], f["context"])), " ")
    return cases.withColumn("leaks", T.late_dates(text, "event_date"))


def consensus_calendar(labels: DataFrame) -> DataFrame:
    """The most common base date of each event, the earliest of equals."""
    counts = labels.groupBy("event_id", "base_close_date").agg(F.count("*").alias("c"))
    day = F.datediff(F.col("base_close_date").cast("date"), F.lit("1970-01-01").cast("date"))
    return counts.groupBy("event_id").agg(F.max_by("base_close_date", F.struct("c", -day)).alias("base_close_date"))


def unique_case_ids(cases: DataFrame, written=None) -> DataFrame:
    """Case ids that repeat among written cases (all, unless told) get the last four characters of the event id."""
    written = F.lit(True) if written is None else written
    w = Window.partitionBy("case_id", written).orderBy("event_id")
    later = written & (F.row_number().over(w) > 1)
    return cases.withColumn("case_id", F.when(later, F.concat_ws("_", "case_id", F.substring("event_id", -4, 4))).otherwise(F.col("case_id")))


def evidence(structured: DataFrame, labels: DataFrame) -> DataFrame:
    """(event_id, rows, n_priced): the relations of each event as evidence, with whether their symbol has
    a label; relations without a symbol are left out."""
    priced = labels.groupBy("event_id").agg(F.collect_set("symbol").alias("priced"))
    j = structured.join(priced, "event_id", "left")
    has = lambda r: F.coalesce(F.array_contains("priced", F.upper(F.trim(r["symbol"]))), F.lit(False))
    sources = F.transform(F.slice("source_ids", 1, 1), lambda i: F.concat(F.lit("SRC_"), i))

    def row(r):
        sym = F.upper(F.trim(r["symbol"]))
        pick = lambda a, b: F.when(has(r), a).otherwise(b)
        path = F.when(F.size(r["relation_path"]) > 0, r["relation_path"]).otherwise(F.array(T.blank("event_subject"), T.blank("event_family"), sym))
        trace = lambda label, url, kind: F.struct(F.lit(label).alias("label"), url.alias("url"), F.lit(kind).alias("type"))
        return F.struct(
            sym.alias("symbol"), F.coalesce(T.first_filled(r["company"]), sym).alias("company"), pick(vocab.PRICED, vocab.UNPRICED).alias("priced_label_status"),
            F.coalesce(T.first_filled(r["relation_type"]), F.lit("related")).alias("relation_type"), path.alias("relation_path"), T.blank(r["evidence_statement"]).alias("evidence_statement"),
            F.when(F.size(sources) > 0, sources).otherwise(F.array(F.lit("SRC_UNKNOWN"))).alias("evidence_ids"), pick(vocab.TREATMENT_PRICED, vocab.TREATMENT_UNPRICED).alias("training_treatment"),
            F.lit(None).cast("double").alias("manual_strength_score"), F.lit(None).cast("string").alias("manual_direction_label"),
            F.coalesce(T.first_filled(r["relation_type_cn"]), F.lit(vocab.RELATION_CN)).alias("relation_type_cn"), T.blank(r["impact_path_cn"]).alias("impact_path_cn"),
            F.array(trace(vocab.TRACE_OFFICIAL, T.blank("official_source_url"), "official"), trace(vocab.TRACE_RELATION, F.lit("#relationEvidence"), "local_ui")).alias("source_trace"),
            pick(vocab.TREATMENT_PRICED_CN, vocab.TREATMENT_UNPRICED_CN).alias("training_treatment_cn"),
        )

    rows = F.transform(F.filter("relations", lambda r: T.blank(F.trim(r["symbol"])) != ""), row)
    return j.select("event_id", rows.alias("rows"), F.size(F.filter("relations", has)).alias("n_priced"))


def case_issues(c, priced) -> Column:
    """What a case breaks of the rules of its form: names of fields in order; empty if it is sound. `c`
    maps a dotted name to its Column, `priced` tells whether market_data.symbols is sound: bars are tested
    where they are listed. The type of a case is fixed by its columns, so patterns, least sizes and bounds
    are left to test."""
    day = lambda name: ~T.blank(c(name)).rlike(T.DAY)
    cal = "time_dimension_calibration."
    few = lambda name, n: F.coalesce(F.size(c(name)), F.lit(0)) < n
    tests = {
        "case_id": ~T.blank(c("case_id")).rlike("^[A-Z0-9][A-Z0-9_]{5,90}$"), "main_event.event_date": day("main_event.event_date"),
        "main_event.event_influence_channels": few("main_event.event_influence_channels", 2), "main_event.facts_publicly_reported": few("main_event.facts_publicly_reported", 2),
        "market_data.symbols": ~priced,
        "supervised_targets_hidden_labels.labels": few("supervised_targets_hidden_labels.labels", 3), "target_relation_evidence.rows": few("target_relation_evidence.rows", 5),
    } | {cal + n: day(cal + n) for n in ("base_close_date", "event_natural_date", "first_tradable_session", "label_dates.1d", "label_dates.5d", "label_dates.20d")}
    return F.array_compact(F.array(*[F.when(tests[n], F.lit(n)) for n in sorted(tests)]))


def priced_bars(prices: DataFrame) -> DataFrame:
    """(event_id, bars, priced): a map from symbol to bars for each event, and whether it has three at
    least, all sound. Where the map is not asked for, only what the tests found moves."""
    if "sound" not in prices.columns:
        prices = prices.withColumn("sound", sound_bars("model_input", "label_audit"))
    windows = F.struct(F.col("model_input").alias("model_input_ohlcv_adjusted_daily"), F.col("label_audit").alias("label_audit_ohlcv_adjusted_daily"))
    named = F.coalesce(F.col("symbol").rlike(r"^[A-Z][A-Z0-9.\-]{0,9}$"), F.lit(False))
    entries = F.array_sort(F.collect_list(F.struct("symbol", windows)))
    return prices.groupBy("event_id").agg(F.map_from_entries(entries).alias("bars"), ((F.count("*") >= 3) & F.bool_and(F.col("sound") & named)).alias("priced"))


def assemble(structured: DataFrame, labels: DataFrame, prices: DataFrame, found: DataFrame, intraday: DataFrame | None = None, allow_missing: bool = False) -> DataFrame:
    """event_id, drop_reason (null for complete cases), leaks (dates after the event, told but no reason
    to drop), issues of the form, and the nested case. structured: event_id, case_id, case_title,
    event_family, event_type, event_subject, event_subject_type, event_date, official_source_url,
    primary_symbols, source_ids, facts, channels, relations; labels, prices (price_windows), found
    (with_sources) and intraday (event_id, symbols map) are joined by event. Events without labels are
    left out. A repeated case id gets the end of its event id."""
    label = F.struct("rank_20d", "symbol", "base_close_date", "base_close", "first_tradable", "gap", *[f"{p}ret_{h}" for p in ("", "open_") for h in ("1d", "5d", "20d")], *[f"date_{h}" for h in ("1d", "5d", "20d")])
    by_event = labels.groupBy("event_id").agg(F.array_sort(F.collect_list(label)).alias("t"))
    shared = consensus_calendar(labels)
    cal = labels.join(shared, ["event_id", "base_close_date"]).groupBy("event_id").agg(F.min_by(F.struct("base_close_date", "first_tradable", *[f"date_{h}" for h in ("1d", "5d", "20d")]), "symbol").alias("cal"))
    j = structured.join(by_event, "event_id").join(cal, "event_id").join(priced_bars(prices), "event_id").join(evidence(structured, labels), "event_id").join(associations(found), "event_id", "left")
    j = audit(j).withColumn("case_id", T.case_id("case_id", F.get("primary_symbols", F.lit(0)), "event_id"))
    if intraday is not None:
        j = j.join(intraday.select("event_id", F.col("symbols").alias("minutes")), "event_id", "left")
        none = F.from_json(F.lit("{}"), dict(intraday.dtypes)["symbols"])
        j = j.withColumn("minutes", F.coalesce(F.map_filter("minutes", lambda s, _: F.exists("t", lambda x: x["symbol"] == s)), none))
    else:
        j = j.withColumn("minutes", F.from_json(F.lit("{}"), "map<string,string>"))
    has = F.size("minutes") > 0
    returns = lambda x, p: F.struct(*[x[f"{p}ret_{h}"].alias(h) for h in ("1d", "5d", "20d")])
    targets = F.transform("t", lambda x: F.struct(
        x["symbol"].alias("symbol"), x["base_close_date"].alias("base_close_date"), x["base_close"].alias("base_close"), x["first_tradable"].alias("first_tradable_session"),
        x["gap"].alias("close_to_next_open_gap_pct"), returns(x, "").alias("close_to_close_return_pct"), returns(x, "open_").alias("tradable_open_to_close_return_pct"),
        F.struct(*[x[f"date_{h}"].alias(h) for h in ("1d", "5d", "20d")]).alias("horizon_dates"), F.lit(True).alias("is_hidden_from_model_input"), x["rank_20d"].alias("cross_section_rank_20d"),
    ))
    channels = F.filter("channels", lambda x: T.blank(x) != "")
    parts = {
        "schema": F.lit(vocab.CASE_SCHEMA), "case_id": F.col("case_id"), "case_title": T.blank("case_title"), "event_family": F.coalesce(T.first_filled("event_family"), F.lit("other")),
        "main_event": F.struct(
            F.col("case_id").alias("event_id"), T.blank("event_subject").alias("event_subject"), T.blank("event_subject_type").alias("event_subject_type"),
            F.coalesce(T.first_filled("event_type"), F.lit("other")).alias("event_type"), "event_date", T.blank("case_title").alias("title"),
            F.transform(F.slice("source_ids", 1, 8), lambda i: F.concat(F.lit("SRC_"), i)).alias("source_ids"), "official_source_url", F.col("facts").alias("facts_publicly_reported"),
            F.transform(channels, lambda x: F.struct(x.alias("channel"), F.lit(None).cast("string").alias("manual_direction"), F.lit(vocab.CHANNEL_ROLE).alias("training_role"))).alias("event_influence_channels"),
        ),
        "supervised_targets_hidden_labels": F.struct(F.lit(vocab.LABEL_BASE).alias("label_base"), F.size("t").alias("label_count"), targets.alias("labels"), F.array(*map(F.lit, vocab.TRAIN_METRICS)).alias("metrics_to_train")),
        "time_dimension_calibration": F.struct(
            F.col("event_date").alias("event_natural_date"), "cal.base_close_date", F.col("cal.first_tradable").alias("first_tradable_session"),
            F.struct(*[F.col(f"cal.date_{h}").alias(h) for h in ("1d", "5d", "20d")]).alias("label_dates"), F.concat_ws("..", "cal.first_tradable", "cal.date_20d").alias("label_window"),
            F.lit(True).alias("artifact_dates_are_not_model_time"), F.lit(vocab.LEAKAGE_BOUNDARY).alias("leakage_boundary"),
        ),
        "target_relation_evidence": F.struct(F.lit(vocab.RELATION_POLICY).alias("policy"), "rows"),
        "market_data": F.struct(F.lit(vocab.PRICE_PROVIDER).alias("provider"), F.lit(vocab.PRICE_ADJUSTMENT).alias("adjustment"), F.col("bars").alias("symbols")),
        "intraday_volume_panel": F.struct(
            F.when(has, "unknown").otherwise("missing").alias("provider"), F.lit("America/New_York").alias("timezone"), "event_date", F.lit("1m").alias("interval"),
            F.lit(vocab.SESSION_SCOPE).alias("session_scope"), F.col("minutes").alias("symbols"),
        ),
        "associatin_search": F.coalesce("associations", F.struct(*[F.from_json(F.lit("[]"), ITEMS).alias(k) for k in vocab.CASE_KINDS])),
    }
    # Ids are made unique before the case is put together, and its parts are tested one by one, so that what
    # nobody reads of it is not moved for that.
    part = lambda name: reduce(lambda c, field: c[field], name.split(".")[1:], parts[name.split(".")[0]])
    made = j.select("*", drop_reason(F.size("facts"), F.size(channels), F.size("relations"), F.col("n_priced"), has, allow_missing).alias("reason"), case_issues(part, F.col("priced")).alias("issues"))
    told = made.withColumn("drop_reason", F.coalesce("reason", F.when(F.size("issues") > 0, F.lit("form")))).drop("reason", "priced")
    return unique_case_ids(told, F.col("drop_reason").isNull()).select("event_id", "drop_reason", "leaks", "issues", F.struct(*[v.alias(k) for k, v in parts.items()]).alias("case"))


def case_summary(structured: DataFrame, labels: DataFrame, cases: DataFrame) -> DataFrame:
    """One row: events read, with labels, written, dropped, and with leaks or issues."""
    known = structured.join(labels.select("event_id").distinct().withColumn("l", F.lit(1)), "event_id", "left")
    told = known.join(cases.select("event_id", F.col("drop_reason").isNull().alias("kept"), ((F.size("leaks") > 0) | (F.size("issues") > 0) | F.col("drop_reason").isNotNull()).alias("told")), "event_id", "left")
    return told.agg(
        F.count("*").alias("structured_in"), F.count("l").alias("with_market"), F.count_if("kept").alias("cases_written"), F.count_if(~F.coalesce("kept", F.lit(False))).alias("dropped"), F.count_if("told").alias("events_with_issues")
    )
