"""Candidate events: gate, score, sweep, triage join, keep-best, caps and cross-source exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.functions import vocab


def gate(recent: int = 5, recent_alt: int = 3, early: int = 2, era: str = vocab.ERA_SPLIT, date: str | None = None) -> Column:
    """Enough articles for the era; fewer do for a recent event with corroboration."""
    n, late = F.col("n_articles"), F.col("peak_date") >= era
    ok = (late & ((n >= recent) | ((n >= recent_alt) & (F.col("n_v2_reactions") >= 1)))) | (~late & (n >= early))
    return ok & (F.col("peak_date") == date) if date else ok


def score() -> Column:
    n = lambda c: F.col(c).cast("double")
    return (
        2.0 * F.ln(1 + n("n_articles")) + 0.5 * n("n_sources") + 0.3 * n("n_content_types") + 1.5 * F.ln(1 + n("n_high"))
        + 2.0 * F.ln(1 + n("n_v2_reactions")) + F.when(F.col("track") == "macro", 1.0).otherwise(0.0)
    )


def candidates(clusters: DataFrame, **limits) -> DataFrame:
    kept = clusters.filter(gate(**limits))
    return kept.select("*", F.substring("peak_date", 1, 7).alias("month"), (F.col("peak_date") >= vocab.ERA_SPLIT).alias("is_recent"), score().alias("score"))


def sweep(clusters: DataFrame) -> DataFrame:
    """Recent and early counts for a grid of gates, in one pass over the clusters."""
    grid = [(rm, am, em) for rm in (3, 4, 5, 6, 8) for am in (2, 3) if am <= rm for em in (2, 3)]
    late, n, v = F.col("peak_date") >= vocab.ERA_SPLIT, F.col("n_articles"), F.col("n_v2_reactions")
    sums = []
    for rm, am, em in grid:
        ok = F.count_if(late & ((n >= rm) | ((n >= am) & (v >= 1))))
        sums.append(F.struct(F.lit(rm).alias("recent_min"), F.lit(am).alias("alt_min"), F.lit(em).alias("early_min"), ok.alias("recent"), F.count_if(~late & (n >= em)).alias("early")))
    return clusters.agg(F.array(*sums).alias("g")).select(F.explode("g").alias("g")).select("g.*")


def validated(cands: DataFrame, triage: DataFrame, least: int = 3) -> DataFrame:
    """Candidates with a valid verdict of enough significance; a malformed date falls back to the peak."""
    ok = F.lit(True) if "_error" not in triage.columns else F.col("_error").isNull()
    good = triage.filter(ok & F.coalesce(F.col("is_valid_event").try_cast("boolean"), F.lit(False)))
    good = good.withColumn("significance", F.col("significance").try_cast("int")).filter(F.col("significance") >= least)
    joined = cands.join(good, "event_id")
    iso = F.coalesce(F.col("event_date"), F.lit("")).rlike(r"^\d{4}-\d{2}-\d{2}$") & F.col("event_date").between(*vocab.DATE_RANGE)
    return joined.withColumn("event_date", F.when(iso, F.col("event_date")).otherwise(F.col("peak_date")))


def keep_best(rows: DataFrame) -> DataFrame:
    """The most significant event of each (type, date, first symbol or subject)."""
    who = F.coalesce(F.get("primary_symbols", F.lit(0)), F.lower(F.substring(T.blank("event_subject"), 1, 30)))
    w = Window.partitionBy("event_type", "event_date", "who").orderBy(F.desc("significance"), F.desc("score"), "event_id")
    return rows.withColumn("who", who).withColumn("rk", F.row_number().over(w)).filter("rk = 1").drop("rk", "who")


def cap_by_symbol(rows: DataFrame, cap: int = 12) -> DataFrame:
    """At most `cap` events of a first symbol, best first; 0 is no cap; events without one are exempt."""
    if not cap:
        return rows
    w = Window.partitionBy("s0").orderBy(F.desc("significance"), F.desc("score"), "event_id")
    ranked = rows.withColumn("s0", F.get("primary_symbols", F.lit(0))).withColumn("rk", F.row_number().over(w))
    return ranked.filter(F.col("s0").isNull() | (F.col("rk") <= cap)).drop("s0", "rk")


def without_filed(rows: DataFrame, filed: DataFrame, days: int = 3) -> DataFrame:
    """Events without a filing event on one of their symbols on the same date, or of the same type
    within `days` days."""
    x = rows.select("event_id", "event_date", "event_type", F.explode("primary_symbols").alias("sym"))
    y = filed.select(F.explode("primary_symbols").alias("ysym"), F.coalesce("event_date", F.lit("")).alias("yd"), F.coalesce("event_type", F.lit("")).alias("yt"))
    near = (F.col("event_date") == F.col("yd")) | ((F.col("event_type") == F.col("yt")) & (T.days_apart("event_date", "yd") <= days))
    hit = x.join(y, (F.col("sym") == F.col("ysym")) & near, "left_semi").select("event_id").distinct()
    return rows.join(hit, "event_id", "left_anti")


def top_members(members: DataFrame, most: int = 8) -> DataFrame:
    """The best members of an event: preferred sources, longer bodies, one for each title key."""
    order = [T.source_rank("source_name"), F.desc("body_len"), F.asc("id")]
    by_title = Window.partitionBy("event_id", T.title_key("title", 60)).orderBy(*order)
    by_event = Window.partitionBy("event_id").orderBy(*order)
    one = members.withColumn("t", F.row_number().over(by_title)).filter("t = 1").drop("t")
    return one.withColumn("rk", F.row_number().over(by_event)).filter(F.col("rk") <= most)


def sample_titles(members: DataFrame, most: int = 6) -> DataFrame:
    """Titles of the longest members of each event."""
    w = Window.partitionBy("event_id").orderBy(F.desc("body_len"), "id")
    top = members.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= most)
    return top.groupBy("event_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rk", "title"))), lambda x: x["title"]).alias("titles"))


def on_peak(events: DataFrame, date: str | None = None, limit: int | None = None) -> DataFrame:
    """Events whose peak is the date, all without one; the first `limit` by id where that is asked for."""
    kept = events.filter(F.col("peak_date") == date) if date else events
    return kept.orderBy("event_id").limit(limit) if limit else kept


def structure_inputs(events: DataFrame, members: DataFrame, bodies: DataFrame, filed: DataFrame | None = None, most: int = 8) -> DataFrame:
    """What a model is given on each event: (event_id, n_members, source_ids, articles). Members of
    wanted events only are ranked; bodies (id, body) are joined to the few that stay, one that is
    missing is empty. `filed` members (event_id, id, source_name, title, pub_date, body) of filing events
    are single articles. Events without members have no row."""
    best = top_members(members.join(events.select("event_id").distinct(), "event_id", "left_semi"), most).select("event_id", "id", "rk", "pub_date", "source_name", "title")
    text = best.join(bodies.select("id", T.clean_body("body").alias("body")), "id", "left")
    if filed is not None:
        text = text.unionByName(filed.select("event_id", "id", F.lit(1).alias("rk"), "pub_date", "source_name", "title", T.clean_body("body", 8400).alias("body")))
    part = F.format_string("--- %d [%s] %s ---\n%s\n%s", F.col("rk"), T.blank("pub_date"), F.coalesce(T.first_filled("source_name"), F.lit("?")), T.blank("title"), F.coalesce(T.first_filled("body"), F.lit("(empty)")))
    parts = F.array_sort(F.collect_list(F.struct("rk", F.col("id").cast("string").alias("id"), part.alias("part"))))
    grouped = text.groupBy("event_id").agg(parts.alias("p"))
    return grouped.select("event_id", F.size("p").alias("n_members"), F.transform("p", lambda x: x["id"]).alias("source_ids"), F.array_join(F.transform("p", lambda x: x["part"]), "\n\n").alias("articles"))
