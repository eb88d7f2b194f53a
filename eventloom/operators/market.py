"""Price panels: sessions, as-of base days, forward returns with ranks, and intraday panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as T

BEFORE, AFTER, MIN_BARS, MIN_LABELS = 15, 20, 380, 3
HORIZONS = {"1d": 0, "5d": 4, "20d": 19}


def merge_panels(old: DataFrame, new: DataFrame) -> DataFrame:
    """Panels joined, the old row kept where both have a (symbol, date); of new rows that repeat one, the least."""
    least = new.groupBy("symbol", "date").agg(F.min(F.struct(*[c for c in new.columns if c not in ("symbol", "date")])).alias("r")).select("symbol", "date", "r.*")
    return old.unionByName(least.join(old.select("symbol", "date"), ["symbol", "date"], "left_anti"))


def missing_symbols(wanted: DataFrame, panel: DataFrame) -> DataFrame:
    return wanted.join(panel.select("symbol").distinct(), "symbol", "left_anti")


def event_symbols(relation_symbols, primary_symbols, most: int = 16) -> Column:
    """Primary symbols that are not related ones, last first, then the related ones; upper case, valid, distinct."""
    clean = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda s: F.upper(F.trim(s))), lambda s: s.rlike(r"^[A-Z][A-Z0-9.\-]{0,9}$")))
    related = clean(relation_symbols)
    front = F.reverse(F.array_except(clean(primary_symbols), related))
    return F.slice(F.concat(front, related), 1, most)


def sessions(panel: DataFrame) -> DataFrame:
    """Panel (symbol, date, open, close) with the place `k` of each session in its symbol (from 0), their
    number, the next session's day and open, and the days and closes of the horizons."""
    w = Window.partitionBy("symbol").orderBy("date")
    ahead = {f"{c}_{h}": F.lead(c, k + 1).over(w) for h, k in HORIZONS.items() for c in ("close", "date")}
    return panel.select("symbol", "date", "open", "close").withColumns(
        {"k": F.row_number().over(w) - 1, "n": F.count("*").over(Window.partitionBy("symbol")), "first_date": F.lead("date", 1).over(w), "first_open": F.lead("open", 1).over(w)} | ahead
    )


def base_sessions(events: DataFrame, panel: DataFrame) -> DataFrame:
    """Each (event_id, symbol, event_date, bucket) with its base session: the last one before the date
    for pre_market, else the last one not after it. Events and sessions are put in one order by symbol,
    and each event takes the last session ahead of it, so the work grows with their sum, not with their
    product. They move once, as narrow rows: what follows a session is looked up where its symbol is."""
    row = F.struct("date", "close", "k", "n", "first_date", "first_open", *[f"{c}_{h}" for h in HORIZONS for c in ("close", "date")])
    marks = sessions(panel.filter("symbol IS NOT NULL").select("symbol", "date", "open", "close").repartition("symbol")).select("symbol", F.col("date").alias("at"), F.lit(1).alias("turn"), row.alias("b"))
    asks = events.select("symbol", F.col("event_date").alias("at"), F.when(F.col("bucket") == "pre_market", 0).otherwise(2).alias("turn"), F.struct("event_id", "event_date", "bucket").alias("e")).repartition("symbol")
    w = Window.partitionBy("symbol").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionByName(asks, allowMissingColumns=True).withColumn("b", F.last("b", True).over(w))
    found = both.filter("e IS NOT NULL AND b IS NOT NULL")
    return found.select("e.event_id", "symbol", "e.event_date", "e.bucket", "b.*")


def labels(events: DataFrame, panel: DataFrame) -> DataFrame:
    """Labels of events: base close to four places, the gap to the next open, returns over 1, 5 and 20
    sessions from the base close and from that open, with the days they end on, and the rank of the
    20-day return in the event; symbols need 15 sessions before and 20 after; events need three labels."""
    base = base_sessions(events, panel).filter((F.col("k") >= BEFORE) & (F.col("k") + 1 + AFTER <= F.col("n")))
    out = base.select(
        "event_id", "symbol", F.col("date").alias("base_close_date"), F.round("close", 4).alias("base_close"), F.col("first_date").alias("first_tradable"), T.pct("close", "first_open").alias("gap"),
        *[T.pct("close", f"close_{h}").alias(f"ret_{h}") for h in HORIZONS], *[T.pct("first_open", f"close_{h}").alias(f"open_ret_{h}") for h in HORIZONS], *[f"date_{h}" for h in HORIZONS],
    )
    each = Window.partitionBy("event_id")
    ranked = out.withColumns({"n_labels": F.count("*").over(each), "rank_20d": F.row_number().over(each.orderBy(F.desc("ret_20d"), "symbol"))})
    return ranked.filter(F.col("n_labels") >= MIN_LABELS)


def unpriced(events: DataFrame, labelled: DataFrame) -> DataFrame:
    """(event_id, symbol) of labelled events whose symbol has no label of its own. Both are brought together
    by event once, so labels are worked out once."""
    rows = lambda df, label: df.select("event_id", "symbol", F.lit(label).alias("label"))
    both = rows(events, 0).union(rows(labelled, 1)).filter("event_id IS NOT NULL").repartition("event_id")
    each = both.groupBy("event_id", "symbol").agg(F.max("label").alias("label"))
    return each.withColumn("any", F.max("label").over(Window.partitionBy("event_id"))).filter("any = 1 AND label = 0").select("event_id", "symbol")


def price_windows(labelled: DataFrame, panel: DataFrame) -> DataFrame:
    """(event_id, symbol, model_input, label_audit, sound): bars of the 15 sessions up to the base, which a
    model may see, and of the 20 after it, which it may not, and whether they are as a case wants them.
    Prices have four places. Sessions that no base reaches are left out before bars are listed, and lists
    are made and tested for bases alone."""
    bar = F.struct("date", *[F.round(c, 4).alias(c) for c in ("open", "high", "low", "close")], F.col("volume").cast("long").alias("volume"))
    bases = labelled.select("symbol", F.col("base_close_date").alias("date")).distinct()
    both = panel.withColumn("session", F.lit(1)).unionByName(bases.withColumn("session", F.lit(0)), allowMissingColumns=True).repartition("symbol")
    marked = both.withColumn("base", (F.min("session").over(Window.partitionBy("symbol", "date")) == 0).cast("int")).filter("session = 1")
    w = Window.partitionBy("symbol").orderBy("date")
    near = marked.withColumn("near", F.max("base").over(w.rowsBetween(-AFTER, BEFORE - 1))).filter("near = 1")
    lists = {"model_input": F.collect_list(bar).over(w.rowsBetween(1 - BEFORE, 0)), "label_audit": F.collect_list(bar).over(w.rowsBetween(1, AFTER))}
    seen = near.withColumns(lists).filter("base = 1").select("symbol", "date", *lists, sound_bars("model_input", "label_audit").alias("sound"))
    return labelled.select("event_id", "symbol", F.col("base_close_date").alias("date")).join(seen, ["symbol", "date"]).select("event_id", "symbol", *lists, "sound")


def sound_bars(model_input, label_audit) -> Column:
    """Whether a case may have these bars: one at least to see and AFTER to audit, with days, prices above 0 and volumes."""
    day = lambda b: T.blank(b["date"]).rlike(T.DAY) & (b["volume"] >= 0) & F.coalesce(F.least(b["open"], b["high"], b["low"], b["close"]) > 0, F.lit(False))
    return F.coalesce((F.size(model_input) >= 1) & (F.size(label_audit) >= AFTER) & F.forall(model_input, day) & F.forall(label_audit, day), F.lit(False))


def intraday_panel(bars: DataFrame) -> DataFrame:
    """Panels of regular-session minute bars (event_id, symbol, ts UTC, open..volume): New York time,
    typical price and dollar volume, bars in order, and whether the panel is complete."""
    local = bars.withColumn("local", F.from_utc_timestamp("ts", "America/New_York"))
    local = local.withColumns({"date": F.date_format("local", "yyyy-MM-dd"), "t": F.date_format("local", "HH:mm")}).filter(F.col("t").between("09:30", "15:59"))
    price = F.round((F.col("high") + F.col("low") + F.col("close")) / 3, 6)
    bar = F.struct("t", "open", "high", "low", "close", "volume", price.alias("vwap"), F.round(price * F.col("volume"), 6).alias("dollar_volume"))
    grouped = local.groupBy("event_id", "symbol", "date").agg(F.array_sort(F.collect_list(bar)).alias("bars"))
    return grouped.withColumns({"bar_count": F.size("bars"), "complete": complete_panel(F.col("bars"))})


def complete_panel(bars, least: int = MIN_BARS) -> Column:
    """At least `least` bars at distinct minutes, from 09:35 or earlier to 15:55 or later."""
    times = F.transform(bars, lambda b: b["t"])
    return (F.size(bars) >= least) & (F.size(F.array_distinct(times)) == F.size(times)) & (F.get(times, F.lit(0)) <= "09:35") & (F.element_at(times, -1) >= "15:55")


def require_fields(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df`; reading a row in which one of the columns is null raises an error that names it."""
    for c in columns:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"missing field {c}")).cast(dict(df.dtypes)[c])).otherwise(F.col(c)))
    return df


def symbol_map(panels: DataFrame) -> DataFrame:
    """One map from symbol to its complete panel for each event."""
    return panels.filter("complete").groupBy("event_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", F.struct("date", "bar_count", "bars"))))).alias("symbols"))
