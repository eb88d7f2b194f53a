"""Title funnel: hard rules, templates, dedup layers, rare-token buckets and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.functions import vocab
from eventloom.operators.cluster import topic


def hard_rule(title) -> Column:
    """The first hard rule that a title meets; null if none."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(vocab.HARD_RULES.items()):
        out = F.when(T.blank(title).rlike("(?i)" + pattern), F.lit(name)).otherwise(out)
    return out


def macro_bucket(title, tags, importance) -> Column:
    """Macro topic of a title; else, for high importance, the first macro tag."""
    tag = F.array_min(F.array_intersect(tags, F.array(*[F.lit(t) for t in vocab.MACRO_TAGS])))
    return F.coalesce(topic(title, vocab.FUNNEL_TOPICS), F.when(importance == "high", F.concat(F.lit("macro_tag_"), tag)))


def layers(rows: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """`rows` (src, id, day, title, body_len, ord) with drop_layer: L1 hard rule, L2 template, L3
    too short, L4 repeated (same day and words; FLASH before NEWS, then order); null for kept rows."""
    bag = F.array_join(F.array_sort(T.tokens("title")), " ")
    marked = rows.withColumns({"rule": hard_rule("title"), "skel": T.skeleton("title"), "bag": bag})
    if templates is not None:
        known = templates.select("skel").distinct().withColumn("known", F.lit(True))
        marked = marked.join(known, "skel", "left")
    else:
        marked = marked.withColumn("known", F.lit(None).cast("boolean"))
    early = (
        F.when(F.col("rule").isNotNull(), F.concat(F.lit("L1:"), "rule")).when(F.col("known"), F.lit("L2"))
        .when((F.col("body_len") < 200) & (F.length("title") < 40), F.lit("L3"))
    )
    marked = marked.withColumn("early", early)
    w = Window.partitionBy("day", "bag", F.col("early").isNull()).orderBy(F.when(F.col("src") == "FLASH", 0).otherwise(1), "ord", "id")
    last = F.when((F.col("bag") != "") & (F.row_number().over(w) > 1), F.lit("L4"))
    return marked.withColumn("drop_layer", F.coalesce("early", last)).drop("known", "early")


def layer_counts(layered: DataFrame) -> DataFrame:
    return layered.groupBy("src", F.coalesce("drop_layer", F.lit("kept")).alias("layer")).agg(F.count("*").alias("n"))


def mine_templates(rows: DataFrame, least: int = 20, subjects: int = 10, share: float = 0.6, fixed: int = 3) -> DataFrame:
    """Templates of titles (src, title): frequent, on many subjects, mostly from one source, with
    enough fixed words. Counts by source come first, so a hot template is never one group."""
    marked = rows.select("src", T.skeleton("title").alias("skel"), T.subjects("title").alias("subject"))
    words = F.size(F.filter(F.split("skel", " "), lambda w: ~w.isin("@", "#", "")))
    by_src = marked.groupBy("skel", "src").agg(F.count("*").alias("n")).groupBy("skel").agg(F.sum("n").alias("freq"), F.max("n").alias("top"))
    many = marked.groupBy("skel").agg(F.countDistinct("subject").alias("n_subjects"))
    kept = by_src.filter(F.col("freq") >= least).join(many, "skel")
    return kept.filter((F.col("n_subjects") >= subjects) & (words >= fixed) & (F.col("top") / F.col("freq") >= share)).select("skel", "freq", "n_subjects", (F.col("top") / F.col("freq")).alias("share"))


def holdout(rows: DataFrame, split_day: str, **limits) -> DataFrame:
    """One row on templates of both halves (before split_day, and from it on): how many there are, are
    shared, and are new in the second; and for titles of the second half how many the templates of the
    first, of the second, the hard rules, both and only one of them meet, and the share that the older
    templates keep. Flags are joined to distinct templates and summed in one pass."""
    halves = [mine_templates(rows.filter(c), **limits).select("skel") for c in (F.col("day") < split_day, F.col("day") >= split_day)]
    both = halves[0].withColumn("t1", F.lit(1)).join(halves[1].withColumn("t2", F.lit(1)), "skel", "full").select("skel", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("t1", "t2")])
    titles = rows.filter(F.col("day") >= split_day).groupBy(T.skeleton("title").alias("skel"), hard_rule("title").isNotNull().cast("int").alias("rx")).agg(F.count("*").alias("n"))
    seen = both.join(titles, "skel", "full").select(
        F.row_number().over(Window.partitionBy("skel").orderBy("rx")).alias("k"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("t1", "t2", "rx", "n")]
    )
    t1, t2, rx, n, first = F.col("t1") == 1, F.col("t2") == 1, F.col("rx") == 1, F.col("n"), F.col("k") == 1
    rows_of = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    out = seen.agg(
        F.count_if(t1 & first).alias("h1"), F.count_if(t2 & first).alias("h2"), F.count_if(t1 & t2 & first).alias("shared"), F.count_if(~t1 & t2 & first).alias("drift"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("h2_rows"), rows_of(t1).alias("by_t1"), rows_of(t2).alias("by_t2"), rows_of(rx).alias("by_rules"),
        rows_of(t1 & rx).alias("by_both"), rows_of(rx & ~t1).alias("only_rules"), rows_of(t1 & ~rx).alias("only_t1"), rows_of(t2 & ~t1).alias("drift_rows"),
    )
    return out.withColumn("kept_share", F.round(F.col("by_t1") / F.greatest("by_t2", F.lit(1)), 3))


def document_frequency(rows: DataFrame) -> DataFrame:
    """(tok, df) over titles."""
    return rows.select(F.explode(T.tokens("title")).alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))


def rare_limit(n: int) -> int:
    return max(200, int(n * 0.0014))


def rare_buckets(rows: DataFrame, df: DataFrame, take: int = 3) -> DataFrame:
    """(id, bucket): the rarest `take` tokens of a title, of which those in two titles and more are
    buckets; a title without one is a bucket of its own (solo:<id>)."""
    toks = rows.select("id", F.explode_outer(T.tokens("title")).alias("tok")).join(df, "tok", "left")
    w = Window.partitionBy("id").orderBy("df", "tok")
    top = toks.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= take)
    per = top.groupBy("id").agg(F.array_sort(F.collect_set(F.when(F.col("df") >= 2, F.col("tok")))).alias("b"))
    return per.select("id", F.explode(F.when(F.size("b") > 0, F.col("b")).otherwise(F.array(F.concat(F.lit("solo:"), F.col("id").cast("string"))))).alias("bucket"))


def size_bin(n) -> Column:
    out = F.lit("200+")
    for top, name in ((199, "50-199"), (49, "10-49"), (9, "5-9"), (4, "3-4"), (2, "2"), (1, "1")):
        out = F.when(n <= top, F.lit(name)).otherwise(out)
    return out


def size_histogram(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy(size_bin(F.col("n_articles")).alias("bin")).agg(F.count("*").alias("clusters"))


def diagnostics(stats: DataFrame) -> DataFrame:
    """Clusters of five and more articles: how many, and how many span over 7 and 30 days; and
    clusters by least size and track."""
    span = F.datediff("last_date", "first_date")
    big = F.col("n_articles") >= 5
    return stats.agg(
        F.count_if(big).alias("n5"), F.count_if(big & (span > 7)).alias("over7"), F.count_if(big & (span > 30)).alias("over30"),
        *[F.count_if((F.col("n_articles") >= n) & (F.col("track") == t)).alias(f"{t}_{n}") for n in (2, 3, 5, 8) for t in ("macro", "company")],
    )


def at_least(stats: DataFrame, sizes: tuple[int, ...] = (3, 10)) -> DataFrame:
    """One row: clusters in all, and those of at least so many articles."""
    return stats.agg(F.count("*").alias("clusters_total"), *[F.count_if(F.col("n_articles") >= n).alias(f"clusters_ge{n}") for n in sizes])


def largest(stats: DataFrame, titles: DataFrame, top: int = 25, least: int = 5) -> DataFrame:
    """The `top` largest clusters of at least `least` articles with sample titles: a top-k report."""
    big = stats.filter(F.col("n_articles") >= least).orderBy(F.desc("n_articles"), "event_id").limit(top)
    return big.join(titles, "event_id", "left")


def by_frequency(templates: DataFrame) -> DataFrame:
    """Templates with their place, most frequent first, equals by name. Places follow from counts of
    frequencies; only templates of one frequency are ordered by one task."""
    above = templates.groupBy("freq").agg(F.count("*").alias("c")).select("freq", (F.sum("c").over(Window.orderBy(F.desc("freq"))) - F.col("c")).alias("above"))
    placed = templates.withColumn("k", F.row_number().over(Window.partitionBy("freq").orderBy("skel"))).join(above, "freq")
    return placed.withColumn("place", F.col("above") + F.col("k")).drop("above", "k")
