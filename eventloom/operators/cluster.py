"""Event clusters: tracks, band join by similarity, merging, statistics and corroboration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.functions import text as T
from eventloom.functions import vocab
from eventloom.operators.graph import components

SPAN_DAYS, JACCARD, RATIO, OVERLAP, LOOK_BACK = 3, 0.15, 72, 0.3, 400
#: Tokens of a group of rows that are counted at a time.
COLUMNS = 4096


def topic(title, topics: dict[str, str]) -> Column:
    """The first topic whose pattern the lower-case title meets; null if none."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(topics.items()):
        out = F.when(F.lower(T.blank(title)).rlike(pattern), F.lit(name)).otherwise(out)
    return out


def pool(index: DataFrame) -> DataFrame:
    """Index rows that may be events, in company and macro buckets: (bucket, track, ...)."""
    kept = index.filter(
        F.col("content_type").isin("US_NEWS", "US_FLASH", "US_ARTICLE", "US_POST") & (F.col("pub_date") != "") & (F.col("body_len") >= 200) & (F.col("title") != "")
    )
    for tag in vocab.NOISE_TAGS:
        kept = kept.filter(~F.coalesce(F.col("tags").like(f"%{tag}%"), F.lit(False)))
    company = kept.filter(F.col("n_symbols").between(1, 8)).withColumn("bucket", F.explode(F.split("symbols", ",")))
    company = company.filter(F.col("bucket").rlike(r"^[A-Z][A-Z0-9.\-]{0,5}$")).withColumn("track", F.lit("company"))
    macro = kept.filter((F.col("n_symbols") == 0) & ~F.col("has_crypto")).withColumn("bucket", topic("title", vocab.MACRO_TOPICS))
    return company.unionByName(macro.filter("bucket IS NOT NULL").withColumn("track", F.lit("macro")))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows (bucket, id, day) with `ord`, their place in the bucket by day and id. Only the counts of
    days are ordered by whole buckets; rows are ordered by bucket and day, so no task holds a bucket."""
    ahead = Window.partitionBy("bucket").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy("bucket", "day").agg(F.count("*").alias("c")).select("bucket", "day", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("before"))
    placed = rows.withColumn("in_day", F.row_number().over(Window.partitionBy("bucket", "day").orderBy("id")))
    return placed.join(days, ["bucket", "day"]).withColumn("ord", F.col("before") + F.col("in_day")).drop("before", "in_day")


def shared_counts(codes: np.ndarray, row: np.ndarray, n: int, first: int, words: int) -> np.ndarray:
    """How many of their distinct tokens each of n rows shares with each from `first` on: products of 0/1
    matrices, of COLUMNS tokens at a time. Tokens are codes below `words`, with their rows beside them."""
    several = np.bincount(codes, minlength=words) > 1
    place = np.cumsum(several) - 1
    keep = several[codes]  # a token of one row is shared with none
    at, row = place[codes[keep]], row[keep]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    out = np.zeros((n, n - first), np.float32)
    for lo in range(0, int(several.sum()), COLUMNS):
        i, j = np.searchsorted(at, (lo, lo + COLUMNS))
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[i:j], at[i:j] - lo] = 1
        out += m @ m[first:].T
    return out


def similar_pairs(rows: DataFrame, ratio: float | None = RATIO, jaccard: float = JACCARD, days: int = SPAN_DAYS, look_back: int = LOOK_BACK, rare: DataFrame | None = None, lower: bool = False) -> DataFrame:
    """(bucket, a, b) of rows (bucket, id, day, title) without null days: at most `days` and `look_back`
    rows apart in a bucket, token Jaccard and, unless None, word-set ratio reached. With `rare` (tok)
    pairs must share a rare token. Buckets are cut into blocks of look_back rows, and a row meets its own
    block and the next, so a hot bucket is many groups of at most two blocks. In a group shared tokens are
    counted exactly for all pairs at once; only pairs that reach the bounds leave it."""
    t = F.lower("title") if lower else F.col("title")
    base = ordered(rows.select("bucket", "id", "day", t.alias("title")).filter("bucket IS NOT NULL AND day IS NOT NULL")).withColumn("toks", T.tokens("title"))
    if rare is not None:
        hit = base.select("bucket", "id", F.explode("toks").alias("tok")).join(rare, "tok").groupBy("bucket", "id").agg(F.collect_set("tok").alias("rare"))
        base = base.join(hit, ["bucket", "id"])  # rows without a rare token share none
    base = base.withColumns({"day": F.datediff("day", F.lit("1970-01-01").cast("date")), "block": F.floor((F.col("ord") - 1) / look_back)}).filter("day IS NOT NULL")
    lists = ["toks", "rare"] if rare is not None else ["toks"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # pairs are many where rows are few, so tasks must not be merged by bytes
    placed = base.withColumn("ahead", F.explode(F.array(F.lit(0), F.lit(1)))).select("bucket", "id", "title", "ord", "day", *lists, (F.col("block") + F.col("ahead")).alias("block"), (1 - F.col("ahead")).alias("own")).repartition(parts, "bucket", "block")

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("own", "ascending"), ("ord", "ascending")]).combine_chunks()
        n, (order, day) = table.num_rows, (table.column(c).to_numpy().astype(np.int64) for c in ("ord", "day"))
        first = int(n - table.column("own").to_numpy().sum())
        x = y = np.zeros(0, np.int64)
        if first < n:
            back, apart = order[None, first:] - order[:, None], day[None, first:] - day[:, None]
            ok = (back > 0) & (back <= look_back) & (apart <= days)
            for name in reversed(lists):
                column = pa.concat_arrays(table.column(name).chunks)
                size = np.diff(column.offsets.to_numpy())
                coded = column.flatten().dictionary_encode()
                shared = shared_counts(coded.indices.to_numpy(), np.repeat(np.arange(n), size), n, first, len(coded.dictionary)).astype(np.int64)
                if name == "rare":
                    ok &= shared > 0
                else:
                    union = size[:, None] + size[None, first:] - shared  # tokens are distinct
                    ok &= (union > 0) & (shared / np.maximum(union, 1) >= jaccard)
            x, y = np.nonzero(ok)
            y = y + first
        of = lambda name, at: table.column(name).take(pa.array(at))
        return pa.table({"bucket": of("bucket", x), "a": of("id", x), "b": of("id", y), "ta": of("title", x), "tb": of("title", y)})

    kinds = {f.name: f.dataType for f in placed.schema.fields}
    schema = StructType([StructField("bucket", kinds["bucket"]), StructField("a", kinds["id"]), StructField("b", kinds["id"]), StructField("ta", StringType()), StructField("tb", StringType())])
    pairs = placed.groupBy("bucket", "block").applyInArrow(meet, schema)
    return pairs.filter(T.token_set_ratio("ta", "tb") >= ratio).drop("ta", "tb") if ratio is not None else pairs.drop("ta", "tb")


def clusters_in_buckets(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cid, id): clusters of whole buckets; a row without a pair is a cluster of its own."""
    node = lambda c: F.concat_ws("|", "bucket", c)
    comps = components(pairs.select(node("a").alias("a"), node("b").alias("b")))
    named = rows.select("bucket", "id", node("id").alias("node"))
    return named.join(comps, "node", "left").select(F.coalesce("comp", "node").alias("cid"), "id")


def merge_overlapping(members: DataFrame, share: float = OVERLAP) -> DataFrame:
    """(event_id, id): clusters that share at least `share` of the smaller one's ids become one
    event, whose id follows from its smallest member."""
    members = members.distinct()
    sizes = members.groupBy("cid").agg(F.count("*").alias("n"))
    x, y = members.alias("x"), members.alias("y")
    common = x.join(y, (F.col("x.id") == F.col("y.id")) & (F.col("x.cid") < F.col("y.cid"))).groupBy(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).agg(F.count("*").alias("c"))
    sized = common.join(sizes.withColumnsRenamed({"cid": "a", "n": "na"}), "a").join(sizes.withColumnsRenamed({"cid": "b", "n": "nb"}), "b")
    comps = components(sized.filter(F.col("c") / F.least("na", "nb") >= share).select("a", "b"))
    rooted = members.join(comps, members.cid == comps.node, "left").select(F.coalesce("comp", "cid").alias("root"), "id").distinct()
    ids = rooted.groupBy("root").agg(F.min("id").alias("least"))
    return rooted.join(ids, "root").select(F.concat(F.lit("EVT_"), F.substring(F.sha1(F.col("least").cast("string").cast("binary")), 1, 12)).alias("event_id"), "id")


def event_stats(members: DataFrame) -> DataFrame:
    """Statistics of events over members with event_id, id, source_name, content_type, pub_date,
    importance, track, title, body_len. Ties: earliest day, then the smallest id."""
    rest = F.struct("title", "source_name", "content_type", "pub_date", "importance", "track", "body_len")
    one = members.groupBy("event_id", "id").agg(F.min(rest).alias("m")).select("event_id", "id", "m.*")  # of rows that repeat an id the least
    return one.groupBy("event_id").agg(
        F.count("*").alias("n_articles"), F.countDistinct("source_name").alias("n_sources"), F.countDistinct("content_type").alias("n_content_types"),
        F.min("pub_date").alias("first_date"), F.max("pub_date").alias("last_date"), F.mode("pub_date", True).alias("peak_date"),
        F.sum((F.col("importance") == "high").cast("long")).alias("n_high"), F.max("track").alias("track"),
        F.min_by("title", F.struct(-F.col("body_len"), "id")).alias("rep_title"),
    )


def event_symbols(pairs: DataFrame, most: int = 30) -> DataFrame:
    """(event_id, all_symbols): the first `most` symbols in order, joined. `pairs`: (event_id, sym)."""
    top = Window.partitionBy("event_id").orderBy("sym")
    kept = pairs.distinct().withColumn("rk", F.row_number().over(top)).filter(F.col("rk") <= most)
    return kept.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_list("sym")), ",").alias("all_symbols"))


def corroboration(symbols: DataFrame, stats: DataFrame, reactions: DataFrame, before: int = 1, after: int = 7) -> DataFrame:
    """(event_id, n_v2_reactions): distinct documents on a symbol of the event from `before` days
    ahead of its peak to `after` days past it, for events of two articles and more."""
    width = before + after + 1
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    e = symbols.join(stats.filter("n_articles >= 2").select("event_id", (day("peak_date") - before).alias("lo")), "event_id")
    # Days are cut into blocks as long as a window, so a window is in two at most; the join is on symbol and
    # block and forms no more of a symbol's history than twice the window.
    block = lambda c: F.floor(c / width)
    asks = e.select("event_id", "sym", "lo", F.explode(F.sequence(block(F.col("lo")), block(F.col("lo") + width - 1))).alias("block"))
    seen = reactions.select("sym", "doc_id", day("d").alias("day")).withColumn("block", block(F.col("day")))
    hit = asks.join(seen, ["sym", "block"]).filter(F.col("day").between(F.col("lo"), F.col("lo") + width - 1))
    return hit.groupBy("event_id").agg(F.countDistinct("doc_id").alias("n_v2_reactions"))


def day_margin(rows: DataFrame, date: str, days: int = 7, day: str = "pub_date") -> DataFrame:
    """Rows within `days` days of a date, so that clusters that reach it are whole."""
    around = [F.date_format(f(F.lit(date).cast("date"), days), "yyyy-MM-dd") for f in (F.date_sub, F.date_add)]
    return rows.filter(F.col(day).between(*around))


def merged_spans(members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Events of merged clusters with their distinct ids, first and last day, and track: macro if one of
    the clusters is. members: event_id, cid, id; clusters: cid, first_day, last_day, track."""
    whole = members.select("event_id", "cid").distinct().join(clusters, "cid").groupBy("event_id").agg(
        F.count("*").alias("n_clusters"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.max("track").alias("track")
    )  # macro comes after company
    return whole.join(members.groupBy("event_id").agg(F.countDistinct("id").alias("n_articles")), "event_id")
