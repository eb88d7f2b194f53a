"""Benchmark decontamination by a prefix-filtered containment join (DataFrame operators only).

An item window is a short sequence of words that must be contained whole, so the containment
threshold is 1 and the necessary prefix of a window, in order of rarity, is its rarest word: a
text that lacks that word cannot contain the window. Texts are joined on that word alone; the
length bound (a text must hold the window) and the positional bound (the word must leave room on
both sides) drop further candidates before the words are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import NOT_ALNUM, ascii_lower, settle, split_words

#: Up to so many window rows (each about 200 bytes) the windows are broadcast; beyond, shuffled.
BROADCAST_WINDOWS = 200_000


def _words(col):
    return split_words(ascii_lower(F.coalesce(col, F.lit(""))), NOT_ALNUM)


def item_windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct windows with the items that hold them: (win, items). An item of fewer words than
    `width`, but not none, is one window."""
    words = items.select(F.col(item_id).cast("string").alias("item"), _words(F.col(text)).alias("w"))
    n = F.size("w")
    starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))
    return (
        words.select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.slice("w", F.col("s") + 1, width).alias("win"))
        .groupBy("win")
        .agg(F.collect_set("item").alias("items"))
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 8,
    min_items: int = 2,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit (words inside any occurrence of a window),
    n_items, items_sha256, contaminated.

    Null and empty texts have no words and are never contaminated. Repeated rows each get their row,
    rows that share an id but not a text are kept apart. Items without words match nothing; an item
    with a null id marks words as hit but is not counted. Further columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("k"), _words(F.col("text")).alias("w"))
    windows = settle(item_windows(items, item_id, item_text, width), "windows")
    small = windows.count() <= BROADCAST_WINDOWS
    hint = F.broadcast if small else (lambda df: df)

    # Rarity: in how many texts each window word occurs.
    tokens = windows.select("win", F.posexplode("win").alias("off", "tok"))
    vocabulary = tokens.select("tok").distinct()
    # (The outer generators keep the optimizer from splitting every text twice to drop empty ones.)
    frequency = (
        keyed.select(F.explode_outer("w").alias("tok")).join(hint(vocabulary), "tok").groupBy("tok").agg(F.count("*").alias("df"))
    )
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "tok", "off")).alias("r")
    probes = tokens.join(frequency, "tok", "left").groupBy("win").agg(rarest)
    probes = probes.filter("r.df > 0").join(windows, "win").select("win", "items", F.size("win").alias("len"), "r.tok", "r.off")
    # A marker ends every text and meets one empty window, so each text keeps a row. There are as many
    # markers as partitions of a shuffle, four times over, taken in turn by row, so none is a hot key.
    # No word starts with a control character.
    marks = 1 if small else 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = lambda number: F.concat(F.lit("\x01"), number.cast("string"))
    ends = docs.sparkSession.range(marks).select(
        F.array().cast("array<string>").alias("win"), F.array().cast("array<string>").alias("items"),
        F.lit(0).alias("len"), mark(F.col("id")).alias("tok"), F.lit(0).alias("off"),
    )
    probes = settle(probes.unionByName(ends), "probes")

    turn = F.lit(0) if small else F.monotonically_increasing_id() % marks
    at = keyed.withColumn("mark", mark(turn)).select("doc_id", "k", "w", F.size("w").alias("n"), F.posexplode_outer(F.array_append("w", F.col("mark"))).alias("p", "tok"))
    if not small:  # rows are shuffled: carry the neighbourhood of the word, not the text
        lo = F.greatest(F.col("p") - (width - 1), F.lit(0))
        at = at.select("doc_id", "k", "n", "p", "tok", F.slice("w", lo + 1, 2 * width - 1).alias("w"), lo.alias("lo"))
    else:
        at = at.withColumn("lo", F.lit(0))
    start = F.col("p") - F.col("off")
    matches = (
        at.join(hint(probes), "tok")
        .filter((start >= 0) & (start + F.col("len") <= F.col("n")))
        .filter((F.col("len") == 0) | (F.slice("w", start - F.col("lo") + 1, F.col("len")) == F.col("win")))
        .select("doc_id", "k", "n", "items", F.when(F.col("len") > 0, F.struct(start.alias("s"), (start + F.col("len")).alias("e"))).alias("span"))
    )
    covered = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("e")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(a["e"], s["s"]))).cast("long").alias("n"),
            F.greatest(a["e"], s["e"]).alias("e"),
        ),
        lambda a: a["n"],
    )
    per_text = matches.groupBy("doc_id", "k").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count_if(F.col("span").isNull()).alias("rows"),
        F.collect_set("span").alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"),
    )
    return per_text.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.size("ids") >= min_items).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 7], ' ') AS g, least(len(w), 8) AS l
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT l FROM win),
dw AS (SELECT r, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
       FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, sizes WHERE len(w) >= l)),
hit AS (SELECT dw.r, dw.s, dw.l, win.item_id FROM dw JOIN win ON dw.g = win.g AND dw.l = win.l),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + l)) AS p FROM (SELECT DISTINCT r, s, l FROM hit)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN its USING (r)
"""
