"""Host-level quality rules (DataFrame operators only).

Every text gets base counts and a base verdict. Failures are then counted by host and the hosts' rates
are shrunk towards an empirical beta prior fitted over all hosts by moments. A host is rejected, and
loses its remaining documents too, where even the lower bound of its shrunk rate (SURE posterior
standard deviations below) lies APART of the prior's standard deviations above its mean and reaches
LEAST_RATE. Where all hosts fail alike, none is an outlier and none is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import settle, split_words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Posterior and prior standard deviations of the bounds, and the rate of failures below which no host is rejected.
SURE, APART, LEAST_RATE = 2.0, 1.0, 0.25
#: Host tables up to so many rows are broadcast; beyond, joined by shuffle.
BROADCAST_HOSTS = 500_000


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host and the base counts and verdict of every text; null texts have no words."""
    text = F.coalesce("text", F.lit(""))
    spaced = text  # a split at one plain character needs no regular expression
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    words = docs.select("doc_id", "host", text.alias("t"), split_words(spaced, " ").alias("w"))
    n = F.size("w")
    # One hash per window of five words; n_repeat_words needs the positions of repeated ones only.
    shifted = F.arrays_zip("w", *[F.slice("w", k + 1, F.greatest(n, F.lit(0))).alias(f"w{k}") for k in range(1, WINDOW)])
    grams = F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(shifted, 1, n - WINDOW + 1), lambda z: F.xxhash64(z))
    )
    symbols = F.col("t")
    for c in SYMBOLS:  # byte searches; far cheaper than one pass by characters
        symbols = F.replace(symbols, F.lit(c), F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = words.select(
        "doc_id",
        "host",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(symbols)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        grams.alias("g"),
    )
    pairs = F.when(
        F.size(F.array_distinct("g")) < F.size("g"),
        F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    marked = counted.select("*", pairs.alias("s"))
    twice = F.sort_array(
        F.transform(
            F.filter("s", lambda x, j: (F.get("s", j - 1)["h"] == x["h"]) | (F.get("s", j + 1)["h"] == x["h"])),
            lambda x: x["i"],
        )
    )
    marked = marked.select("*", twice.alias("p"))
    covered = F.aggregate(
        "p",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("e")),
        lambda a, i: F.struct(
            (a["n"] + (i + WINDOW) - F.greatest(a["e"], i)).cast("long").alias("n"), (i + WINDOW).alias("e")
        ),
        lambda a: a["n"],
    )
    out = marked.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return out.withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    )


def host_verdicts(counted: DataFrame, least_rate: float = LEAST_RATE) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, lower, upper, host_rejected. The prior Beta(a, b) has the mean
    and, by moments over the hosts, the spread of the hosts' rates, less what binomial noise explains;
    with one host, or no spread, it weighs as much as the documents of a mean host."""
    hosts = settle(
        counted.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")),
        "host-counts",
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("n_docs")).alias("inv"), F.avg("n_docs").alias("mean_docs"))
    m, v, inv, mean_docs = (0.0 if x is None else x for x in moments.first())  # one row, of four numbers
    extra = v - m * (1 - m) * inv
    weight = max(m * (1 - m) / extra - 1, 1.0) if extra > 0 else mean_docs
    upper = m + APART * (m * (1 - m) / (weight + 1)) ** 0.5
    shrunk = (F.col("n_failed") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
    lower = F.col("shrunk_rate") - SURE * F.sqrt(F.col("shrunk_rate") * (1 - F.col("shrunk_rate")) / (F.col("n_docs") + F.lit(weight) + 1))
    judged = hosts.withColumn("shrunk_rate", shrunk).withColumn("lower", lower).withColumn("upper", F.lit(upper))
    return judged.withColumn("host_rejected", F.col("lower") >= F.greatest("upper", F.lit(least_rate)))


def apply_host_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", least_rate: float = LEAST_RATE
) -> DataFrame:
    """Base counts, base_failed and kept for every row of `docs`.

    A null text has no words and fails the base rule, as an empty one does. Documents without a host
    are judged by the base rule alone. Repeated rows count as often as they occur; an empty table
    gives an empty result, very long texts are counted whole, and further columns are ignored.
    Windows of a text are told apart by a 64-bit hash.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host"))
    counted = settle(base_counts(docs), "base-counts")
    verdicts = settle(host_verdicts(counted, least_rate), "hosts")
    rejected = verdicts.filter("host_rejected").select(F.col("host").alias("h"))
    if rejected.count() <= BROADCAST_HOSTS:
        rejected = F.broadcast(rejected)
    joined = counted.join(rejected, F.col("host") == F.col("h"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("h").isNull()).drop("host", "h")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, s, array_to_string(w[s:s + 4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 5)) AS p FROM
        (SELECT r, s, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1) GROUP BY r),
c AS (SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, avg(1 / n) AS inv, avg(n) AS mean_docs FROM h),
p AS (SELECT m, CASE WHEN v - m * (1 - m) * inv > 0 THEN greatest(m * (1 - m) / (v - m * (1 - m) * inv) - 1, 1.0) ELSE mean_docs END AS wt FROM m),
s AS (SELECT source, n, (k + m * wt) / (n + wt) AS s, wt, m + 1 * sqrt(m * (1 - m) / (wt + 1)) AS upper FROM h, p),
bad AS (SELECT source FROM s WHERE s - 2 * sqrt(s * (1 - s) / (n + wt + 1)) >= greatest(upper, 0.25))
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM f
"""
