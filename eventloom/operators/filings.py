"""The 8-K track: filings, their paragraphs, summaries and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.sources.records import paragraph_documents


def is_8k(attachments) -> Column:
    """Whether an attachment's file type is exactly 8-K; amendments are not."""
    return F.coalesce(F.exists(attachments, lambda a: a["file_type"] == "8-K"), F.lit(False))


def in_window(day, date: str | None = None, days: int = 0, month: str | None = None) -> Column:
    """Days around a date, or a month, but not both; everything without either."""
    if date and month:
        raise ValueError("a day and a month exclude each other")
    if date:
        return F.col(day).between(F.date_format(F.date_sub(F.lit(date).cast("date"), days), "yyyy-MM-dd"), F.date_format(F.date_add(F.lit(date).cast("date"), days), "yyyy-MM-dd"))
    return F.substring(F.col(day), 1, 7).isin(*month.split(",")) if month else F.lit(True)


def filing_events(records: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """One row per 8-K of cleaned records. The summary is the record's first sentence; without a
    body, the item title or first sentence of the filing's paragraphs (accession, paragraph_index,
    text); else null. Paragraphs are pruned to wanted filings before they are put together."""
    first = F.get(F.filter("notice.attachments", lambda a: a["file_type"] == "8-K"), F.lit(0))
    base = records.filter(is_8k(F.col("notice.attachments"))).select(
        "id", F.coalesce(T.accession(first["url"]), T.accession("source.url")).alias("accession"), T.cik(first["url"]).alias("cik"),
        T.first_filled("notice.declare_date", T.published_day("published_at")).alias("declare_date"), "title", "body",
        F.transform("entities.stocks", lambda s: s["symbol"]).alias("symbols"), first["url"].alias("url"),
    )
    wanted = base.filter((T.blank("body") == "") & F.col("accession").isNotNull()).select("accession").distinct()
    texts = paragraph_documents(paragraphs.join(wanted, "accession", "left_semi"), "accession", "paragraph_index", "text")
    joined = base.join(texts.select("accession", F.col("body").alias("filed")), "accession", "left")
    text = T.first_filled("body", "filed")
    summary = F.when(T.blank("body") != "", T.first_sentence("body")).when(T.blank("filed") != "", F.coalesce(T.item_title("filed"), T.first_sentence("filed")))
    origin = F.when(T.blank("body") != "", "native").when(T.blank("filed") != "", "v2").otherwise("none")
    return joined.select(
        "id", "accession", "cik", "declare_date", "title", "symbols", "url", T.item_number(text).alias("item"), T.item_title(text).alias("item_title"),
        F.substring(summary, 1, 12000).alias("summary"), origin.alias("summary_source"), F.concat(F.lit("EVT8K_"), "accession").alias("event_id"),
    )


def usable(events: DataFrame) -> DataFrame:
    """Events with a summary and a filing number."""
    return events.filter((T.blank("summary") != "") & (T.blank("accession") != ""))


def latest_day(rows: DataFrame, day: str) -> DataFrame:
    """The rows of the latest non-empty day."""
    top = rows.filter(F.col(day) != "").agg(F.max(day).alias("top"))  # one row
    return rows.join(F.broadcast(top), F.col(day) == F.col("top"), "left_semi")


def as_member(events: DataFrame) -> DataFrame:
    """A filing event as an article of its own event; events without a summary have none."""
    title = F.coalesce(T.first_filled("title"), F.concat(F.lit("Form 8-K Item "), F.coalesce(T.first_filled("item"), F.lit("?"))))
    return events.filter(T.blank("summary") != "").select(
        "event_id", F.coalesce(T.first_filled("id"), F.col("event_id")).alias("id"), F.lit("SEC EDGAR 8-K").alias("source_name"), title.alias("title"), F.col("declare_date").alias("pub_date"),
        F.col("url"), F.length("summary").alias("body_len"), F.col("summary").alias("body"),
    )


def source_url(source) -> Column:
    """The URL of a source that is a dict as text, else the first URL in the text; null if none."""
    found = F.nullif(F.regexp_extract(T.blank(source), r"https?://[^\s'\"}]+", 0), F.lit(""))
    return F.coalesce(T.first_filled(T.literal_dict(source)["url"]), found)
