"""Dedup keys of records, by priority: filing, URL, post, robot template, content, id.

Records are structs as `eventloom.sources.records` yields them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions import text as T
from eventloom.functions import urls, vocab


def sha_key(prefix: str, value) -> Column:
    return F.concat(F.lit(f"{prefix}:sha256:"), F.sha2(value, 256))


def plain_market_text(c) -> Column:
    """References decoded, link texts for links, codes for code attributes, no tags or URLs, lower
    case, everything but [a-z0-9$%.-] to one space."""
    x = T.html_unescape(T.blank(c))
    x = F.regexp_replace(x, r"\[([^\]]+)\]\([^)]+\)", " $1 ")
    x = F.regexp_replace(x, r"(?i)data-code=[\"']?([A-Za-z0-9.\-]{1,12})[^>]*>", "> $1 ")
    x = F.regexp_replace(x, r"<[^>]+>", " ")
    x = F.regexp_replace(x, r"(?i)https?://\S+|www\.\S+", " ")
    return F.trim(F.regexp_replace(F.lower(x), r"[^a-z0-9$%.\-]+", " "))


def symbols(body, stocks) -> Column:
    """Sorted distinct symbols of a record's stocks and of four marks in its text, the first twelve."""
    families = [r"(?i)data-code=[\"']?([A-Za-z0-9.\-]{1,12})", r"(?i)/stocks/(?:[A-Z]+-)?([A-Z0-9.\-]{1,12})",
                r"(?<![A-Za-z0-9_])\$([A-Z][A-Z0-9.\-]{0,11})(?![A-Za-z0-9_])", r"\(([A-Z][A-Z0-9.\-]{0,11})\)"]
    found = F.concat(F.coalesce(stocks, F.array().cast("array<string>")), *[F.regexp_extract_all(T.blank(body), F.lit(p), F.lit(1)) for p in families])
    upper = F.transform(found, lambda s: F.regexp_replace(F.upper(F.trim(s)), r"^[.\-]+|[.\-]+$", ""))
    return F.slice(F.array_sort(F.array_distinct(F.filter(upper, lambda s: s.rlike(r"^[A-Z][A-Z0-9.\-]{0,11}$")))), 1, 12)


def title_slug(title) -> Column:
    """The first six words before 's, |, : or -, joined by _; null under three characters."""
    subject = F.regexp_replace(plain_market_text(F.split(T.html_unescape(T.blank(title)), r"'s|\||:|-", 2)[0]), r"^[ .\-]+|[ .\-]+$", "")
    return F.when(F.length(subject) >= 3, F.array_join(F.slice(F.split(subject, r"\s+"), 1, 6), "_"))


def notice_key(content_type, attachments) -> Column:
    """Filing number of the first attachment that has one, else the first normal URL."""
    numbers = F.filter(F.transform(attachments, lambda a: T.accession(a["url"])), lambda x: x.isNotNull())
    links = F.filter(F.transform(attachments, lambda a: urls.normalize_url(a["url"])), lambda x: x.isNotNull())
    key = F.coalesce(F.concat(F.lit("notice:"), F.get(numbers, F.lit(0))), sha_key("notice_url", F.get(links, F.lit(0))))
    return F.when(content_type == "US_NOTICE", key)


def post_key(content_type, body, stocks) -> Column:
    plain = plain_market_text(body)
    enough = (F.length(plain) >= 32) & (F.size(F.split(plain, " ")) >= 5)
    value = F.concat(F.lit("symbols="), F.array_join(symbols(body, stocks), ","), F.lit("|body="), plain)
    return F.when((content_type == "US_POST") & enough, sha_key("post", value))


def robot_key(content_type, title, body, stocks, published_at) -> Column:
    """Financial, then technical, then insider template of a robot's text."""
    plain = plain_market_text(F.concat_ws("\n", T.blank(title), T.blank(body)))
    padded = F.concat(F.lit(" "), plain, F.lit(" "))
    symbol = F.get(symbols(F.concat_ws("\n", T.blank(title), T.blank(body)), stocks), F.lit(0))
    subject, day = F.coalesce(symbol, title_slug(title)), T.published_day(published_at)

    results = plain.contains("financial results") | (padded.contains(" revenue ") & padded.contains(" net income ")) | plain.rlike(
        r"\bq[1-4]\b.*\bearnings\b|\bearnings\b.*\bq[1-4]\b"
    )
    year = T.first_filled(F.regexp_extract(plain, r"\b(20\d{2})\b", 1), F.substring(day, 1, 4))
    named = F.regexp_extract(plain, r"\b(q[1-4]|first quarter|second quarter|third quarter|fourth quarter|half[- ]year|full year|annual)\b", 1)
    period = F.coalesce(F.nullif(F.translate(named, " -", "__"), F.lit("")), F.lit("unknown_period"))
    financial = F.when(results & symbol.isNotNull(), F.concat_ws("|", F.lit("financial_results"), symbol, F.coalesce(year, F.lit("")), period))

    chart = plain.contains("chart signals") | plain.contains("bollinger") | padded.contains(" rsi ")
    frame = F.translate(F.regexp_extract(plain, r"\b(\d+\s*min|\d+\s*hour|\d+\s*day|daily|weekly)\b", 1), " ", "")
    seen = F.array_compact(F.array(*[F.when(plain.rlike(p), F.lit(n)) for n, p in sorted(vocab.SIGNALS.items())]))
    technical = F.when(
        chart & subject.isNotNull() & (F.size(seen) > 0),
        F.concat_ws("|", F.lit("technical_signal"), subject, F.coalesce(F.nullif(frame, F.lit("")), F.lit("unknown_timeframe")), F.array_join(seen, "+"), day),
    )
    insider = F.when(
        (plain.contains("insider transactions reported") | plain.contains("insider trading")) & subject.isNotNull(),
        F.concat_ws("|", F.lit("insider_transaction"), subject, day),
    )
    return F.when(content_type == "US_ROBOT", F.concat(F.lit("robot_template:"), F.coalesce(financial, technical, insider)))


def dedup_key(r) -> Column:
    """struct(key, method) of a record: `r` maps a field name to its Column."""
    stocks = F.transform(r("entities.stocks"), lambda s: s["symbol"])
    choices = {
        "notice_attachment": notice_key(r("content_type"), r("notice.attachments")),
        "source_url": F.when(urls.is_article_url(r("source.url")), sha_key("url", urls.normalize_url(r("source.url")))),
        "post_fingerprint": post_key(r("content_type"), r("body"), stocks),
        "robot_template": robot_key(r("content_type"), r("title"), r("body"), stocks, r("published_at")),
        "content_hash": T.content_hash(r("title"), r("body")),
        "id": F.concat(F.lit("id:"), r("id")),
    }
    return F.coalesce(*[F.when(k.isNotNull(), F.struct(k.alias("key"), F.lit(m).alias("method"))) for m, k in choices.items()])
