"""URL normal form and the reasons to refuse a URL as an article's key, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions import vocab
from eventloom.functions.text import blank

PARTS = r"^(?i)(https?)://([^/?#\s]+)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _part(url, k: int) -> Column:
    return F.regexp_extract(F.trim(blank(url)), PARTS, k)


def _decoded(c: Column) -> Column:
    """A query part without plus signs and percent codes; a percent sign that begins no code stays."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    """A query part with all but letters, digits and _.-~ in percent codes, and blanks as plus signs."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _pairs(url) -> Column:
    """Decoded query parameters as (key, value); a value may be blank or missing."""
    parts = F.filter(F.split(_part(url, 4), "&"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=?", "")).alias("v")))


def normalize_url(url) -> Column:
    """Lower-case scheme and host, no fragment, no trailing slash, no tracking parameters, the
    others decoded, sorted and encoded anew; null for what is no http(s) URL."""
    raw = _part(url, 3)
    path = F.when(raw.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(raw, "/+$", ""))
    tracking = F.array(*[F.lit(k) for k in vocab.TRACKING_KEYS])
    kept = F.filter(_pairs(url), lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.array_contains(tracking, F.lower(p["k"])))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    whole = F.concat(F.lower(_part(url, 1)), F.lit("://"), F.lower(_part(url, 2)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(_part(url, 1) != "", whole)


def reject_reason(url) -> Column:
    """Why a URL is no article's: missing, invalid, a feed or API path, a sitemap, a list query; else null."""
    path = F.lower(_part(url, 3))
    holds = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: path.contains(w))
    lists = F.array(*[F.lit(k) for k in vocab.LIST_KEYS])
    return (
        F.when(F.trim(blank(url)) == "", F.lit("missing_url"))
        .when(_part(url, 1) == "", F.lit("invalid_url"))
        .when(holds(vocab.FEED_PATHS), F.lit("feed_or_api_path"))
        .when(holds(vocab.SITEMAPS), F.lit("sitemap_url"))
        .when(F.exists(_pairs(url), lambda p: F.array_contains(lists, F.lower(p["k"]))), F.lit("feed_or_list_query"))
    )


def is_article_url(url) -> Column:
    return normalize_url(url).isNotNull() & reject_reason(url).isNull()


def host(url) -> Column:
    return F.lower(_part(url, 2))
