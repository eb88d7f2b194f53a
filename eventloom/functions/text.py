"""Column functions on text: normal forms, tokens, keys of titles, filings and dates.

All are built-in expressions but for three Arrow UDFs (html_to_text, html_unescape,
token_set_ratio), whose semantics the built-ins lack.
"""

from __future__ import annotations

import re

import html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from eventloom.functions import vocab


DAY = r"^\d{4}-\d{2}-\d{2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """'' for null."""
    return F.coalesce(_col(c), F.lit(""))


def first_filled(*cols) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])


def normalize_text(c, unicode_space: bool = True) -> Column:
    """White space runs to one space, trimmed, lower case; null is ''. With unicode_space, no-break
    and other Unicode spaces count as white space."""
    space = r"(?U)\s+" if unicode_space else r"[ \t\n\r\f]+"
    return F.lower(F.trim(F.regexp_replace(blank(c), space, " ")))


def content_hash(title, body, unicode_space: bool = True) -> Column:
    """hash:sha256:<of normal title | normal body>; null when both are empty."""
    t, b = normalize_text(title, unicode_space), normalize_text(body, unicode_space)
    return F.when((t != "") | (b != ""), F.concat(F.lit("hash:sha256:"), F.sha2(F.concat_ws("|", t, b), 256)))


def iso_time(seconds) -> Column:
    """Epoch seconds to yyyy-MM-ddTHH:mm:ssZ; null for null, 0 and what is no number."""
    s = _col(seconds).try_cast("long")
    return F.when(s != 0, F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def norm_date(c) -> Column:
    """The leading yyyy-MM-dd if in range, else ''."""
    d = F.regexp_extract(blank(c), r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.when(d.between(*vocab.DATE_RANGE), d).otherwise("")


def published_day(c) -> Column:
    return F.when(F.length(blank(c)) >= 10, F.substring(_col(c), 1, 10)).otherwise("")


def days_apart(a, b) -> Column:
    """Absolute days between two date strings; 999 where one is none."""
    d = lambda c: F.try_to_date(_col(c), "yyyy-MM-dd")
    return F.coalesce(F.abs(F.datediff(d(a), d(b))), F.lit(999))


def date_gap_days(a, b) -> Column:
    """Absolute value of the floored days between two ISO times: -13.5 days counts 14, 13.5 counts 13."""
    t = lambda c: F.unix_timestamp(F.try_to_timestamp(_col(c)))
    return F.abs(F.floor((t(a) - t(b)) / 86400))


def tokens(c) -> Column:
    """Distinct title tokens: lower-case [a-z0-9]+ of at least two characters, without stop words."""
    found = F.regexp_extract_all(F.lower(blank(c)), F.lit("[a-z0-9]+"), F.lit(0))
    stop = F.array(*[F.lit(w) for w in vocab.STOP_WORDS])
    return F.array_except(F.filter(found, lambda t: F.length(t) > 1), stop)


def token_jaccard(a, b) -> Column:
    """Shared over all distinct elements of two arrays; 0 for two empty ones."""
    union = F.size(F.array_union(_col(a), _col(b)))
    return F.when(union > 0, F.size(F.array_intersect(_col(a), _col(b))) / union).otherwise(F.lit(0.0))


def _title_words(c) -> Column:
    """Words of a title without the punctuation around them, with their kind: # has a digit, @ is a name."""
    edge = "[" + re.escape(vocab.TITLE_STRIP) + "]+"
    words = F.filter(F.split(blank(c), r"(?U)\s+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.regexp_replace(w, f"^{edge}|{edge}$", ""))
    return F.transform(bare, lambda w: F.struct(w.alias("w"), F.when(w.rlike(r"(?U)\d"), "#").when(w.rlike(vocab.NAME_WORD), "@").otherwise("").alias("kind")))


def skeleton(c) -> Column:
    """Title template: words with a digit are #, runs of names and codes one @, others lower case."""
    words = _title_words(c)
    run = lambda w, i: (w["kind"] == "@") & (F.coalesce(F.get(words, i - 1)["kind"], F.lit("")) == "@")
    kept = F.filter(words, lambda w, i: ~run(w, i))
    return F.array_join(F.transform(kept, lambda w: F.when(w["kind"] == "", F.lower(w["w"])).otherwise(w["kind"])), " ")


def subjects(c) -> Column:
    """The names that a skeleton replaces by @, in lower case and joined: the subject of a title."""
    return F.array_join(F.transform(F.filter(_title_words(c), lambda w: w["kind"] == "@"), lambda w: F.lower(w["w"])), " ")


def title_key(c, length: int = 60) -> Column:
    """Lower case, white space runs to one space, not trimmed, cut."""
    return F.substring(F.lower(F.regexp_replace(blank(c), r"\s+", " ")), 1, length)


def first_sentence(c) -> Column:
    return F.split(F.trim(blank(c)), r"(?<=[.!?])\s", 2)[0]


def item_number(c) -> Column:
    return F.nullif(F.regexp_extract(blank(c), vocab.ITEM, 1), F.lit(""))


def item_title(c) -> Column:
    t = F.regexp_replace(F.regexp_extract(blank(c), vocab.ITEM, 2), r"\s+", " ")
    return F.nullif(F.regexp_replace(t, r"^[ ;,.]+|[ ;,.]+$", ""), F.lit(""))


def accession(url) -> Column:
    """The first 18 digits in a row, or with the dashes of a filing number."""
    flat = F.regexp_extract(F.regexp_replace(blank(url), r"(\d{10})-(\d{2})-(\d{6})", "$1$2$3"), r"(\d{18})", 1)
    return F.nullif(flat, F.lit(""))


def cik(url) -> Column:
    return F.nullif(F.regexp_extract(blank(url), r"edgar/data/(\d+)/", 1), F.lit(""))


def source_rank(name) -> Column:
    """Place of the first preferred source that the name contains; their number if none."""
    out = F.lit(len(vocab.PREFERRED_SOURCES))
    for i, s in reversed(list(enumerate(vocab.PREFERRED_SOURCES))):
        out = F.when(F.lower(blank(name)).contains(s), F.lit(i)).otherwise(out)
    return out


def clean_body(c, limit: int = 2800) -> Column:
    """Tags to spaces, character references decoded, white space collapsed, cut."""
    text = html_unescape(F.regexp_replace(blank(c), r"<[^>]+>", " "))
    return F.substring(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), 1, limit)


def snippet(c, limit: int = 200) -> Column:
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(blank(c), r"<[^>]+>", " "), r"\s+", " ")), 1, limit)


def title_pattern(name) -> Column:
    """A pattern of a company's first two words without the ends of company names, however many follow
    each other; '' under four characters. A name that is such an end and nothing else stays."""
    bare = F.regexp_replace(blank(name), r"(?U)^\s+|\s+$", "")
    one = vocab.NAME_SUFFIX.removeprefix("(?i)").removesuffix("$")
    stripped = F.regexp_replace(bare, rf"(?i)^(.*?\S)(?:{one}\s*)+$", "$1")
    words = F.slice(F.filter(F.split(stripped, r"(?U)\s+"), lambda w: w != ""), 1, 2)
    pattern = F.array_join(F.transform(words, lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}_])", r"\\$1")), r"\s+")
    return F.when(F.length(F.array_join(words, "")) >= 4, pattern).otherwise("")


def related_code(c) -> Column:
    """AAPL.O and the like to the bare code; others unchanged."""
    bare = F.regexp_extract(_col(c), r"^([A-Z][A-Z0-9.\-]{0,9})\.(O|N|OQ|A|K|P)$", 1)
    return F.when(bare != "", bare).otherwise(_col(c))


def json_text(c) -> Column:
    """A JSON value from a text, or from its outermost braces; null if neither parses."""
    return F.coalesce(F.try_parse_json(_col(c)), F.try_parse_json(F.regexp_extract(_col(c), r"(?s)\{.*\}", 0)))


def literal_dict(c) -> Column:
    """A map from JSON or from a Python literal with single quotes; null if neither parses. Quotes are
    taken for quotes beside brackets, commas and colons only, so apostrophes inside stay."""
    kind = "map<string,string>"
    strict = F.when(F.try_parse_json(_col(c)).isNotNull(), F.from_json(_col(c), kind))
    named = F.regexp_replace(F.regexp_replace(F.regexp_replace(_col(c), r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    swapped = F.regexp_replace(named, r"(?<=[{\[,:]\s{0,3})'|'(?=\s{0,3}[}\],:])", '"')
    return F.coalesce(strict, F.when(F.try_parse_json(swapped).isNotNull(), F.from_json(swapped, kind)))


def pct(a, b) -> Column:
    """Change from a to b in percent, to three places."""
    return F.round((_col(b) / _col(a) - 1) * 100, 3)


def case_id(wanted, symbol, event_id) -> Column:
    """Upper case with underscores if well formed, else <symbol or MACRO>_<event id>."""
    c = F.translate(F.upper(blank(wanted)), "-", "_")
    return F.when(c.rlike("^[A-Z0-9][A-Z0-9_]{5,80}$"), c).otherwise(F.concat_ws("_", F.coalesce(first_filled(symbol), F.lit("MACRO")), _col(event_id)))


def late_dates(text, event_date) -> Column:
    """Dates in a text that are later than the event: what must not leak into a case."""
    return F.filter(F.regexp_extract_all(blank(text), F.lit(r"20\d\d-\d\d-\d\d"), F.lit(0)), lambda d: d > _col(event_date))


class _Text(HTMLParser):
    """Text of a page: no scripts, styles or images; links as [text](href)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden, self.hrefs = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "a":
            href = dict(attrs).get("href")
            self.hrefs.append(href)
            self.parts.append("[" if href else "")
        else:
            self.parts.append(" " if tag not in ("b", "i", "em", "strong", "span", "u") else "")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "a" and self.hrefs:
            href = self.hrefs.pop()
            self.parts.append(f"]({href})" if href else "")
        else:
            self.parts.append(" " if tag not in ("b", "i", "em", "strong", "span", "u") else "")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def _page_text(page: str | None) -> str:
    parser = _Text()
    parser.feed(page or "")
    parser.close()
    return " ".join("".join(parser.parts).split())


@F.pandas_udf(StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    return pages.map(_page_text, na_action=None)


@F.pandas_udf(StringType())
def html_unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one big integer as a row of bits."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def _similarity(a: str, b: str) -> float:
    return 100.0 * 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def set_ratio(a: str | None, b: str | None) -> float:
    """Similarity of two texts by their sets of words, 0 to 100."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (left and right):
        return 100.0
    first, second = f"{both} {left}".strip(), f"{both} {right}".strip()
    scores = [_similarity(first, second)]
    if both:
        scores += [_similarity(both, first), _similarity(both, second)]
    return max(scores)


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
