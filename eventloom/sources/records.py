"""Raw feed records: line scan, permissive parse, validation with reject reasons, cleaned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from eventloom.functions import text as T
from eventloom.functions import vocab

#: Raw record; fields that drift in type are read as strings.
RAW = """_id string, businessCode string, type string, title string, content string, ctime string, rtime string,
news struct<sourceUrl:string,source:string,gid:string>, source string, author string, authorInfo struct<name:string>,
summary string, contentTagMap map<string,struct<code:string>>,
links array<struct<type:string,word:string,param:struct<stockCode:string,stockName:string,code:string,name:string>>>,
cryptoInfos array<struct<code:string,name:string>>,
noticeInfo struct<noticeType:string,declareDate:string,attachmentList:array<struct<url:string,fileType:string,storeType:string>>>,
language string, materialId string, extensions struct<uid:string>"""


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, line_no, raw): non-blank lines of files, trimmed. Numbers start at 1 and count blank lines.
    Files are read in splits of any number: rows of a split come in order in one partition, so their place
    in it is a difference of ids, and only the line counts of splits are added up by file."""
    at = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(paths).select(at["file_path"].alias("path"), at["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("seq"), "value")
    splits = lines.groupBy("path", "start").agg(F.count("*").alias("c"), F.min("seq").alias("first"))
    ahead = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "start", "first", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("before"))
    numbered = lines.join(splits, ["path", "start"]).withColumn("line_no", F.col("before") + F.col("seq") - F.col("first") + 1)
    named = F.element_at(F.split("path", "/"), -1).alias("file")
    return numbered.select(named, "line_no", F.trim(F.regexp_replace("value", "\r$", "")).alias("raw")).filter("raw <> ''")


def batch_number(file) -> Column:
    """Number of content_batch_<n>.ndjson; null for other names, which come last."""
    return F.regexp_extract(file, r"content_batch_(\d+)\.ndjson$", 1).try_cast("long")


def _distinct_by(entries: Column, key: str) -> Column:
    """Entries whose key occurs first, in order, empty keys left out."""
    filled = F.filter(entries, lambda x: T.blank(x[key]) != "")
    keys = F.transform(filled, lambda x: x[key])
    return F.filter(filled, lambda x, i: F.array_position(keys, x[key]) == i + 1)


def transform(lines: DataFrame) -> DataFrame:
    """Cleaned records with `reject_reason`, null for accepted ones. Reasons in order of precedence:
    invalid_json, invalid_record, missing_id, invalid_type_code, unknown_content_type,
    missing_published_at, empty_body, missing_notice_attachment."""
    r = lines.select("*", F.try_parse_json("raw").alias("v"), F.from_json("raw", RAW).alias("r"))
    kind = F.col("r.businessCode")
    body = T.html_to_text(F.col("r.content"))
    tags = F.filter(F.transform(F.map_values("r.contentTagMap"), lambda t: t["code"]), lambda c: (T.blank(c) != "") & ~c.rlike(r"^\d+$"))
    levels = F.create_map(*[F.lit(x) for kv in vocab.IMPORTANCE.items() for x in kv])
    level = F.get(F.filter(F.transform(tags, lambda t: F.try_element_at(levels, t)), lambda x: x.isNotNull()), F.lit(0))
    links = F.coalesce("r.links", F.array().cast("array<struct<type:string,word:string,param:struct<stockCode:string,stockName:string,code:string,name:string>>>"))
    stocks = F.transform(F.filter(links, lambda x: x["type"] == "stock"), lambda x: F.struct(x["param"]["stockCode"].alias("symbol"), x["param"]["stockName"].alias("name")))
    coins = F.concat(
        F.transform(F.filter(links, lambda x: x["type"] == "crypto"), lambda x: F.struct(T.first_filled(x["param"]["code"], x["param"]["stockCode"], x["word"]).alias("code"), x["param"]["name"].alias("name"))),
        F.coalesce("r.cryptoInfos", F.array().cast("array<struct<code:string,name:string>>")),
    )
    files = F.transform(
        F.filter(F.coalesce("r.noticeInfo.attachmentList", F.array().cast("array<struct<url:string,fileType:string,storeType:string>>")), lambda a: T.blank(a["url"]) != ""),
        lambda a: F.struct(a["url"].alias("url"), F.coalesce(T.first_filled(a["fileType"], a["storeType"]), F.lit("")).alias("file_type")),
    )
    notice = F.when(kind == "US_NOTICE", F.struct(F.col("r.noticeInfo.noticeType").alias("filing_type"), F.col("r.noticeInfo.declareDate").alias("declare_date"), files.alias("attachments")))
    code = F.coalesce(F.col("r.type").try_cast("int"), F.when(F.col("r.type").rlike(r"^-?\d+\.\d+$") & (F.schema_of_variant(F.try_variant_get("v", "$.type", "variant")) != "STRING"), F.col("r.type").try_cast("double").try_cast("int")))
    out = r.select(
        "file", "line_no", "raw", "v", F.col("r._id").alias("id"), kind.alias("content_type"), code.alias("type_code"),
        F.trim(T.blank("r.title")).alias("title"), body.alias("body"), F.trim(T.blank("r.summary")).alias("summary"),
        T.iso_time("r.ctime").alias("published_at"), F.coalesce(T.iso_time("r.rtime"), T.iso_time("r.ctime")).alias("updated_at"),
        F.struct(T.first_filled("r.news.source", "r.source").alias("name"), F.col("r.news.sourceUrl").alias("url"), T.first_filled("r.author", "r.authorInfo.name").alias("author")).alias("source"),
        F.struct(_distinct_by(stocks, "symbol").alias("stocks"), _distinct_by(coins, "code").alias("crypto")).alias("entities"),
        tags.alias("tags"), level.alias("importance"), F.filter(tags, lambda t: t.isin(*vocab.REGIONS)).alias("regions"), notice.alias("notice"),
        F.struct(F.col("r.language").alias("language"), F.col("r.news.gid").alias("gid"), F.col("r.materialId").alias("material_id"), F.col("r.extensions.uid").alias("uid")).alias("meta"),
    )
    reason = (
        F.when(F.col("v").isNull(), F.lit("invalid_json"))
        .when(~F.schema_of_variant("v").startswith("OBJECT"), F.lit("invalid_record"))
        .when(T.blank("id") == "", F.lit("missing_id"))
        .when(F.col("type_code").isNull(), F.lit("invalid_type_code"))
        .when(~T.blank("content_type").isin(*vocab.CONTENT_TYPES), F.lit("unknown_content_type"))
        .when(F.col("published_at").isNull(), F.lit("missing_published_at"))
        .when((F.col("content_type") != "US_NOTICE") & (F.col("body") == ""), F.lit("empty_body"))
        .when((F.col("content_type") == "US_NOTICE") & (F.coalesce(F.size("notice.attachments"), F.lit(0)) < 1), F.lit("missing_notice_attachment"))
    )
    return out.withColumn("reject_reason", reason).drop("v")


def _compact(value: Column, kind: DataType) -> Column | None:
    """`value` without empty parts, at any depth; null if nothing is left. Numbers and booleans stay."""
    if isinstance(kind, StringType):
        return F.nullif(F.trim(value), F.lit(""))
    if isinstance(kind, ArrayType):
        left = F.filter(F.transform(value, lambda x: _compact(x, kind.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(left) > 0, left)
    if isinstance(kind, MapType):
        left = F.map_filter(F.transform_values(value, lambda _, x: _compact(x, kind.valueType)), lambda _, x: x.isNotNull())
        return F.when(F.size(left) > 0, left)
    if isinstance(kind, StructType):
        parts = [_compact(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(F.coalesce(*[p.isNotNull() for p in map(_truth, parts)], F.lit(False)), F.struct(*parts)) if parts else F.lit(None)
    return value


def _truth(part: Column) -> Column:
    """True for a value, null for none, so that coalesce stops at the first value."""
    return F.when(part.isNotNull(), F.lit(True))


def pruned(df: DataFrame) -> DataFrame:
    """Public form: strings trimmed; empty strings, arrays, maps and structs null at any depth, so the
    JSON writer omits them; working columns that start with _ dropped. Zero and false stay."""
    return df.select(*[_compact(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if not f.name.startswith("_")])


def batch_stats(records: DataFrame, key: str = "dedup_method") -> DataFrame:
    """(file, what, n): per file the rows read, accepted and rejected, accepted ones by type and by
    dedup method, and rejected ones by reason. Labels are counted, so rows are combined before they move."""
    ok = F.col("reject_reason").isNull()
    labels = F.array_compact(F.array(
        F.lit("input"), F.when(ok, "accepted").otherwise("rejected"), F.when(ok, F.concat(F.lit("type:"), "content_type")),
        F.when(ok, F.concat(F.lit("dedup:"), key)), F.when(~ok, F.concat(F.lit("reject:"), "reject_reason")),
    ))
    return records.select("file", F.explode(labels).alias("what")).groupBy("file", "what").agg(F.count("*").alias("n"))


def discover(spark: SparkSession, folder: str) -> list[str]:
    """The input files of a folder by name: cleaned_batch*.jsonl if there are any, else all *.jsonl."""
    jvm = spark._jvm
    for pattern in ("cleaned_batch*.jsonl", "*.jsonl"):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if found:
            return sorted(f.getPath().toString() for f in found)
    return []


def without_indexed(files: list[str], indexed: list[str], fresh: bool = False) -> list[str]:
    """Files that have no index yet, by their names without folder and ending; all of them when fresh."""
    stem = lambda f: f.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    done = set() if fresh else {stem(f) for f in indexed}
    return [f for f in files if stem(f) not in done]


#: Paragraph record; source and context are JSON or literals of dicts.
PARAGRAPH = "doc_id string, source_type string, title string, published_at string, text string, source string, context string"


def parsed_paragraphs(lines: DataFrame) -> DataFrame:
    """Paragraphs of lines (file, line_no, raw); lines that are no JSON object are skipped."""
    read = lines.select("file", "line_no", F.try_parse_json("raw").alias("v"), F.from_json("raw", PARAGRAPH).alias("r"))
    return read.filter(F.schema_of_variant("v").startswith("OBJECT")).select("file", "line_no", "r.*")


def paragraph_index(paragraphs: DataFrame) -> DataFrame:
    """One row for each (file, doc_id): type, title, date, codes and source of its first line, how many
    paragraphs and characters it has, and the numbers of its lines in order."""
    codes = F.from_json(T.literal_dict("context")["related_codes"], "array<string>")
    codes = F.array_distinct(F.transform(F.coalesce(codes, F.array().cast("array<string>")), lambda c: T.related_code(c)))
    rows = paragraphs.select(
        "file", F.col("line_no").cast("long").alias("line_no"), T.blank("doc_id").alias("doc_id"), F.length(T.blank("text")).alias("chars"),
        F.struct(T.blank("source_type").alias("source_type"), F.substring(T.blank("title"), 1, vocab.TITLE_CHARS).alias("title"), T.blank("published_at").alias("published_at"),
                 F.array_join(codes, ",").alias("symbols"), T.blank(T.literal_dict("source")["name"]).alias("source_name")).alias("head"),
    )
    docs = rows.groupBy("file", "doc_id").agg(
        F.min_by("head", "line_no").alias("head"), F.count("*").alias("n_paragraphs"), F.sum("chars").alias("text_len"), F.array_join(F.array_sort(F.collect_list("line_no")), ",").alias("lines")
    )
    return docs.select("file", "doc_id", "head.*", T.norm_date("head.published_at").alias("pub_date"), "n_paragraphs", "text_len", "lines")


def index_summary(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """One row: v1 rows, v2 paragraphs and documents, and files of both indexes."""
    v = v1.select("file", F.lit(1).cast("long").alias("v1_rows"), F.lit(0).cast("long").alias("v2_paragraphs"), F.lit(0).cast("long").alias("v2_docs"))
    v = v.unionByName(v2.select("file", F.lit(0).cast("long").alias("v1_rows"), F.col("n_paragraphs").alias("v2_paragraphs"), F.lit(1).cast("long").alias("v2_docs")))
    return v.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("v1_rows", "v2_paragraphs", "v2_docs")], F.countDistinct("file").alias("files_ok"))


# The forms that an export window takes, by mode.
MATERIAL_FORMS = ("8-K", "10-Q", "10-K", "6-K", "20-F", "425")
NOTICE_MODES = {"none": (), "all": None, "8k": ("8-K",), "material": MATERIAL_FORMS}


def export_window(index: DataFrame, start: str, end: str | None = None, notices: str | None = None) -> DataFrame:
    """Index rows with start <= pub_date < end. With a mode of `notices` (none, 8k, material, all) the
    index is of documents: reports and calls, and the filings of the mode, told by their titles."""
    kept = index.filter((F.col("pub_date") >= start) & (F.col("pub_date") < end if end else F.lit(True)))
    if notices is None:
        return kept
    forms = NOTICE_MODES[notices]
    named = F.lit(True) if forms is None else F.coalesce(*[F.when(F.col("title").contains(f"Form {f}"), F.lit(True)) for f in forms], F.lit(False))
    return kept.filter(F.col("source_type").isin("report", "teleconference") | ((F.col("source_type") == "notice") & named))


def index_rows(records: DataFrame) -> DataFrame:
    """Flat index of cleaned records: cut title, joined symbols and tags, counts, filing number."""
    syms = F.transform("entities.stocks", lambda s: s["symbol"])
    return records.select(
        "id", "content_type", T.norm_date("published_at").alias("pub_date"), "published_at", F.col("source.name").alias("source_name"), "importance",
        F.substring("title", 1, vocab.TITLE_CHARS).alias("title"), F.array_join(syms, ",").alias("symbols"), F.size(syms).alias("n_symbols"),
        (F.size("entities.crypto") > 0).alias("has_crypto"), F.array_join("tags", ",").alias("tags"), F.array_join("regions", ",").alias("regions"),
        F.length("body").alias("body_len"), F.regexp_extract(T.blank("dedup.key"), "^notice:(.+)$", 1).alias("accession"),
    )


def paragraph_documents(rows: DataFrame, doc: str, order: str, text: str) -> DataFrame:
    """One row per document of a paragraph table: number of paragraphs, characters, joined text."""
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(order), F.lit(0)).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    joined = F.array_join(F.filter(F.transform(parts, lambda p: p["t"]), lambda t: t != ""), "\n")
    return rows.groupBy(doc).agg(F.count("*").alias("n_paragraphs"), F.sum(F.length(T.blank(text))).alias("n_chars"), joined.alias("body"))


def symbol_names(records: DataFrame) -> DataFrame:
    """How often each (symbol, name) pair occurs."""
    pairs = records.select(F.explode("entities.stocks").alias("s")).select("s.symbol", "s.name")
    return pairs.filter(T.blank("symbol") != "").groupBy("symbol", "name").agg(F.count("*").alias("count"))
