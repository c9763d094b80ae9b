"""Sources: parquet, JSON lines, delimited text, relational tables, object listings, nested records, feeds, threads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusloom.functions import records as R, text as X
from corpusloom.operators.running import row_numbers


def explode_passages(df: DataFrame, query: str, flags: Column, texts: Column, max_docs: int | None = None) -> DataFrame:
    """One row per passage of a query with its relevance flag; an optional stop after ``max_docs`` passages."""
    rows = df.select(query, F.posexplode(F.arrays_zip(flags.alias("rel"), texts.alias("text"))).alias("pos", "p"))
    out = rows.select(query, "pos", "p.rel", "p.text")
    return out if max_docs is None else out.limit(max_docs)


def parquet_corpus(spark: SparkSession, path: str, query: str, flags: str, texts: str, max_docs: int | None = None) -> DataFrame:
    return explode_passages(spark.read.parquet(path), query, F.col(flags), F.col(texts), max_docs)


def judged_corpus(spark: SparkSession, corpus: str, topics: str, qrels: str) -> DataFrame:
    """JSON-lines corpus, tab-separated topics and judgments; files with ``test`` in their name are skipped."""
    docs = spark.read.schema("docid string, text string").json(corpus)
    tsv = lambda path, schema: spark.read.schema(schema).csv(path, sep="\t", quote="").filter(
        ~F.contains(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("test")))
    t = tsv(topics, "qid string, query string")
    r = tsv(qrels, "qid string, q0 string, docid string, rel int").drop("q0")
    return r.join(t, "qid").join(docs, "docid").select("qid", "query", "docid", "text", "rel")


def delimited_table(spark: SparkSession, path: str, delimiter: str = ",", rows: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of headed text files; a line is rejected when its width differs from the header's.

    ``rows`` keeps data lines ``[from, to)`` of each file, counted after the header.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"))
    numbered = row_numbers(lines, "file", ["block", "seq"], "line_no")
    fields = F.split("value", re.escape(delimiter), -1)
    header = numbered.filter("line_no = 1").select("file", fields.alias("header"))
    data = numbered.filter("line_no > 1").withColumn("row", F.col("line_no") - 2)
    if rows:
        data = data.filter((F.col("row") >= rows[0]) & (F.col("row") < rows[1]))
    checked = data.withColumn("fields", fields).join(header, "file")
    same = F.size("fields") == F.size("header")
    good = checked.filter(same).select("file", "row", F.map_from_arrays("header", "fields").alias("cells"))
    return good, checked.filter(~same).select("file", "row", "value")


def json_format(text: Column, sample: int = 10, threshold: float = 0.8) -> Column:
    """``json``, ``jsonl`` or ``text``: whole text valid, or enough of the first non-blank lines valid."""
    lines = F.slice(F.filter(F.split(text, "\n"), lambda l: ~X.is_blank(l)), 1, sample)
    valid = F.filter(lines, lambda l: X.strict_json(l).isNotNull())
    share = F.try_divide(F.size(valid), F.size(lines))
    return F.when(X.strict_json(text).isNotNull(), "json").when(F.coalesce(share >= threshold, F.lit(False)), "jsonl").otherwise("text")


# --- relational -----------------------------------------------------------------------------------------


def jdbc_table(spark: SparkSession, url: str, base_query: str, ts: str | None = None, start=None, end=None, **options: str) -> DataFrame:
    """A database query read through JDBC; the time window is a filter, which Spark pushes to the database."""
    df = spark.read.format("jdbc").options(url=url, query=base_query, **options).load()
    return time_window(df, ts, start, end) if ts else df


def time_window(df: DataFrame, ts: str, start=None, end=None, rule: str = "open_start") -> DataFrame:
    """Rows of ``(start, end]`` (``open_start``) or ``[start, end)`` (``open_end``); an empty window gives nothing."""
    stamp = F.col(ts)
    bound = lambda v: v if isinstance(v, Column) else F.lit(v).cast(df.schema[ts].dataType)
    if start is not None:
        df = df.filter(stamp > bound(start) if rule == "open_start" else stamp >= bound(start))
    if end is not None:
        df = df.filter(stamp <= bound(end) if rule == "open_start" else stamp < bound(end))
    return df


def ids_only(df: DataFrame, key: str) -> DataFrame:
    """The ids that a source holds now, nothing else: what a prune compares with. Only the key column is read."""
    return df.select(F.col(key).cast("string").alias("id")).filter(F.col("id").isNotNull()).distinct()


def max_cursor(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("cursor"))


def render_rows(
    df: DataFrame, content: list[str], metadata: list[str], id_column: str | None, source: str, updated: str | None = None, keep: list[str] = ()
) -> DataFrame:
    """Rows as documents: ``【column】:`` blocks, id from the key column or the content, title from the first column."""
    blocks = [F.concat(F.lit(f"【{c}】:\n"), F.col(c).cast("string")) for c in content]
    body = F.concat_ws("\n\n", *blocks)
    by_content = F.concat(F.lit(f"{source}:"), F.md5(body))
    key = F.coalesce(F.concat(F.lit(f"{source}:"), F.col(id_column).cast("string")), by_content) if id_column else by_content
    title = F.substring(X.strip(F.regexp_replace(F.col(content[0]).cast("string"), "[\r\n]", " ")), 1, 100)
    meta = F.map_filter(F.create_map(*[x for c in metadata for x in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    stamp = [F.col(updated).cast("timestamp").alias("updated_at")] if updated else []
    return df.select(
        *keep, key.alias("id"), body.alias("text"), title.alias("title"), F.octet_length(body).alias("size_bytes"), meta.alias("metadata"), *stamp)


# --- object listings ---------------------------------------------------------------------------------------


def list_objects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Listing of a folder tree without the contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("path").alias("key"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def select_objects(listing: DataFrame, start=None, end=None) -> DataFrame:
    """Objects modified in ``(start, end]``, no folders, with a display name: the base name where it is unique."""
    kept = time_window(listing.filter(~F.endswith("key", F.lit("/"))), "modified", start, end)
    kept = kept.withColumn("base", F.substring_index("key", "/", -1))
    clashes = kept.groupBy("base").agg(F.count("*").alias("__n")).filter("__n > 1")
    named = kept.join(clashes, "base", "left")
    return named.select(*kept.columns, F.when(F.col("__n").isNull(), F.col("base")).otherwise(F.col("key")).alias("name")).drop("base")


# --- nested records, feeds, threads ------------------------------------------------------------------------------


def record_documents(
    records: DataFrame, column: str, id_path: str, content: str, metadata: list[str], ts_path: str | None = None, start=None, end=None, keep: list[str] = ()
) -> DataFrame:
    """JSON records as documents.

    ``content`` is a template with ``{dotted.path}`` slots, stripped of HTML; ``metadata`` paths are kept as a map;
    the record time must lie in ``[start, end)``.
    """
    doc = records.select(*keep, F.try_parse_json(column).alias("__v"))
    v = F.col("__v")
    text = F.lit(content)
    for path in re.findall(r"{([^{}]+)}", content):
        text = F.replace(text, F.lit("{" + path + "}"), R.path_text(v, path))
    text = X.strip(F.regexp_replace(X.unescape_entities(F.regexp_replace(text, "<[^>]+>", " ")), r"[ \t]+", " "))
    meta = F.map_filter(
        F.create_map(*[x for p in metadata for x in (F.lit(p), R.path_text(v, p))]), lambda k, value: value != "")
    out = doc.select(*keep, R.path_text(v, id_path).alias("id"), text.alias("text"), meta.alias("metadata"),
                     *([R.path_text(v, ts_path).try_cast("timestamp").alias("updated_at")] if ts_path else []))
    return time_window(out, "updated_at", start, end, "open_end") if ts_path else out


FEED_SCHEMA = "guid string, link string, title string, summary string, content array<string>, updated string, published string, author string, category array<string>"
FEED_TIME = "d MMM yyyy HH:mm:ss Z"  # after the week day


def feed_entries(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(FEED_SCHEMA).load(path)


def feed_documents(entries: DataFrame, feed_url: str, start=None, end=None) -> DataFrame:
    """Feed entries as documents; identity from id, link or title, time from updated or published."""
    filled = lambda c: F.nullif(X.strip(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    key = F.coalesce(filled("guid"), filled("link"), filled("title"), F.lit(feed_url))
    title = F.coalesce(filled("title"), filled("link"), key)
    # Tags and entities are handled on the joined blocks: decoding may call Python, which lambdas cannot.
    decode = lambda c: X.unescape_entities(F.regexp_replace(c, "<[^>]*>", "\n"))
    lines = lambda c: F.array_join(F.filter(F.transform(F.split(c, "\n"), X.strip), lambda s: s != ""), "\n")
    joined = decode(F.array_join(F.coalesce("content", F.array().cast("array<string>")), "\u0001"))
    blocks = F.filter(F.transform(F.split(joined, "\u0001"), lines), lambda s: s != "")
    body = F.when(F.size(blocks) > 0, F.array_join(blocks, "\n\n")).otherwise(lines(decode(F.coalesce("summary", F.lit("")))))
    stamp = lambda c: F.try_to_timestamp(F.regexp_replace(c, r"^\s*[A-Za-z]{3},\s*", ""), F.lit(FEED_TIME))
    when = F.coalesce(stamp("updated"), stamp("published"))
    out = entries.select(
        F.concat(F.lit("rss:"), F.md5(key)).alias("id"), title.alias("title"), X.strip(F.concat_ws("\n\n", title, F.nullif(body, F.lit("")))).alias("text"),
        when.alias("updated_at"), F.coalesce("category", F.array().cast("array<string>")).alias("categories"))
    return time_window(out, "updated_at", start, end)


def threads(messages: DataFrame, channel: str, thread: str, order: str, sender: str, text: str, drop: Column) -> tuple[DataFrame, DataFrame]:
    """(threads, sections) without the dropped messages.

    A thread has a title from its first sender and text and the time of its last message; its sections are numbered
    rows, so a thread of any length stays distributed.
    """
    kept = messages.filter(~drop)
    first = F.min_by(F.struct(F.col(sender).alias("s"), F.col(text).alias("t")), F.col(order))
    heads = kept.groupBy(channel, thread).agg(first.alias("__f"), F.max(order).alias("updated"), F.count("*").alias("sections"))
    head = F.col("__f.t")
    snippet = F.when(F.length(head) > 50, F.concat(F.rtrim(F.substring(head, 1, 50)), F.lit("..."))).otherwise(head)
    title = F.replace(F.concat(F.col("__f.s"), F.lit(" in #"), F.col(channel).cast("string"), F.lit(": "), snippet), F.lit("\n"), F.lit(" "))
    sections = row_numbers(kept, [channel, thread], [order], "section").select(channel, thread, "section", F.col(text).alias("text"))
    return heads.select(channel, thread, title.alias("title"), "updated", "sections"), sections


def document_ranges(docs: DataFrame, doc: str, units: Column, size: int) -> DataFrame:
    """Tasks of ``size`` units: ``(doc, from, to)``."""
    n = docs.select(doc, units.cast("long").alias("__n")).filter(F.col("__n") > 0)
    rows = n.select(doc, "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(size).cast("long"))).alias("from"))
    return rows.select(doc, "from", F.least(F.col("from") + size, F.col("__n")).alias("to"))


# --- typed columns -----------------------------------------------------------------------------------------

# Column type by name suffix, and the accepted date formats.
SUFFIX_TYPES = {
    "int": "int", "ulong": "decimal(20,0)", "long": "bigint", "short": "smallint", "flt": "float", "dbl": "double", "kwd": "string", "tks": "string",
    "ltks": "string", "raw": "string", "with_weight": "string", "fea": "double", "feas": "map<string,double>", "bin": "binary", "dt": "timestamp", "vec": "array<float>",
}
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd_HH-mm-ss")


def suffix_type(name: str) -> str | None:
    """Type of a column from the end of its name, the longest suffix first."""
    for suffix in sorted(SUFFIX_TYPES, key=len, reverse=True):
        if name.endswith("_" + suffix):
            return SUFFIX_TYPES[suffix]
    return None


def suffix_cast(df: DataFrame) -> DataFrame:
    """Every text column in the type its name asks for; what does not convert is null."""
    out = []
    for name in df.columns:
        c, kind = F.col(name), suffix_type(name)
        if kind is None or kind == "string":
            out.append(c)
        elif kind == "timestamp":
            out.append(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS]).alias(name))
        elif kind.startswith(("map", "array")):
            out.append(F.from_json(c, kind).alias(name))
        else:
            out.append(c.try_cast(kind).alias(name))
    return df.select(*out)


def convert_table(df: DataFrame, target: dict[str, str], extra: str = "extra", vector: str = r"q_[0-9]+_vec") -> DataFrame:
    """Copy with a target schema: fields are cast, JSON text is parsed, vector columns kept, the rest goes to ``extra``."""
    out = []
    for name, kind in target.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
        elif isinstance(df.schema[name].dataType, T.StringType) and kind.startswith(("map", "array", "struct")):
            out.append(F.from_json(name, kind).alias(name))
        elif kind == "string" and not isinstance(df.schema[name].dataType, T.AtomicType):
            out.append(F.to_json(name).alias(name))
        else:
            out.append(F.col(name).cast(kind).alias(name) if kind == "string" else F.col(name).try_cast(kind).alias(name))
    vectors = [c for c in df.columns if c not in target and re.fullmatch(vector, c)]
    rest = [c for c in df.columns if c not in target and c not in vectors]
    out += [F.col(c) for c in vectors]
    if rest:
        cells = F.create_map(*[x for c in rest for x in (F.lit(c), F.col(c).cast("string"))])
        out.append(F.map_filter(cells, lambda k, v: v.isNotNull()).alias(extra))
    return df.select(*out)
