"""Documents to ordered chunks.

A document is one row, so the greedy merges are folds over its sections inside that row: no shuffle, no group, and
whole texts whatever their length. A fold carries only counters and group numbers; texts are joined once at the end.
Operators that need line neighbourhoods explode the lines and use windows per document, which the input row bounds.

All functions return ``(doc, pos, text, …)`` and keep the columns named in ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions import text as X
from corpusloom.operators import layout as L
from corpusloom.session import cut_lineage

NO_INTS = "array<int>"
NO_TEXTS = "array<string>"
FOLD_BLOCK = 256


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


# --- the fold ---------------------------------------------------------------------------------------------


def fold_groups(items: Column, start: Callable, state: dict[str, Column], update: Callable) -> Column:
    """Group number of every item of an array.

    ``start(state, item)`` tells whether the item opens a new group, ``update(state, item, opened)`` gives the next
    state. The group numbers are the only array that grows, and it does so in blocks of ``FOLD_BLOCK`` items that are put
    together once: appending copies an array, so the time is linear in the items.
    """
    zero = F.struct(F.lit(-1).alias("g"), *[c.alias(n) for n, c in state.items()], _empty("array<array<int>>").alias("parts"))

    def step(a, x):
        opened = (a["g"] < 0) | start(a, x)
        g = F.when(opened, a["g"] + 1).otherwise(a["g"])
        new = update(a, x, opened)
        return F.struct(g.alias("g"), *[new[n].alias(n) for n in state], F.array_append(a["ids"], g).alias("ids"))

    def fold(a, block):
        fresh = F.struct(a["g"].alias("g"), *[a[n].alias(n) for n in state], _empty(NO_INTS).alias("ids"))
        done = F.array(F.aggregate(block, fresh, step))
        return F.transform(done, lambda r: F.struct(
            r["g"].alias("g"), *[r[n].alias(n) for n in state], F.array_append(a["parts"], r["ids"]).alias("parts")))[0]

    def blocks(whole):
        starts = F.when(F.size(whole) > 0, F.sequence(F.lit(0), F.size(whole) - 1, F.lit(FOLD_BLOCK))).otherwise(_empty(NO_INTS))
        return F.transform(starts, lambda s: F.slice(whole, s + 1, FOLD_BLOCK))

    return F.transform(F.array(items), lambda whole: F.aggregate(blocks(whole), zero, fold, lambda a: F.flatten(a["parts"])))[0]


def pack(counts: Column, start: Callable) -> Column:
    """Group numbers when the state is the running token count of the open group: ``start(n, c)``."""
    return fold_groups(
        counts, lambda a, c: start(a["n"], c), {"n": F.lit(0)}, lambda a, c, opened: {"n": F.when(opened, c).otherwise(a["n"] + c)})


def group_slices(df: DataFrame, ids: Column, items: str, make: Callable[[Column], Column], name: str) -> DataFrame:
    """Add ``name``: ``make(slice of items)`` for every run of equal group numbers."""
    marked = df.withColumn("__ids", ids)
    n = F.size("__ids")
    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(_empty(NO_INTS))
    starts = F.filter(index, lambda i: (i == 0) | (F.get("__ids", i) != F.get("__ids", i - 1)))
    marked = marked.withColumn("__starts", starts)
    pieces = F.transform(
        "__starts", lambda s, k: make(F.slice(items, s + 1, F.coalesce(F.get("__starts", k + 1), F.size("__ids")) - s)))
    return marked.withColumn(name, pieces).drop("__ids", "__starts")


def explode_chunks(df: DataFrame, doc: str, chunks: str, keep=()) -> DataFrame:
    """``(doc, keep…, pos, text, tokens)`` of the non-blank chunks; positions count the kept ones."""
    kept = F.filter(chunks, lambda c: ~X.is_blank(c))
    rows = df.select(doc, *keep, F.posexplode(kept).alias("pos", "text"))
    return rows.withColumn("tokens", X.token_count(F.col("text")))


def _counts(items: str) -> Column:
    return F.transform(items, X.token_count)


def with_overlap(texts: Column, percent: float) -> Column:
    """Prefix every text with the tail of the one before it, itself already prefixed."""
    if not percent:
        return texts
    keep = (100 - percent) / 100

    def step(a, t):
        last = F.element_at(a, F.when(F.size(a) > 0, -1).otherwise(F.lit(None).cast("int")))
        tail = F.substr(last, F.floor(F.length(last) * F.lit(keep)).cast("int") + 1)
        return F.array_append(a, F.concat(F.coalesce(tail, F.lit("")), t))

    return F.aggregate(texts, _empty(NO_TEXTS), step)


# --- merges -----------------------------------------------------------------------------------------------


def merge_sections(df: DataFrame, doc: str, text: str, budget: int = 128, overlap: float = 0, separator: str = "\n", keep=()) -> DataFrame:
    """Append sections while the chunk is within its budget; a new chunk starts with the tail of the last one."""
    base = df.select(doc, *keep, F.transform(F.split(text, separator), lambda s: F.concat(F.lit("\n"), s)).alias("__s"))
    limit = budget * (100 - overlap) / 100
    grouped = group_slices(base, pack(_counts("__s"), lambda n, c: n > limit), "__s", lambda s: F.array_join(s, ""), "__t")
    return explode_chunks(grouped.withColumn("__t", with_overlap(F.col("__t"), overlap)), doc, "__t", keep)


def custom_delimiters(spec: str) -> list[str]:
    """Delimiters written between back-ticks."""
    return re.findall(r"`([^`]+)`", spec)


def split_custom(df: DataFrame, doc: str, text: str, spec: str, keep=()) -> DataFrame:
    """One chunk per piece between back-ticked delimiters, which are dropped."""
    pieces = F.transform(X.split_any(F.col(text), custom_delimiters(spec)), lambda p: F.concat(F.lit("\n"), p))
    return explode_chunks(df.select(doc, *keep, pieces.alias("__t")), doc, "__t", keep)


def kept_split(text: Column, pattern: str) -> Column:
    """Pieces with the delimiter that ends them; empty and blank pieces dropped; a bad pattern splits nothing."""
    try:
        re.compile(pattern)
    except re.error:
        return F.array(text)
    if not pattern:
        return F.array(F.coalesce(text, F.lit("")))
    marked = F.regexp_replace(text, f"({pattern})", "$1\u0001")
    return F.filter(F.split(marked, "\u0001", -1), lambda p: ~X.is_blank(p) & ~p.rlike(rf"(?s)\A(?:{pattern})\z"))


def split_kept(df: DataFrame, doc: str, text: str, pattern: str, keep=()) -> DataFrame:
    return explode_chunks(df.select(doc, *keep, kept_split(F.col(text), pattern).alias("__t")), doc, "__t", keep)


def merge_plain(df: DataFrame, doc: str, text: str, budget: int = 128, delimiters: str = "\n!?;。；！？", keep=()) -> DataFrame:
    """Split on any delimiter character, merge with newlines until the chunk is over budget."""
    base = df.select(doc, *keep, X.split_any(F.col(text), list(delimiters)).alias("__s"))
    join = lambda s: F.regexp_replace(F.array_join(s, "\n"), "^\n+", "")
    grouped = group_slices(base, pack(_counts("__s"), lambda n, c: n > budget), "__s", join, "__t")
    return explode_chunks(grouped, doc, "__t", keep)


def split_parents(df: DataFrame, doc: str, text: str, parent_pattern: str, child_pattern: str, keep=()) -> DataFrame:
    """Parents split by one pattern, their children by another; each child keeps its parent's text."""
    parents = split_kept(df, doc, text, parent_pattern, keep).withColumnsRenamed({"pos": "parent_pos", "text": "mom"}).drop("tokens")
    rows = parents.select(doc, *keep, "parent_pos", "mom", F.posexplode(kept_split(F.col("mom"), child_pattern)).alias("pos", "text"))
    return rows.withColumn("tokens", X.token_count(F.col("text")))


def _carry_merge(items: Column, opens: Callable, joins: Callable, opening: Callable) -> Column:
    """Fold that carries the open chunk's text, for merges whose token count includes the overlap."""
    zero = F.struct(_empty("array<struct<kind:string,text:string>>").alias("done"), F.lit("").alias("kind"), F.lit("").alias("text"),
                    F.lit(0).alias("n"), F.lit(False).alias("open"))

    def flush(a):
        return F.when(a["open"], F.array_append(a["done"], F.struct(a["kind"].alias("kind"), a["text"].alias("text")))).otherwise(a["done"])

    def step(a, x):
        new = ~a["open"] | opens(a, x)
        text, n = opening(a, x)
        joined, m = joins(a, x)
        return F.when(
            new, F.struct(flush(a).alias("done"), x["kind"].alias("kind"), text.alias("text"), n.alias("n"), F.lit(True).alias("open"))
        ).otherwise(F.struct(a["done"].alias("done"), a["kind"].alias("kind"), joined.alias("text"), m.alias("n"), F.lit(True).alias("open")))

    return F.aggregate(items, zero, step, flush)


def merge_typed(df: DataFrame, doc: str, items: str, budget: int, overlap: float = 0, keep=()) -> DataFrame:
    """Merge text items by size; a table or image stands alone and breaks the run.

    ``items`` is an array of ``struct(kind, text)``.
    """
    limit = budget * (100 - overlap) / 100
    is_text = lambda k: k == "text"

    def opening(a, x):
        cut = F.substr(a["text"], F.floor(F.length(a["text"]) * F.lit((100 - overlap) / 100)).cast("int") + 1)
        carry = F.when(a["open"] & is_text(a["kind"]) & is_text(x["kind"]), cut).otherwise("") if overlap else F.lit("")
        text = F.concat(carry, x["text"])
        return text, X.token_count(text)

    merged = _carry_merge(
        F.filter(items, lambda x: ~is_text(x["kind"]) | ~X.is_blank(x["text"])),
        lambda a, x: ~is_text(a["kind"]) | ~is_text(x["kind"]) | (a["n"] > limit),
        lambda a, x: (F.concat(a["text"], F.lit("\n"), x["text"]), a["n"] + X.token_count(x["text"])),
        opening,
    )
    rows = df.select(doc, *keep, F.posexplode(F.filter(merged, lambda c: ~X.is_blank(c["text"]))).alias("pos", "c"))
    return rows.select(doc, *keep, "pos", "c.kind", "c.text", X.token_count(F.col("c.text")).alias("tokens"))


def whole_document(df: DataFrame, doc: str, sections: Column, keep=()) -> DataFrame:
    joined = df.select(doc, *keep, F.array(F.array_join(sections, "\n")).alias("__t"))
    return explode_chunks(joined, doc, "__t", keep)


def merge_markdown(df: DataFrame, doc: str, sections: Column, budget: int = 128, overlap: float = 0, keep=()) -> DataFrame:
    """Open a new chunk when the next section would exceed the budget; it starts with the last characters before it."""

    def opening(a, x):
        size = F.floor(F.length(a["text"]) * F.lit(overlap) / 100).cast("int")
        tail = F.when(a["open"] & (size > 0), F.substr(a["text"], F.length(a["text"]) - size + 1)).otherwise("") if overlap else F.lit("")
        text = F.when(tail != "", F.concat(tail, F.lit("\n"), x["text"])).otherwise(x["text"])
        return text, X.token_count(tail) + X.token_count(x["text"])

    items = F.transform(sections, lambda s: F.struct(F.lit("text").alias("kind"), s.alias("text")))
    joined = lambda a, x: F.when(a["text"] != "", F.concat(a["text"], F.lit("\n"), x["text"])).otherwise(x["text"])
    merged = _carry_merge(
        items,
        lambda a, x: (a["text"] != "") & (a["n"] + X.token_count(x["text"]) > budget),
        lambda a, x: (joined(a, x), a["n"] + X.token_count(x["text"])),
        opening,
    )
    return explode_chunks(df.select(doc, *keep, F.transform(merged, lambda c: c["text"]).alias("__t")), doc, "__t", keep)


def pack_blocks(df: DataFrame, doc: str, blocks: str, budget: int = 512, keep=()) -> DataFrame:
    """Pack blocks up to the budget; a block over it is cut into slices of that many tokens."""
    tokens = lambda b: X.tokens(b)

    def cut(b):
        n = X.token_count(b)
        slices = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / budget).cast("int")), lambda i: F.struct(
            F.array_join(F.slice(tokens(b), i * budget + 1, budget), " ").alias("text"), F.lit(True).alias("own")))
        return F.when(n > budget, slices).otherwise(F.array(F.struct(b.alias("text"), F.lit(False).alias("own"))))

    base = df.select(doc, *keep, F.flatten(F.transform(blocks, cut)).alias("__b"))
    counts = F.transform("__b", lambda b: F.struct(X.token_count(b["text"]).alias("n"), b["own"].alias("own")))
    ids = fold_groups(
        counts, lambda a, x: x["own"] | a["own"] | (a["n"] + x["n"] > budget), {"n": F.lit(0), "own": F.lit(False)},
        lambda a, x, o: {"n": F.when(o, x["n"]).otherwise(a["n"] + x["n"]), "own": x["own"]})
    grouped = group_slices(base, ids, "__b", lambda s: F.array_join(F.transform(s, lambda b: b["text"]), "\n"), "__t")
    return explode_chunks(grouped, doc, "__t", keep)


def batch_chunks(df: DataFrame, doc: str, chunks: str, budget: int = 4096, keep=()) -> DataFrame:
    """Concatenate consecutive chunks while they stay under the budget."""
    base = df.select(doc, *keep, F.col(chunks).alias("__s"))
    grouped = group_slices(base, pack(_counts("__s"), lambda n, c: n + c >= budget), "__s", lambda s: F.array_join(s, ""), "__t")
    return explode_chunks(grouped, doc, "__t", keep)


# --- tables -----------------------------------------------------------------------------------------------


def split_table(df: DataFrame, doc: str, table: str, budget: int = 512, keep=()) -> DataFrame:
    """Cut an HTML table into tables of whole rows within the token budget."""
    base = df.select(doc, *keep, F.regexp_extract_all(table, F.lit(r"(?is)<tr(?:\s[^>]*)?>.*?</tr\s*>"), F.lit(0)).alias("__s"))
    make = lambda s: F.concat(F.lit("<table>"), F.array_join(s, ""), F.lit("</table>"))
    grouped = group_slices(base, pack(_counts("__s"), lambda n, c: n + c > budget), "__s", make, "__t")
    return explode_chunks(grouped, doc, "__t", keep)


def batch_rows(rows: Column, size: int = 10, separator: str = "; ") -> Column:
    """Rows joined ten by ten."""
    n = F.size(rows)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).otherwise(_empty(NO_INTS))
    return F.transform(starts, lambda i: F.array_join(F.slice(rows, i * size + 1, size), separator))


RESERVED_COLUMNS = ("id", "_id", "index", "idx")  # fixed values
HEADER_REMARKS = r"(/.*|（[^（）]+?）|\([^()]+?\))"  # fixed value


def clean_header(name: str) -> str:
    """Column name without alternatives after a slash and remarks in parentheses."""
    return re.sub(HEADER_REMARKS, "", name)


def row_chunks(df: DataFrame, roles: dict[str, str] | None = None, keep=()) -> DataFrame:
    """Every row as a chunk: ``- column: value`` lines, and the stored columns as a map.

    Role of a column: ``indexing`` (text), ``metadata`` (stored) or ``both``; empty cells and rows are skipped.
    """
    roles = roles or {}
    columns = [c for c in df.columns if c not in RESERVED_COLUMNS and c not in keep]
    cell = {c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns}
    role = {c: roles.get(c, "both") for c in columns}
    lines = [F.concat(F.lit(f"- {c}: "), cell[c]) for c in columns if role[c] in ("indexing", "vectorize", "both")]
    stored = [x for c in columns if role[c] in ("metadata", "both") for x in (F.lit(c), cell[c])]
    data = F.map_filter(F.create_map(*stored), lambda k, v: v.isNotNull()) if stored else F.create_map().cast("map<string,string>")
    text = F.array_join(F.array_compact(F.array(*lines)), "\n") if lines else F.lit("")
    out = df.select(*keep, text.alias("text"), data.alias("chunk_data"))
    return out.filter((F.col("text") != "") | (F.size("chunk_data") > 0))


# Shapes of tables in markdown.
BORDERED_TABLE = r"(?d)(?:\n|\A)(?:\|.*?\|.*?\|.*?\n)(?:\|(?:\s*[:-]+[-| :]*\s*)\|.*?\n)(?:\|.*?\|.*?\|.*?\n)+"
BORDERLESS_TABLE = r"(?d)(?:\n|\A)(?:\S.*?\|.*?\n)(?:(?:\s*[:-]+[-| :]*\s*).*?\n)(?:\S.*?\|.*?\n)+"
HTML_TABLE = (
    r"(?is)(?:\n|\A)\s*(?:(?:<html[^>]*>\s*<body[^>]*>\s*<table[^>]*>.*?</table>\s*</body>\s*</html>)"
    r"|(?:<body[^>]*>\s*<table[^>]*>.*?</table>\s*</body>)|(?:<table[^>]*>.*?</table>))\s*(?=\n|\z)"
)


def lift_tables(text: Column) -> tuple[Column, Column]:
    """(remainder, tables): bordered, borderless and HTML tables taken out of markdown."""
    tables = []
    for pattern in (BORDERED_TABLE, BORDERLESS_TABLE, HTML_TABLE):
        if pattern is HTML_TABLE:
            text = F.regexp_replace(text, r"(?i)<(table|td|tr|th|tbody|thead|div)[^>]*>", "<$1>")
        tables.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        text = F.regexp_replace(text, pattern, "\n\n")
    return text, F.concat(*tables)


# --- markdown elements ----------------------------------------------------------------------------------------


def lines_of(df: DataFrame, doc: str, text: str, keep=()) -> DataFrame:
    return df.select(doc, *keep, F.posexplode(F.split(text, "\n")).alias("pos", "line"))


def joined_lines(lines: DataFrame, by: list[str], separator: str = "\n", line: str = "line", name: str = "text") -> DataFrame:
    """Lines of a group in order, joined; groups lie inside one document."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", line)))
    return lines.groupBy(*by).agg(
        F.array_join(F.transform(ordered, lambda s: s[line]), separator).alias(name), F.min("pos").alias("start_line"), F.max("pos").alias("end_line"))


def markdown_elements(lines: DataFrame, doc: str) -> DataFrame:
    """Headers, fenced code, lists, quotes and paragraphs with their line ranges.

    Fences toggle, so a running count tells code from prose. Indented words continue a list only when the last
    block mark is a list item; blank lines stay with their block unless a paragraph is about to end.
    """
    order = Window.partitionBy(doc).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    line = F.col("line")
    fence = F.startswith(X.strip(line), F.lit("```"))
    m = lines.withColumn("__f", F.sum(fence.cast("int")).over(upto))
    closing = fence & (F.col("__f") % 2 == 0)
    raw = (
        F.when((F.col("__f") % 2 == 1) | closing, "code_block")
        .when(line.rlike(r"^#{1,6}\s+"), "header")
        .when(line.rlike(r"^\s*[-*+]\s+") | line.rlike(r"^\s*[0-9]+\.\s+"), "list_block")
        .when(F.startswith(X.strip(line), F.lit(">")), "blockquote")
        .when(X.is_blank(line), "blank")
        .when(line.rlike(r"^\s+[\p{L}\p{N}_]"), "indented")
        .otherwise("text_block")
    )
    m = m.withColumn("__raw", raw)
    anchor = F.last(F.when(~F.col("__raw").isin("blank", "indented"), F.col("__raw")), ignorenulls=True).over(before)
    m = m.withColumn("__a", F.when(F.col("__raw") != "indented", F.col("__raw")).when(anchor == "list_block", "list_block").otherwise("text_block"))
    last = F.last(F.when(F.col("__a") != "blank", F.col("__a")), ignorenulls=True).over(before)
    next_block = F.coalesce(F.lead("__raw").over(order).isin("header", "code_block", "list_block", "blockquote"), F.lit(False))
    kind = F.when(F.col("__a") != "blank", F.col("__a")).when(last.isin("list_block", "blockquote"), last).when(
        (last == "text_block") & ~next_block, last).otherwise("none")
    m = m.withColumn("kind", kind)
    opened = F.col("__f") % 2 == 1
    starts = (
        (F.col("kind") == "header") | ~F.col("kind").eqNullSafe(F.lag("kind").over(order))
        | (F.startswith(X.strip(line), F.lit("```")) & opened)
    )
    m = m.withColumn("element", F.sum(starts.cast("int")).over(upto)).filter(F.col("kind") != "none")
    # Trailing blank lines still count as part of their block.
    return joined_lines(m, [doc, "element", "kind"]).filter(~X.is_blank(F.col("text")))


# --- question and answer, tags ----------------------------------------------------------------------------------


def sniff_delimiter(lines: Column) -> Column:
    """Tab or comma, whichever splits more lines into exactly two fields; tab wins ties."""
    count = lambda d: F.size(F.filter(lines, lambda l: F.size(F.split(l, d, -1)) == 2))
    return F.when(count("\t") >= count(","), "\t").otherwise(",")


def _fields(df: DataFrame, doc: str, text: str) -> DataFrame:
    base = df.select(doc, F.split(text, "\n").alias("__l"))
    rows = base.select(doc, sniff_delimiter(F.col("__l")).alias("__d"), F.posexplode("__l").alias("pos", "line"))
    return rows.withColumn("__p", F.split_part("line", F.col("__d"), F.lit(1))).withColumn(
        "__two", (F.length("line") - F.length(F.replace("line", F.col("__d"), F.lit("")))) == 1)


def question_rows(df: DataFrame, doc: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejected lines): a two-field line starts a pair, other lines continue its answer."""
    order = Window.partitionBy(doc).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = _fields(df, doc, text).withColumn("pair", F.sum(F.col("__two").cast("int")).over(upto))
    question = F.last(F.when(F.col("__two"), F.col("__p")), ignorenulls=True).over(upto)
    rows = rows.withColumn("question", question)
    piece = F.when(F.col("__two"), F.split_part("line", F.col("__d"), F.lit(2))).otherwise(F.concat(F.lit("\n"), "line"))
    owned = F.coalesce(F.col("question") != "", F.lit(False))
    good = rows.filter(owned).withColumn("line", piece)
    last = rows.groupBy(doc).agg(F.max("pair").alias("__last"))
    pairs = joined_lines(good, [doc, "pair", "question"], "", name="answer").join(last, doc)
    pairs = pairs.filter((F.col("answer") != "") | (F.col("pair") == F.col("__last"))).select(doc, "pair", "question", "answer")
    return pairs, rows.filter(~owned & ~F.col("__two")).select(doc, "pos")


def heading_questions(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Heading stack as the question, the text below it as the answer; headings in fenced code do not count."""
    order = Window.partitionBy(doc).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = lines_of(df, doc, text)
    fence = F.startswith(X.strip(F.col("line")), F.lit("```"))
    marks = F.length(F.regexp_extract("line", "^(#*)", 1))
    rows = rows.withColumn("__f", F.sum(fence.cast("int")).over(upto))
    level = F.when((F.col("__f") % 2 == 0) & marks.between(1, 6), marks).otherwise(L.BODY_LEVEL)
    rows = rows.withColumn("level", level).withColumn("section", F.sum((F.col("level") < L.BODY_LEVEL).cast("int")).over(upto))
    title = F.ltrim(F.regexp_replace("line", "^#*", ""))
    path = L.heading_path(rows, doc, "pos", "level", title, 6)
    heads = path.filter(F.col("level") < L.BODY_LEVEL).select(doc, "section", F.array_join("path", "\n").alias("question"))
    body = joined_lines(rows.filter(F.col("level") == L.BODY_LEVEL), [doc, "section"], name="answer")
    return heads.join(body.select(doc, "section", X.strip(F.col("answer")).alias("answer")), [doc, "section"]).filter(
        (F.col("answer") != "") & (F.col("question") != ""))


def tagged_rows(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Content runs up to the next two-field line, whose second field holds the tags."""
    order = Window.partitionBy(doc).orderBy("pos")
    rows = _fields(df, doc, text)
    two = F.col("__two").cast("int")
    group = F.coalesce(F.sum(two).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("row", group)
    tags = F.filter(F.transform(F.split(F.split_part("line", F.col("__d"), F.lit(2)), ","), lambda t: F.replace(X.strip(t), F.lit("."), F.lit("_"))), lambda t: t != "")
    ends = rows.filter("__two").select(doc, "row", tags.alias("tags"))
    piece = F.concat(F.lit("\n"), F.when(F.col("__two"), F.col("__p")).otherwise(F.col("line")))
    return ends.join(joined_lines(rows.withColumn("line", piece), [doc, "row"], "", name="content").select(doc, "row", "content"), [doc, "row"])


# --- titles -----------------------------------------------------------------------------------------------------

# Numbering styles, one family per row, outermost level first.
BULLET_FAMILIES = (
    (
        r"第[零一二三四五六七八九十百0-9]+(分?编|部分)", r"第[零一二三四五六七八九十百0-9]+章", r"第[零一二三四五六七八九十百0-9]+节",
        r"第[零一二三四五六七八九十百0-9]+条", r"[\(（][零一二三四五六七八九十百]+[\)）]",
    ),
    (
        r"第[0-9]+章", r"第[0-9]+节", r"[0-9]{0,2}[\. 、]", r"[0-9]{0,2}\.[0-9]{0,2}[^a-zA-Z/%~-]",
        r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}", r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}",
    ),
    (
        r"第[零一二三四五六七八九十百0-9]+章", r"第[零一二三四五六七八九十百0-9]+节", r"[零一二三四五六七八九十百]+[ 、]",
        r"[\(（][零一二三四五六七八九十百]+[\)）]", r"[\(（][0-9]{0,2}[\)）]",
    ),
    (
        r"PART (ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)", r"Chapter (I+V?|VI*|XI|IX|X)", r"Section [0-9]+", r"Article [0-9]+",
    ),
    (r"#[^#]", r"##[^#]", r"###.*", r"####.*", r"#####.*", r"######.*"),
)
# Fixed value: what looks like a bullet and is none.
NOT_BULLET = r"^(0|[0-9]+ +[0-9~个只-]|[0-9]+\.{2,})"
NOT_TITLE_MARKS = "[,;，。；！!]"


def is_bullet(line: Column) -> Column:
    return ~line.rlike(NOT_BULLET)


def is_not_title(text: Column) -> Column:
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    article = text.rlike("^第[零一二三四五六七八九十百0-9]+条")
    long = (words > 12) | (~F.contains(text, F.lit(" ")) & (F.length(text) >= 32))
    return ~article & (long | text.rlike(NOT_TITLE_MARKS))


def numbering_style(lines: Column) -> Column:
    """Index of the numbering family most lines follow, -1 when none does; ties go to the first."""
    stripped = F.transform(lines, X.strip)
    hits = [_family_hits(stripped, family) for family in BULLET_FAMILIES]
    best = F.array_max(F.array(*[F.struct(h.alias("h"), F.lit(-i).alias("i")) for i, h in enumerate(hits)]))
    return F.when(best["h"] > 0, -best["i"]).otherwise(-1)


def _family_hits(lines: Column, family) -> Column:
    pattern = "^(?:" + "|".join(f"(?:{x})" for x in family) + ")"
    return F.size(F.filter(lines, lambda l: l.rlike(pattern) & is_bullet(l)))


def line_level(line: Column, family: int, layout: Column | None = None) -> Column:
    """0-based level of a line in one numbering family; a title by layout comes after them, body text last."""
    patterns = BULLET_FAMILIES[family]
    text = X.strip(line)
    out = None
    for i, p in enumerate(patterns):
        hit = text.rlike(f"^(?:{p})") & is_bullet(line)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    if layout is not None:
        out = out.when(layout.rlike("title|head") & ~is_not_title(F.split_part(line, F.lit("@"), F.lit(1))), len(patterns))
    return out.otherwise(len(patterns) + 1)


def outline_levels(lines: Column, outline: Column, share: float = 0.03, similarity: float = 0.8) -> Column:
    """Level of every line from the first outline entry that resembles it, null when the outline is too small.

    ``outline`` is an array of ``struct(text, level)``; both arrays belong to one document.
    """

    def level(line):
        hit = F.filter(outline, lambda o: X.bigram_similarity(o["text"], line) > similarity)
        return F.coalesce(F.get(hit, F.lit(0))["level"] + 1, F.lit(L.BODY_LEVEL))

    return F.when(F.size(outline) / F.size(lines) > share, F.transform(lines, level))


def title_tree_chunks(lines: DataFrame, doc: str, level: str, target: str, whole_headings: bool = False) -> DataFrame:
    """Chunks along the title tree cut at the document's target level.

    Default: one chunk per leaf title, made of the titles and bodies on its path. ``whole_headings``: one chunk per
    title that has body text (or no children), made of the titles on its path and its own body.
    """
    order = Window.partitionBy(doc).orderBy("pos")
    is_title = F.coalesce(F.col(level) <= F.col(target), F.lit(False))
    marked = lines.withColumn("section", F.sum(is_title.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    marked = marked.withColumn("__title", is_title)
    body = joined_lines(marked.filter(~F.col("__title")), [doc, "section"], name="body").select(doc, "section", "body")
    heads = marked.filter("__title").select(doc, "section", F.col(level).alias("level"), F.col("line").alias("title"))
    nodes = heads.join(body, [doc, "section"], "left")
    by_section = Window.partitionBy(doc).orderBy("section")
    nodes = nodes.withColumn("__leaf", F.coalesce(F.lead("level").over(by_section) <= F.col("level"), F.lit(True)))
    own = F.concat_ws("\n", "title", "body")
    label = F.col("title") if whole_headings else own
    paths = _paths(nodes, doc, label)
    if whole_headings:
        chosen = paths.filter(F.col("body").isNotNull() | F.col("__leaf")).select(
            doc, "section", F.concat_ws("\n", F.array_join("path", "\n"), "body").alias("text"))
    else:
        chosen = paths.filter("__leaf").select(doc, "section", F.array_join("path", "\n").alias("text"))
    root = body.filter(F.col("section") == 0).select(doc, "section", F.col("body").alias("text"))
    return root.unionByName(chosen)


def _paths(nodes: DataFrame, doc: str, label: Column) -> DataFrame:
    """Labels of the ancestors of every node and its own, from levels in order: a fold over the document's titles."""
    titles = nodes.groupBy(doc).agg(
        F.array_sort(F.collect_list(F.struct("section", "level", label.alias("label"), "body", "__leaf"))).alias("__n"))

    def step(a, x):
        open_titles = F.filter(a["stack"], lambda s: s["level"] < x["level"])
        stack = F.array_append(open_titles, F.struct(x["level"].alias("level"), x["label"].alias("label")))
        return F.struct(stack.alias("stack"), F.array_append(a["out"], F.transform(stack, lambda s: s["label"])).alias("out"))

    zero = F.struct(_empty("array<struct<level:int,label:string>>").alias("stack"), _empty("array<array<string>>").alias("out"))
    folded = titles.withColumn("__p", F.aggregate("__n", zero, step, lambda a: a["out"]))
    rows = folded.select(doc, F.explode(F.arrays_zip("__n", "__p")).alias("z"))
    return rows.select(doc, "z.__n.section", "z.__n.body", "z.__n.__leaf", F.col("z.__p").alias("path"))


def section_chunks(lines: DataFrame, doc: str, section: str, tokens: str, low: int = 32, high: int = 1024) -> DataFrame:
    """Merge lines while the chunk is tiny, or while it is not full and the section stays the same."""
    docs = lines.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("pos", F.col(section).alias("s"), F.col(tokens).alias("n"), "line"))).alias("__l"))
    ids = fold_groups(
        F.col("__l"), lambda a, x: ~((a["n"] < low) | ((a["n"] < high) & (a["s"] == x["s"]))), {"n": F.lit(0), "s": F.lit(-2).cast("long")},
        lambda a, x, o: {"n": F.when(o, x["n"]).otherwise(a["n"] + x["n"]), "s": x["s"].cast("long")})
    make = lambda s: F.concat(F.array_join(F.transform(s, lambda l: l["line"]), "\n"), F.lit("\n"))
    return explode_chunks(group_slices(docs, ids, "__l", make, "__t"), doc, "__t")


def ancestor_chunks(lines: DataFrame, doc: str, rank: str, depth: int, n_ranks: int, budget: int = 218) -> DataFrame:
    """Every line with its nearest preceding titles, deepest rank first; small single lines are packed together.

    ``rank`` 0 is body text, higher ranks are more important titles. A title that stands before the title found at
    the next rank belongs to an earlier section and is dropped. Lines of ranks below ``depth`` that no deeper line
    has taken up make chunks of their own.
    """
    before = Window.partitionBy(doc).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    near = {f"__p{r}": F.max(F.when(F.col(rank) == r, F.col("pos"))).over(before) for r in range(1, n_ranks)}
    base = lines.withColumns(near)
    levels = F.array(*[F.struct(F.lit(r).alias("r"), F.col(f"__p{r}").alias("p")) for r in range(1, n_ranks)])
    above = F.filter(levels, lambda s: (s["r"] > F.col(rank)) & s["p"].isNotNull() & (F.col(rank) + 1 != n_ranks - 1))

    def step(a, s):
        last = F.element_at(a, -1)
        kept = F.when(s["p"] > last, F.slice(a, 1, F.size(a) - 1)).otherwise(a)
        return F.array_append(kept, s["p"])

    built = base.filter(F.col(rank) < depth).withColumn("__m", F.aggregate(above, F.array("pos"), step))
    # A title is used up by chunks of deeper ranks that are themselves kept; deeper ranks are decided first.
    kept = built.filter(F.col(rank) == 0)
    for r in range(1, depth):
        used = kept.select(doc, F.explode("__m").alias("pos")).distinct()
        kept = kept.unionByName(built.filter(F.col(rank) == r).join(used, [doc, "pos"], "left_anti").select(kept.columns))
    texts = lines.select(doc, F.col("pos").alias("__x"), F.col("line").alias("__line"))
    members = kept.select(doc, rank, "pos", F.explode("__m").alias("__x")).join(texts, [doc, "__x"])
    joined = members.groupBy(doc, rank, "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__x", "__line"))), lambda s: s["__line"]), "\n").alias("text"), F.count("*").alias("m"))
    rows = joined.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), "pos", "text", "m"))).alias("__c"))
    items = F.transform("__c", lambda c: F.struct((c["m"] == 1).alias("one"), X.token_count(c["text"]).alias("n")))
    ids = fold_groups(
        items, lambda a, x: ~(x["one"] & (a["n"] + x["n"] < budget)), {"n": F.lit(0)},
        lambda a, x, o: {"n": F.when(~x["one"], F.lit(budget)).otherwise(F.when(o, x["n"]).otherwise(a["n"] + x["n"]))})
    return explode_chunks(group_slices(rows, ids, "__c", lambda s: F.array_join(F.transform(s, lambda c: c["text"]), "\n"), "__t"), doc, "__t")


CONTENTS_TITLES = r"(?i)^(contents|目录|目次|table of contents|tableofcontents|致谢|acknowledge)$"  # fixed values


def drop_contents_pages(lines: DataFrame, doc: str, english: bool = True, reach: int = 128) -> DataFrame:
    """Remove a contents list: from its title to the next line that starts like the first entry, at most 128 lines on."""
    order = Window.partitionBy(doc).orderBy("pos")
    after = order.rowsBetween(1, Window.unboundedFollowing)
    flat = F.regexp_replace(F.split_part("line", F.lit("@@"), F.lit(1)), "[ 　]+", "")
    text = X.strip(F.col("line"))
    prefix = F.array_join(F.slice(F.split(text, r"\s+"), 1, 2), " ") if english else F.substring(text, 1, 3)
    marked = lines.withColumn("__pre", F.when(text != "", prefix)).withColumn("__head", X.strip(flat).rlike(CONTENTS_TITLES))
    entry = F.first(F.when(F.col("__pre").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("__pre").alias("t"))), ignorenulls=True).over(after)
    heads = marked.withColumn("__e", entry).filter("__head").select(doc, F.col("pos").alias("__c"), "__e.p", "__e.t")
    # Candidates lie at most `reach` lines after the first entry: buckets of that width make it an equi-join.
    bucket = lambda c: F.floor(c / reach)
    left = heads.withColumn("__b", F.explode(F.array(bucket(F.col("p")), bucket(F.col("p")) + 1)))
    right = marked.select(doc, F.col("pos").alias("__q"), text.alias("__text"), bucket(F.col("pos")).alias("__b"))
    hit = left.join(right, [doc, "__b"]).filter(
        (F.col("__q") > F.col("p")) & (F.col("__q") <= F.col("p") + reach) & F.startswith("__text", F.col("t")))
    ends = hit.groupBy(doc, "__c").agg(F.min("__q").alias("__end"))
    ranges = heads.join(ends, [doc, "__c"], "left").select(
        doc, "__c", (F.coalesce(F.col("__end") - 1, F.col("p"), F.col("__c"))).alias("__to"))
    # A contents title inside a removed range is gone already.
    listed = ranges.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("__c", "__to"))).alias("__r"))
    zero = F.struct(F.lit(-1).alias("end"), _empty("array<struct<c:int,to:int>>").alias("out"))
    fold = F.aggregate(
        "__r", zero,
        lambda a, x: F.when(x["__c"] <= a["end"], a).otherwise(F.struct(
            x["__to"].alias("end"), F.array_append(a["out"], F.struct(x["__c"].alias("c"), x["__to"].alias("to"))).alias("out"))),
        lambda a: a["out"])
    gone = listed.select(doc, fold.alias("__g"))
    inside = F.exists("__g", lambda g: F.col("pos").between(g["c"], g["to"]))
    return lines.join(gone, doc, "left").filter(~F.coalesce(inside, F.lit(False))).select(lines.columns)


def promote_colon_titles(lines: DataFrame, doc: str, rest: int = 32) -> DataFrame:
    """A line that ends in a colon gives its last clause as a title line before it, if the rest is long enough."""
    text = X.strip(F.split_part("line", F.lit("@"), F.lit(1)))
    clause = F.regexp_extract(text, r"(?:[。？！!?;；]|\. )([^。？！!?;；]*?[:：])$", 1)
    clause = F.regexp_replace(clause, r"^.*\. ", "")
    hit = text.rlike("[:：]$") & (clause != "") & (F.length(text) - F.length(clause) >= rest)
    parts = F.when(hit, F.array(F.struct(clause.alias("line"), F.lit("title").alias("layout")), F.struct(F.col("line"), F.lit("").alias("layout")))).otherwise(
        F.array(F.struct(F.col("line"), F.lit("").alias("layout"))))
    return lines.select(doc, "pos", F.posexplode(parts).alias("sub", "x")).select(doc, "pos", "sub", "x.line", "x.layout")


def merge_same_mark(lines: DataFrame, doc: str) -> DataFrame:
    """Join neighbouring lines that start with the same character, unless it is a Latin letter or an ideograph."""
    order = Window.partitionBy(doc).orderBy("pos")
    mark = F.substring(X.strip(F.col("line")), 1, 1)
    rows = lines.filter(~X.is_blank(F.col("line"))).withColumn("__m", mark)
    joins = (F.col("__m") == F.lag("__m").over(order)) & ~F.lower("__m").rlike(r"^[a-z\p{IsHan}]")
    rows = rows.withColumn("run", F.sum((~F.coalesce(joins, F.lit(False))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return joined_lines(rows, [doc, "run"])


def drop_dotted_pages(lines: DataFrame, by: list[str], line: str = "line", limit: int = 3) -> DataFrame:
    """Remove pages with more than three lines of dotted leaders."""
    dirty = lines.filter(F.contains(line, F.lit("··"))).groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") > limit)
    return lines.join(dirty, by, "left_anti")


def positions(pos: Column) -> Column:
    """Position record of a chunk that has no page geometry: its ordinal in every field, pages counted from 1."""
    return F.struct(
        F.array(pos + 1).alias("page_num"), F.array(pos).alias("top"),
        F.array(F.struct((pos + 1).alias("page"), pos.alias("left"), pos.alias("right"), pos.alias("top"), pos.alias("bottom"))).alias("position"))


def toc_spans(toc: DataFrame, doc: str, start: str, last_only_own: bool = True) -> DataFrame:
    """``(doc, entry, pos)``: an entry owns the chunks from its own to the next entry's; the last one only its own."""
    order = Window.partitionBy(doc).orderBy(start)
    nxt = F.coalesce(F.lead(start).over(order), F.col(start))
    return toc.withColumn("__to", nxt).select(doc, F.col(start).alias("entry"), F.explode(F.sequence(F.col(start), F.col("__to"))).alias("pos"))


# --- JSON -------------------------------------------------------------------------------------------------------


def split_json(df: DataFrame, doc: str, leaves: str, budget: int = 2000, floor: int | None = None, keep=()) -> DataFrame:
    """Pack the leaves of a JSON document into chunks of bounded serialised size, in order.

    ``leaves`` is an array of ``struct(path, json)``; list members carry their index in the path. A chunk is closed
    when the next leaf would reach the budget and it holds at least ``floor`` characters (default budget − 200).
    """
    floor = max(budget - 200, 50) if floor is None else floor
    size = lambda x: F.length(x["path"]) + F.length(x["json"]) + 6
    ids = fold_groups(
        F.col(leaves), lambda a, x: (a["n"] + size(x) >= budget) & (a["n"] >= floor), {"n": F.lit(2)},
        lambda a, x, o: {"n": F.when(o, size(x) + 2).otherwise(a["n"] + size(x))})
    make = lambda s: F.concat(F.lit("{"), F.array_join(F.transform(s, lambda x: F.concat(F.lit('"'), x["path"], F.lit('": '), x["json"])), ", "), F.lit("}"))
    base = df.select(doc, *keep, F.col(leaves).alias(leaves))
    return explode_chunks(group_slices(base, ids, leaves, make, "__t"), doc, "__t", keep)


def json_leaves(df: DataFrame, doc: str, document: str, keep=(), step: int = 4) -> DataFrame:
    """``(doc, leaves)``: ``struct(path, json)`` of all leaves of a VARIANT column, in order, however deep objects and lists are nested.

    Documents that still hold an object or a list after ``step`` levels are the frontier of the next round, whose rows are
    written first; a round has no shuffle, and a table whose documents are shallow ends after one. Empty objects and
    lists have no leaves; a null document has null ``leaves``.
    """
    first = F.when(F.col(document).isNotNull(), F.array(F.struct(F.lit("").alias("path"), F.col(document).alias("v"))))
    frontier, done = df.select(doc, *keep, first.alias("leaves")), []
    while True:
        level = F.col("leaves")
        for _ in range(step):
            level = F.flatten(F.transform(level, _open))
        opened = cut_lineage(frontier.withColumn("leaves", level))
        nested = F.coalesce(F.exists("leaves", lambda s: F.schema_of_variant(s["v"]).rlike("^(OBJECT|ARRAY)<")), F.lit(False))
        done.append(opened.filter(~nested))
        frontier = opened.filter(nested)
        if frontier.isEmpty():
            break
    rows = reduce(lambda x, y: x.unionByName(y), done)
    return rows.withColumn("leaves", F.transform("leaves", lambda s: F.struct(s["path"].alias("path"), F.to_json(s["v"]).alias("json"))))


def _open(s: Column) -> Column:
    kind = F.schema_of_variant(s["v"])
    prefix = F.when(s["path"] == "", "").otherwise(F.concat(s["path"], F.lit(".")))
    child = lambda key, v: F.struct(F.concat(prefix, key).alias("path"), v.alias("v"))
    members = F.transform(F.map_entries(F.try_variant_get(s["v"], "$", "map<string,variant>")), lambda e: child(e["key"], e["value"]))
    listed = F.transform(F.try_variant_get(s["v"], "$", "array<variant>"), lambda v, i: child(i.cast("string"), v))
    return F.when(F.startswith(kind, F.lit("OBJECT")), members).when(F.startswith(kind, F.lit("ARRAY")), listed).otherwise(
        F.array(F.struct(s["path"].alias("path"), s["v"].alias("v"))))
