"""Chunking operators over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X, web
from corpusloom.operators import chunking as C, layout as L
from corpusloom.operators.running import row_numbers
from corpusloom.plans.ranking import LEVEL_SQL, LINES_SQL, doc_lines, levelled
from corpusloom.plans.text import q, sql_tokens
from corpusloom.registry import query


def fold_sql(source: str, start: str, opened: str = "x.n", grown: str = "f.acc + x.n") -> str:
    """Recursive CTE ``f(doc_id, pos, s, n, g, acc)`` that packs ``source(doc_id, pos, s, n)`` greedily."""
    return f"""f as (select doc_id, pos, s, n, 0 as g, {opened.replace('x.', '')} as acc from {source} where pos = 0
 union all select x.doc_id, x.pos, x.s, x.n, f.g + case when {start} then 1 else 0 end, case when {start} then {opened} else {grown} end
 from f join {source} x on x.doc_id = f.doc_id and x.pos = f.pos + 1)"""


def exploded_sql(array: str, table: str = "documents", key: str = "doc_id") -> str:
    """``src(doc_id, pos, s, n)`` from an array expression over a table."""
    return f"""a as (select {key} as doc_id, {array} as l from {table}), u as (select doc_id, unnest(l) as s, generate_subscripts(l, 1) - 1 as pos from a),
 src as (select doc_id, pos, s, len({sql_tokens('s')}) as n from u)"""


CHUNK_OUT = """o as (select doc_id, g, {text} as text from f group by doc_id, g),
 k as (select * from o where trim(text, E' \\t\\n\\r\\x0b\\x0c') <> '')
select doc_id, row_number() over (partition by doc_id order by g) - 1 as pos, md5(text) as text, len({tokens}) as tokens from k"""


def out_sql(text: str) -> str:
    return CHUNK_OUT.format(text=text, tokens=sql_tokens("text"))


def hashed(chunks, *extra, doc="doc_id"):
    return chunks.select(doc, F.col("pos").cast("long").alias("pos"), F.md5("text").alias("text"), F.col("tokens").cast("long").alias("tokens"), *extra)


LINE_LIST = "string_split(text, chr(10))"
NEWLINED = f"list_transform({LINE_LIST}, lambda s: chr(10) || s)"
MERGED = f"with recursive {exploded_sql(NEWLINED)}, {fold_sql('src', 'f.acc > 128')}, "


@query("k1_token_merge", MERGED + out_sql("string_agg(s, '' order by pos)"))
def k1(t):
    return hashed(C.merge_sections(t.documents, "doc_id", "text", 128))


@query("k1_token_merge_overlap", f"""with recursive {exploded_sql(NEWLINED)}, {fold_sql('src', 'f.acc > 102.4')},
 own as (select doc_id, g, string_agg(s, '' order by pos) as t from f group by doc_id, g),
 w as (select doc_id, g, t from own where g = 0 union all
   select o.doc_id, o.g, substr(w.t, cast(floor(length(w.t) * 0.8) as int) + 1) || o.t from w join own o on o.doc_id = w.doc_id and o.g = w.g + 1),
 k as (select doc_id, g, t as text from w where trim(t, E' \\t\\n\\r') <> '')
select doc_id, row_number() over (partition by doc_id order by g) - 1 as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from k""")
def k1_overlap(t):
    return hashed(C.merge_sections(t.documents, "doc_id", "text", 128, overlap=20))


def _pieces_sql(array: str) -> str:
    return f"""with {exploded_sql(array)}, k as (select doc_id, pos as g, s as text from src where trim(s, E' \\t\\n\\r\\x0b\\x0c') <> '')
select doc_id, row_number() over (partition by doc_id order by g) - 1 as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from k"""


@query("k2_custom_delimiters", _pieces_sql("list_transform(regexp_split_to_array(text, '!!|\\| |\\.'), lambda p: chr(10) || p)"))
def k2(t):
    return hashed(C.split_custom(t.documents, "doc_id", "text", "`.` or `!!` or `| `"))


_KEPT = "list_filter(regexp_split_to_array(regexp_replace(text, '(!!|\\.|\\n)', '\\1' || chr(1), 'g'), chr(1)), lambda p: p not in ('!!', '.', chr(10)))"


@query("k3_delimiter_kept", _pieces_sql(_KEPT))
def k3(t):
    return hashed(C.split_kept(t.documents, "doc_id", "text", r"!!|\.|\n"))


@query("k3_bad_pattern", f"select doc_id, 0 as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from documents where trim(text) <> ''")
def k3_bad(t):
    return hashed(C.split_kept(t.documents, "doc_id", "text", "(unclosed"))


@query("k4_plain_merge", f"with recursive {exploded_sql(r'''regexp_split_to_array(text, '[\n!?;。；！？]')''')}, {fold_sql('src', 'f.acc > 64')}, "
       + out_sql("regexp_replace(string_agg(s, chr(10) order by pos), '^\\n+', '')"))
def k4(t):
    return hashed(C.merge_plain(t.documents, "doc_id", "text", 64))


@query("k5_parent_child", f"""with {exploded_sql(LINE_LIST)},
 par as (select doc_id, pos as g, s || case when pos < (select max(pos) from src m where m.doc_id = src.doc_id) then chr(10) else '' end as mom from src where trim(s, E' \\t\\n\\r') <> ''),
 pk as (select *, row_number() over (partition by doc_id order by g) - 1 as parent_pos from par),
 ch as (select doc_id, parent_pos, mom, unnest(l) as text, generate_subscripts(l, 1) as cp from (
   select *, list_filter(regexp_split_to_array(regexp_replace(mom, '(\\. |\\.)', '\\1' || chr(1), 'g'), chr(1)), lambda p: trim(p, E' \\t\\n\\r') <> '' and p not in ('.', '. ')) as l from pk))
select doc_id, parent_pos, row_number() over (partition by doc_id, parent_pos order by cp) - 1 as pos, md5(mom) as mom, md5(text) as text, len({sql_tokens('text')}) as tokens from ch""")
def k5(t):
    chunks = C.split_parents(t.documents, "doc_id", "text", r"\n", r"\. |\.")
    return hashed(chunks, F.col("parent_pos").cast("long").alias("parent_pos"), F.md5("mom").alias("mom"))


@query("k6_typed_merge", rf"""with recursive {LINES_SQL},
 src as (select doc_id, row_number() over (partition by doc_id order by pos) - 1 as pos, line as s, n, kind from li),
 f as (select doc_id, pos, kind, s as txt, n as acc, 0 as g from src where pos = 0 union all
   select x.doc_id, x.pos, x.kind,
    case when f.kind <> 'text' or x.kind <> 'text' then x.s when f.acc > 36 then substr(f.txt, cast(floor(length(f.txt) * 0.9) as int) + 1) || x.s else f.txt || chr(10) || x.s end,
    case when f.kind <> 'text' or x.kind <> 'text' then x.n when f.acc > 36 then len({sql_tokens("(substr(f.txt, cast(floor(length(f.txt) * 0.9) as int) + 1) || x.s)")}) else f.acc + x.n end,
    f.g + case when f.kind <> 'text' or x.kind <> 'text' or f.acc > 36 then 1 else 0 end
   from f join src x on x.doc_id = f.doc_id and x.pos = f.pos + 1),
 o as (select doc_id, g, arg_max(txt, pos) as text, any_value(kind) as kind from f group by doc_id, g)
select doc_id, g as pos, md5(text) as text, kind, len({sql_tokens('text')}) as tokens from o""")
def k6(t):
    """Lines with their kind as items, merged to 40 tokens with 10 % overlap."""
    kind = lambda l: F.when(F.contains(l, F.lit(" | ")), "table").when(F.contains(l, F.lit("!!")), "image").otherwise("text")
    items = F.transform(F.filter(F.split("text", "\n"), lambda l: ~X.is_blank(l)), lambda l: F.struct(kind(l).alias("kind"), l.alias("text")))
    return hashed(C.merge_typed(t.documents.withColumn("items", items), "doc_id", "items", 40, overlap=10), "kind")


@query("k7_whole_document", f"select doc_id, 0 as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from documents where trim(text) <> ''")
def k7(t):
    return hashed(C.whole_document(t.documents, "doc_id", F.split("text", "\n")))


MARKDOWN_SQL = r"""md as (select page_id, '# ' || url || chr(10) || chr(10) || 'Intro of ' || url || chr(10) || '  tail' || chr(10) || chr(10) || '- one ' || page_id || chr(10) || '  more words'
 || chr(10) || chr(10) || '1. two' || chr(10) || '> quote' || chr(10) || chr(10) || '```py' || chr(10) || '# not a header' || chr(10) || '- x' || chr(10) || '```' || chr(10) || 'Closing text' || chr(10) || chr(10) || 'second' as text from pages)"""


def markdown_pages(t):
    """Markdown with every kind of block, built from the page columns."""
    n = F.lit("\n")
    text = F.concat(
        F.lit("# "), "url", n, n, F.lit("Intro of "), "url", n, F.lit("  tail"), n, n, F.lit("- one "), "page_id", n, F.lit("  more words"), n, n, F.lit("1. two"),
        n, F.lit("> quote"), n, n, F.lit("```py"), n, F.lit("# not a header"), n, F.lit("- x"), n, F.lit("```"), n, F.lit("Closing text"), n, n, F.lit("second"))
    return t.pages.select("page_id", text.alias("text"))


@query("k8_markdown_elements", """
select page_id, kind, start_line, end_line, md5(text) as text from (
 select page_id, 'header' as kind, 0 as start_line, 0 as end_line, '# ' || url as text from pages union all
 select page_id, 'text_block', 2, 3, 'Intro of ' || url || chr(10) || '  tail' from pages union all
 select page_id, 'list_block', 5, 8, '- one ' || page_id || chr(10) || '  more words' || chr(10) || chr(10) || '1. two' from pages union all
 select page_id, 'blockquote', 9, 10, '> quote' || chr(10) from pages union all
 select page_id, 'code_block', 11, 14, '```py' || chr(10) || '# not a header' || chr(10) || '- x' || chr(10) || '```' from pages union all
 select page_id, 'text_block', 15, 17, 'Closing text' || chr(10) || chr(10) || 'second' from pages)""")
def k8(t):
    els = C.markdown_elements(C.lines_of(markdown_pages(t), "page_id", "text"), "page_id")
    return els.select("page_id", "kind", "start_line", "end_line", F.md5("text").alias("text"))


@query("k9_markdown_tables", """
select page_id, md5('Before ' || url || chr(10) || chr(10) || 'middle' || chr(10) || chr(10) || 'between' || chr(10) || chr(10) || chr(10) || 'after ' || page_id) as remainder, 3 as n,
 md5(chr(10) || '| a | b |' || chr(10) || '|---|:-:|' || chr(10) || '| ' || url || ' | 1 |' || chr(10)) as bordered,
 md5(chr(10) || 'a | b' || chr(10) || '--- | ---' || chr(10) || 'x' || page_id || ' | 2' || chr(10)) as borderless,
 md5(chr(10) || '<table><tr><td>' || url || '</td></tr></table>') as html from pages""")
def k9(t):
    n = F.lit("\n")
    text = F.concat(
        F.lit("Before "), "url", n, F.lit("| a | b |\n|---|:-:|\n| "), "url", F.lit(" | 1 |\n"), F.lit("middle"), n, F.lit("a | b\n--- | ---\nx"), "page_id", F.lit(" | 2\n"),
        F.lit("between"), n, F.lit('<table class="c"><tr><td id="1">'), "url", F.lit("</td></tr></table>\n"), F.lit("after "), "page_id")
    rows = t.pages.select("page_id", text.alias("text"))
    remainder, tables = C.lift_tables(F.col("text"))
    out = rows.select("page_id", remainder.alias("r"), tables.alias("t"))
    return out.select(
        "page_id", F.md5("r").alias("remainder"), F.size("t").alias("n"), F.md5(F.col("t")[0]).alias("bordered"), F.md5(F.col("t")[1]).alias("borderless"),
        F.md5(F.col("t")[2]).alias("html"))


_TAIL = "case when cast(floor(length(f.acc) * 10 / 100) as int) > 0 then right(f.acc, cast(floor(length(f.acc) * 10 / 100) as int)) else '' end"


@query("k10_markdown_merge", rf"""with recursive {exploded_sql(LINE_LIST)},
 f as (select doc_id, pos, s as acc, n as m, 0 as g from src where pos = 0 union all
  select x.doc_id, x.pos, case when f.acc <> '' and f.m + x.n > 100 then case when {_TAIL} <> '' then {_TAIL} || chr(10) || x.s else x.s end
     when f.acc <> '' then f.acc || chr(10) || x.s else x.s end,
   case when f.acc <> '' and f.m + x.n > 100 then len({sql_tokens('(' + _TAIL + ')')}) + x.n else f.m + x.n end,
   f.g + case when f.acc <> '' and f.m + x.n > 100 then 1 else 0 end from f join src x on x.doc_id = f.doc_id and x.pos = f.pos + 1),
 k as (select doc_id, g, arg_max(acc, pos) as text from f group by doc_id, g having trim(arg_max(acc, pos), E' \t\n\r') <> '')
select doc_id, row_number() over (partition by doc_id order by g) - 1 as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from k""")
def k10(t):
    return hashed(C.merge_markdown(t.documents, "doc_id", F.split("text", "\n"), 100, overlap=10))


_BODY = r"regexp_replace(html, '<(script)(?:\s[^>]*)?>.*?</script\s*>', ' ', 'gis')"
for _e in ("style", "head"):
    _BODY = rf"regexp_replace({_BODY}, '<{_e}(?:\s[^>]*)?>.*?</{_e}\s*>', ' ', 'gis')"
_BODY = rf"regexp_replace({_BODY}, '<!--.*?-->', ' ', 'gs')"
_BODY = rf"regexp_replace({_BODY}, '<h1(?:\s[^>]*)?>', chr(1) || '# ', 'gi')"
_BODY = rf"regexp_replace({_BODY}, '</?(?:{'|'.join(web.BLOCK_ELEMENTS)})(?:\s[^>]*)?/?>', chr(1), 'gi')"
BLOCK_LIST = rf"""list_filter(list_transform(string_split({_BODY}, chr(1)), lambda b: trim(regexp_replace(trim(regexp_replace(b, '<[^>]*>', ' ', 'gs')), '[ \t\r\n]+', ' ', 'g'))),
  lambda b: b <> '' and not regexp_matches(b, '^#+$'))"""


@query("k11_html_blocks", f"""with {exploded_sql(BLOCK_LIST, 'pages', 'page_id')} select doc_id as page_id, pos, md5(s) as block from src""")
def k11(t):
    blocks = t.pages.select("page_id", F.posexplode(web.block_texts(F.col("html"))).alias("pos", "block"))
    return blocks.select("page_id", F.col("pos").cast("long").alias("pos"), F.md5("block").alias("block"))


@query("k12_block_packing", f"""with recursive {exploded_sql(BLOCK_LIST, 'pages', 'page_id')},
 cut as (select doc_id, pos, case when n > 40 then array_to_string({sql_tokens('s')}[i * 40 + 1:i * 40 + 40], ' ') else s end as s, n > 40 as own, i
   from src, range(0, 10000) r(i) where i <= case when n > 40 then (n - 1) // 40 else 0 end),
 c2 as (select doc_id, row_number() over (partition by doc_id order by pos, i) - 1 as pos, s, own, len({sql_tokens('s')}) as n from cut),
 f as (select doc_id, pos, s, own, n as acc, 0 as g from c2 where pos = 0 union all
  select x.doc_id, x.pos, x.s, x.own, case when x.own or f.own or f.acc + x.n > 40 then x.n else f.acc + x.n end, f.g + case when x.own or f.own or f.acc + x.n > 40 then 1 else 0 end
  from f join c2 x on x.doc_id = f.doc_id and x.pos = f.pos + 1),
 k as (select doc_id, g, string_agg(s, chr(10) order by pos) as text from f group by doc_id, g)
select doc_id as page_id, g as pos, md5(text) as text, len({sql_tokens('text')}) as tokens from k where trim(text) <> ''""")
def k12(t):
    blocks = t.pages.select("page_id", web.block_texts(F.col("html")).alias("b"))
    return hashed(C.pack_blocks(blocks, "page_id", "b", 40), doc="page_id")


_ROWS = f"list_transform({LINE_LIST}, lambda l: '<tr><td>' || l || '</td></tr>')"


@query("k13_table_split", f"with recursive {exploded_sql(_ROWS)}, {fold_sql('src', 'f.acc + x.n > 80')}, "
       + out_sql("'<table>' || string_agg(s, '' order by pos) || '</table>'"))
def k13(t):
    rows = F.transform(F.split("text", "\n"), lambda l: F.concat(F.lit("<tr><td>"), l, F.lit("</td></tr>")))
    table = F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>"))
    return hashed(C.split_table(t.documents.select("doc_id", table.alias("table")), "doc_id", "table", 80))


@query("k13_row_batches", f"""select doc_id, (pos // 10)::bigint as batch, md5(string_agg(s, '; ' order by pos)) as text from (
 select doc_id, unnest({LINE_LIST}) as s, generate_subscripts({LINE_LIST}, 1) - 1 as pos from documents) group by doc_id, pos // 10""")
def k13_batches(t):
    rows = t.documents.select("doc_id", F.posexplode(C.batch_rows(F.split("text", "\n"))).alias("batch", "text"))
    return rows.select("doc_id", F.col("batch").cast("long").alias("batch"), F.md5("text").alias("text"))


@query("k14_row_chunks", """
select c_custkey, '- c_name: ' || c_name || chr(10) || '- c_mktsegment: ' || c_mktsegment as text, case when c_acctbal > 0 then 'yes' else null end as stored, c_mktsegment as both,
 case when c_acctbal > 0 then 2 else 1 end as n from customer""")
def k14(t):
    rows = t.customer.select("c_custkey", F.lit(1).alias("id"), "c_name", "c_mktsegment", F.when(F.col("c_acctbal") > 0, "yes").alias("positive"))
    out = C.row_chunks(rows, {"c_name": "indexing", "positive": "metadata"}, keep=["c_custkey"])
    return out.select("c_custkey", "text", F.col("chunk_data")["positive"].alias("stored"), F.col("chunk_data")["c_mktsegment"].alias("both"), F.size("chunk_data").alias("n"))


FIELDS_SQL = rf"""w as (select doc_id, {LINE_LIST} as l from documents),
 sn as (select *, case when len(list_filter(l, lambda x: len(string_split(x, chr(9))) = 2)) >= len(list_filter(l, lambda x: len(string_split(x, ',')) = 2)) then chr(9) else ',' end as d from w),
 fl as (select doc_id, d, unnest(l) as line, generate_subscripts(l, 1) - 1 as pos from sn), ft as (select *, len(string_split(line, d)) = 2 as two from fl)"""


@query("k15_question_rows", rf"""with {FIELDS_SQL}, p as (select *, sum(two::int) over (partition by doc_id order by pos) as pair, max(two::int) over (partition by doc_id) as any2 from ft),
 qn as (select *, max(case when two then string_split(line, d)[1] end) over (partition by doc_id, pair) as question, sum(two::int) over (partition by doc_id) as last from p),
 a as (select doc_id, pair, question, last, string_agg(case when two then string_split(line, d)[2] else chr(10) || line end, '' order by pos) as answer from qn where question <> '' group by all)
select doc_id, pair::bigint as pair, md5(question) as question, md5(answer) as answer, 'pair' as kind from a where answer <> '' or pair = last
union all select doc_id, pos, '', '', 'rejected' from qn where coalesce(question, '') = '' and not two""")
def k15(t):
    pairs, rejected = C.question_rows(t.documents, "doc_id", "text")
    bad = rejected.select("doc_id", F.col("pos").cast("long").alias("pair"), F.lit("").alias("question"), F.lit("").alias("answer"), F.lit("rejected").alias("kind"))
    return pairs.select("doc_id", "pair", F.md5("question").alias("question"), F.md5("answer").alias("answer"), F.lit("pair").alias("kind")).unionByName(bad)


@query("k16_heading_questions", """
select page_id, url || chr(10) || 'Part ' || page_id as question, 'body one' || chr(10) || '```' || chr(10) || '## code' || chr(10) || '```' as answer from pages
union all select page_id, url || chr(10) || 'Other', 'body two' from pages union all select page_id, url || chr(10) || 'Other' || chr(10) || 'Deep', 'body three' from pages""")
def k16(t):
    text = F.concat(
        F.lit("stray\n# "), "url", F.lit("\n## Part "), "page_id", F.lit("\nbody one\n```\n## code\n```\n## Other\n\nbody two\n#### Deep\nbody three\n"))
    return C.heading_questions(t.pages.select("page_id", text.alias("text")), "page_id", "text").select("page_id", "question", "answer")


@query("k17_tagged_rows", rf"""with {FIELDS_SQL}, g as (select *, coalesce(sum(two::int) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as row from ft),
 e as (select doc_id, row, array_to_string(list_filter(list_transform(string_split(string_split(line, d)[2], ','), lambda x: replace(trim(x), '.', '_')), lambda x: x <> ''), '|') as tags from g where two),
 c as (select doc_id, row, string_agg(chr(10) || case when two then string_split(line, d)[1] else line end, '' order by pos) as content from g group by all)
select doc_id, row::bigint as row, md5(content) as content, md5(tags) as tags from e join c using (doc_id, row)""")
def k17(t):
    rows = C.tagged_rows(t.documents, "doc_id", "text")
    return rows.select("doc_id", F.col("row").cast("long").alias("row"), F.md5("content").alias("content"), F.md5(F.array_join("tags", "|")).alias("tags"))


def numbered_lines(t):
    """Document lines that carry a heading mark or a number, depending on the language."""
    lines = F.split("text", "\n")
    mark = lambda l, i: F.when(F.col("lang") == "de", F.concat(F.lit("Section 1 "), l)).when(F.col("lang") == "fr", F.concat(i + 1, F.lit(". "), l)).when(
        F.col("lang") == "es", F.concat(F.lit("## "), l)).otherwise(l)
    return t.documents.select("doc_id", "lang", F.transform(lines, mark).alias("lines"))


def _family_sql(index: int) -> str:
    pattern = "^(?:" + "|".join(f"(?:{p})" for p in C.BULLET_FAMILIES[index]) + ")"
    return f"len(list_filter(sl, lambda x: regexp_matches(x, {q(pattern)}) and not regexp_matches(x, {q(C.NOT_BULLET)})))"


NUMBERED_SQL = f"""nl as (select doc_id, lang, list_transform({LINE_LIST}, lambda l, i: case lang when 'de' then 'Section 1 ' || l when 'fr' then i || '. ' || l when 'es' then '## ' || l else l end) as lines from documents),
 st as (select doc_id, lang, list_transform(lines, lambda l: trim(l, E' \\t\\n\\r')) as sl from nl)"""


@query("k18_numbering_style", f"""with {NUMBERED_SQL}, h as (select doc_id, [{', '.join(_family_sql(i) for i in range(5))}] as h from st)
select doc_id, case when list_max(h) > 0 then list_position(h, list_max(h)) - 1 else -1 end as family from h""")
def k18(t):
    return numbered_lines(t).select("doc_id", C.numbering_style(F.col("lines")).alias("family"))


def _level_sql(index: int) -> str:
    cases = " ".join(f"when regexp_matches(s, {q(f'^(?:{p})')}) and not regexp_matches(s, {q(C.NOT_BULLET)}) then {i}" for i, p in enumerate(C.BULLET_FAMILIES[index]))
    n, t = len(C.BULLET_FAMILIES[index]), "split_part(s, '@', 1)"
    return f"case {cases} when pos = 0 and not (len(list_filter(regexp_split_to_array({t}, '\\s+'), lambda w: w <> '')) > 12 or (not contains({t}, ' ') and length({t}) >= 32) or regexp_matches({t}, '[,;，。；！!]')) then {n} else {n + 1} end"


@query("k19_line_levels", f"""with {NUMBERED_SQL}, e as (select doc_id, lang, unnest(sl) as s, generate_subscripts(sl, 1) - 1 as pos from st)
select doc_id, pos, case when lang = 'fr' then {_level_sql(1)} when lang = 'de' then {_level_sql(3)} else {_level_sql(4)} end as level from e""")
def k19(t):
    rows = numbered_lines(t).select("doc_id", "lang", F.posexplode("lines").alias("pos", "line"))
    layout = F.when(F.col("pos") == 0, "title").otherwise("text")
    level = lambda family: C.line_level(X.strip(F.col("line")), family, layout)
    pick = F.when(F.col("lang") == "fr", level(1)).when(F.col("lang") == "de", level(3)).otherwise(level(4))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), pick.alias("level"))


def _bigrams_sql(c: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({c}), 1)), lambda i: substr({c}, cast(i as int), 2)))"


@query("k20_outline_levels", f"""with {exploded_sql(BLOCK_LIST, 'pages', 'page_id')}, lines as (select doc_id as page_id, pos, s, n from src where n <= 12),
 outline as (select page_id, o, unnest([title, 'Ads']) as text, unnest([1, 2]) as lvl from (select page_id, 1 as o, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') as title from pages)),
 cnt as (select page_id, count(*) as n_lines from lines group by 1),
 sim as (select l.page_id, l.pos, lvl, len(list_intersect({_bigrams_sql('text')}, {_bigrams_sql('substr(s, 1, length(text) + 1)')}))
   / greatest(len({_bigrams_sql('text')}), len({_bigrams_sql('substr(s, 1, length(text) + 1)')}), 1) as sim from lines l join outline using (page_id))
select page_id, pos, coalesce(min(case when sim > 0.8 then lvl end) + 1, 99) as level from sim join cnt using (page_id) where 2 / n_lines > 0.03 group by page_id, pos""")
def k20(t):
    lines = t.pages.select("page_id", web.page_title(F.col("html")).alias("title"), web.block_texts(F.col("html")).alias("blocks"))
    numbered = F.filter(F.transform("blocks", lambda b, i: F.struct(i.alias("pos"), b.alias("line"))), lambda s: X.token_count(s["line"]) <= 12)
    outline = F.array(F.struct(F.col("title").alias("text"), F.lit(1).alias("level")), F.struct(F.lit("Ads").alias("text"), F.lit(2).alias("level")))
    rows = lines.select("page_id", numbered.alias("l"), outline.alias("o"))
    texts = rows.select("page_id", "l", "o", F.transform("l", lambda s: s["line"]).alias("t"))
    levels = texts.select("page_id", F.explode(F.arrays_zip(F.col("l"), C.outline_levels(F.col("t"), F.col("o")).alias("v"))).alias("z")).filter(F.col("z.v").isNotNull())
    return levels.select("page_id", F.col("z.l.pos").cast("long").alias("pos"), F.col("z.v").alias("level"))


TREE_SQL = f"""{LEVEL_SQL}, tg as (select doc_id, list_sort(list_distinct(list(level))) as lv2 from lv where level < 99 group by 1),
 tt as (select doc_id, lv2[least(2, len(lv2))] as target from tg),
 sc as (select lv.*, target, coalesce(level <= target, false) as title, sum(case when level <= target then 1 else 0 end) over (partition by doc_id order by pos) as section from lv left join tt using (doc_id)),
 body as (select doc_id, section, string_agg(line, chr(10) order by pos) as body from sc where not title group by all),
 heads as (select doc_id, section, level, line as title, pos from sc where title),
 nodes as (select heads.*, body, coalesce(lead(level) over (partition by doc_id order by section) <= level, true) as leaf from heads left join body using (doc_id, section)),
 anc as (select n.doc_id, n.section, a.section as asec, a.title, a.body, a.level from nodes n join nodes a on a.doc_id = n.doc_id and a.section < n.section and a.level < n.level
   where not exists (select 1 from nodes b where b.doc_id = n.doc_id and b.section > a.section and b.section < n.section and b.level <= a.level))"""


@query("k21_title_tree", f"""with {TREE_SQL}, up as (select doc_id, section, string_agg(concat_ws(chr(10), title, body), chr(10) order by asec) as path from anc group by all)
select doc_id, section::bigint as section, md5(concat_ws(chr(10), path, title, body)) as text from nodes left join up using (doc_id, section) where leaf
union all select doc_id, 0, md5(body) from body where section = 0""")
def k21(t):
    lines = levelled(t).join(L.hierarchy_level(levelled(t), "doc_id", "level", 2), "doc_id", "left")
    return C.title_tree_chunks(lines, "doc_id", "level", "target").select("doc_id", "section", F.md5("text").alias("text"))


@query("k21_title_tree_headings", f"""with {TREE_SQL}, up as (select doc_id, section, string_agg(title, chr(10) order by asec) as path from anc group by all)
select doc_id, section::bigint as section, md5(concat_ws(chr(10), path, title, body)) as text from nodes left join up using (doc_id, section) where leaf or body is not null
union all select doc_id, 0, md5(body) from body where section = 0""")
def k21_headings(t):
    lines = levelled(t).join(L.hierarchy_level(levelled(t), "doc_id", "level", 2), "doc_id", "left")
    return C.title_tree_chunks(lines, "doc_id", "level", "target", whole_headings=True).select("doc_id", "section", F.md5("text").alias("text"))


@query("k22_section_chunks", f"""with recursive {LEVEL_SQL},
 sec as (select *, row_number() over (partition by doc_id order by pos) - 1 as p, sum(case when level <= 2 then 1 else 0 end) over (partition by doc_id order by pos)
   - first(case when level <= 2 then 1 else 0 end) over (partition by doc_id order by pos) as sid from lv),
 f as (select doc_id, p as pos, line as s, sid, n as acc, 0 as g from sec where p = 0 union all
  select x.doc_id, x.p, x.line, x.sid, case when f.acc < 32 or (f.acc < 1024 and f.sid = x.sid) then f.acc + x.n else x.n end,
   f.g + case when f.acc < 32 or (f.acc < 1024 and f.sid = x.sid) then 0 else 1 end from f join sec x on x.doc_id = f.doc_id and x.p = f.pos + 1), """
       + out_sql("string_agg(s, chr(10) order by pos) || chr(10)"))
def k22(t):
    lines = L.section_numbers(levelled(t), "doc_id", "pos", "level", 2)
    return hashed(C.section_chunks(lines, "doc_id", "section", "n"))


@query("k23_ancestor_merge")
def k23(t):
    """Checked against a brute-force merge in the tests."""
    rank = F.when(F.col("level") == 1, 3).when(F.col("level") == 2, 2).when(F.col("level") == 3, 1).otherwise(0)
    return hashed(C.ancestor_chunks(levelled(t).withColumn("rank", rank), "doc_id", "rank", 3, 5))


@query("k24_contents_removal", f"""select doc_id, pos - 4 as pos, md5(line) as line from (select doc_id, unnest({LINE_LIST}) as line, generate_subscripts({LINE_LIST}, 1) + 3 as pos from documents)""")
def k24(t):
    """A contents list in front of every document: its title, a first entry, and two more lines."""
    marked = F.concat(F.lit("Table of Contents\n"), F.lit("Chapter 1 "), "lang", F.lit("\nsome entry\nanother\n"), F.lit("Chapter 1 starts "), F.col("text"))
    lines = C.lines_of(t.documents.select("doc_id", marked.alias("text")), "doc_id", "text")
    kept = C.drop_contents_pages(lines, "doc_id")
    clean = F.when(F.col("pos") == 4, F.regexp_replace("line", "^Chapter 1 starts ", "")).otherwise(F.col("line"))
    return kept.select("doc_id", (F.col("pos") - 4).cast("long").alias("pos"), F.md5(clean).alias("line"))


@query("k25_colon_titles", f"""with {LINES_SQL}
select doc_id, pos, 0 as sub, md5('see ' || doc_id || ':') as line, 'title' as layout from li where length(line) >= 60 union all
select doc_id, pos, case when length(line) >= 60 then 1 else 0 end, md5(replace(line, '@', '#') || '. see ' || doc_id || ':'), '' from li""")
def k25(t):
    plain = F.replace(F.col("line"), F.lit("@"), F.lit("#"))
    lines = doc_lines(t).withColumn("line", F.concat(plain, F.lit(". see "), "doc_id", F.lit(":")))
    out = C.promote_colon_titles(lines, "doc_id", 62)
    return out.select("doc_id", "pos", "sub", F.md5("line").alias("line"), "layout")


@query("k26_chunk_batches", f"with recursive {exploded_sql(LINE_LIST)}, {fold_sql('src', 'f.acc + x.n >= 300')}, " + out_sql("string_agg(s, '' order by pos)"))
def k26(t):
    return hashed(C.batch_chunks(t.documents.withColumn("l", F.split("text", "\n")), "doc_id", "l", 300))


@query("k27_json_split", f"""with recursive lf as (select doc_id, ['lang', 'meta.a.b.c.d.n', 'meta.a.b.c.d.source'] || list_transform(range(0, len(ls)), lambda i: 'lines.' || i) as paths,
   [to_json(lang)::varchar, cast(n_chars as varchar), to_json(source)::varchar] || list_transform(ls, lambda l: cast(length(l) as varchar)) as vals
   from (select *, {LINE_LIST} as ls from documents)),
 u as (select doc_id, unnest(paths) as p, unnest(vals) as v, generate_subscripts(paths, 1) - 1 as i from lf),
 src as (select doc_id, row_number() over (partition by doc_id order by split_part(p, '.', 1), case when p like 'lines.%' then cast(split_part(p, '.', 2) as int) end, p) - 1 as pos, '"' || p || '": ' || v as s, length(p) + length(v) + 6 as n from u),
 {fold_sql('src', 'f.acc + x.n >= 120 and f.acc >= 50', opened='x.n + 2')}, {out_sql("'{' || string_agg(s, ', ' order by pos) || '}'")}""")
def k27(t):
    meta = F.struct(F.col("n_chars").alias("n"), F.col("source"))
    for name in "dcba":
        meta = F.struct(meta.alias(name))
    body = F.to_json(F.struct(
        F.col("lang"), F.transform(F.split("text", "\n"), F.length).alias("lines"), meta.alias("meta")))
    leaves = C.json_leaves(t.documents.select("doc_id", F.parse_json(body).alias("v")), "doc_id", "v")
    return hashed(C.split_json(leaves, "doc_id", "leaves", 120, 50))


@query("k28_positions", f"""select doc_id, pos, pos + 1 as page_num, pos as top, pos + 1 as page, pos as bottom from (
 select doc_id, unnest({LINE_LIST}) as line, generate_subscripts({LINE_LIST}, 1) - 1 as pos from documents)""")
def k28(t):
    rows = C.lines_of(t.documents, "doc_id", "text").select("doc_id", F.col("pos").cast("long").alias("pos"), C.positions(F.col("pos").cast("long")).alias("p"))
    return rows.select("doc_id", "pos", F.col("p.page_num")[0].alias("page_num"), F.col("p.top")[0].alias("top"), F.col("p.position")[0]["page"].alias("page"), F.col("p.position")[0]["bottom"].alias("bottom"))


@query("k29_same_mark_merge", rf"""with {LINES_SQL}, mk as (select doc_id, pos, case when kind = 'text' then line else '* ' || line end as line from li),
 m as (select *, substr(trim(line, E' \t\n\r'), 1, 1) as mark from mk),
 j as (select *, sum(case when mark = prev and not regexp_matches(lower(mark), '^[a-z\p{{Han}}]') then 0 else 1 end) over (partition by doc_id order by pos) as run
   from (select *, lag(mark) over (partition by doc_id order by pos) as prev from m))
select doc_id, run::bigint as run, min(pos) as start_line, max(pos) as end_line, md5(string_agg(line, chr(10) order by pos)) as text from j group by doc_id, run""")
def k29(t):
    lines = doc_lines(t).withColumn("line", F.when(F.col("kind") == "text", F.col("line")).otherwise(F.concat(F.lit("* "), "line")))
    return C.merge_same_mark(lines, "doc_id").select("doc_id", "run", "start_line", "end_line", F.md5("text").alias("text"))


@query("k30_reading_order", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() over (partition by l_orderkey order by l_linenumber % 2, l_suppkey % 2, l_quantity, l_extendedprice, l_linenumber, l_partkey, l_suppkey) as place from lineitem""")
def k30(t):
    boxes = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_linenumber") % 2).alias("page"), (F.col("l_suppkey") % 2).alias("col"),
        F.col("l_quantity").alias("top"), F.col("l_extendedprice").alias("x0"))
    placed = row_numbers(boxes, "l_orderkey", ["page", "col", "top", "x0", "l_linenumber", "l_partkey", "l_suppkey"], "place")
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "place")


@query("k31_dotted_pages", f"""with {LINES_SQL}, p as (select doc_id, pos // 10 as page, pos, contains(line, 'the ') as dots from li)
select doc_id, pos, page::bigint as page from p where (doc_id, page) not in (select (doc_id, page) from p where dots group by doc_id, page having count(*) > 3)""")
def k31(t):
    pages = doc_lines(t).select("doc_id", "pos", F.floor(F.col("pos") / 10).alias("page"), F.replace(F.col("line"), F.lit("the "), F.lit("··")).alias("line"))
    return C.drop_dotted_pages(pages, ["doc_id", "page"]).select("doc_id", "pos", "page")


@query("j16_contents_spans", f"""with {LEVEL_SQL}, toc as (select doc_id, pos as entry, coalesce(lead(pos) over (partition by doc_id order by pos), pos) as upto from lv where level = 1)
select toc.doc_id, entry, lv.pos, md5(line) as line from toc join lv on lv.doc_id = toc.doc_id and lv.pos between entry and upto""")
def j16(t):
    lines = levelled(t)
    spans = C.toc_spans(lines.filter(F.col("level") == 1).select("doc_id", "pos"), "doc_id", "pos")
    return spans.join(lines, ["doc_id", "pos"]).select("doc_id", "entry", "pos", F.md5("line").alias("line"))
