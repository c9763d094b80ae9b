"""Text, date and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X, web
from corpusloom.registry import query


def q(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


TOKENS = r"regexp_extract_all(regexp_replace(lower({c}), '(\p{{Han}})', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"
WS = r"E' \t\n\r\x0b\x0c'"


def sql_tokens(column: str) -> str:
    return TOKENS.format(c=column)


@query("x1_redundant_space_removal", r"""
select doc_id, md5(regexp_replace(regexp_replace(text, '([^a-z0-9.,\)>]) +([^ ])', '\1\2', 'gi'),
  '([^ ]) +([^a-z0-9.,\(<])', '\1\2', 'gi')) as cleaned from documents""")
def x1(t):
    return t.documents.select("doc_id", F.md5(X.remove_redundant_spaces(F.col("text"))).alias("cleaned"))


@query("x2_markdown_fence_strip", f"""
select conv_id, turn, trim(text, {WS}) as cleaned from conversations""")
def x2(t):
    fenced = F.concat(F.lit("  ```markdown \n"), F.col("text"), F.lit("\n ``` \n"))
    return t.conversations.select("conv_id", "turn", X.clean_markdown_block(fenced).alias("cleaned"))


@query("x3_blank_test", r"""
select doc_id, pos, trim(line) = '' as blank from (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)""")
def x3(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", F.col("pos").cast("long").alias("pos"), X.is_blank(F.col("line")).alias("blank"))


@query("x4_digit_normalisation", """
select doc_id, cast(n_chars as varchar) || '/' || cast(doc_id as varchar) || md5(text) as normalized from documents""")
def x4(t):
    arabic = F.translate(F.col("n_chars").cast("string"), "0123456789", X.ARABIC_DIGITS)
    persian = F.translate(F.col("doc_id").cast("string"), "0123456789", X.PERSIAN_DIGITS)
    both = X.normalize_arabic_digits(F.concat(arabic, F.lit("/"), persian))
    return t.documents.select("doc_id", F.concat(both, F.md5(X.normalize_arabic_digits(F.col("text")))).alias("normalized"))


@query("x5_presentation_forms", "select doc_id, md5('لا' || text) as normalized from documents where lang = 'es' "
       "union all select doc_id, md5(text) from documents where lang <> 'es'")
def x5(t):
    raw = F.when(F.col("lang") == "es", F.concat(F.lit("ﻻ"), F.col("text"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", F.md5(X.normalize_presentation_forms(raw)).alias("normalized"))


@query("x6_string_clean", r"""
select page_id, md5(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
  trim(html), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', chr(169)),
  '&middot;', chr(183)), '&amp;', '&'), '["\x00-\x1f\x7f-\x9f]', '', 'g')) as cleaned from pages""")
def x6(t):
    return t.pages.select("page_id", F.md5(X.clean_string(F.col("html"))).alias("cleaned"))


@query("x7_english_test", r"""
select doc_id, length(regexp_replace(text, '[^`a-zA-Z0-9.,'':;/"?<>!()\-]', '', 'g')) / length(text) > 0.8 as text_english,
  len(list_filter(lines, lambda l: regexp_matches(trim(l), '^[`a-zA-Z0-9\s.,'':;/"?<>!()\-]$')))
    / greatest(len(lines), 1) > 0.8 as lines_english
from (select doc_id, text, list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '') as lines from documents)""")
def x7(t):
    lines = F.split("text", "\n")
    return t.documents.select(
        "doc_id", X.is_english(F.col("text")).alias("text_english"), X.is_english_list(lines).alias("lines_english"))


@query("x8_cjk_test", r"""
with src as (select doc_id, lang, case when lang = 'es' then '第章节' || regexp_replace(text, '[a-z]', '字', 'g') else text end as text from documents)
select doc_id, length(regexp_replace(text, '[^一-鿿]', '', 'g')) / length(text) > 0.2 as han_share,
  len(words) <= 3 or len(list_filter(words, lambda w: not regexp_matches(w, '^[a-zA-Z]+$'))) / len(words) >= 0.7 as han_query
from (select *, regexp_split_to_array(text, '[ \t]+') as words from src)""")
def x8(t):
    text = F.when(F.col("lang") == "es", F.concat(F.lit("第章节"), F.regexp_replace("text", "[a-z]", "字"))).otherwise(F.col("text"))
    docs = t.documents.select("doc_id", text.alias("text"))
    return docs.select(
        "doc_id", X.is_chinese(F.col("text")).alias("han_share"), X.is_chinese_query(F.col("text")).alias("han_query"))


@query("x9_garbled_test", r"""
with src as (select doc_id, case when source = 'src3' then text || ' (cid : 12)'
    when source = 'src4' then repeat(chr(57344), length(text)) || text else text end as text from documents),
 v as (select doc_id, text, regexp_replace(text, '[\s\x0b]', '', 'g') as visible from src)
select doc_id, regexp_matches(text, '\(cid\s*:\s*[0-9]+\s*\)')
  or coalesce(length(regexp_replace(visible, '[^\x{E000}-\x{F8FF}\x{FFFD}\x00-\x1f\x80-\x9f]', '', 'g'))
     / nullif(length(visible), 0) >= 0.5, false) as garbled from v""")
def x9(t):
    text = (
        F.when(F.col("source") == "src3", F.concat("text", F.lit(" (cid : 12)")))
        .when(F.col("source") == "src4", F.concat(F.repeat(F.lit(""), F.length("text")), F.col("text")))
        .otherwise(F.col("text"))
    )
    return t.documents.select("doc_id", X.is_garbled(text).alias("garbled"))


def _sql_normalized(column: str) -> str:
    spaced = column
    han = "一-龥"
    for pattern in (f"([A-Za-z]+[0-9]+)([{han}]+)", f"([A-Za-z])([{han}]+)", f"([{han}]+)([A-Za-z]+[0-9]+)", f"([{han}]+)([A-Za-z])"):
        spaced = f"regexp_replace({spaced}, '{pattern}', '\\1 \\2', 'g')"
    wide = f"translate(lower({spaced}), {q(X.FULL_WIDTH)}, {q(X.HALF_WIDTH)})"
    flat = f"trim(regexp_replace({wide}, {q(X.QUERY_PUNCTUATION)}, ' ', 'g'))"
    out = f"regexp_replace({flat}, {q(X.QUESTION_WORDS_ZH)}, '', 'g')"
    out = f"regexp_replace({out}, {q(X.QUESTION_WORDS_EN)}, ' ', 'gi')"
    return f"regexp_replace({out}, {q(X.FUNCTION_WORDS_EN)}, ' ', 'gi')"


X10_INPUT = "'What is the ＡＢＣ' || '第12章 how? ' || text"


@query("x10_query_normalisation", f"select item_id, {_sql_normalized(X10_INPUT)} as normalized from benchmark")
def x10(t):
    raw = F.concat(F.lit("What is the ＡＢＣ第12章 how? "), F.col("text"))
    return t.benchmark.select("item_id", X.normalize_query(raw).alias("normalized"))


@query("x11_tokenise", rf"""
select doc_id, md5(array_to_string({sql_tokens("text || ' 第12章abc'")}, ' ')) as tokens,
  md5(array_to_string(regexp_extract_all(regexp_replace(lower(text || ' 第12章abc'), '(\p{{Han}})', ' \1 ', 'g'), '\p{{L}}+|\p{{N}}+'), ' ')) as fine
from documents""")
def x11(t):
    text = F.concat("text", F.lit(" 第12章abc"))
    return t.documents.select(
        "doc_id", F.md5(F.array_join(X.tokens(text), " ")).alias("tokens"), F.md5(F.array_join(X.fine_tokens(text), " ")).alias("fine"))


@query("x12_stop_tokens", rf"""
select doc_id, md5(array_to_string(list_filter({sql_tokens("text || ' 7 我 在 88'")},
  lambda w: not list_contains([{', '.join(q(w) for w in X.STOP_WORDS)}], w) and not regexp_matches(w, '^[0-9]$')), ' ')) as kept
from documents""")
def x12(t):
    return t.documents.select(
        "doc_id", F.md5(F.array_join(X.filter_tokens(X.tokens(F.concat("text", F.lit(" 7 我 在 88")))), " ")).alias("kept"))


@query("x13_short_token_merge", rf"""
with tk as (select item_id, {sql_tokens("text || ' a b cd e f g 12 x yy'")} as tks from benchmark),
 g as (select item_id, tks, coalesce((length(tks[1]) = 1 or regexp_matches(tks[1], '^[0-9a-z]{{1,2}}$'))
   and length(tks[2]) > 1 and not regexp_matches(tks[2], '^[0-9a-zA-Z]'), false) as glue from tk),
 e as (select item_id, glue, unnest(tks) as tk, generate_subscripts(tks, 1) as pos from g),
 s as (select *, not (glue and pos <= 2) and (length(tk) = 1 or regexp_matches(tk, '^[0-9a-z]{{1,2}}$')) as short from e),
 r as (select *, sum(case when short then 0 else 1 end) over (partition by item_id order by pos) as island from s),
 n as (select *, row_number() over (partition by item_id, island, short order by pos) - 1 as i,
        count(*) over (partition by item_id, island, short) as n from r),
 grp as (select *, case when short then case when n >= 5 and i < 2 * ((n - 3) // 2) then i // 2
        when n >= 5 then (n - 3) // 2 else 0 end else case when glue and pos <= 2 then -2 else -1 end end as k,
        case when glue and pos <= 2 then 0 else island end as isl from n),
 j as (select item_id, min(pos) as p, string_agg(tk, ' ' order by pos) as phrase from grp group by item_id, isl, short, k)
select item_id, string_agg(phrase, '|' order by p) as merged from j group by item_id""")
def x13(t):
    tks = X.tokens(F.concat("text", F.lit(" a b cd e f g 12 x yy")))
    return t.benchmark.select("item_id", F.array_join(X.merge_short_tokens(tks), "|").alias("merged"))


@query("x14_adjacent_word_merge", r"""
with w as (select doc_id, list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda x: x <> '') as ws from documents),
 e as (select doc_id, unnest(ws) as w, generate_subscripts(ws, 1) as pos from w),
 f as (select *, coalesce(regexp_matches(w, '[a-zA-Z]$') and
    regexp_matches(lag(w) over (partition by doc_id order by pos), '[a-zA-Z]$'), false) as joins from e),
 g as (select *, sum(case when joins then 0 else 1 end) over (partition by doc_id order by pos) as grp from f),
 p as (select doc_id, grp, string_agg(w, ' ' order by pos) as phrase from g group by doc_id, grp)
select doc_id, md5(string_agg(phrase, '|' order by grp)) as phrases, count(*) as n from p group by doc_id""")
def x14(t):
    phrases = X.merge_adjacent_words(F.col("text"))
    return t.documents.select(
        "doc_id", F.md5(F.array_join(phrases, "|")).alias("phrases"), F.size(phrases).cast("long").alias("n"))


@query("x15_token_count", f"select doc_id, len({sql_tokens('text')}) as n from documents")
def x15(t):
    return t.documents.select("doc_id", X.token_count(F.col("text")).cast("long").alias("n"))


@query("x16_truncate_tokens", f"select doc_id, array_to_string({sql_tokens('text')}[1:12], ' ') as head from documents")
def x16(t):
    return t.documents.select("doc_id", X.truncate_tokens(F.col("text"), 12).alias("head"))


@query("x17_split_merge_transform", r"""
select doc_id, len(regexp_split_to_array(text, '!!| \| |, ')) as pieces,
  md5(array_to_string(regexp_split_to_array(text, '!!| \| |, '), '~')) as joined,
  'Source ' || source || ' in ' || lang || ' (' || source || ')' as merged from documents""")
def x17(t):
    pieces = X.split_any(F.col("text"), [", ", " | ", "!!"])
    merged = X.merge_template("Source {source} in {lang} ({source})", source=F.col("source"), lang=F.col("lang"))
    return t.documents.select(
        "doc_id", F.size(pieces).cast("long").alias("pieces"), F.md5(F.array_join(pieces, "~")).alias("joined"), merged.alias("merged"))


@query("x18_split_by_markers", rf"""
select doc_id, md5(array_to_string(list_filter(list_transform(regexp_split_to_array(text, '!!|\|'),
  lambda s: trim(s, {WS})), lambda s: s <> ''), '~')) as pieces from documents""")
def x18(t):
    return t.documents.select("doc_id", F.md5(F.array_join(X.split_by_markers(F.col("text"), ["|", "!!"]), "~")).alias("pieces"))


@query("x19_combined_value_split", r"""
select p_partkey, array_to_string(case when p_brand = replace(p_name, ' ', '') then [p_brand]
  else list_distinct_ordered end, '|') as parts from (
  select p_partkey, p_name, p_brand, [string_split(p_name, ' ')[1]] ||
    case when string_split(p_name, ' ')[2] = string_split(p_name, ' ')[1] then [] else [string_split(p_name, ' ')[2]] end
    || [p_brand] as list_distinct_ordered from part)""")
def x19(t):
    values = F.array(F.replace(F.col("p_name"), F.lit(" "), F.lit(" 、 ")), F.concat("p_brand", F.lit("; ,"), F.col("p_brand")))
    return t.part.select("p_partkey", F.array_join(X.split_combined_values(values), "|").alias("parts"))


@query("x20_safe_float", """
select event_id, coalesce(try_cast(case when event_type = 'error' then event_type else cast(value as varchar) end as double),
  cast('-infinity' as double)) as value from events""")
def x20(t):
    raw = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", X.safe_float(raw).alias("value"))


@query("x21_overlap_percent", """
with v as (select l_orderkey, l_linenumber, l_partkey, l_discount, l_quantity * 10 - 100 as q from lineitem)
select l_orderkey, l_linenumber, l_partkey, least(90, greatest(0, cast(floor(case when l_discount > 0 and l_discount < 1 then l_discount * 100
  else l_discount end) as int))) as share, least(90, greatest(0, cast(trunc(q) as int))) as percent, 0 as invalid from v""")
def x21(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", X.normalize_overlap_percent(F.col("l_discount").cast("string")).alias("share"),
        X.normalize_overlap_percent((F.col("l_quantity") * 10 - 100).cast("string")).alias("percent"),
        X.normalize_overlap_percent(F.col("l_returnflag")).alias("invalid"))


@query("x22_tag_feature_parse", """
select event_id, cast(json_extract(props, '$.k') as double) as k, value as v, 2 as n from events where event_type <> 'error'
union all select event_id, null, null, 0 from events where event_type = 'error'""")
def x22(t):
    body = F.concat(
        F.lit('{"a": '), F.get_json_object("props", "$.k"), F.lit(', "b": "7", " ": 1, "c": true, " v ": '), F.col("value"), F.lit("}"))
    literal = F.concat(F.lit("{'a': "), F.get_json_object("props", "$.k"), F.lit(", 'v': "), F.col("value"), F.lit("}"))
    raw = F.when(F.col("event_type") == "error", F.lit("not a map")).when(F.col("event_type") == "click", literal).otherwise(body)
    parsed = t.events.select("event_id", X.parse_tag_features(raw).alias("m"))
    return parsed.select("event_id", F.col("m")["a"].alias("k"), F.col("m")["v"].alias("v"), F.size("m").alias("n"))


@query("x23_epoch_text_dates", """
select event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as shown, epoch_ms(date_trunc('second', ts)) as back from events""")
def x23(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    shown = X.epoch_ms_to_text(ms)
    return t.events.select("event_id", shown.alias("shown"), X.text_to_epoch_ms(shown).alias("back"))


@query("x24_iso_dates", """
select event_id, case when event_type = 'error' then 'bad' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as shown,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as whole,
  (epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(ts)) / 1000000 as seconds from events""")
def x24(t):
    iso = F.when(F.col("event_type") == "error", F.lit("bad")).when(
        F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
    return t.events.select(
        "event_id", X.iso_to_text(iso).alias("shown"), F.date_format(X.truncate_micros(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("whole"),
        X.seconds_since(F.col("ts"), F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("seconds"))


@query("x25_cell_casts", """
select o_orderkey, case o_orderstatus when 'O' then 'yes' when 'F' then 'no' end as flag,
  strftime(o_orderdate, '%Y-%m-%d 00:00:00') as day from orders""")
def x25(t):
    flag = F.when(F.col("o_orderstatus") == "O", " Yes ").when(F.col("o_orderstatus") == "F", "×").otherwise("maybe")
    day = F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy/MM/dd")).when(
        F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "dd MMM yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", X.cell_to_bool(flag).alias("flag"), X.cell_to_date_text(day).alias("day"))


@query("x26_content_id", """
select doc_id, md5(text || cast(doc_id as varchar)) as chunk_id, sha256(text) as fingerprint from documents""")
def x26(t):
    return t.documents.select(
        "doc_id", X.content_id(F.col("text"), F.col("doc_id")).alias("chunk_id"), F.sha2("text", 256).alias("fingerprint"))


@query("x27_modulo_hash", """
select doc_id, cast(list_reduce(list_prepend(0::hugeint, list_transform(range(0, 5), lambda i:
   cast('0x' || substr(sha1(text), cast(i * 8 + 1 as int), 8) as hugeint))),
   lambda a, w: (a * 4294967296 + w) % 1000) as bigint) as bucket from documents""")
def x27(t):
    return t.documents.select("doc_id", X.modulo_hash(F.col("text"), 1000).alias("bucket"))


@query("x28_variable_substitution", """
select conv_id, turn, role || ' said: ' || text || ' {other} (' || role || ')' as filled from conversations""")
def x28(t):
    values = F.create_map(F.lit("role"), F.col("role"), F.lit("text"), F.col("text"))
    return t.conversations.select(
        "conv_id", "turn", X.replace_variables(F.lit("{role} said: {text} {other} ({role})"), values).alias("filled"))


@query("x29_bigram_similarity", """
with p as (select p_partkey, p_name as l, p_brand || p_name as r from part),
 b as (select p_partkey, list_distinct(list_transform(range(1, length(l)), lambda i: substr(l, cast(i as int), 2))) as a,
   list_distinct(list_transform(range(1, least(length(r), length(l) + 1)), lambda i: substr(r, cast(i as int), 2))) as c from p)
select p_partkey, round(len(list_intersect(a, c)) / greatest(len(a), len(c), 1), 6) as similarity from b""")
def x29(t):
    return t.part.select(
        "p_partkey", F.round(X.bigram_similarity(F.col("p_name"), F.concat("p_brand", F.col("p_name"))), 6).alias("similarity"))


_EDGE = r"""[ .?/''"()!,:;-]"""


@query("x30_keyword_highlight", rf"""
with s as (select doc_id, regexp_replace(text, '[\r\n]', ' ', 'g') as flat from documents),
 l as (select doc_id, flat, list_filter(list_transform(regexp_split_to_array(flat, '[.?!;]'), lambda x: trim(x)), lambda x: x <> '') as ss from s),
 m as (select doc_id, flat,
   list_filter(list_transform(ss, lambda x: regexp_replace(regexp_replace(x, '(^|{_EDGE})(the)({_EDGE}|$)', '\1<em>\2</em>\3', 'gi'),
      '(^|{_EDGE})(of)({_EDGE}|$)', '\1<em>\2</em>\3', 'gi')), lambda x: regexp_matches(x, '<em>[^<>]+</em>', 'i')) as words,
   list_filter(list_transform(ss, lambda x: regexp_replace(regexp_replace(x, 'the', '<em>the</em>', 'gi'), 'of', '<em>of</em>', 'gi')),
      lambda x: regexp_matches(x, '<em>[^<>]+</em>', 'i')) as lits from l)
select doc_id, md5(case when len(words) > 0 then array_to_string(words, '...') else flat end) as by_words,
  md5(case when len(lits) > 0 then array_to_string(lits, '...') else flat end) as literal from m""")
def x30(t):
    return t.documents.select(
        "doc_id", F.md5(X.highlight(F.col("text"), ["the", "of"])).alias("by_words"),
        F.md5(X.highlight(F.col("text"), ["the", "of"], mode="literal")).alias("literal"))


def _sql_drop(column: str, names) -> str:
    for name in names:
        column = f"regexp_replace({column}, '<{name}(?:\\s[^>]*)?>.*?</{name}\\s*>', ' ', 'gis')"
    return column


_SQL_COMMENTS = r"regexp_replace(html, '<!--.*?-->', ' ', 'gs')"
_SQL_CLEAN = _sql_drop(_SQL_COMMENTS, ("title", "header", "nav", "footer", "script", "style", "symbol", "aside"))


@query("x31_web_page_clean_up", rf"""
select page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') as title,
  md5(trim(regexp_replace(replace(replace(replace(replace(regexp_replace({_SQL_CLEAN}, '<[^>]*>', ' ', 'gs'),
   '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) as body from pages""")
def x31(t):
    return t.pages.select(
        "page_id", web.page_title(F.col("html")).alias("title"), F.md5(web.clean_text(F.col("html"))).alias("body"))


@query("x32_links_and_images", r"""
select distinct page_id, 'link' as kind, 0 as line, u as url, regexp_extract(u, '^[a-z]+://([^/:?#]+)', 1) as host from (
  select page_id, unnest(regexp_extract_all(html, '<a\s[^>]*?href=["'']([^"'']+)["'']', 1, 'i')) as u from pages)
union all
select distinct page_id, 'image', pos, u, regexp_extract(u, '^[a-z]+://([^/:?#]+)', 1) from (
  select page_id, cast(p - 1 as int) as pos, unnest(regexp_extract_all(line, '!\[[^\]]*\]\(([^)\s]+)', 1)) as u from (
   select page_id, unnest([html, '![x](' || url || ')']) as line, unnest([1, 2]) as p from pages))""")
def x32(t):
    links = t.pages.select("page_id", F.lit("link").alias("kind"), F.lit(0).alias("line"), F.explode(web.hyperlinks(F.col("html"))).alias("url"))
    marked = F.concat(F.regexp_replace("html", "\n", " "), F.lit("\n![x]("), F.col("url"), F.lit(")"))
    lines = t.pages.select("page_id", F.posexplode(F.split(marked, "\n")).alias("line", "content"))
    images = lines.select("page_id", F.lit("image").alias("kind"), "line", F.explode(web.image_urls(F.col("content"))).alias("url"))
    both = links.unionByName(images)
    return both.withColumn("host", F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1))


_MARKED = "text || ' (ID: ' || turn || ') [ID ' || conv_id || '] 【ID:' || (turn + 1) || '】 ref ' || conv_id || ' [3]'"


@query("x33_citation_repair", rf"""
with m as (select conv_id, turn, {_MARKED} as t from conversations),
 a as (select conv_id, turn, regexp_replace(regexp_replace(regexp_replace(t, '\(\s*ID\s*[: ]*\s*0*([0-4])\s*\)', '[ID:\1]', 'g'), '\[\s*ID\s*[: ]*\s*0*([0-4])\s*\]', '[ID:\1]', 'g'), '【\s*ID\s*[: ]*\s*0*([0-4])\s*】', '[ID:\1]', 'g') as t from m),
 r as (select conv_id, turn, regexp_replace(t, '(?i)ref\s*0*([0-4])([^0-9]|$)', '[ID:\1]\2', 'g') as repaired from a)
select *, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(repaired, '\[(?:ID:)?([0-9]+)\]', 1), lambda x: x::bigint), lambda x: x < 5))), ',') as cited from r""")
def x33(t):
    marked = F.concat(
        "text", F.lit(" (ID: "), "turn", F.lit(") [ID "), "conv_id", F.lit("] 【ID:"), F.col("turn") + 1, F.lit("】 ref "), "conv_id", F.lit(" [3]"))
    repaired = t.conversations.select("conv_id", "turn", X.repair_citations(marked, 5).alias("repaired"))
    return repaired.withColumn("cited", F.array_join(X.cited_ids(F.col("repaired"), 5), ","))


@query("x34_reasoning_strip", """
select conv_id, turn, case when role = 'user' then '</think>' || text || '<think>' else text end as answer from conversations""")
def x34(t):
    raw = F.when(F.col("role") == "user", F.concat(F.lit("</think>"), "text", F.lit("<think>"))).when(
        F.col("role") == "system", F.col("text")
    ).otherwise(F.concat(F.lit("<think>a</think>b</think>"), "text"))
    return t.conversations.select("conv_id", "turn", X.strip_reasoning(raw).alias("answer"))


@query("x35_fenced_json_parse", """
select event_id, case when event_type <> 'error' then cast(json_extract(props, '$.k') as int) end as k from events""")
def x35(t):
    raw = F.when(F.col("event_type") == "error", F.concat(F.lit("oops "), "props")).otherwise(
        F.concat(F.lit(" ```json\n"), "props", F.lit("\n``` ")))
    return t.events.select("event_id", F.try_variant_get(X.parse_fenced_json(raw), "$.k", "int").alias("k"))


@query("x36_front_matter", """
select doc_id, case when lang = 'de' then 'untitled' else source end as name,
  case when lang = 'de' then '' else 'text in ' || lang end as description,
  case when lang = 'de' then '' else lang || '|' || source end as tags from documents""")
def x36(t):
    header = F.concat(F.lit("---\nname: x\ndescription: text in "), "lang", F.lit("\ntags: ["), "lang", F.lit(", "), "source",
                      F.lit("]\nname: "), "source", F.lit("\n---\n"), "text")
    raw = F.when(F.col("lang") == "de", F.regexp_replace(F.col("text"), "^---", "")).otherwise(header)
    meta = t.documents.select("doc_id", X.front_matter(raw, F.lit("untitled")).alias("m"))
    return meta.select("doc_id", "m.name", "m.description", F.array_join("m.tags", "|").alias("tags"))


@query("x37_whitespace_collapse", rf"""
select doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(text || '  ' || chr(10) || chr(10) || ' x', ' +', ' ', 'g'),
  ' +[\n\r]', chr(10), 'g'), '[\n\r]+', chr(10), 'g'), {WS})) as collapsed, md5(regexp_replace(text, '[\n\r]+', ' ', 'g')) as flat from documents""")
def x37(t):
    return t.documents.select(
        "doc_id", F.md5(X.collapse_whitespace(F.concat("text", F.lit("  \n\n x")))).alias("collapsed"),
        F.md5(X.newlines_to_space(F.col("text"))).alias("flat"))


@query("x38_version_increment", """
select p_partkey, case when p_brand = 'Brand#2' then '1.0.0'
  when p_size >= 40 then (p_size + 1) || '.0.0' else p_size || '.999.' || (p_partkey % 999 + 1) end as version from part""")
def x38(t):
    raw = F.when(F.col("p_brand") == "Brand#2", F.lit("7.1")).when(
        F.col("p_size") >= 40, F.concat("p_size", F.lit(".999.999"))
    ).otherwise(F.concat("p_size", F.lit(".999."), F.col("p_partkey") % 999))
    return t.part.select("p_partkey", X.increment_version(raw).alias("version"))
