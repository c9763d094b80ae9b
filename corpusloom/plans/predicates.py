"""Projections, filters and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from corpusloom.functions import predicates as P, records as R
from corpusloom.operators.running import row_numbers
from corpusloom.registry import query

META_SQL = """meta as (
  select doc_id, 'lang' as key, lang as value from documents union all
  select doc_id, 'source', source from documents union all
  select doc_id, 'n_chars', cast(n_chars as varchar) from documents union all
  select doc_id, 'quality', cast(quality as varchar) from labels union all
  select doc_id, 'toxic', cast(toxic as varchar) from labels)"""


def doc_meta(t):
    """Long metadata table of the documents."""
    docs = t.documents.select("doc_id", "lang", "source", F.col("n_chars").cast("string").alias("n_chars"))
    wide = docs.unpivot("doc_id", ["lang", "source", "n_chars"], "key", "value")
    labels = t.labels.select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"))
    return wide.unionByName(labels.unpivot("doc_id", ["quality", "toxic"], "key", "value"))


ORDER_META_SQL = """ometa as (
  select o_orderkey as doc_id, 'status' as key, o_orderstatus as value from orders union all
  select o_orderkey, 'priority', o_orderpriority from orders union all
  select o_orderkey, 'price', cast(o_totalprice as varchar) from orders union all
  select o_orderkey, 'day', strftime(o_orderdate, '%Y-%m-%d') from orders union all
  select o_orderkey, 'note', case when o_orderstatus = 'P' then '' else 'n' || o_orderpriority end from orders where o_orderstatus <> 'F')"""


def order_meta(t):
    base = t.orders.select(
        F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("string").alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    note = t.orders.filter(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("doc_id"), F.lit("note").alias("key"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("n"), "o_orderpriority")).alias("value"))
    return base.unpivot("doc_id", ["status", "priority", "price", "day"], "key", "value").unionByName(note)


@query("p1_equality_filter", """
select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '5-LOW')""")
def p1(t):
    rows = t.orders.withColumn("tags", F.array("o_orderstatus", "o_orderpriority"))
    condition = {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "5-LOW"], "o_custkey": None, "tags": ["F", "zzz"]}
    return P.equality_filter(rows, condition).select("o_orderkey")


@query("p2_availability_filter", """
select d.doc_id, not coalesce(quality < 1, false) as listed, coalesce(quality < 1, false) as hidden
from documents d left join labels using (doc_id)""")
def p2(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.select("doc_id", P.available(F.col("quality"), 1).alias("listed"), P.available(F.col("quality"), 0).alias("hidden"))


@query("p3_exists_filter", """
select doc_id, 'exists' as kind from documents semi join labels using (doc_id)
union all select doc_id, 'missing' from documents anti join labels using (doc_id)""")
def p3(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    have = P.equality_filter(rows, {"exists": "quality"}).select("doc_id", F.lit("exists").alias("kind"))
    lack = P.equality_filter(rows, {"must_not": {"exists": "quality"}}).select("doc_id", F.lit("missing").alias("kind"))
    return have.unionByName(lack)


@query("p4_substring_filter", "select p_partkey, p_name from part where contains(lower(p_name), 'bolt')")
def p4(t):
    return t.part.filter(P.contains_ignore_case(F.col("p_name"), "BoLT")).select("p_partkey", "p_name")


_META_CASES = [
    ("contains", "priority", "LOW"), ("not contains", "priority", "low"), ("in", "status", "f, o"), ("not in", "status", ["F"]),
    ("start with", "priority", "4-N"), ("end with", "priority", "gent"), ("empty", "note", None), ("not empty", "note", None),
    ("=", "status", "p"), ("≠", "status", "P"), (">", "price", "250000"), ("<", "price", 1000.5), ("≥", "day", "1998-01-01"),
    ("≤", "day", "1993-06-30"), ("=", "price", "abc"), (">", "status", "5"),
]


@query("p5_metadata_filter", f"""with {ORDER_META_SQL}
select 0 as clause, doc_id from ometa where key = 'priority' and contains(lower(value), 'low') union all
select 1, doc_id from ometa where key = 'priority' and not contains(lower(value), 'low') union all
select 2, doc_id from ometa where key = 'status' and lower(value) in ('f', 'o') union all
select 3, doc_id from ometa where key = 'status' and lower(value) not in ('f') union all
select 4, doc_id from ometa where key = 'priority' and starts_with(lower(value), '4-n') union all
select 5, doc_id from ometa where key = 'priority' and ends_with(lower(value), 'gent') union all
select 6, o_orderkey from orders where o_orderkey not in (select doc_id from ometa where key = 'note' and value <> '') union all
select 7, doc_id from ometa where key = 'note' and value <> '' union all
select 8, doc_id from ometa where key = 'status' and lower(value) = 'p' union all
select 9, doc_id from ometa where key = 'status' and lower(value) <> 'p' union all
select 10, doc_id from ometa where key = 'price' and cast(value as double) > 250000 union all
select 11, doc_id from ometa where key = 'price' and cast(value as double) < 1000.5 union all
select 12, doc_id from ometa where key = 'day' and value >= '1998-01-01' union all
select 13, doc_id from ometa where key = 'day' and value <= '1993-06-30' union all
select 15, doc_id from ometa where key = 'status' and lower(value) > '5'""")
def p5(t):
    meta, ids = order_meta(t), t.orders.select(F.col("o_orderkey").alias("doc_id"))
    flags = P.metadata_flags(meta, [{"op": op, "key": key, "value": value} for op, key, value in _META_CASES], ids)
    held = F.array(*[F.when(F.col(f"__c{i}"), F.lit(i)) for i in range(len(_META_CASES))])
    return flags.select(F.explode(F.array_compact(held)).alias("clause"), "doc_id")


@query("p6_clause_combination", f"""with {META_SQL}
select doc_id, 'and' as logic from (select doc_id from meta where key = 'lang' and value in ('en', 'de') intersect
  select doc_id from meta where key = 'n_chars' and try_cast(value as double) > 1000 intersect
  select doc_id from meta where key = 'quality' and value = '1') union all
select doc_id, 'or' from (select doc_id from meta where key = 'lang' and value = 'fr' union
  select doc_id from meta where key = 'toxic' and value = '1') union all
select doc_id, 'none' from meta where false""")
def p6(t):
    meta = doc_meta(t)
    both = P.metadata_filter(
        meta,
        [{"key": "lang", "op": "in", "value": "en,de"}, {"key": "n_chars", "op": ">", "value": "1000"}, {"key": "quality", "op": "=", "value": "1"}],
    ).select("doc_id", F.lit("and").alias("logic"))
    either = P.metadata_filter(
        meta, [{"key": "lang", "op": "=", "value": "fr"}, {"key": "toxic", "op": "=", "value": "1"}], "or"
    ).select("doc_id", F.lit("or").alias("logic"))
    empty = P.metadata_filter(
        meta, [{"key": "lang", "op": "=", "value": "xx"}, {"key": "toxic", "op": "=", "value": "1"}]
    ).select("doc_id", F.lit("none").alias("logic"))
    return both.unionByName(either).unionByName(empty)


@query("p7_native_predicate", """
select o_orderkey from orders where o_totalprice >= 100000 and o_custkey in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144)
  and lower(o_orderstatus) <> 'p' union all
select o_orderkey from orders where o_totalprice < 5000 or lower(o_orderpriority) like '%urgent%'""")
def p7(t):
    every = P.native_filter(t.orders, [
        {"key": "o_totalprice", "op": ">=", "value": "100000"}, {"key": "o_custkey", "op": "in", "value": "1,2,3,5,8,13,21,34,55,89,144"},
        {"key": "o_orderstatus", "op": "not is", "value": "P"}])
    some = P.native_filter(
        t.orders, [{"key": "o_totalprice", "op": "<", "value": 5000}, {"key": "o_orderpriority", "op": "contains", "value": "URGENT"}], "or")
    return every.select("o_orderkey").unionByName(some.select("o_orderkey"))


@query("p8_json_path_predicate", """
with e as (select event_id, event_type, ts, cast(json_extract(props, '$.k') as int) as k from events)
select event_id, 'num' as kind from e where k > 50 and k <> 60 union all
select event_id, 'is' from e where event_type = 'click' union all
select event_id, 'member' from e where event_type = 'error' union all
select event_id, 'time' from e where ts < timestamp '2024-01-10 00:00:00' or ts > timestamp '2024-01-20 00:00:00'""")
def p8(t):
    body = F.to_json(F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_type").alias("type"),
        F.array("event_type", F.lit("any")).alias("tags"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")))
    rows = t.events.select("event_id", body.alias("metadata"))
    parts = [
        ("num", [{"name": "k", "op": ">", "value": 50}, {"name": "k", "op": "≠", "value": 60}], "and"),
        ("is", [{"name": "type", "op": "is", "value": "click"}], "and"),
        ("member", [{"name": "tags", "op": "contains", "value": "error"}], "and"),
        ("time", [{"name": "at", "op": "before", "value": "2024-01-10 00:00:00"}, {"name": "at", "op": "after", "value": "2024-01-20 00:00:00"}], "or"),
    ]
    out = None
    for kind, conditions, logic in parts:
        hit = P.json_filter(rows, "metadata", conditions, logic).select("event_id", F.lit(kind).alias("kind"))
        out = hit if out is None else out.unionByName(hit)
    return out


@query("p9_operator_names", f"""with {META_SQL}
select doc_id, 'is' as name from meta where key = 'lang' and value = 'en' union all
select doc_id, 'not is' from meta where key = 'lang' and value <> 'en' union all
select doc_id, '>=' from meta where key = 'n_chars' and try_cast(value as int) >= 2000 union all
select doc_id, '<=' from meta where key = 'n_chars' and try_cast(value as int) <= 2000""")
def p9(t):
    out = None
    for name, key, value in (("is", "lang", "EN"), ("not is", "lang", "en"), (">=", "n_chars", "2000"), ("<=", "n_chars", 2000)):
        hit = P.metadata_filter(doc_meta(t), [{"key": key, "op": name, "value": value}]).select("doc_id", F.lit(name).alias("name"))
        out = hit if out is None else out.unionByName(hit)
    return out


@query("p10_filter_mode", """
select doc_id, 'manual' as mode from (select doc_id from labels where toxic = 1 union select doc_id from documents where lang = 'es')
union all select doc_id, 'base' from labels where toxic = 1""")
def p10(t):
    base = t.labels.filter(F.col("toxic") == 1)
    hit = P.metadata_filter(doc_meta(t), [{"key": "lang", "op": "=", "value": "es"}])
    none = P.metadata_filter(doc_meta(t), [{"key": "lang", "op": "=", "value": "xx"}])
    docs = t.documents.select("doc_id")
    manual = docs.join(P.resolve_ids(base, hit), "doc_id", "left_semi").select("doc_id", F.lit("manual").alias("mode"))
    only = docs.join(P.resolve_ids(base, none), "doc_id", "left_semi").select("doc_id", F.lit("base").alias("mode"))
    empty = docs.join(P.resolve_ids(none), "doc_id", "left_semi").select("doc_id", F.lit("empty").alias("mode"))
    return manual.unionByName(only).unionByName(empty)


def event_records(t):
    record = F.create_map(
        F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return t.events.select("event_id", record.alias("r"))


_K = "cast(json_extract(props, '$.k') as varchar)"


@query("p11_select_keys", f"select event_id, {_K} as k, event_type as type, 2 as n from events")
def p11(t):
    rows = event_records(t).select("event_id", R.select_keys(F.col("r"), ["k", "type", "nope"]).alias("r"))
    return rows.select("event_id", F.col("r")["k"].alias("k"), F.col("r")["type"].alias("type"), F.size("r").alias("n"))


@query("p12_remove_keys", f"select event_id, cast(user_id as varchar) as user_id, 1 as n from events")
def p12(t):
    rows = event_records(t).select("event_id", R.remove_keys(F.col("r"), ["k", "type"]).alias("r"))
    return rows.select("event_id", F.col("r")["user"].alias("user_id"), F.size("r").alias("n"))


@query("p13_rename_keys", f"select event_id, {_K} as score, cast(user_id as varchar) as type, 2 as n from events")
def p13(t):
    rows = event_records(t).select("event_id", R.rename_keys(F.col("r"), [("k", "score"), ("user", "type"), ("nope", "x"), ("k", " ")]).alias("r"))
    return rows.select("event_id", F.col("r")["score"].alias("score"), F.col("r")["type"].alias("type"), F.size("r").alias("n"))


@query("p14_put_keys", "select event_id, 'fixed' as type, event_type || '!' as copy, 4 as n from events")
def p14(t):
    rows = event_records(t).select(
        "event_id", R.put_keys(F.col("r"), {"type": "fixed", "copy": F.concat(F.col("r")["type"], F.lit("!"))}).alias("r"))
    return rows.select("event_id", F.col("r")["type"].alias("type"), F.col("r")["copy"].alias("copy"), F.size("r").alias("n"))


@query("p15_record_rules", f"""
select event_id from events where starts_with(event_type, 'c') and {_K} <> '7' and contains(cast(user_id as varchar), '1')""")
def p15(t):
    rules = [{"key": "type", "op": "start with", "value": "c"}, {"key": "k", "op": "≠", "value": 7}, {"key": "user", "op": "contains", "value": 1}]
    rows = event_records(t)
    for rule in rules:
        rows = rows.filter(P.rule_matches(F.col("r"), rule))
    return rows.select("event_id")


@query("p16_literal_evaluation", f"""
select event_id, {_K} as k, 'BIGINT' as kind_k, event_type as text, 'STRING' as kind_text,
  case when cast(user_id as int) > 75 then 'BOOLEAN' else 'STRING' end as kind_flag from events""")
def p16(t):
    rows = t.events.select(
        "event_id", R.literal(F.get_json_object("props", "$.k")).alias("a"), R.literal(F.col("event_type")).alias("b"),
        R.literal(F.when(F.col("user_id") > 75, "True").otherwise("'True'")).alias("c"))
    return rows.select(
        "event_id", F.try_variant_get("a", "$", "string").alias("k"), F.schema_of_variant("a").alias("kind_k"),
        F.try_variant_get("b", "$", "string").alias("text"), F.schema_of_variant("b").alias("kind_text"), F.schema_of_variant("c").alias("kind_flag"))


@query("p17_combine_records", f"""
with f as (select event_id, 'k' as key, {_K} as value from events union all select event_id, 'type', event_type from events)
select key, row_number() over (partition by key order by event_id) as position, value from f""")
def p17(t):
    """Merged records in long form: one row per member of each key's list."""
    entries = t.events.select("event_id", F.explode(F.create_map(
        F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type"))).alias("key", "value"))
    return row_numbers(entries, "key", ["event_id"], "position").select("key", "position", "value")


_LINES = "string_split(text, chr(10))"


@query("p18_list_nth_head_tail", f"""
select doc_id, md5(coalesce({_LINES}[2], '')) as second, md5(coalesce({_LINES}[-1], '')) as last,
  md5(array_to_string({_LINES}[1:3], '~')) as head, md5(array_to_string({_LINES}[greatest(len({_LINES}) - 1, 1):], '~')) as tail from documents""")
def p18(t):
    lines = F.split("text", "\n")
    join = lambda c, sep="": F.md5(F.array_join(c, sep))
    return t.documents.select(
        "doc_id", join(R.nth(lines, 2)).alias("second"), join(R.nth(lines, -1, strict=True)).alias("last"),
        join(R.head(lines, 3), "~").alias("head"), join(R.tail(lines, 2), "~").alias("tail"))


@query("p19_list_filter", f"""
select doc_id, len(list_filter({_LINES}, lambda l: contains(l, 'the'))) as with_the, len(list_filter({_LINES}, lambda l: starts_with(l, 'Th'))) as start_th,
  len(list_filter({_LINES}, lambda l: ends_with(l, '.'))) as end_dot, len(list_filter({_LINES}, lambda l: l <> '')) as not_blank from documents""")
def p19(t):
    lines = F.split("text", "\n")
    size = lambda op, value: F.size(R.filter_list(lines, op, value)).cast("long")
    return t.documents.select(
        "doc_id", size("contains", "the").alias("with_the"), size("start with", "Th").alias("start_th"),
        size("end with", ".").alias("end_dot"), size("≠", "").alias("not_blank"))


@query("p20_list_sort", """
select doc_id, md5(array_to_string(list_sort(string_split(text, chr(10))), '~')) as up,
  md5(array_to_string(list_reverse_sort(string_split(text, chr(10))), '~')) as down, least(lang, source) || ' ' || greatest(lang, source) as records from documents""")
def p20(t):
    lines = F.split("text", "\n")
    records = F.array(F.create_map(F.lit("b"), F.lit("x"), F.lit("a"), F.col("source")), F.create_map(F.lit("a"), F.col("lang"), F.lit("b"), F.lit("y")))
    ordered = R.sort_records(records)
    return t.documents.select(
        "doc_id", F.md5(F.array_join(R.sort_list(lines), "~")).alias("up"), F.md5(F.array_join(R.sort_list(lines, True), "~")).alias("down"),
        F.array_join(F.transform(ordered, lambda r: r["a"]), " ").alias("records"))


@query("p21_routing", """
select event_id, case when event_type = 'error' and value >= 10 then 'alert' when contains(event_type, 'lic') or user_id < 10 then 'clicks'
  when event_type > 'p' and user_id > 95 then 'late' else 'rest' end as route from events""")
def p21(t):
    cases = [
        {"items": [(F.col("event_type"), "=", "error"), (F.col("value"), "≥", "10", True)], "to": "alert"},
        {"items": [(F.col("event_type"), "contains", "LIC"), (F.col("user_id"), "<", "10", True)], "logic": "or", "to": "clicks"},
        {"items": [(F.col("event_type"), ">", "p"), (F.col("user_id").cast("string"), ">", "95")], "to": "late"},
    ]
    return t.events.select("event_id", P.route(cases, "rest").alias("route"))


@query("p22_first_available", """
select o_orderkey, case when o_orderstatus = 'F' then o_orderpriority when o_orderstatus = 'O' then c_mktsegment else o_orderstatus end as value
from orders join customer on o_custkey = c_custkey""")
def p22(t):
    first = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).when(F.col("o_orderstatus") == "O", "  ")
    second = F.when(F.col("o_orderstatus") == "O", F.col("c_mktsegment")).otherwise("")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    truthy = lambda c: F.nullif(F.trim(c), F.lit(""))
    return joined.select("o_orderkey", F.coalesce(truthy(first), truthy(second), truthy(F.col("o_orderstatus"))).alias("value"))


@query("p23_assignment", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity + 1 as bigint) as plus, cast(l_quantity - 2 as bigint) as minus, cast(l_quantity * 3 as bigint) as times,
  case when l_suppkey % 10 = 0 then 'ERROR:DIVIDE_BY_ZERO' else 'ok' end as divided,
  'ERROR:VARIABLE_NOT_NUMBER or PARAMETER_NOT_NUMBER' as wrong, l_returnflag || ',' || l_linestatus || ',x' as appended,
  l_linestatus as first_gone, l_returnflag as last_gone, '' as cleared from lineitem""")
def p23(t):
    quantity = F.col("l_quantity").cast("string")
    pair = F.array("l_returnflag", "l_linestatus")
    divided = R.arithmetic(quantity, "/=", (F.col("l_suppkey") % 10).cast("string"))
    number = lambda op, v: R.arithmetic(quantity, op, F.lit(v)).cast("double").cast("long")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", number("+=", "1").alias("plus"), number("-=", "2").alias("minus"), number("*=", "3").alias("times"),
        F.when(F.startswith(divided, F.lit("ERROR")), divided).otherwise("ok").alias("divided"),
        R.arithmetic(F.col("l_returnflag"), "+=", F.lit("1")).alias("wrong"), F.array_join(R.list_assign(pair, "append", F.lit("x")), ",").alias("appended"),
        F.array_join(R.list_assign(pair, "remove_first"), ",").alias("first_gone"), F.array_join(R.list_assign(pair, "remove_last"), ",").alias("last_gone"),
        F.array_join(R.list_assign(pair, "clear"), ",").alias("cleared"))


@query("p24_typed_condition", """
select event_id, contains(event_type, 'ic') as s, value > 20 as n, true as m, event_type = 'error' as l, event_type = 'view' as b, user_id > 75 as e from events""")
def p24(t):
    tags = F.array("event_type", F.lit("z"))
    c = P.typed_condition
    maybe = F.when(F.col("user_id") <= 75, F.col("event_type"))
    return t.events.select(
        "event_id", c(F.col("event_type"), T.StringType(), "contains", "ic").alias("s"), c(F.col("value"), T.DoubleType(), ">", 20).alias("n"),
        c(F.from_json("props", "map<string,string>"), T.MapType(T.StringType(), T.StringType()), "not empty").alias("m"),
        c(tags, T.ArrayType(T.StringType()), "contains", "error").alias("l"), c(F.col("event_type") == "view", T.BooleanType(), "is", True).alias("b"),
        c(maybe, T.StringType(), "empty").alias("e"))


@query("p25_dotted_path", f"""
select event_id, {_K} as k, event_type || ', ' || cast(user_id as varchar) as labels, event_type as first_label, 'none' as missing,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as day from events""")
def p25(t):
    body = F.parse_json(F.to_json(F.struct(
        F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")).alias("a"),
        F.array(F.struct(F.col("event_type").alias("label")), F.struct(F.col("user_id").cast("string").alias("label"))).alias("tags"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))))
    rows = t.events.select("event_id", body.alias("b"))
    return rows.select(
        "event_id", R.path_text(F.col("b"), "a.k").alias("k"), R.path_text(F.col("b"), "tags[*].label").alias("labels"),
        R.path_text(F.col("b"), "tags[0].label").alias("first_label"), R.path_text(F.col("b"), "tags[9].label", default="none").alias("missing"),
        R.path_text(F.col("b"), "at", "date").alias("day"))


@query("p26_field_projection", """
select d.doc_id, lang, cast(n_chars as varchar) as n_chars, case when l.doc_id is null then 0 else 1 end + 2 as n_fields
from documents d left join labels l using (doc_id)""")
def p26(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("lang", "n_chars", "quality")]), {"ignoreNullFields": "true"})
    kept = rows.select("doc_id", F.from_json(text, "map<string,string>").alias("m"))
    return kept.select("doc_id", F.col("m")["lang"].alias("lang"), F.col("m")["n_chars"].alias("n_chars"), F.size("m").alias("n_fields"))


@query("p27_catalog_listing", """
select doc_id, source, n_chars, (select count(*) from documents where lang = 'en' and n_chars > 500) as total
from documents where lang = 'en' and n_chars > 500 order by n_chars desc, doc_id limit 50 offset 50""")
def p27(t):
    hits = t.documents.filter((F.col("lang") == "en") & (F.col("n_chars") > 500)).select("doc_id", "source", "n_chars")
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy(F.col("n_chars").desc(), "doc_id").offset(50).limit(50).withColumn("total", total)


@query("p28_row_visibility", """
select c_custkey from customer where c_mktsegment <> 'HOUSEHOLD' and
 (c_nationkey = 7 or (c_acctbal > 0 and c_nationkey in (select n_nationkey from nation where n_regionkey = 1)))""")
def p28(t):
    catalog = t.customer.select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("owner"), F.when(F.col("c_acctbal") > 0, "team").otherwise("me").alias("permission"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "0").otherwise("1").alias("status"))
    joined = t.nation.filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").cast("string").alias("tenant"))
    return P.visible_to(catalog, "owner", joined, "7").select("c_custkey")


@query("p29_name_allow_list", """
select p_partkey, 'exact' as mode from part where p_name in ('red bolt', 'blue bolt') union all
select p_partkey, 'regex' from part where regexp_full_match(p_name, 'small .*|.* ring') union all select p_partkey, 'all' from part""")
def p29(t):
    exact = P.allow_list(t.part, "p_name", ["red bolt", "blue bolt"]).select("p_partkey", F.lit("exact").alias("mode"))
    regex = P.allow_list(t.part, "p_name", ["small .*", ".* ring"], regex=True).select("p_partkey", F.lit("regex").alias("mode"))
    return exact.unionByName(regex).unionByName(P.allow_list(t.part, "p_name", []).select("p_partkey", F.lit("all").alias("mode")))
