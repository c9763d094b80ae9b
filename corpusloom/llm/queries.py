"""The thin queries over the test tables: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import functions as F

from corpusloom.llm import conversations, decontamination, jaccard, langid, licenses, lm, mixing, passages, phrases, pii, quality, sharding, warc
from corpusloom.llm.registry import register, table
from corpusloom.session import scratch_path

WORDS_SQL = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

WARC_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h) as payload_bytes, sha1(h) as x, min(page_id) over (partition by h) as first from p),
c as (select *, list_aggregate([to_base(('0x' || substr(x, 5 * i + 1, 5))::bigint, 32, 4) for i in range(8)], 'string_agg', '') as b from d)
select page_id, payload_bytes, translate(upper(b), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest,
  case when page_id is null or page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from c"""

LOWER_SQL = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_SQL = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION_SQL = f"""
with d as (select row_number() over () as k, doc_id, {ALNUM_SQL.format(LOWER_SQL.format('text'))} as ws from documents),
it as (select item_id::varchar as item, {ALNUM_SQL.format(LOWER_SQL.format('text'))} as ws from benchmark),
win as (select distinct item, list_aggregate(ws[i:i + 12], 'string_agg', ' ') as phrase, len(ws[i:i + 12]) as n
  from (select item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) as i from it where len(ws) > 0)),
lens as (select distinct n from win),
runs as (select k, i, n, list_aggregate(ws[i:i + n - 1], 'string_agg', ' ') as phrase from (select k, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, lens where len(ws) >= n)),
hit as (select k, i, runs.n, item from runs join win using (phrase)),
words as (select k, count(distinct p) as n_hit from (select k, unnest(range(i, i + n)) as p from hit) group by k),
items as (select k, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as listed from hit group by k),
a as (select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256 from d left join words using (k) left join items using (k))
select *, n_hit > 0 and 20 * n_hit >= n_words as contaminated from a"""

JACCARD_SQL = f"""
with recursive d as (select doc_id, {WORDS_SQL.format(LOWER_SQL.format('text'))} as ws from documents),
s as (select distinct doc_id, list_aggregate(ws[i:i + 2], 'string_agg', ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) as i from d where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
e as (select a, b from l union select b, a from l),
r(doc_id, seen) as (select doc_id, doc_id from d union select r.doc_id, e.b from r join e on e.a = r.seen)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(seen) as component_id from r left join n using (doc_id) group by doc_id"""

QUALITY_SQL = rf"""
with d as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
w as (select k, doc_id, t, {WORDS_SQL.format('t')} as ws from d),
tri as (select k, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c from (select k, ws, unnest(range(1, len(ws) - 1)) as i from w)),
rep as (select k, i from (select k, i, count(*) over (partition by k, a, b, c) as n from tri) where n > 1),
cov as (select k, count(distinct p) as n_repeat_words from (select k, unnest([i, i + 1, i + 2]) as p from rep) group by k),
ln as (select k, pos, line, len({WORDS_SQL.format('line')}) as n, length(line) - length(translate(line, '{quality.SYMBOLS}', '')) as marks,
    len(regexp_extract_all(line, '\s(?:\||»|›|•|·|>|::)\s')) + 1 as items
  from (select k, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as pos from w)),
bad as (select *, n > 0 and (marks > 0.5 * n or not regexp_matches(line, '[\p{{L}}\p{{N}}]') or (items >= 4 and n <= 4 * items)
    or (n <= 40 and regexp_matches(lower(line), '{"|".join(quality.BOILERPLATE)}'))) as fails,
  row_number() over (partition by k, line order by pos) as nth from ln),
by_doc as (select k, coalesce(sum(n) filter (fails), 0) as lost, count(*) filter (n > 0 and nth > 1) as n_dup_lines from bad group by k),
c as (select doc_id, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(t) - length(translate(t, '{quality.SYMBOLS}', '')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(lost, 0) as lost
  from w left join cov using (k) left join by_doc using (k)),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and lost <= 0.5 * n_words as kept from v"""

PHRASES_SQL = f"""
with d as (select coalesce(lang, 'und') as lang, regexp_split_to_array({LOWER_SQL.format('text')}, '[.,;:!?\\x0A-\\x0D]') as ps from documents),
p as (select lang, regexp_extract_all(x, '[^\\x20\\x09]+') as ws from (select lang, unnest(ps) as x from d)),
g as (select lang, m, list_aggregate(ws[i:i + m - 1], 'string_agg', ' ') as phrase from (select lang, ws, m, unnest(range(1, len(ws) - m + 2)) as i from p, (values (1), (2), (3)) v(m))),
c as (select lang, m, phrase, count(*) as a from g group by all),
n as (select lang, sum(a) as n from c where m = 1 group by lang),
t as (select lang, m, phrase, a, string_split(phrase, ' ') as w from c where m > 1 and a >= 10),
cut as (select t.*, k, list_aggregate(w[1:k], 'string_agg', ' ') as lp, list_aggregate(w[k + 1:m], 'string_agg', ' ') as rp from t, (values (1), (2)) v(k) where k < m),
s as (select cut.lang, cut.m, cut.phrase, cut.a, k, x.a as l, y.a as r, (1000000::hugeint * cut.a * cut.a) // (x.a::hugeint * y.a) as score
  from cut join c x on x.lang = cut.lang and x.phrase = cut.lp join c y on y.lang = cut.lang and y.phrase = cut.rp),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
i as (select lang, sub, max(a) as around from (select lang, a, list_aggregate(w[1:2], 'string_agg', ' ') as sub from t where m = 3 union all select lang, a, list_aggregate(w[2:3], 'string_agg', ' ') from t where m = 3) group by all),
f as (select b.* from b left join i on i.lang = b.lang and i.sub = b.phrase where around is null or 100 * around < 50 * b.a),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from f)
select o.lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from o join n using (lang) where rank <= 2000"""


@register("op9_quality_rules", QUALITY_SQL)
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", quality.line_quality(F.col("text")).alias("q"))
    return docs.select("doc_id", *[f"q.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@register("op1_hypergeometric_shards")
def op1(spark, sf_dir):
    placed = sharding.shuffle_into_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    text = F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op2_pivotal_mix")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("key"), "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix_counts(rows)
    return mixed.select(F.col("key").alias("doc_id"), "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


@register("op4_license_scan")
def op4(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@register("op5_warc_round_trip", WARC_SQL)
def op5(spark, sf_dir):
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")), path)
    read = warc.read_archives(spark, path)
    return read.select(warc.page_of(F.col("origin")).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), warc.page_of(F.col("refers_to")).alias("refers_to"))


@register("op7_decontamination", CONTAMINATION_SQL)
def op7(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register("op3_personal_data")
def op3(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"pii.n_{k}" for k in pii.KINDS], F.sha2("pii.base", 256).alias("base_sha256"), "pii.spans")


@register("op6_ngram_jaccard", JACCARD_SQL)
def op6(spark, sf_dir):
    groups = jaccard.similarity_groups(table(spark, sf_dir, "documents"), size=3, similarity=Fraction(9, 10))
    return groups.select("doc_id", "n_shingles", "component_id")


@register("op8_language_model")
def op8(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"))


@register("op10_repeated_passages")
def op10(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@register("op13_conversation_repair")
def op13(spark, sf_dir):
    return conversations.repaired_digests(table(spark, sf_dir, "conversations"))


@register("op12_phrase_mining", PHRASES_SQL)
def op12(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register("op11_language_id")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = langid.is_held_out(F.col("doc_id"))
    net = langid.learn(docs, ~held)
    return langid.identify(docs, net, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")
