"""Literal cases of the scalar functions and predicates."""

import pytest
from pyspark.sql import functions as F, types as T

from corpusloom.functions import predicates as P, records as R, text as X, vectors as VEC, web
from corpusloom.operators import retrieval as V
from corpusloom.operators.ranking import rerank_window


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [("( test", "(test"), ("world !", "world!"), ("a b", "a b")])
def test_redundant_spaces(spark, text, expected):
    assert one(spark, X.remove_redundant_spaces(F.lit(text))) == expected


@pytest.mark.parametrize("text, expected", [("```markdown\n# T\n```", "# T"), ("plain", "plain")])
def test_markdown_fence(spark, text, expected):
    assert one(spark, X.clean_markdown_block(F.lit(text))) == expected


@pytest.mark.parametrize("text, expected", [("(cid:12) x", True), ("clear", False), ("a", True), ("", False)])
def test_garbled(spark, text, expected):
    assert one(spark, X.is_garbled(F.lit(text))) is expected


@pytest.mark.parametrize("value, expected", [("0.25", 25), ("120", 90), ("-3", 0), ("x", 0), ("30", 30)])
def test_overlap_percent(spark, value, expected):
    assert one(spark, X.normalize_overlap_percent(F.lit(value))) == expected


@pytest.mark.parametrize("value, expected", [("1.2.3", "1.2.4"), ("1.2.999", "1.3.0"), ("1.999.999", "2.0.0"), ("x", "1.0.0"), ("", "1.0.0")])
def test_version_increment(spark, value, expected):
    assert one(spark, X.increment_version(F.lit(value))) == expected


def test_highlight_keeps_matching_sentences(spark):
    out = one(spark, X.highlight(F.lit("First sentence. Second has keyword. Third none."), ["keyword"]))
    assert out == "Second has <em>keyword</em>"


def test_uncommon_entities_and_presentation_forms(spark):
    assert one(spark, X.unescape_entities(F.lit("&eacute;&amp;lt;&lt;"))) == "é&lt;<"
    assert one(spark, X.normalize_presentation_forms(F.lit("ﻻ"))) == "لا"


@pytest.mark.parametrize("answer, expected", [("(ID: 1) ref 7 REF2", "[ID:1] ref 7 [ID:2]"), ("【ID ٢】", "[ID:٢]"), ("ref12 ref1", "ref12 [ID:1]")])
def test_citations(spark, answer, expected):
    assert one(spark, X.repair_citations(F.lit(answer), 5)) == expected


def test_reasoning_strip(spark):
    assert one(spark, X.strip_reasoning(F.lit("<think>a</think>b"))) == "b"
    assert one(spark, X.strip_reasoning(F.lit("</think>b<think>"))) == "</think>b<think>"


def test_tag_features(spark):
    asked = F.create_map(F.lit("apple"), F.lit(1.0))
    score = V.rank_feature(asked, X.parse_tag_features(F.lit("{'apple': 2.0}")), F.lit(0.0))
    assert one(spark, score) == pytest.approx(10.0)
    assert one(spark, V.rank_feature(asked, X.parse_tag_features(F.lit("oops")), F.lit(0.0))) == 0.0


@pytest.mark.parametrize("clause, expected", [
    (("contains", "earth"), True), (("contains", "mars"), False), (("in", "hello earth, x"), True), (("=", "Hello Earth"), True), (("≠", "5"), True), (("empty", None), False)])
def test_metadata_cell(spark, clause, expected):
    assert one(spark, P.cell_matches(F.lit("hello earth"), *clause)) is expected


def test_metadata_and_with_empty_first_clause_is_empty(spark):
    meta = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "doc_id long, key string, value string")
    filters = [{"key": "a", "op": "=", "value": "nope"}, {"key": "a", "op": "=", "value": "x"}]
    assert P.metadata_filter(meta, filters).count() == 0
    assert P.metadata_filter(meta, filters, "or").count() == 1


@pytest.mark.parametrize("clause", [{"key": "nope", "op": "=", "value": 1}, {"key": "a", "op": "~", "value": 1}, {"key": "a", "op": "=", "value": [1]}])
def test_unsupported_clauses(clause):
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(P.UnsupportedFilter):
        P.native_predicate(schema, clause)


def test_strict_list_operations_fail_out_of_range(spark):
    with pytest.raises(Exception, match="out of range"):
        one(spark, R.head(F.array(F.lit("a")), 3, strict=True))


def test_unknown_names_fail(spark):
    df = spark.createDataFrame([("a",)], "name string")
    with pytest.raises(Exception, match="unknown names: b"):
        P.allow_list(df, "name", ["a", "b"]).collect()


def test_rerank_window():
    assert rerank_window(1, 10) == (0, 70, 0)
    assert rerank_window(8, 10) == (70, 70, 0)
    assert rerank_window(1, 1) == (0, 30, 0)


def test_zero_vectors(spark):
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, VEC.cosine(zero, F.array(F.lit(1.0), F.lit(0.0)))) == 0.0


def test_nested_boilerplate_takes_the_parser(spark):
    page = "<html><nav><nav>a</nav>b</nav><div class='x sidebar'>c<div>d</div></div><p role='banner'>e</p><p>keep &amp; this</p></html>"
    assert one(spark, web.clean_text(F.lit(page))) == "keep & this"
