"""User statements: what reads the session's views runs, everything else is refused and changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import sqlapi as Q


@pytest.fixture()
def session(spark):
    s = Q.SqlSession(spark)
    s.functions()
    s.view("g_rows", spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.array(F.lit(1), F.lit(2)).alias("xs")))
    spark.range(3).createOrReplaceTempView("g_hidden")
    return s


QUERIES = [
    "select * from g_rows", "select g, count(*) as n from G_ROWS group by g having count(*) > 1 order by n desc limit 2",
    "with a as (select k from g_rows where k > 2), b as (select * from a) select * from b join a using (k)", "select k, x from g_rows lateral view explode(xs) t as x",
    "select k from g_rows where k in (select max(k) from g_rows) union all select 1", "select k, sum(k) over (partition by g order by k) as s from g_rows", "select * from (select g, k from g_rows) pivot (sum(k) for g in (0, 1, 2))",
    "select * from values (1, 2), (3, 4) as v(a, b)", "select a.k from g_rows a left anti join g_rows b on a.k = b.k + 1", "select k from g_rows except select 3 intersect select 3", "select distinct g from g_rows offset 1",
    '''select json_extract_string('{"a": 1}', '$.a') as x''', "select exists(select 1 from g_rows r where r.k = o.k) as e from g_rows o", "select * from g_rows r, lateral (select r.k + 1 as n)",
]

REFUSED = [
    "create table g_new as select 1", "insert into g_rows values (1)", "drop view g_rows", "set spark.sql.ansi.enabled = false", "cache table g_rows", "explain select 1", "show tables", "use default",
    "execute immediate 'create table g_new as select 1'", "execute immediate 'create or replace temporary view g_new as select 1'", "from g_rows insert overwrite directory '{out}' using parquet select *",
    "insert overwrite directory '{out}' using parquet select 1", "select java_method('java.lang.System', 'setProperty', 'g.probe', '1')", "select k from g_rows order by reflect('java.lang.System', 'setProperty', 'g.probe', '1')",
    "select 1 where try_reflect('java.lang.System', 'setProperty', 'g.probe', '1') is null", "select * from text.`/etc/hostname`", "select * from g_hidden", "select * from default.g_rows", "select * from identifier('g_hidden')",
    "select identifier('reflect')('java.lang.System', 'setProperty', 'g.probe', '1')", "select (select max(id) from g_hidden)", "select k from g_rows where k in (select id from g_hidden)", "with a as (select * from g_hidden) select * from a",
    "select * from g_hidden where 1 in (with g_hidden as (select 1) select * from g_hidden)", "with a as (select * from b), b as (select 1) select * from a", "select transform(k) using 'cat' as (x string) from g_rows", "select * from range(5)",
]


@pytest.mark.parametrize("statement", QUERIES)
def test_queries_run(session, statement):
    assert session.run(statement).collect() is not None


@pytest.mark.parametrize("statement", REFUSED)
def test_others_are_refused(session, statement, tmp_path):
    before = sorted(t.name for t in session.spark.catalog.listTables())
    with pytest.raises(Q.RefusedStatement):
        session.run(statement.format(out=tmp_path / "out"))
    assert sorted(t.name for t in session.spark.catalog.listTables()) == before
    assert not os.path.exists(tmp_path / "out") and session.spark._jvm.java.lang.System.getProperty("g.probe") is None
