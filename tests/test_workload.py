"""Every registered query against its SQL, and the shape of the plans."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from phasewise.workload.queries import QUERIES

DATA = Path("/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()  # fmt: skip

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def comparable(rows):
    def text(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return sorted([tuple(map(text, r)) for r in rows])


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    df = entry.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    cursor = sql.execute(entry.oracle_sql()[name])
    place = [d[0] for d in cursor.description]
    assert sorted(place) == columns
    expected = comparable([[r[place.index(c)] for c in columns] for r in cursor.fetchall()])
    assert comparable(df.select(*columns).collect()) == expected
    assert expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_on_the_jvm_without_cross_products(spark, name):
    text = plan(entry.queries()[name](spark, str(DATA)))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_scope_reaches_the_scan(spark, tmp_path):
    from phasewise.plans import study

    path = str(tmp_path / "phases")
    spark.createDataFrame(
        [("11", "PHASE_1", None, None)], "pId string, phaseId string, startDate date, endDate date"
    ).write.parquet(path)
    text = plan(study.phase_windows(spark.read.parquet(path), 1, prefix="1"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "StringStartsWith(pId,1)" in pushed and "EqualTo(phaseId,PHASE_1)" in pushed


def test_only_used_columns_are_read(spark):
    text = plan(entry.queries()["agg_level_overall"](spark, str(DATA)))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"user_id", "event_type", "value"}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["stu_engagement", "dev_sleep_stages", "win_midrank", "st_ranksum"])
def test_partitioning_does_not_change_results(spark, name):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    one = comparable(entry.queries()[name](spark, str(DATA)).collect())
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        other = comparable(entry.queries()[name](spark, str(DATA)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one == other
