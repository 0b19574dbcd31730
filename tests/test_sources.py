"""Readers and writers on small files."""

import datetime as dt

import pytest
from comparing import rows

from phasewise.sources import readers, schemas, writers


def test_csv_ids_and_missing_cells(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("record_id,age,day\n007,NA,2024-01-01\n008,41,NaT\n009,oops,\n")
    df = readers.read_csv(spark, str(path), "record_id string, age double, day date, gone int")
    assert rows(df) == [("007", None, dt.date(2024, 1, 1)), ("008", 41.0, None), ("009", None, None)]


def test_quotes_commas_and_line_breaks_in_cells(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('record_id,said,age\n1,"say ""hi"", ok",5\n2,"two\nlines",6\n3,"",7\n')
    df = readers.read_csv(spark, str(path), "record_id string, said string, age int", multi_line=True)
    assert rows(df) == [("1", 'say "hi", ok', 5), ("2", "two\nlines", 6), ("3", None, 7)]


def test_written_csv_reads_back(spark, tmp_path):
    path = str(tmp_path / "t")
    given = [("1", 'a "b", c'), ("2", "x\ny"), ("3", None), ("4", "back\\slash")]
    writers.write_table(spark.createDataFrame(given, "id string, t string"), path, "csv")
    assert rows(readers.read_csv(spark, path, "id string, t string", multi_line=True)) == given


def test_rejected_records_are_kept_apart_and_counted(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("record_id,age,day\n1,41,2024-01-01\n2,41,2024-01-01,x\n3\n4,old,never\n5,NA,\n")
    df = readers.csv_with_rejects(spark, str(path), "record_id string, age double, day date")
    assert rows(readers.reject_counts(df)) == [("age, day", 1), ("good", 2), ("torn", 2)]
    lines = {r.record_id: r[readers.REJECT].line for r in df.filter(f"{readers.REJECT}.line IS NOT NULL").collect()}
    assert lines == {"2": "2,41,2024-01-01,x", "3": "3"}
    kept = readers.read_csv(spark, str(path), "record_id string, age double, day date")
    assert [r[0] for r in rows(kept)] == ["1", "4", "5"]


def test_rejected_documents_are_kept_apart_and_counted(spark):
    good = '{"date":"2024-01-01","dataset":[{"time":"10:00:00","steps":3}]}'
    given = [good, "{nonsense", None, '{"date":"2024-01-01"}', '{"dataset":[{"time":"10:00:00"}]}', "{}"]
    df = spark.createDataFrame([("p", g) for g in given], "pid string, json string")
    found = readers.documents_with_rejects(df)
    assert rows(readers.reject_counts(found)) == [
        ("dataset", 1), ("date", 1), ("date, dataset", 1), ("good", 1), ("torn", 2)]
    assert readers.minutes_from_json(df).count() == 1


def test_cohorts_are_harmonised(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,dhl_1\n1,2\n")
    (tmp_path / "b.csv").write_text("record_id,dhls1\n2,3\n")
    paths = {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")}
    schema = "record_id string, dhl_1 int, dhls1 int"
    df = readers.read_cohorts(spark, paths, schema, [(r"^(dhl_|dhls_?)", "dhls_")])
    assert rows(df) == [("a", "1", 2), ("b", "2", 3)]


def test_files_folded_by_key(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x\n1,2\n")
    (tmp_path / "b.csv").write_text("k,y\n1,3\n2,4\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    df = readers.read_and_join(spark, paths, ["k int, x int", "k int, y int"], ["k"])
    assert rows(df) == [(1, 2, 3), (2, None, 4)]


def test_jdbc_slices_need_bounds():
    options = readers.jdbc_options("jdbc:x", "t", "id", ("0", "9"), 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")


def test_table_with_declared_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", None, None)], schemas.PARTICIPANTS)
    writers.write_table(df, path, order=("id",))
    assert rows(readers.read_table(spark, path, schemas.PARTICIPANTS)) == rows(df)


def test_latest_run_is_read_back(spark, tmp_path):
    path = str(tmp_path / "runs")
    for day, x in ((1, 1), (2, 2), (2, 3)):
        frame = spark.createDataFrame([(x,)], "x int")
        writers.write_dated(frame, path, dt.date(2024, 1, day))
    assert rows(writers.read_latest(spark, path)) == [(3,)]
    assert spark.read.parquet(path).count() == 2


def test_malformed_documents_give_no_rows(spark):
    good = '{"date":"2024-01-01","dataset":[{"time":"10:00:00","heartrate":60,"steps":3}]}'
    df = spark.createDataFrame([("p1", good), ("p2", "{nonsense")], "pid string, json string")
    got = rows(readers.minutes_from_json(df).select("pid", "heartrate", "steps"))
    assert got == [("p1", 60.0, 3)]


def test_phase_averages_drop_overall(spark):
    df = spark.createDataFrame([("a", "1", 1.0), ("a", "overall", 2.0)], "record_id string, phase string, m double")
    assert rows(readers.phase_averages(df)) == [("a", 1, 1.0)]
