import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimweave.plans.steps import run_steps
from claimweave.session import shared_dir, store_table
from claimweave.sources import readers, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lookup_csv_selects_and_renames(spark, tmp_path):
    (tmp_path / "l.csv").write_text("A,B,C\n01,2.5,x\n02,,y\n")
    got = readers.read_lookup_csv(spark, str(tmp_path / "l.csv"), "A string, B double, C string", ["A", "B"], {"A": "code"})
    assert got.columns == ["code", "B"] and rows(got) == [("01", 2.5), ("02", None)]


def test_delimited_lowers_names(spark, tmp_path):
    (tmp_path / "v.txt").write_text("Group_ID|Charged\ng|1.5\n")
    got = readers.read_delimited(spark, str(tmp_path / "v.txt"), "Group_ID string, Charged double")
    assert got.columns == ["group_id", "charged"] and rows(got) == [("g", 1.5)]


def test_header_detail_over_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("H|g1|Alpha\nD|ann|F\nD|bob|\n")
    (tmp_path / "b.txt").write_text("H|g2|Beta\nD|cyd|M\n\n")
    got = readers.read_header_detail(spark, str(tmp_path), ["group_id", "name"], ["member", "sex"])
    assert rows(got) == [("g1", "Alpha", "ann", "F"), ("g1", "Alpha", "bob", None), ("g2", "Beta", "cyd", "M")]


def test_xml_skips_broken_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><row><id>1</id><n>x</n></row><row><id>2</id></row></r>")
    (tmp_path / "b.xml").write_text("<r><row><id>3</id><n>broken")
    got = readers.read_xml_records(spark, str(tmp_path), "row", "id int, n string")
    assert rows(got) == [(1, "x"), (2, None)]


def test_json_sample_keeps_column_order(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"zeta": 1, "alpha": 2}\n{"alpha": 3}\n')
    assert readers.read_json_model_sample(spark, str(tmp_path)) == ["zeta", "alpha"]


def test_materialize_computes_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    for force in (False, False, True):
        assert writers.materialize(spark, build, path, force).count() == 3
    assert len(calls) == 2
    with pytest.raises(ZeroDivisionError):
        writers.materialize(spark, lambda: 1 / 0, str(tmp_path / "other"))
    (tmp_path / "t" / "_SUCCESS").unlink()
    with pytest.raises(FileExistsError):
        writers.materialize(spark, build, path)


def test_delimited_export_has_crlf_and_quoted_header(spark, tmp_path, frame):
    path = tmp_path / "out"
    writers.write_delimited(frame([("a|b", 1)], "k string, n int").coalesce(1), str(path))
    text = b"".join(p.read_bytes() for p in path.glob("part-*"))
    assert text == b'"k"|"n"\r\n"a|b"|"1"\r\n'


def test_database_shape(frame):
    df = frame([(dt.datetime(2020, 1, 2, 3, 4), "x")], "ts timestamp, name string")
    got = writers.jdbc_frame(df)
    assert got.dtypes == [("TS", "date"), ("NAME", "string")]


def test_view_and_store(spark, frame):
    assert writers.register_view(frame([(1,)], "a int"), "test_shared").count() == 1
    df = frame([(1, "x"), (2, None)], "a int, b string")
    assert rows(store_table(df)) == rows(df)


def test_shared_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir() is not None


def test_steps_enforce_the_schema(frame):
    frames = {"x": frame([("1",)], "a string")}
    step = lambda f, s: {**f, "out": f["x"].withColumn("b", F.lit(s.history_months))}
    assert run_steps(frames, [step], schema={"a": "int"}).dtypes == [("a", "int"), ("b", "int")]
    with pytest.raises(ValueError):
        run_steps(frames, [step], schema={"zzz": "int"})
    assert set(frames) == {"x"}
