import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.operators import frames, reports, reshape, summaries, words


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_cast_types_checks_names_and_types(frame):
    df = frame([("1", "x")], "a string, b string")
    assert frames.cast_types(df, {"a": T.IntegerType()}).dtypes == [("a", "int"), ("b", "string")]
    with pytest.raises(ValueError):
        frames.cast_types(df, {"z": T.IntegerType()})
    with pytest.raises(TypeError):
        frames.cast_types(df, {"a": "int"})
    with pytest.raises(ValueError):
        frames.rename_cols(df, {"z": "y"})


def test_hide_small_cells_per_group(frame):
    rules = frame([("g", "x", 5, 0, 0, "Y"), ("g", "y", 0, 0, 0, "Y"), ("g", "z", 0, 0, 0, "N"), ("h", "w", 1, 0, 0, None)],
                  "k string, label string, adult_male int, adult_female int, children int, display_flag string")
    counts = frame([("g", 4, 9, 9)], "k string, adult_male int, adult_female int, children int")
    got = frames.hide_small_cells(rules, counts, ["label"], ["k"])
    assert [r.label for r in got.orderBy("k", "display_flag", "adult_male").collect()] == [
        "Cannot Disclose", "y", "Cannot Disclose", "Cannot Disclose",
    ]


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(1000)
    a, b, c = (sorted(r.id for r in frames.sample_rows(df, ["id"], 50, seed=s).collect()) for s in (1, 1, 2))
    assert len(a) == 50 and a == b and a != c


def test_keep_sources_keeps_unknown(frame):
    df = frame([("i",), ("o",), ("r",), (None,)], "s string")
    assert rows(frames.keep_sources(df, "s", inpatient=False, rx=False)) == rows(frame([("o",), (None,)], "s string"))


def test_select_columns(frame):
    df = frame([(1, 2, 3)], "pred_a int, pred_b int, x int")
    assert frames.select_columns(df, prefix="pred_", exclude=["pred_b"]).columns == ["pred_a"]


def test_dummies(frame):
    df = frame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    assert rows(reshape.dummy_code(df, "c")) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert reshape.levels_of(df, "c") == ["a", "b"]
    got = reshape.any_levels(frame([(1, "a"), (1, "a"), (1, "q"), (2, "q")], "id int, c string"), ["id"], "c", ["a", "b"], "x")
    assert rows(got) == [(1, 1, 0, 1, 1), (2, 0, 0, 0, 0)]


def test_align_features_orders_and_fills(frame):
    df = frame([(1, None, 5)], "id int, a int, extra int")
    got = reshape.align_features(df, ["id"], ["new", "a"])
    assert got.columns == ["id", "new", "a"] and rows(got) == [(1, 0, 0)]


def test_melts(frame):
    df = frame([(1, "x", None), (2, None, "y")], "id int, d1 string, d2 string")
    assert rows(reshape.melt_codes(df, ["id"], ["d1", "d2"])) == [(1, "x"), (2, "y")]
    got = reshape.melt_impacts(frame([(1, 0.5)], "id int, hcup_12_shap double"), ["id"], ["hcup_12_shap"])
    assert rows(got) == [(1, "hcup_12_shap", 0.5, "12")]


def test_multi_hot_and_columns_to_rows(frame):
    df = frame([(["a", "c"],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(reshape.multi_hot("x", ["a", "b", "c"])).collect()] == [[1, 0, 1], [0, 0, 0]]
    assert rows(reshape.columns_to_rows(frame([(1, 2, 3)], "id int, a int, b int"), ["id"], ["a", "b"])) == [(1, 2), (1, 3)]


def test_flatten_json_keeps_bad_text_as_nulls(frame):
    df = frame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, "oops"), (3, None)], "id int, doc string")
    got = reshape.flatten_json(df, "doc", "a int, b struct<c: string>")
    assert got.columns == ["id", "a", "b.c"]
    assert rows(got) == [(1, 1, "x"), (2, None, None), (3, None, None)]


def test_setting_amounts(frame):
    df = frame([("m", "i", 24.0), ("m", "i", 24.0), ("m", "o", None), ("n", "o", 48.0)], "m string, s string, a double")
    got = reshape.setting_pmpm(df, ["m"], "s", "a", {"ip": "i", "op": "o"})
    assert rows(got) == [("m", 2.0, 0.0), ("n", 0.0, 2.0)]


def test_reports(frame, tmp_path):
    df = frame([("a", 500.0, None), ("b", 2000.0, None), ("c", 1.0, 0.5)], "k string, cost double, impact double")
    assert [r.k for r in reports.threshold_rows(df, {"cost": 1000.0, "impact": 0.01}).orderBy("k").collect()] == ["b", "c"]
    path = str(tmp_path / "runs")
    assert reports.add_results(df, path, replace=True).count() == 3
    assert reports.add_results(df, path).count() == 6
    assert reports.add_results(df, path, replace=True).count() == 3
    frames_ = {"p": frame([(1, 1.0)], "id int, v double"), "q": frame([(2, 2.0)], "id int, v double")}
    assert rows(reports.columns_by_key(frames_, ["id"], "v")) == [(1, 1.0, None), (2, None, 2.0)]


def test_summaries(frame):
    people = frame([("M", 18), ("F", 40), ("F", 17), ("M", 3)], "sex string, age int")
    assert rows(summaries.age_sex_counts(people)) == [(1, 1, 2)]
    names = frame([("1", "x"), ("1", "x"), ("2", "x"), ("2", "y")], "code string, name string")
    assert rows(summaries.collapse_names(names, "code", "name")) == [("1", "x"), ("2", "2")]
    freq = summaries.freq_table(frame([("a",), ("a",), (None,)], "c string"), "c")
    assert {r.c: r.n for r in freq.collect()} == {"a": 2, "(missing)": 1}
    codes = frame([(1, ["b", "a", None]), (1, ["a"]), (2, None), (3, ["z"])], "k int, x array<string>")
    assert rows(summaries.sorted_codes(codes, ["k"], {"x": "x"})) == [(1, ["a", "b"]), (3, ["z"])]


def test_histogram_counts_every_value_once(frame):
    df = frame([(float(v),) for v in [0, 1, 2, 3, 10]] + [(None,)], "v double")
    got = summaries.histogram(df, "v", bins=5)
    assert rows(got) == [(1, 2), (2, 2), (5, 1)]
    flat = summaries.histogram(frame([(2.0,), (2.0,)], "v double"), "v", bins=4)
    assert rows(flat) == [(1, 2)]


def test_weighted_corr(frame):
    import numpy as np

    data = [(1.0, 2.0, 1.0), (2.0, 1.0, 3.0), (4.0, 6.0, 2.0), (5.0, 5.0, 1.0)]
    got = summaries.weighted_corr(frame(data, "x double, y double, w double"), "x", "y", "w").first().corr
    x, y, w = map(np.array, zip(*data))
    cov = np.cov(x, y, aweights=w)
    assert math.isclose(got, cov[0, 1] / math.sqrt(cov[0, 0] * cov[1, 1]))


def test_group_event_risk_falls_back_to_manual_rate(frame):
    df = frame([("g", 4200.0, 10, None), ("h", 2400.0, 10, 20.0)], "k string, cost double, n int, rate double")
    got = {r.k: r.med_debit_rs for r in summaries.group_event_risk(df, ["k"], "cost", "n", "rate").collect()}
    assert math.isclose(got["g"], 0.1, rel_tol=1e-6) and math.isclose(got["h"], 1.0, rel_tol=1e-6)


def test_term_counts(frame):
    df = frame([("The cat, the CAT! 42 cats",), (None,), ("it's a dog's life",)], "t string")
    got = {r.term: r.n for r in words.term_counts(df, "t").collect()}
    assert got == {"cat": 2, "cats": 1, "its": 1 , "dogs": 1, "life": 1} or got == {"cat": 2, "cats": 1, "dogs": 1, "life": 1}
    assert len(words.ENGLISH_STOP_WORDS) == len(set(words.ENGLISH_STOP_WORDS))


def test_flatten_json_finds_the_keys(frame):
    rows_in = [(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"b": {"d": 2.5}, "a": 7}'), (3, "no json"), (4, None)]
    got = reshape.flatten_json(frame(rows_in, "id int, doc string"), "doc")
    assert set(got.columns) == {"id", "a", "b.c", "b.d"}
    found = {r["id"]: (r["a"], r["b.c"], None if r["b.d"] is None else float(r["b.d"])) for r in got.collect()}
    assert found == {1: (1, "x", None), 2: (7, None, 2.5), 3: (None, None, None), 4: (None, None, None)}
