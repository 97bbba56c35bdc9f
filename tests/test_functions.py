import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from claimweave.functions import amounts, codes, dates, numbers

D = dt.date


def values(frame, rows, schema, column):
    return [r[0] for r in frame(rows, schema).select(column).collect()]


def test_parse_date_key_drops_bad_keys(frame):
    got = values(frame, [(20240229,), (20230229,), (None,)], "k int", dates.parse_date_key("k"))
    assert got == [D(2024, 2, 29), None, None]


def test_plan_month_accepts_upper_case(frame):
    got = values(frame, [("01JAN2018",), ("17Feb2019",)], "s string", dates.parse_plan_month("s"))
    assert got == [D(2018, 1, 1), D(2019, 2, 1)]


def test_underwriting_date_clips_to_month_end(frame):
    got = values(frame, [(D(2020, 5, 31),), (D(2020, 1, 1),)], "d date", dates.underwriting_date("d"))
    assert got == [D(2020, 2, 29), D(2019, 10, 1)]


@pytest.mark.parametrize(
    "day, want",
    [(D(2018, 1, 1), 0), (D(2017, 12, 31), 1), (D(2017, 12, 1), 1), (D(2017, 11, 30), 2), (D(2018, 1, 15), 0)],
)
def test_months_before_rounds_up(frame, day, want):
    assert values(frame, [(day,)], "d date", dates.months_before(F.lit(D(2018, 1, 1)), "d")) == [want]


def test_times_bucket_edges(frame):
    rows = [(m,) for m in (0, 1, 3, 4, 9, 10, None)]
    assert values(frame, rows, "m int", dates.times_bucket("m")) == [3, 1, 1, 2, 2, 3, 3]
    rows = [(m,) for m in (1, 3, 4, 9, 10, 26)]
    assert values(frame, rows, "m int", dates.times_bucket_from("m")) == [1, 1, 2, 2, 3, 3]


def test_month_differences(frame):
    rows = [(D(2018, 1, 31), D(2018, 3, 1))]
    got = values(frame, rows, "a date, b date", dates.calendar_month_diff("a", "b"))[0]
    assert math.isclose(got, 2 - 30 / 30.436875)
    assert values(frame, rows, "a date, b date", dates.fixed_month_diff("a", "b")) == [29 / 30]


def test_detection_range_and_rank(frame):
    rows = [(3.99,), (4.0,), (11.9,), (12.0,)]
    labels = values(frame, rows, "m double", dates.detection_range("m"))
    assert [x.split(" ")[0] for x in labels] == ["0-3", "4-12", "4-12", "13+"]
    ranks = values(frame, rows, "m double", dates.detection_rank(dates.detection_range("m")))
    assert ranks == [3, 2, 2, 1]


def test_age_clips_negative_and_missing(frame):
    rows = [(D(1980, 1, 2),), (D(2030, 1, 1),), (None,)]
    day = F.lit(D(2020, 1, 1))
    assert values(frame, rows, "b date", dates.age_at(day, "b")) == [39, 0, 0]
    assert values(frame, rows, "b date", dates.age_at(day, "b", clip=False)) == [39, -11, None]


def test_month_end_and_batch(frame):
    rows = [("202402",), ("20240215",), ("2024",), (None,)]
    assert values(frame, rows, "s string", dates.month_end("s")) == [D(2024, 2, 29), D(2024, 2, 15), None, None]
    assert values(frame, [("202402_x",)], "s string", dates.batch_month("s")) == [D(2024, 2, 1)]


def test_history_months_clamped(frame):
    rows = [(D(2018, 1, 1), D(2010, 1, 1)), (D(2018, 1, 1), D(2018, 5, 1)), (D(2018, 1, 1), D(2017, 11, 15)), (D(2018, 1, 1), None)]
    assert values(frame, rows, "u date, s date", dates.history_months("u", "s")) == [24, 0, 1, None]


def test_covered_months_edges(frame):
    e = D(2018, 1, 1)
    rows = [
        (e, D(2017, 1, 1), D(2018, 6, 30)), (e, D(2017, 1, 1), D(2018, 7, 31)), (e, D(2018, 4, 1), D(2019, 12, 31)),
        (e, D(2018, 1, 1), None), (e, None, D(2018, 12, 31)),
    ]
    assert values(frame, rows, "e date, s date, x date", dates.covered_months("e", "s", "x")) == [6, 7, 9, 12, 12]


def test_code_cleaning(frame):
    rows = [("123",), ("0",), ("na",), (None,), ("00042",), ("1234567890123",)]
    got = values(frame, rows, "c string", codes.clean_ndc("c"))
    assert got[:5] == ["00000000123", None, None, None, "00000000042"]
    rows = [("450.0",), ("0450",), (None,), ("12345",)]
    assert values(frame, rows, "c string", codes.clean_revenue("c")) == ["0450", "0450", None, "12345"]
    assert values(frame, [(" A01.2 ",)], "c string", codes.clean_icd("c")) == ["A012"]
    assert values(frame, [("X123",), ("",)], "c string", codes.strip_prefix_char("c")) == ["123", ""]


def test_setting_and_flags(frame):
    rows = [("R1",), ("",), (None,)]
    assert values(frame, rows, "c string", codes.claim_setting("c")) == ["i", "o", "o"]
    assert values(frame, rows, "c string", codes.claim_setting("c", empty_counts=True)) == ["i", "i", "o"]
    rows = [("F",), ("M",), ("x",), (None,)]
    assert values(frame, rows, "c string", codes.normalize_sex("c")) == ["F", "M", "M", "F"]
    assert values(frame, [("18",), ("01",), (None,)], "c string", codes.subscriber_flag("c")) == [1, 0, 0]
    assert values(frame, [("Big HUMMER",), (None,), ("x",)], "c string", codes.contains_flag("c", "hum")) == [1, 0, 0]
    assert values(frame, [("a",), ("z",), (None,)], "c string", codes.value_switch("c", {"a": 1}, 9)) == [1, 9, 9]


def test_keys_and_labels(frame):
    rows = [("a", None), (None, "b"), ("", "b")]
    assert values(frame, rows, "x string, y string", codes.concat_key("x", "y")) == ["a|~", "~|b", "|b"]
    assert values(frame, rows, "x string, y string", codes.code_label("x", "y")) == ["CPT: a", "ICD: b", "ICD: b"]


def test_numbers(frame):
    assert values(frame, [("1,234.5",), ("x",), (None,)], "s string", numbers.parse_money("s")) == [1234.5, None, None]
    assert values(frame, [(-2.0,), (0.0,), (None,), (3.0,)], "x double", numbers.charge_sign("x")) == [-1, 0, 0, 1]
    got = values(frame, [(-4.0,), (0.0,), (4.0,)], "x double", numbers.signed_sqrt("x", 3.0, 0.0, 1.0))
    assert got == [-6.0, 0.0, 6.0]
    got = values(frame, [(0.0,), (5.0,)], "x double", numbers.box_cox("x"))
    assert [round(v, 9) for v in got] == [round(math.log(0.001), 9), round(math.log(5.001), 9)]
    assert values(frame, [(5,), (50,), (5000,), (None,)], "x int", numbers.clamp("x", 10, 1000)) == [10, 50, 1000, None]
    assert values(frame, [(-5.0,), (None,), (5.0,)], "x double", numbers.floor_at_zero("x")) == [0.0, 0.0, 5.0]


def test_unit_reprice_rules(frame):
    rows = [(5.0, 2.0, 3.7), (-5.0, 2.0, 3.7), (0.0, 2.0, 3.7), (5.0, 2.0, None), (5.0, None, 3.7), (None, 2.0, 3.0)]
    schema = "u double, p double, c double"
    assert values(frame, rows, schema, amounts.repriced("u", "p", "c")) == [6.0, -6.0, 0.0, 10.0, None, None]
    assert values(frame, rows[:1], schema, amounts.repriced("u", "p", "c", "floor")) == [10.0]
    assert values(frame, rows[:1], schema, amounts.repriced("u", "p", "c", whole_limit=False)) == [7.4]


def test_charge_caps(frame):
    rows = [(5.0, 9.0), (-12.0, 9.0), (12.0, -9.0), (None, 9.0), (5.0, None)]
    assert values(frame, rows, "a double, c double", amounts.capped_by_charge("a", "c")) == [5.0, 9.0, -9.0, 9.0, None]
    assert values(frame, [(5.0, 9.0), (-12.0, -20.0)], "a double, c double", amounts.signed_cap("a", "c")) == [5.0, -20.0]


def test_history_amount_by_row_kind(frame):
    schema = "k string, n string, p string, na double, pa double, ra double, al double, ch double"
    rows = [
        ("md", "N", "P", 1.0, 2.0, 3.0, 4.0, 9.0), ("mr", "N", "P", 1.0, 2.0, 3.0, 4.0, 9.0),
        ("mc", "N", "P", None, 2.0, 3.0, 4.0, 9.0), ("mr", None, "", 1.0, 2.0, 3.0, 4.0, 9.0),
        ("mr", None, None, 1.0, 2.0, None, 4.0, 9.0), ("mc", "N", "P", None, None, 3.0, 40.0, 9.0),
    ]
    got = values(frame, rows, schema, amounts.history_amount("k", "n", "p", "na", "pa", "ra", "al", "ch"))
    assert got == [0.0, 0.0, 2.0, 3.0, 4.0, 9.0]


def test_vendor_amounts(frame):
    rows = [(None, 10.0, 3.0, 2.0), (4.0, 10.0, 3.0, 2.0), (None, None, None, None)]
    got = values(frame, rows, "a double, d double, l double, p double", amounts.rx_vendor_amount("a", "d", "l", "p"))
    assert got == [6.0, 4.0, 0.0]
    got = values(frame, [(8.0, 1), (8.0, 2), (8.0, 3)], "d double, t int", amounts.period_debit_cost("d", "t"))
    assert got == [258.0, 516.0, 1032.0]
