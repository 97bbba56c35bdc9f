import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimweave.operators import joins

D = dt.date


def test_lookback_window_edges(frame):
    uw = D(2018, 1, 1)
    coverage = frame([("m", "a", uw)], "member string, account string, underwriting_date date")
    days = [D(2015, 12, 31), D(2016, 1, 1), D(2017, 12, 31), D(2018, 1, 1)]
    claims = frame([("m", "a", d, d) for d in days], "member string, account string, d1 date, d2 date")
    got = joins.lookback_filter(claims, coverage, ["member", "account"], ["d1", "d2"])
    assert sorted(r.d1 for r in got.collect()) == [D(2016, 1, 1), D(2017, 12, 31)]


def test_lookback_needs_both_dates_and_both_keys(frame):
    coverage = frame([("m", "a", D(2018, 1, 1))], "member string, account string, underwriting_date date")
    rows = [("m", "a", D(2017, 1, 1), D(2018, 2, 1)), ("m", "b", D(2017, 1, 1), D(2017, 1, 1)), (None, "a", D(2017, 1, 1), D(2017, 1, 1))]
    claims = frame(rows, "member string, account string, d1 date, d2 date")
    assert joins.lookback_filter(claims, coverage, ["member", "account"], ["d1", "d2"]).count() == 0


def test_plan_year_window_edges(frame):
    coverage = frame([("m", D(2018, 2, 1))], "member string, effective_date date")
    days = [D(2018, 1, 31), D(2018, 2, 1), D(2019, 1, 31), D(2019, 2, 1)]
    claims = frame([("m", d) for d in days], "member string, d date")
    got = joins.plan_year_filter(claims, coverage, ["member"], ["d"])
    assert sorted(r.d for r in got.collect()) == days[1:3]


def test_month_range_join_equals_spine_join(frame):
    r = random.Random(5)
    groups = frame([("g", D(2018, 6, 1), D(2018, 4, 30)), ("h", D(2019, 1, 1), D(2018, 11, 15))],
                   "group_id string, underwriting_date date, data_thru date")
    rows = [(r.choice("ghx"), D(2015, 1, 1) + dt.timedelta(days=r.randint(0, 1500))) for _ in range(300)]
    claims = frame(rows, "group_id string, day date")
    fast = joins.month_range_join(claims, groups, "day").select("group_id", "day", "month_from_uw", "times")
    spine = joins.month_spine(groups).drop("underwriting_date", "data_thru")
    slow = claims.join(spine, (claims.group_id == spine.group_id) & F.col("day").between(F.col("month_start"), F.col("month_end")))
    slow = slow.select(claims.group_id, "day", "month_from_uw", "times")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_attach_keeps_rows_with_null_keys(frame):
    left = frame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    right = frame([("a", "x"), (None, "y")], "k string, w string")
    assert {tuple(r) for r in joins.attach(left, right, ["k"]).collect()} == {("a", 1, "x"), (None, 2, None), ("z", 3, None)}


def test_signal_join_three_ways(frame):
    claims = frame([("P1", "D1", 1), ("P1", "D9", 2), ("P9", "D2", 3), ("P3", None, 4)], "p string, d string, id int")
    rules = frame([("both", "P1", "D1"), ("dx", None, "D2"), ("cpt", "P3", None), ("none", None, None)],
                  "event string, cpt_signal string, dx_signal string")
    got = joins.signal_join(claims, rules, "p", "d")
    assert sorted((r.event, r.id, r.cpt_signal, r.dx_signal) for r in got.collect()) == [
        ("both", 1, "P1", "D1"), ("cpt", 4, "P3", ""), ("dx", 3, "", "D2"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_source_match_equals_pairing(frame, seed):
    r = random.Random(seed)
    day = lambda: D(2018, 1, 1) + dt.timedelta(days=r.randint(0, 1200))
    subs = [(i, r.choice("ab"), day()) for i in range(40)]
    events = [(r.choice("abc"), day(), r.choice(["s1", "s2", "s3"])) for _ in range(60)]
    got = joins.source_match(
        frame(subs, "id int, k string, day date"), frame(events, "key string, seen date, src string"),
        {"k": "key"}, "day", "seen", "src", {"one": "s1", "two": "s2"},
    )
    want = set()
    for i, k, d in subs:
        hit = {s for e, x, s in events if e == k and 90 <= (d - x).days <= 820}
        want.add((i, k, d, int("s1" in hit), int("s2" in hit)))
    assert {tuple(x) for x in got.collect()} == want


def test_source_match_window_edges(frame):
    d = D(2020, 1, 1)
    subs = frame([(1, "a", d)], "id int, k string, day date")
    for gap, want in ((89, 0), (90, 1), (820, 1), (821, 0)):
        events = frame([("a", d - dt.timedelta(days=gap), "s")], "k string, seen date, src string")
        got = joins.source_match(subs, events, {"k": "k"}, "day", "seen", "src", {"s": "s"}).first()
        assert got.s == want


def test_new_keys_ignore_nulls_in_known(frame):
    got = joins.new_keys_only(frame([("a",), ("b",), ("b",)], "k string"), frame([("a",), (None,)], "k string"), ["k"])
    assert [tuple(r) for r in got.collect()] == [("b",)]


def test_eligible_claims_keep_whole_claims(frame):
    lines = frame([(1, "i", None), (1, "o", "X"), (2, "o", "OK"), (2, "o", "X"), (3, "o", "X")],
                  "claim_id int, setting string, proc_cd string")
    got = joins.eligible_claims(lines, frame([("OK",)], "cpt string"))
    assert sorted(r.claim_id for r in got.collect()) == [1, 1, 2, 2]


def test_two_editions(frame):
    first, second = frame([("A", "x")], "diag_cd string, prefx_map_id string"), frame([("A", "y"), ("B", "z")], "diag_cd string, prefx_map_id string")
    got = joins.two_edition_category(frame([("A",), ("B",), ("C",), (None,)], "c string"), "c", first, second, "unk")
    assert {tuple(r) for r in got.collect()} == {("A", "x"), ("B", "z"), ("C", "unk"), (None, "unk")}


def test_merge_features_fills_zero(frame):
    base = frame([(1,), (2,)], "k int")
    got = joins.merge_features(base, {"a": frame([(1, 5.0)], "k int, x double"), "b": frame([(2, 7.0)], "k int, y double")}, ["k"], ["x", "y"])
    assert {tuple(r) for r in got.collect()} == {(1, 5.0, 0.0), (2, 0.0, 7.0)}


def test_full_outer_coalesce(frame):
    left = frame([("a", 1, 10)], "k string, l_n int, lv int")
    right = frame([("b", 2, 20)], "k string, r_n int, rv int")
    got = joins.full_outer_coalesce(left, right, ["k"], {"n": ("l_n", "r_n")})
    assert {(r.k, r.n, r.lv, r.rv) for r in got.collect()} == {("a", 1, 10, None), ("b", 2, None, 20)}


def test_no_nested_loop_joins(spark, frame):
    """Every dated or signal join has an equi key."""
    claims = frame([("m", D(2017, 1, 1), "P", "D")], "member string, d date, p string, x string")
    coverage = frame([("m", D(2018, 1, 1))], "member string, underwriting_date date")
    rules = frame([("e", "P", "D")], "event string, cpt_signal string, dx_signal string")
    for df in (joins.lookback_filter(claims, coverage, ["member"], ["d"]), joins.signal_join(claims, rules, "p", "x")):
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
