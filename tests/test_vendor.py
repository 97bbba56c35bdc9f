import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimweave.operators import signals, vendor

D = dt.date
PERSON = "group_id string, member_id string, underwriting_date date, times int"
UW = D(2018, 1, 1)


def test_debit_summary_two_levels(frame):
    rows = [("g", "m", UW, 1, "a", 400.0), ("g", "m", UW, 1, "a", 300.0), ("g", "m", UW, 1, "b", 100.0), ("g", "m", UW, 2, "b", 60.0)]
    df = frame(rows, PERSON + ", drug_name string, debits double")
    got = {r.times: r.debit_cost for r in vendor.debit_summary(df, vendor.PERSON).collect()}
    assert got[1] == pytest.approx(129 * (500 / 3) / 4) and got[2] == pytest.approx(129 * 60 / 2)
    assert {r.debit_cost for r in vendor.debit_summary(df, vendor.PERSON, override=7).collect()} == {7.0}


def test_debit_summary_keeps_only_costs_above_actual(frame):
    df = frame([("g", "m", UW, 3, "a", 1.0, 500.0), ("g", "n", UW, 3, "a", 9.0, 500.0)], PERSON + ", drug_name string, debits double, spent double")
    got = vendor.debit_summary(df, vendor.PERSON, F.col("spent")).collect()
    assert [(r.member_id, r.debit_cost) for r in got] == [("n", 1161.0)]


def test_debit_by_code_needs_both_codes(frame):
    rows = frame([("g", "m", UW, 1, "N", "P"), ("g", "m", UW, 1, "N", "P"), ("g", "m", UW, 1, None, "P")], PERSON + ", ndc_id string, proc_cd string")
    cost = frame([("g", "m", UW, 1, 5.0)], PERSON + ", debit_cost double")
    got = vendor.debit_by_code(rows, cost, vendor.PERSON, ["ndc_id", "proc_cd"]).collect()
    assert [(r.ndc_id, r.proc_cd, r.debit_cost) for r in got] == [("N", "P", 10.0)]


def test_period_debits(frame):
    drug = frame([("g", UW, 1, "a", 100.0, 1, 1), ("g", UW, 1, "a", 100.0, 1, 1), ("g", UW, 2, "b", 50.0, 1, 1)],
                 "group_id string, underwriting_date date, times int, drug_name string, plan_yr_dollar double, earliest_period int, latest_period int")
    dx = frame([("g", UW, "m", 2, "D1"), ("g", UW, "m", 1, "D2"), ("g", UW, "n", 1, "D1"), ("g", UW, "m", 3, "D1")],
               "group_id string, underwriting_date date, member_id string, times int, value string")
    table = frame([("D1", "x", 2, 1, 10.0), ("D2", "x", 3, 1, 30.0)],
                  "diag_cd string, diag_grouping string, earliest_period int, latest_period int, plan_yr_dollar double")
    got = vendor.period_debits([drug], dx, table).first()
    assert (got.rx_debits, got.med_debits) == (100.0, 40.0)


def test_claimants_are_distinct(frame):
    a = frame([("g", "m"), ("g", "m")], "group_id string, member_id string")
    b = frame([("g", "m"), ("h", "n"), ("x", "q")], "group_id string, member_id string")
    got = vendor.claimants([a, b], frame([("g", 1), ("h", 2)], "group_id string, size int"))
    assert sorted((r.group_id, r.member_id, r.hist_mths_avail) for r in got.collect()) == [("g", "m", 24), ("h", "n", 24)]


MONTHLY = [f"l{i}" for i in range(17)]


@pytest.mark.parametrize("s", [0.0, 0.4, 3.0, 5.0, 7.25, 16.5, 20.0])
@pytest.mark.parametrize("partial", [False, True])
def test_plan_likelihood(frame, s, partial):
    levels = [0.01 * (i + 1) for i in range(17)]
    df = frame([(s, *levels, 0.5)], "s double, " + ", ".join(f"{c} double" for c in MONTHLY) + ", tail double")
    got = df.select(signals.plan_likelihood("s", MONTHLY, "tail", partial)).first()[0]
    end, want = s + 12, 0.0
    for i, level in enumerate(levels):
        if partial:
            want += level * min(1, max(0, i + 1 - s)) * min(1, max(0, end - i))
        else:
            want += level * (i + 1 > s) * (end > i)
    assert got == pytest.approx(want + 0.5 * (end > 17))


CLAIM = "group_id string, member_id string, claim_id int, from_date date, proc_cd string, underwriting_date date, effective_date date, d1 string, d2 string"
RULE = "event string, signal string, event_cost double, cpt_signal string, dx_signal string"


def test_latest_signal_per_rule(frame):
    eff = D(2018, 4, 1)
    rows = [
        ("g", "m", 1, D(2017, 5, 1), "P", UW, eff, "A", None), ("g", "m", 2, D(2017, 9, 1), "P", UW, eff, "B", "A"),
        ("g", "m", 3, D(2018, 2, 1), "P", UW, eff, "A", None), ("g", "m", 4, D(2017, 9, 1), "Q", UW, eff, "A", "A"),
        ("g", "n", 5, D(2017, 3, 1), "Z", UW, eff, None, None),
    ]
    rules = frame([("e", "both", 10.0, "P", "A"), ("e", "dx", 10.0, None, "A"), ("f", "cpt", 10.0, "Z", None)], RULE)
    got = signals.latest_signals(frame(rows, CLAIM), rules, ["d1", "d2"])
    assert sorted((r.event, r.signal, r.member_id, r.claim_id) for r in got.collect()) == [
        ("e", "both", "m", 2), ("e", "dx", "m", 2), ("f", "cpt", "n", 5),
    ]


def test_member_event_takes_the_costliest(frame):
    eff = D(2018, 4, 1)
    schema = "event string, group_id string, member_id string, claim_id int, from_date date, underwriting_date date, effective_date date, event_cost double, cpt_signal string, dx_signal string, "
    schema += ", ".join(f"{c} double" for c in MONTHLY) + ", tail double"
    rows = [
        ("e", "g", "m", 1, D(2018, 1, 1), UW, eff, 10.0, "", "A", *[0.1] * 17, 0.0),
        ("e", "g", "m", 2, D(2018, 1, 1), UW, eff, 50.0, "", "B", *[0.1] * 17, 0.0),
    ]
    got = signals.member_event_cost(frame(rows, schema), MONTHLY, "tail").collect()
    assert [(r.dx_signal, round(r.event_est_cost, 6)) for r in got] == [("B", 60.0)]


def test_weights_sum_debit_without_pairing(frame):
    line = "group_id string, member_id string, underwriting_date date, times int, setting string"
    key = ("g", "m", UW, 1, "o")
    proc = frame([(*key, "P1", 5.0, None, 9.0, "A"), (*key, "P2", 5.0, None, 9.0, "B")],
                 line + ", proc_cd string, ndc_amt double, cpt_amt double, charged double, d1 string")
    rev = frame([(*key, 4.0, "A")], line + ", rev_amt double, d1 string")
    debit = frame([(*key, "P1", 3.0), (*key, "P2", 4.0)], line + ", proc_cd string, debit_cost double")
    icd = frame([("A", "ca"), ("B", "cb")], "diag_cd string, prefx_map_id string")
    got = {r.category: r for r in signals.category_cost_weights(proc, rev, debit, icd, ["d1"]).collect()}
    assert got["ca"].cpt_allowed == 7.0 and got["cb"].cpt_allowed == 7.0 and got["ca"].rev_allowed == 4.0
    assert got["ca"].weight_combined_allowed == pytest.approx(11 / 18.01)


def test_event_debit_defaults_to_zero(frame):
    groups = frame([("g", UW, 1.0), ("h", UW, 2.0)], "group_id string, underwriting_date date, risk_pfm double")
    events = frame([("g", UW, 0.25), ("g", UW, 0.5)], "group_id string, underwriting_date date, med_debit_rs double")
    assert {r.group_id: r.risk_pfm for r in signals.apply_event_debit(groups, events).collect()} == {"g": 1.75, "h": 2.0}
