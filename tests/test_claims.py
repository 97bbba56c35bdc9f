import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimweave.config import DEFAULTS
from claimweave.operators import claims, coverage, targets

D = dt.date
CODES = "id int, rev string, proc string, ndc string, d1 string, d2 string"


@pytest.mark.parametrize(
    "row, want",
    [
        ((1, "R", "P", None, "A", "B"), [("md", "A"), ("md", "B"), ("mc", "P"), ("mr", "R")]),
        ((1, None, None, "N", None, ""), [("mc", None)]),
        ((1, "", "", "N", "A", "A"), [("mc", ""), ("md", "A"), ("md", "A")]),
        ((1, None, "", None, None, None), []),
    ],
)
def test_verticalize_shapes(frame, row, want):
    got = claims.verticalize(frame([row], CODES), "rev", "proc", "ndc", ["d1", "d2"])
    assert sorted(((r.datatype, r.value) for r in got.collect()), key=str) == sorted(want, key=str)


def test_verticalize_can_drop_repeated_codes(frame):
    got = claims.verticalize(frame([(1, None, "P", None, "A", "A")], CODES), "rev", "proc", "ndc", ["d1", "d2"], distinct_codes=True)
    assert sorted((r.datatype, r.value) for r in got.collect()) == [("mc", "P"), ("md", "A")]


def test_genetic_codes_before_categories(frame):
    rows = frame([("md", "G"), ("md", "A"), ("mc", "G"), ("mc", "X"), ("md", "Z")], "datatype string, value string")
    genetic = claims.genetic_list(frame([("G",)], "icd10 string"), frame([("X",)], "symp string"))
    plain = frame([("A", "hcup_a"), ("E", "")], "diag_cd string, prefx_map_id string")
    got = claims.replace_by_category(claims.replace_genetic(rows, genetic), plain)
    assert sorted(tuple(r) for r in got.collect()) == sorted(
        [("md", "hcup_unk"), ("md", "hcup_a"), ("mc", "G"), ("mc", "99999"), ("md", "hcup_unk")]
    )
    mapped = plain.unionByName(frame([("99999", "gen")], "diag_cd string, prefx_map_id string"))
    got = claims.replace_by_category(claims.replace_genetic(rows, genetic), mapped)
    assert ("md", "gen") in [tuple(r) for r in got.collect()]


def test_history_is_floored_at_zero(frame):
    got = claims.aggregate_history(frame([("a", -5.0), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, ag_allow_amt double"), ["k"])
    assert {tuple(r) for r in got.collect()} == {("a", 0.0), ("b", 0.0), ("c", 5.0)}


def test_filter_includes_both_ends_and_both_dates(frame):
    lo, hi = D(2016, 1, 1), D(2016, 12, 31)
    rows = [("EM", lo, hi), ("LV", lo, D(2017, 1, 1)), ("XX", lo, lo), (None, lo, lo), ("EM", None, lo)]
    got = claims.filter_dates_and_platforms(frame(rows, "p string, a date, b date"), "p", ["a", "b"], lo, hi)
    assert [tuple(r) for r in got.collect()] == [("EM", lo, hi)]


def test_rx_amounts(frame):
    prices = frame([("N", 2.0, 3.0)], "ndc_id string, allowed_per_unit double, serv_unit_cnt_max double")
    rows = [(1, "N", None, 5.0, 100.0), (2, "N", 4.0, 5.0, 100.0), (3, "Z", None, 5.0, 100.0), (4, "N", 400.0, 5.0, 100.0)]
    got = claims.rx_priced(
        frame(rows, "id int, ndc_id string, rx_cost double, payable_metric_cnt double, wac_ingrd_cost_amt double"), prices
    )
    assert {r.id: r.ag_allow_amt for r in got.collect()} == {1: 6.0, 2: 4.0, 3: 0.0, 4: 100.0}


def spans(frame, rows):
    return frame(rows, "sdr_person_id string, src_cust_id string, src_platform_cd string, cov_eff_date date, cov_end_date date, rel_type_cd string")


def test_collapse_coverage(frame):
    rows = [
        ("m", "a", "EM", D(2017, 1, 1), D(2017, 12, 31), "01"), ("m", "a", "LV", D(2016, 1, 1), D(2016, 12, 31), "18"),
        ("m", "a", "XX", D(2010, 1, 1), D(2030, 12, 31), "18"),
    ]
    got = [tuple(r) for r in coverage.collapse_coverage(spans(frame, rows)).collect()]
    assert got == [("m", "a", D(2016, 1, 1), D(2017, 12, 31), 1)]


def test_continuous_span_covers_all_accounts_of_a_group(frame):
    rows = frame(
        [("g", "a", "m", D(2017, 1, 1), D(2017, 6, 30), 0), ("g", "b", "m", D(2017, 7, 1), D(2018, 6, 30), 1)],
        "src_rpt_cust_id string, src_cust_id string, sdr_person_id string, cov_eff_date date, cov_end_date date, subscriber_flag int",
    )
    got = coverage.continuous_span(rows).collect()
    assert {(r.src_cust_id, r.cov_eff_date, r.cov_end_date, r.subscriber_flag) for r in got} == {
        ("a", D(2017, 1, 1), D(2018, 6, 30), 1), ("b", D(2017, 1, 1), D(2018, 6, 30), 1),
    }


def test_eligibility_edges(frame):
    eff = D(2018, 1, 1)
    rows = [
        ("m1", eff, D(2019, 1, 1), D(2019, 12, 31)), ("m2", eff, D(2019, 1, 2), D(2019, 12, 31)),
        ("m3", eff, D(2017, 1, 1), eff), ("m4", eff, D(2017, 1, 1), D(2017, 12, 31)), ("", eff, eff, D(2018, 12, 31)),
    ]
    got = coverage.eligible(frame(rows, "sdr_person_id string, effective_date date, cov_eff_date date, cov_end_date date"))
    assert sorted(r.sdr_person_id for r in got.collect()) == ["m1", "m3"]


def test_factor_is_compared_as_a_number(frame):
    factors = frame([("F", "1", "30", "31", "9.5"), ("F", "1", "31", "32", "10.2")],
                    "sex_cd string, subscriber_ind string, min_mbr_age string, max_mbr_age string, age_gender_factor string")
    got = {r.age: r.age_gender_factor for r in coverage.factor_by_age(factors).collect()}
    assert got == {30: 9.5, 31: 10.2, 32: 10.2}


def tiny_coverage(frame):
    crosswalk = frame([("a", "g", D(2018, 1, 1))], "src_cust_id string, src_rpt_cust_id string, effective_date date")
    rows = [
        ("m1", "a", "EM", D(2016, 1, 1), D(2018, 12, 31), "18"),  # 12 months, quoted
        ("m2", "a", "EM", D(2016, 1, 1), D(2018, 6, 30), "01"),  # 6 months: too short
        ("m3", "a", "EM", D(2018, 2, 1), D(2018, 12, 31), "01"),  # starts later: not quoted, no history
    ]
    person = frame([(m, "EM", "F", D(1980, 1, 1)) for m in ("m1", "m2", "m3")],
                   "sdr_person_id string, src_platform_cd string, sex_cd string, birth_date date")
    factors = frame([("F", 1, 0, 99, 2.0), ("F", 0, 0, 99, 1.0)],
                    "sex_cd string, subscriber_ind int, min_mbr_age int, max_mbr_age int, age_gender_factor double")
    return coverage.member_coverage(crosswalk, spans(frame, rows), person, factors, DEFAULTS)


def test_member_coverage_end_to_end(frame):
    got = {r.sdr_person_id: r for r in tiny_coverage(frame).collect()}
    assert set(got) == {"m1", "m3"}
    assert got["m1"].total_members == 3 and got["m1"].quoted_members == 2 and got["m1"].quoted_pfm_rel == 1.5
    assert (got["m1"].hist_mths_avail, got["m1"].cov_months_medical, got["m1"].member_level_incl) == (21, 12, 1)
    assert (got["m3"].hist_mths_avail, got["m3"].cov_months_medical, got["m3"].member_level_incl) == (0, 11, 0)


def test_history_and_targets_end_to_end(frame):
    members = tiny_coverage(frame)
    med = frame(
        [
            (1, "m1", "a", "EM", D(2017, 9, 5), D(2017, 9, 9), 50.0, 40.0, 2.0, None, "P", "A"),
            (2, "m1", "a", "EM", D(2018, 3, 5), D(2018, 3, 9), 50.0, 40.0, 2.0, "R", None, "A"),
            (3, "m3", "a", "EM", D(2017, 9, 5), D(2017, 9, 9), 50.0, 40.0, 2.0, None, "P", "A"),
        ],
        "medclm_key int, sdr_person_id string, src_cust_id string, src_clm_platform_cd string, serv_from_date date, load_date date,"
        "chrg_amt double, allow_icob_amt double, serv_unit_cnt double, revenue_cd string, hcpcs_cpt4_base_cd1 string, primary_diag_cd string",
    )
    lines = frame([(1, None, "B")], "medclm_key int, ndc_id string, diag_cd2 string")
    price = "allowed_per_unit double, serv_unit_cnt_max double"
    ndc = frame([("N", 1.0, 1.0)], "ndc_id string," + price)
    rev = frame([("R", 7.0, 9.0)], "revenue_cd string," + price)
    cpt = frame([("P", 3.0, 9.0)], "hcpcs_cpt4_base_cd1 string," + price)
    genetic = claims.genetic_list(frame([("B",)], "icd10 string"), frame([("Q",)], "symp string"))
    icd = frame([("A", "hcup_a")], "diag_cd string, prefx_map_id string")
    got = claims.med_history(med, lines, members, ndc, rev, cpt, genetic, icd)
    assert sorted((r.sdr_person_id, r.times, r.med_sample, r.datatype, r.value, r.ag_allow_amt) for r in got.collect()) == [
        ("m1", 1, "o", "mc", "P", 6.0), ("m1", 1, "o", "md", "hcup_a", 0.0), ("m1", 1, "o", "md", "hcup_unk", 0.0),
    ]
    goal = claims.med_target(med, lines, members, ndc, rev, cpt).collect()
    assert [(r.sdr_person_id, r.total_med_ag_allow_amt, r.total_med_allow_amt) for r in goal] == [("m1", 14.0, 40.0)]


def both_targets(frame):
    extra = ", ".join(f"{{p}}_{c} int" for c in claims.PERIPHERAL)
    keys = "src_rpt_cust_id string, sdr_person_id string, underwriting_date date, effective_date date, "
    sums = "total_{p}_ag_allow_amt double, total_{p}_allow_amt double, "
    k = ("g", D(2017, 10, 1), D(2018, 1, 1))
    row = lambda m, a, b: (k[0], m, k[1], k[2], a, b, 10, 5, 9, 8, 1, 1, 1)
    med = frame([row("both", 100.0, 50.0), row("med", 30.0, None)], keys + (sums + extra).format(p="med"))
    rx = frame([row("both", 20.0, 10.0), row("rx", 40.0, 40.0)], keys + (sums + extra).format(p="rx"))
    return targets.target(med, rx)


def test_target_keeps_members_with_one_source(frame):
    got = {r.sdr_person_id: (r.mbr_mth_ag_cmpl_allow, r.mbr_mth_allow_icob_amt, r.total_members) for r in both_targets(frame).collect()}
    assert got == {"both": (12.0, 6.0, 9), "med": (3.0, 0.0, 9), "rx": (4.0, 4.0, 9)}


def test_group_means_are_weighted_by_months(frame):
    info = frame([("g", D(2018, 1, 1), "train", None, 1, 0, "S")],
                 "src_rpt_cust_id string, effective_date date, train_subpartition string, comm_rt int, lf_group int, aso_group int, bus_segment_cd string")
    got = targets.customer_data(both_targets(frame), targets.customer_info(info)).first()
    assert got.total_member_months == 30 and got.agnostic_claims_pmpm == pytest.approx(19 / 3) and got.comm_rt == 0


def test_missing_rate_is_zero(frame):
    keys = "src_rpt_cust_id string, sdr_person_id string, underwriting_date date"
    members = frame([("g", "a", D(2018, 1, 1)), ("g", "b", D(2018, 1, 1))], keys)
    rates = frame([("g", "a", D(2018, 1, 1), 5.0)], keys + ", rate_calibrated double")
    assert {r.sdr_person_id: r.rate_calibrated for r in targets.attach_rate(members, rates).collect()} == {"a": 5.0, "b": 0.0}
