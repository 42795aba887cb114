"""J1-J7 on inline rows (FIXTURES.md A, rows 1-7)."""

import pytest

from conftest import d, rows, ts
from visitmart.operators import cohort

VIS = ("pat_id1 long, patient_name string, pat_mrn string, appt_dt string, appt_date date, "
       "actv_code string")


def visit(pat, day, code):
    return (pat, f"P{pat}", f"M{pat}", day.strftime("%Y%m%d"), day, code)


@pytest.fixture()
def chain(spark):
    diag = spark.createDataFrame([
        (1, d(2022, 1, 5), "K70.1"),
        (2, d(2021, 12, 1), "K70.2"), (2, d(2022, 2, 1), "K70.2"),   # first event before window
        (3, d(2022, 3, 1), "k70.3"),                                   # lower case code
        (4, d(2022, 4, 1), "K70.4"),
        (5, d(2022, 5, 1), "K70.5"),
        (6, d(2022, 5, 2), "K70.6"),
        (7, d(2022, 5, 3), "K71.0"),                                   # outside the code range
        (8, d(2022, 6, 1), "K70.8"),
        (9, d(2022, 6, 2), "K70.9"),
    ], "pat_id1 long, appt_date date, diag_code string")
    visits = spark.createDataFrame([
        visit(1, d(2022, 1, 5), "NP"),                                 # upper-case new-patient code
        visit(2, d(2022, 2, 1), "np"),
        visit(3, d(2022, 3, 1), "gc"), visit(3, d(2022, 3, 1), None),  # NULL code: in neither
        visit(4, d(2022, 4, 1), "np"), visit(4, d(2022, 4, 1), "gc"),  # in J2, so not in J3
        visit(5, d(2022, 5, 1), "gc"), visit(5, d(2022, 6, 1), "fu"),  # two visits
        visit(6, d(2022, 5, 2), "gc"), visit(6, d(2022, 5, 2), "fu"),  # two same-day rows
        visit(8, d(2022, 6, 1), "np"),
        visit(9, d(2022, 6, 2), "np"),
    ], VIS)
    earliest = cohort.first_event_cohort(diag, "K70.0", "K70.99", d(2022, 1, 1), d(2022, 8, 20))
    summary = cohort.cohort_visit_summary(visits, earliest, d(2022, 1, 1), d(2022, 8, 20), d(2022, 1, 1), d(2022, 8, 20))
    first_day = cohort.first_day_visits(summary)
    np_ = cohort.new_patient_cohort(first_day, "np")
    nd = cohort.existing_patient_cohort(first_day, "np", np_)
    return diag, visits, earliest, np_, nd


def test_summary_counts_match_row_counts(spark, chain):
    diag, visits, earliest, _, nd = chain
    summary = cohort.cohort_visit_summary(visits, earliest, d(2022, 1, 1), d(2022, 8, 20), d(2022, 1, 1), d(2022, 8, 20))
    counts = dict(rows(cohort.window_visit_counts(summary)))
    assert counts == {1: 1, 3: 2, 4: 2, 5: 2, 6: 2, 8: 1, 9: 1}
    direct = cohort.single_visit_patients(nd, visits, d(2022, 1, 1), d(2022, 8, 20))
    via = cohort.single_visits_from_counts(nd, cohort.window_visit_counts(summary))
    assert rows(direct) == rows(via)


def test_first_event_min_over_all_history(chain):
    _, _, earliest, _, _ = chain
    assert rows(earliest, "pat_id1") == [(1,), (3,), (4,), (5,), (6,), (8,), (9,)]


def test_new_and_existing_are_disjoint(chain):
    _, _, _, np_, nd = chain
    assert rows(np_, "pat_id1", "np_ind") == [(1, "Y"), (4, "Y"), (8, "Y"), (9, "Y")]
    assert rows(nd, "pat_id1", "np_ind") == [(3, "N"), (5, "N"), (6, "N")]


def test_single_visit_counts_pairs(chain):
    _, visits, _, _, nd = chain
    single = cohort.single_visit_patients(nd, visits, d(2022, 1, 1), d(2022, 8, 20))
    # 3 has two visit rows that day (one with a NULL code), 5 has two
    # visits and 6 two same-day rows: every patient has two pairs.
    assert dict(rows(single, "pat_id1", "numb_times")) == {}


def test_single_visit_one_row(spark, chain):
    _, visits, _, _, nd = chain
    only = visits.filter("pat_id1 != 3 OR actv_code IS NOT NULL")
    single = cohort.single_visit_patients(nd, only, d(2022, 1, 1), d(2022, 8, 20))
    assert rows(single, "pat_id1", "numb_times") == [(3, 1)]
    review = cohort.single_visit_review(only, single)
    assert [r.pat_id1 for r in review.collect()] == [3]


def test_union_exclusion_binds_to_second_branch(chain):
    _, _, _, np_, nd = chain
    u = cohort.cohort_union(np_, nd, excluded_ids=(1, 3))
    assert [r[0] for r in rows(u, "pat_id1")] == [1, 4, 5, 6, 8, 9]


def test_mailing_list_suppression(spark, chain):
    _, _, _, np_, nd = chain
    u = cohort.cohort_union(np_, nd, excluded_ids=(1, 3))
    admin = spark.createDataFrame([
        (1, None, None, None, None),
        (4, "1 Main", "HomeLess shelter", None, 7),
        (5, "2 Main", None, None, 7),
        (6, "3 Main", None, None, 7),
        (8, "4 Main", None, None, 7),
        (9, "5 Main", None, ts(2022, 7, 1), 7),
    ], "pat_id1 long, pat_adr1 string, pat_adr2 string, expired_dttm timestamp_ntz, language_pro_id long")
    for c in ("pat_city", "pat_state", "pat_postal", "pat_home_phone", "pat_email", "pat_cellphone", "gender"):
        admin = admin.withColumn(c, admin.pat_adr1)
    patient = spark.createDataFrame([(p, "Mx.") for p in (1, 4, 5, 6, 8, 9)], "pat_id1 long, salutation string")
    ident = spark.createDataFrame([(1, None), (4, ""), (5, None), (6, " "), (8, "D"), (9, None)],
                                  "pat_id1 long, idc string")
    patlog = spark.createDataFrame([
        (4, 5, ts(2021, 1, 1)),          # inactivated inmate: not an inmate
        (5, 5, None), (5, 5, None),     # two active rows
        (6, 6, None),                    # other class
    ], "pat_id1 long, plc_id int, inactive_dttm timestamp_ntz")
    prompt = spark.createDataFrame([(7, "Spanish")], "pro_id long, description string")
    out = cohort.mailing_list(u, admin, patient, ident, patlog, prompt, ts(2022, 9, 1, 8, 0), 5)
    got = rows(out, "pat_id1", "LanguageSpoken", "np_ind")
    assert got == [(1, None, "Y"), (6, "Spanish", "N")]
    assert {r.Extract_Date for r in out.collect()} == {ts(2022, 9, 1, 8, 0)}
