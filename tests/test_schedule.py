"""J8, J10-J18 on inline rows (FIXTURES.md A, rows 8-17) and the as-of lookup
against a brute-force reference."""

import random

from conftest import d, rows, ts
from visitmart.functions import text
from visitmart.operators import asof, coverage, schedule

SCH = ("sch_id long, sch_set_id long, pat_id1 long, version int, app_dttm timestamp_ntz, "
       "create_dttm timestamp_ntz, edit_dttm timestamp_ntz, activity string, staff_id long, "
       "location long, notes string, schstatus_hist_sd string")


def test_visit_vitals_drugs(spark):
    sets = spark.createDataFrame([(1, d(2022, 9, 1)), (1, d(2022, 9, 2)), (1, d(2022, 9, 3)),
                                  (1, d(2022, 9, 4)), (1, d(2022, 9, 4)), (1, d(2022, 8, 1))],
                                 "pat_id1 long, appt_date date")
    pats = spark.createDataFrame([(1, "M1", "DOE, JO")], "pat_id1 long, ida string, pat_id1_name string")
    obs = spark.createDataFrame([(1, "Vital Signs", ts(2022, 9, 1, 8)), (1, "Vital Signs", ts(2022, 9, 1, 9)),
                                 (1, "Vital Signs", ts(2022, 9, 3, 8)), (1, "Labs", ts(2022, 9, 2, 8))],
                                "pat_id1 long, observation_bucket string, measurement_dttm timestamp_ntz")
    drugs = spark.createDataFrame([(1, ts(2022, 9, 2, 10)), (1, ts(2022, 9, 3, 10))],
                                  "pat_id1 long, adm_start_dttm timestamp_ntz")
    out = coverage.visit_vitals_drugs(sets, pats, obs, drugs, d(2022, 9, 1), "vital signs")
    assert rows(out, "appt_date", "Vitals_Date", "Drug_Date") == [
        (d(2022, 9, 1), d(2022, 9, 1), None),          # vitals only (two times, one row)
        (d(2022, 9, 2), None, d(2022, 9, 2)),          # drugs only
        (d(2022, 9, 3), d(2022, 9, 3), d(2022, 9, 3)),  # both
        (d(2022, 9, 4), None, None),                   # neither; duplicate set row once
    ]


def test_status_key_list(spark):
    keys = spark.createDataFrame([(1, ts(2020, 9, 30, 23, 59)), (1, ts(2020, 10, 1, 0, 0)),
                                  (2, ts(2022, 1, 1, 12, 0)), (3, ts(2022, 1, 1, 12, 1))],
                                 "pat_id1 long, app_dttm timestamp_ntz")
    out = schedule.cancels(keys, d(2020, 10, 1), ts(2022, 1, 1, 12, 0))
    assert [r.Pat_Id1 for r in out.collect()] == [2, 1]


def _bump_inputs(spark):
    sch = spark.createDataFrame([
        (1, 10, 7, 1, ts(2024, 1, 20, 9), None, ts(2023, 12, 30, 10), "Chemo, IV", 5, 99, None, "A"),
        (2, 10, 7, 0, ts(2024, 1, 20, 9), None, ts(2024, 1, 5, 10), "Chemo, IV", 5, 99, None, "A"),
        (3, 11, 7, 0, ts(2024, 1, 31, 10), None, ts(2024, 1, 2, 10), "Lab", 5, 99, None, "A"),  # after EOMONTH
        (4, 12, 8, 0, ts(2024, 1, 31, 0), None, ts(2024, 1, 3, 10), "Lab", None, 99, None, "A"),
        (5, 13, 8, 0, ts(2024, 1, 15, 0), None, ts(2024, 1, 3, 10), "Lab", 5, 98, None, "A"),  # other location
    ], SCH)
    patient = spark.createDataFrame([(7, 'DOE, "JJ"'), (8, "ROE, AL")], "pat_id1 long, pat_name string")
    ident = spark.createDataFrame([(7, "M,7"), (8, "M8")], "pat_id1 long, ida string")
    staff = spark.createDataFrame([(99, "Reschedule Desk", None), (98, "Clinic", None), (5, "Smith", "Ann ")],
                                  "staff_id long, last_name string, first_name string")
    return sch, patient, ident, staff


def test_bumps_literal_vs_chrono(spark):
    sch, patient, ident, staff = _bump_inputs(spark)
    lit = schedule.bumps(sch, patient, ident, staff, "reschedule desk", ts(2024, 1, 10))
    chrono = schedule.bumps(sch, patient, ident, staff, "reschedule desk", ts(2024, 1, 10), literal_min=False)
    got = rows(lit, "PATIENT", "MRN", "ACTIVITY", "PROVIDER", "EDIT_DATE", "APPT_DATE", "CALCULATED_DAYS")
    assert got == [
        ('"DOE, ""JJ"""', "M 7", "Chemo  IV", '"Ann Smith"', "01/05/2024", "01/20/2024", 21),
        ('"ROE, AL"', "M8", "Lab", '" "', "01/03/2024", "01/31/2024", 28),
    ]
    assert rows(chrono, "EDIT_DATE") == [("01/03/2024",), ("12/30/2023",)]
    last = schedule.bumps(sch, patient, ident, staff, "reschedule desk", ts(2024, 1, 10), include_last_day=True)
    assert last.count() == 3


def _two_week_inputs(spark):
    vw = spark.createDataFrame([
        (1, "M1", "DOE, JO", ts(2024, 1, 12, 9), "a1 ", "Smith", "Ann", 50, "s"),
        (2, "M2", "ROE, AL", ts(2024, 1, 12, 9), "A1", None, None, 50, None),      # unstaffed, NULL status: kept
        (3, "M3", "POE, ED", ts(2024, 1, 12, 9), "A1", "Smith", None, 50, "x "),   # cancelled in another spelling
        (4, "M4", "LOE, MO", ts(2024, 1, 24, 23), "A1", "INFUSION 2", "Chair", 50, "S"),
        (1, "M1", "DOE, JO", ts(2024, 1, 25, 0), "A1", "Smith", "Ann", 50, "S"),   # day 15
        (1, "M1", "DOE, JO", ts(2024, 1, 12, 9), "V1", "Smith", "Ann", 50, "S"),   # virtual
        (1, "M1", "DOE, JO", ts(2024, 1, 12, 9), "Z9", "Smith", "Ann", 50, "S"),   # no dictionary row
        (5, "M5", "NOE, NO", ts(2024, 1, 12, 9), "A1", "Smith", "Ann", 50, "S"),   # not valid
        (6, "M6", "HOE, HO", ts(2024, 1, 12, 9), "A1", "Smith", "Ann", 50, "S"),   # other race
    ], "pat_id1 long, ida string, pat_name string, app_dttm timestamp_ntz, activity string, stf_last_name string, "
       "stf_first_name string, attending_md_id long, sysdefstatus string")
    staff = spark.createDataFrame([(50, "Lee", "Kim")], "staff_id long, last_name string, first_name string")
    admin = spark.createDataFrame([(p, f"0000{p}") for p in (1, 2, 3, 5, 6)], "pat_id1 long, pat_postal string")
    cpt = spark.createDataFrame([("A1", "h", "c1", "Visit", "Visit"), ("V1", "h", "C1", "Video", "A Video visit")],
                                "hsp_code string, hsp_code3 string, cpt_code string, description string, short_desc string")
    buckets = spark.createDataFrame([("C1 ", "c", "group a")], "actv_code string, actv_class string, actv_bucket string")
    valid = spark.createDataFrame([(p, "N" if p == 5 else "y") for p in range(1, 7)], "pat_id1 long, is_valid string")
    race = spark.createDataFrame([(p, "Group Y" if p == 6 else "group x") for p in range(1, 7)], "pat_id1 long, race string")
    return vw, staff, admin, cpt, buckets, valid, race


def test_two_weeks(spark):
    out = schedule.outreach_two_weeks(*_two_week_inputs(spark), ts(2024, 1, 10, 15), ("Group X",), "Group A", "X", "video", "infusion")
    assert rows(out, "mrn", "provider", "pat_zip") == [
        ("M1", '"Smith, Ann"', "00001"), ("M2", '"Lee, Kim"', "00002"), ("M4", '"Lee, Kim"', None)]
    plain = schedule.outreach_two_weeks(*_two_week_inputs(spark), ts(2024, 1, 10, 15), ("Group X",), "Group A", "X", "video", "infusion",
                                        ordered=False)
    assert rows(out) == rows(plain)


def test_provider_resolution(spark):
    df = spark.createDataFrame([
        ("Infusion 2", "Chair", "Doe", "Jo"),       # infusion resource -> attending
        (None, None, "Doe", "Jo"),                  # no scheduled staff -> attending
        ("Smith", None, "Doe", "Jo"),               # first name missing -> ''
        ("Infusion", "Chair", None, None),          # attending missing -> ''
        (" Smith ", " Ann", None, None),
    ], "stf_last_name string, stf_first_name string, att_last string, att_first string")
    out = [r[0] for r in df.select(schedule.provider_resolution("infusion")).collect()]
    assert out == ['"Doe, Jo"', '"Doe, Jo"', "", "", '"Smith, Ann"']


def test_infusions_windows(spark):
    now = ts(2024, 1, 10, 18, 0)
    vw = spark.createDataFrame([
        (1, 1, "P1", now, now - F_hours(2), "Hydration", "x", "Infusion 1", 5, "Infusion"),
        (2, 1, "P1", ts(2024, 1, 16, 18, 0), now - F_hours(30), "Hydration", "x", "L", 5, "Infusion"),  # created too early
        (3, 1, "P1", ts(2024, 1, 16, 19, 0), now - F_hours(1), "Flush", "x", "L", 5, "INFUSION"),
        (4, 1, "P1", ts(2024, 1, 12, 18, 0), now - F_hours(1), "MEMO", "x", "L", 5, "Infusion"),
        (5, 1, "P1", ts(2024, 1, 12, 18, 0), now - F_hours(1), "Hydration", "x", "L", 6, "Infusion"),  # staff unknown
    ], "sch_id long, pat_id1 long, pat_name string, app_dttm timestamp_ntz, create_dttm timestamp_ntz, "
       "activity string, short_desc string, location_name string, staff_id long, stf_last_name string")
    staff = spark.createDataFrame([(5,)], "staff_id long")
    ident = spark.createDataFrame([(1, "M1")], "pat_id1 long, ida string")
    excl = (" Flush", "MEMO")
    addon = schedule.infusions(vw, staff, ident, now, "infusion", excl, 0, 6, True, 1)
    by_sch = schedule.infusions(vw.drop("create_dttm"), staff, ident, now, "infusion", excl, 0, 6, True, 1,
                                schedule=vw.select("sch_id", "app_dttm", "create_dttm"))
    assert rows(by_sch) == rows(addon)
    day7 = schedule.infusions(vw, staff, ident, now, "infusion", excl, 6, 7, False, None)
    assert rows(addon, "App_DtTm") == [(now,)]
    # 'Flush' is not excluded by ' Flush'
    assert rows(day7, "App_DtTm", "Activity") == [(ts(2024, 1, 16, 19, 0), "Flush")]


def F_hours(h):
    import datetime as dt
    return dt.timedelta(hours=h)


def test_one_week_self_join_pairs_sets(spark):
    now = ts(2024, 1, 10, 9, 0)
    sch = spark.createDataFrame([
        (1, 10, 7, 0, ts(2024, 1, 12, 9), ts(2024, 1, 1), ts(2024, 1, 2), "A1", 5, 99, "n", "S"),
        (2, 10, 7, 0, ts(2024, 1, 13, 9), ts(2024, 1, 3), ts(2024, 1, 4), "a1 ", 5, 99, "n", "F"),
        (3, 10, 7, 1, ts(2024, 1, 14, 9), ts(2024, 1, 5), ts(2024, 1, 6), "A1", 5, 99, "n", "S"),  # old version
        (4, 11, 7, 0, ts(2024, 1, 12, 9), ts(2024, 1, 1), ts(2024, 1, 2), "A1", 5, 99, "n", None),  # NULL status
        (5, 12, 7, 0, ts(2024, 1, 12, 9), ts(2024, 1, 1), ts(2024, 1, 2), "A1", 5, 99, "n", "x "),  # cancelled
        (6, 13, 7, 0, ts(2024, 1, 15, 9), ts(2024, 1, 1), ts(2024, 1, 2), "93", 5, 99, "n", "S"),   # no dictionary row
    ], SCH)
    staff = spark.createDataFrame([(99, "Clinic", None)], "staff_id long, last_name string, first_name string")
    cpt = spark.createDataFrame([("A1", "H3", "C1", "Visit", "Visit")],
                                "hsp_code string, hsp_code3 string, cpt_code string, description string, short_desc string")
    buckets = spark.createDataFrame([("C1", "c", "Group A")], "actv_code string, actv_class string, actv_bucket string")
    admin = spark.createDataFrame([(7, "F", "1 Main", "City", "ST", "87101", None, None, None, None, 1)],
                                  "pat_id1 long, gender string, pat_adr1 string, pat_city string, pat_state string, "
                                  "pat_postal string, pat_home_phone string, pat_work_phone string, "
                                  "pat_work_phone_ex string, pat_cellphone string, ethnicity_pro_id long")
    patient = spark.createDataFrame([(7, "DOE, JO")], "pat_id1 long, pat_name string")
    ident = spark.createDataFrame([(7, "M7", 70, 0), (7, "M7old", 71, 1)], "pat_id1 long, ida string, ident_id long, version int")
    prompt = spark.createDataFrame([(1, "Origin Q")], "pro_id long, description string")
    race = spark.createDataFrame([(7, "Other")], "pat_id1 long, race string")
    prov = spark.createDataFrame([(7, "Dr A")], "pat_id1 long, provider_name string")
    diag = spark.createDataFrame([(7, d(2020, 1, 1), "C50", "Breast")], "pat_id1 long, appt_date date, diag_code string, diag_desc string")
    vwp = spark.createDataFrame([(7, ts(1980, 1, 13))], "pat_id1 long, birth_dttm timestamp_ntz")
    out = schedule.outreach_one_week(sch, staff, cpt, buckets, admin, patient, ident, prompt, race, prov, diag,
                                     vwp, now, ("Group X",), ("origin q",), "X")
    got = rows(out, "App_DtTm", "Sch_Set_Id", "SchStatus_Hist_SD", "MRN", "Age")
    # set 10: one current row in the window with status S, paired with both current tips
    # (S and F); the status 'F' row itself is in the window too; the old version is out.
    # set 11: NULL status is dropped by NOT status = 'X'.
    assert got == [
        (ts(2024, 1, 12, 9), 10, "F", "M7", 43), (ts(2024, 1, 12, 9), 10, "S", "M7", 43),
        (ts(2024, 1, 13, 9), 10, "F", "M7", 44), (ts(2024, 1, 13, 9), 10, "S", "M7", 44),
        (ts(2024, 1, 15, 9), 13, "S", "M7", 44),
    ]
    # the dictionary's code, not the schedule's activity
    assert set(rows(out, "Sch_Set_Id", "CPT_Code", "Hsp_Code")) == {(10, "C1", "A1"), (13, None, None)}


def test_clinic_last_visit(spark):
    now = ts(2024, 3, 1, 8, 0)
    vw = spark.createDataFrame([
        (1, "A, A", ts(2024, 3, 2, 9), 31), (2, "B, B", ts(2024, 3, 3, 9), 31),
        (3, "C, C", ts(2024, 3, 4, 9), 31), (4, "D, D", ts(2024, 3, 5, 9), 31),
        (5, "E, E", ts(2024, 3, 15, 9), 31),   # day 14: outside the half-open window
        (1, "A, A", ts(2024, 3, 6, 9), 32),    # other location
    ], "pat_id1 long, pat_name string, app_dttm timestamp_ntz, location_id int")
    vwp = spark.createDataFrame([(p, f"M{p}", ts(1970, 1, 1)) for p in range(1, 6)],
                                "pat_id1 long, ida string, birth_dttm timestamp_ntz")
    sch = spark.createDataFrame([
        (1, 0, ts(2024, 3, 2, 7), " C"),          # same day only: not earlier
        (2, 0, ts(2024, 2, 1, 9), "X"),           # earlier but not completed
        (3, 0, ts(2024, 1, 1, 9), " C"), (3, 0, ts(2024, 2, 10, 9), "E"),   # two earlier
        (3, 1, ts(2024, 2, 20, 9), " C"),         # old version
        (4, 0, ts(2024, 2, 1, 9), "C"),           # status without the leading blank
    ], "pat_id1 long, version int, app_dttm timestamp_ntz, schstatus_hist_sd string")
    out = schedule.clinic_last_visit(vwp, vw, sch, now, 31, (" C", " D", "E"))
    assert rows(out, "IDA", "Last_Appt") == [("M1", None), ("M2", None), ("M3", d(2024, 2, 10)), ("M4", None)]


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    base = d(2024, 1, 1)
    import datetime as dt
    hist = [(rnd.randint(1, 6), base + dt.timedelta(days=rnd.randint(0, 60))) for _ in range(300)]
    hist += [(1, base + dt.timedelta(days=k)) for k in range(0, 60, 2)] * 20   # a hot key
    targ = [(rnd.randint(1, 7), base + dt.timedelta(days=rnd.randint(0, 70))) for _ in range(200)]
    h = spark.createDataFrame(hist, "pat_id1 long, day date")
    t = spark.createDataFrame(targ, "pat_id1 long, day date")
    got = {(r.pat_id1, r.day): r.last_day for r in asof.strict_backward_asof(t, h).collect()}
    want = {}
    for p, day in set(targ):
        prior = [x for q, x in hist if q == p and x < day]
        want[(p, day)] = max(prior) if prior else None
    assert got == want


def test_collation_in(spark):
    df = spark.createDataFrame([(" C",), ("C",), ("e ",), (None,)], "s string")
    assert [r.s for r in df.filter(text.in_ci("s", (" C", "E"))).collect()] == [" C", "e "]
