"""J19/J20 and R9 on inline rows (FIXTURES.md A, rows 18-19)."""

from conftest import rows, ts
from visitmart.operators import volumes
from visitmart.params import VolumeSpec

VIS = ("pat_id1 long, patient_name string, pat_mrn string, appt_dt string, is_telemed string, "
       "prov_name_last_mq string, prov_name_first_mq string, prov_specialty_type_mq string, "
       "actv_code_desc string, actv_desc string, sch_status_prim string, fy int")


def _inputs(spark):
    visits = spark.createDataFrame([
        (1, 'DOE, "JJ"', "M1", "20220105", "N", "Smith", None, "Rad-Onc Main", "Sim", "Sim, plan", "C", 2022),
        (1, 'DOE, "JJ"', "M1", "20220105", "N", "Smith", None, "Rad-Onc Main", "Sim", "Sim, plan", "C", 2022),
        (2, "ROE, AL", "M2", "20200105", "Y", "Jones", "Pat", "rad-onc", "Sim", "Sim", "C", 2020),   # old FY
        (3, "POE, ED", "M3", "20230301", "Y", "Jones", "Pat", "Breast", "NP", "New", "C", 2023),
    ], VIS)
    admin = spark.createDataFrame([(1, "87101", 7, None, None, None), (2, "87102", None, "F", 1, 10),
                                   (3, "87103", 8, "M", 2, 11)],
                                  "pat_id1 long, pat_postal string, ethnicity_pro_id long, gender string, "
                                  "ref_fac_id long, ref_md_id long")
    vwp = spark.createDataFrame([(p, ts(1970, 5, 6)) for p in (1, 2, 3)], "pat_id1 long, birth_dttm timestamp_ntz")
    prompt = spark.createDataFrame([(7, "Hispanic")], "pro_id long, description string")
    race = spark.createDataFrame([(1, "Other")], "pat_id1 long, race string")
    fac = spark.createDataFrame([(2, "North Clinic")], "fac_id long, name string")
    ext = spark.createDataFrame([(11, None, "Lee  ")], "pnp_id long, first_name string, last_name string")
    return visits, admin, vwp, prompt, race, fac, ext


def test_prefix_match_quoted_activity_gender_blank(spark):
    visits, admin, vwp, prompt, race, _, _ = _inputs(spark)
    spec = VolumeSpec("Rad-Onc", 2021, match="prefix", activity_col="actv_desc", quote_activity=True,
                      gender="blank")
    out = volumes.specialty_volumes(visits, volumes.patient_profile(admin, vwp, race), prompt, spec)
    got = rows(out, "MRN", "DOB", "patient_name", "Provider", "actv_desc", "Race", "Ethnicity", "Gender")
    # duplicate visit rows collapse; NULL first name -> 'Smith; '; NULL gender -> ' '
    assert got == [("M1", "19700506", '"DOE, ""JJ"""', "Smith; ", '"Sim, plan"', "Other", "Hispanic", " ")]


def test_exact_match_keeps_null_gender(spark):
    visits, admin, vwp, prompt, race, _, _ = _inputs(spark)
    out = volumes.specialty_volumes(visits, volumes.patient_profile(admin, vwp, race), prompt, VolumeSpec("breast", 2021, gender="keep"))
    assert rows(out, "MRN", "Race", "Ethnicity", "gender") == [("M3", " ", " ", "M")]


def test_referral_columns(spark):
    visits, admin, vwp, prompt, race, fac, ext = _inputs(spark)
    spec = VolumeSpec("Breast", 2020, referral=True)
    out = volumes.specialty_volumes(visits, volumes.patient_profile(admin, vwp, race), prompt, spec, fac, ext)
    # first name missing -> ' Lee'; facility found
    assert rows(out, "MRN", "ReferringMD", "ReferringFacility") == [("M3", " Lee", "North Clinic")]
    spec2 = VolumeSpec("Rad-Onc", 2019, match="prefix", referral=True)
    out2 = volumes.specialty_volumes(visits, volumes.patient_profile(admin, vwp, race), prompt, spec2, fac, ext)
    # no referral at all -> a single blank; unknown doctor id -> a single blank
    assert rows(out2, "MRN", "ReferringMD", "ReferringFacility") == [("M1", " ", None), ("M2", " ", None)]


def test_binding_profile_equals_the_joined_one(spark):
    import os

    from visitmart.plans.bindings import Bound
    sf = "/root/testdata/sf0.001"
    if os.path.isdir(sf):
        b = Bound.of(spark, sf)
        cols = b.patient_profile.columns
        joined = volumes.patient_profile(b.admin, b.vw_patient, b.patient_race)
        assert sorted(map(str, b.patient_profile.collect())) == sorted(map(str, joined.select(*cols).collect()))
