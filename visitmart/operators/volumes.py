"""Specialty visit volumes (J19) and volumes with referral source.

One parameterised operator covers the per-specialty extracts: they differ
only in the specialty predicate (equality or prefix), the activity column
(plain or quoted), an optional gender column (NULL kept or NULL to blank)
and the referral columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_ci, eq_ci, null_safe_concat, quote_name, startswith_ci
from ..functions.timewin import fmt_ymd_compact
from ..params import VolumeSpec


def specialty_predicate(spec: VolumeSpec):
    col = "prov_specialty_type_mq"
    if spec.match == "prefix":
        return startswith_ci(col, spec.specialty)
    if spec.match == "eq":
        return eq_ci(col, spec.specialty)
    raise ValueError(f"unknown match {spec.match!r}")


def referring_md(first: str = "ref_first", last: str = "ref_last"):
    """``RTRIM(ISNULL(first,'')) + ' ' + RTRIM(ISNULL(last,''))``.

    A single blank when both names are missing.
    """
    return F.concat(F.rtrim(F.coalesce(F.col(first), F.lit(""))), F.lit(" "),
                    F.rtrim(F.coalesce(F.col(last), F.lit(""))))


def patient_profile(admin: DataFrame, vw_patient: DataFrame, patient_race: DataFrame) -> DataFrame:
    """What the volumes read of a patient: contact row, birth time, race if any."""
    return (admin.select("pat_id1", "pat_postal", "ethnicity_pro_id", "gender", "ref_fac_id", "ref_md_id")
            .join(vw_patient.select("pat_id1", "birth_dttm"), "pat_id1")
            .join(patient_race.select("pat_id1", "race"), "pat_id1", "left"))


def specialty_volumes(visits: DataFrame, profile: DataFrame, prompt: DataFrame, spec: VolumeSpec,
                      facility: DataFrame | None = None,
                      external: DataFrame | None = None) -> DataFrame:
    """J19/J20. ``profile`` is ``patient_profile`` or a curated table of its columns:
    the visits meet the patients in one join. ``spec.day_from``, where known,
    repeats the fiscal-year bound on the visit day, which reaches the scan."""
    v = visits.filter((F.col("fy") >= spec.fy_from) & specialty_predicate(spec))
    if spec.day_from is not None:
        v = v.filter(F.col("appt_date") >= F.lit(spec.day_from))
    cols = ["pat_id1", "pat_postal", "ethnicity_pro_id", "gender", "birth_dttm", "race"]
    if spec.referral:
        cols += ["ref_fac_id", "ref_md_id"]
    j = (v.join(profile.select(*cols), "pat_id1")
          .join(prompt.select(F.col("pro_id").alias("ethnicity_pro_id"),
                              F.col("description").alias("ethnicity")), "ethnicity_pro_id", "left"))
    if spec.referral:
        if facility is None or external is None:
            raise ValueError("referral volumes need facility and external inputs")
        j = (j.join(facility.select(F.col("fac_id").alias("ref_fac_id"),
                                    F.col("name").alias("ReferringFacility")), "ref_fac_id", "left")
              .join(external.select(F.col("pnp_id").alias("ref_md_id"),
                                    F.col("first_name").alias("ref_first"),
                                    F.col("last_name").alias("ref_last")), "ref_md_id", "left"))
    activity = (quote_name(spec.activity_col).alias(spec.activity_col) if spec.quote_activity
                else F.col(spec.activity_col))
    cols = [
        F.col("pat_mrn").alias("MRN"),
        fmt_ymd_compact("birth_dttm").alias("DOB"),
        quote_name("patient_name").alias("patient_name"),
        "appt_dt",
        F.col("is_telemed").alias("is_TeleMed"),
        null_safe_concat(F.col("prov_name_last_mq"), "; ", F.col("prov_name_first_mq")).alias("Provider"),
        activity,
        F.col("sch_status_prim").alias("sch_Status_Prim"),
        F.col("fy").alias("FY"),
        "pat_postal",
        F.coalesce(F.col("race"), F.lit(" ")).alias("Race"),
        F.coalesce(F.col("ethnicity"), F.lit(" ")).alias("Ethnicity"),
    ]
    if spec.gender == "keep":
        cols.append(F.col("gender"))
    elif spec.gender == "blank":
        cols.append(F.coalesce(F.col("gender"), F.lit(" ")).alias("Gender"))
    if spec.referral:
        cols += [referring_md().alias("ReferringMD"), "ReferringFacility"]
    return distinct_ci(j.select(*cols))
