"""Schedule extracts: cancellations, no-shows, monthly totals, reschedule
bumps, outreach lists, infusion lists and the clinic list (J10-J18).

Inputs follow ``plans.bindings``: ``schedule`` (one row per appointment
version), ``vw_schedule`` (schedule with patient, staff and location texts),
and the patient-level lookups. "Now" is the explicit ``as_of`` argument.

Plan notes:
* every time window is a range on the raw timestamp column, so it reaches
  the parquet scan as a pushed filter;
* dictionary chains (activity -> code -> bucket) are filtered and joined
  among themselves first, so the fact side meets one pre-filtered lookup;
* the schedule self-join of the one-week list deduplicates both sides per
  set before joining, so only result rows are produced;
* the lists are presented in order; ``ordered=False`` leaves that sort out where
  the rows go to a load.

Text compares, joins and list checks fold case and trailing blanks, as the
source's collation does. ``DISTINCT`` and grouping keep the text as it is: two
spellings stay two rows, where the source would show one of them at random.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (comma_to_space, contains_ci, distinct_ci, eq_ci, fold, fold_literal, group_ci, in_ci,
                              not_in_ci, quote_name, startswith_ci)
from ..functions.timewin import (age_years, as_date, as_datetime, before_day, day_diff, day_window_half_open, ts_literal,
                                 day_window_inclusive, fmt_mdy, month_to_date,
                                 on_or_after_day, rolling_window)
from .asof import strict_backward_asof
from .keyfilter import cut_to_keys


def _now(as_of):
    return ts_literal(as_of)


def _sorted(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if ordered else df


def for_keys(dim: DataFrame, rows: DataFrame, key: str = "pat_id1") -> DataFrame:
    """The dimension rows whose key occurs in ``rows`` (a semi-join).

    A left join from a small slice (a week of appointments) to a large
    dimension can only broadcast the dimension side, so the whole dimension
    would be shuffled. Semi-joining the dimension to the slice's distinct
    keys first lets the runtime broadcast the key set when it is measured
    small and filter the dimension where it is read.
    """
    return dim.join(rows.select(key).distinct(), key, "left_semi")


# -- J10 / J11 ---------------------------------------------------------------

def status_key_list(keys: DataFrame, since: dt.date, as_of, ordered: bool = True) -> DataFrame:
    """Keys with appointment time from ``since`` up to now, newest first."""
    out = (keys.filter(on_or_after_day("app_dttm", since) & (F.col("app_dttm") <= _now(as_of)))
               .select(F.col("pat_id1").alias("Pat_Id1"), F.col("app_dttm").alias("App_DtTm")))
    return _sorted(out, ordered, F.col("App_DtTm").desc())


cancels = status_key_list
no_shows = status_key_list


# -- J12 ---------------------------------------------------------------------

def monthly_appt_total(vw_schedule: DataFrame, as_of, excluded_activities=(), excluded_dept=None,
                       excluded_names=(), include_last_day: bool = False) -> DataFrame:
    """Appointments this month, minus listed activities, one department
    and named test patients; one row with the run date.

    ``DEPT NOT LIKE 'X'`` has no wildcard, so it is an inequality (NULL drops).
    """
    f = month_to_date("app_dttm", as_of, include_last_day) & not_in_ci("activity", excluded_activities)
    if excluded_dept is not None:
        f = f & (fold("dept") != F.lit(fold_literal(excluded_dept)))
    if excluded_names:
        f = f & not_in_ci("pat_name", excluded_names)
    return vw_schedule.filter(f).agg(
        F.count(F.lit(1)).alias("TotalMoAppts"),
        F.lit(as_date(as_of)).alias("runDate"))


# -- J13 ---------------------------------------------------------------------

def bumps(schedule: DataFrame, patient: DataFrame, ident: DataFrame, staff: DataFrame,
          location_name: str, as_of, literal_min: bool = True,
          include_last_day: bool = False, keep=lambda df: df, ordered: bool = True) -> DataFrame:
    """Per appointment at the reschedule location this month, the
    earliest edit, the appointment day and the days between.

    ``literal_min=True`` keeps the source's ``MIN`` over ``MM/dd/yyyy``
    text (12/30 of one year beats 01/05 of the next); the day count always
    uses the true earliest edit. Deleted versions are included on purpose.
    The month's rows at the location are small; ``keep`` (a temp table in
    production) holds them so the patient and staff dimensions can be cut
    to their keys before the left joins. Spellings of an activity or a name that
    differ in case or trailing blanks are one group, with one earliest edit.
    """
    loc = staff.filter(eq_ci("last_name", location_name)).select(F.col("staff_id").alias("location"))
    base = keep(schedule.filter(month_to_date("app_dttm", as_of, include_last_day))
                        .join(loc, "location", "left_semi"))
    pats = for_keys(patient, base).select("pat_id1", F.col("pat_name").alias("pname"),
                                          F.col("pat_id1").alias("pat_key"))
    idn = for_keys(ident, base).select(F.col("pat_id1").alias("pat_key"), "ida")
    prov = for_keys(staff, base, "staff_id").select("staff_id", F.col("first_name").alias("prov_first"),
                                                    F.col("last_name").alias("prov_last"))
    s = (base.join(pats, "pat_id1", "left")
             .join(idn, "pat_key", "left")
             .join(prov, "staff_id", "left"))
    g = group_ci(s, ["app_dttm", "pat_key", "ida", "activity", "prov_first", "prov_last", "pname"],
                 F.min(fmt_mdy("edit_dttm")).alias("min_edit_text"), F.min("edit_dttm").alias("min_edit"))
    provider = F.concat(F.rtrim(F.coalesce("prov_first", F.lit(""))), F.lit(" "),
                        F.rtrim(F.coalesce("prov_last", F.lit(""))))
    edit = F.col("min_edit_text") if literal_min else fmt_mdy("min_edit")
    out = distinct_ci(g.select(
        quote_name(F.coalesce("pname", F.lit(""))).alias("PATIENT"),
        comma_to_space("ida").alias("MRN"),
        comma_to_space("activity").alias("ACTIVITY"),
        quote_name(comma_to_space(provider)).alias("PROVIDER"),
        edit.alias("EDIT_DATE"),
        fmt_mdy("app_dttm").alias("APPT_DATE"),
        day_diff("min_edit", "app_dttm").alias("CALCULATED_DAYS"),
    ))
    return _sorted(out, ordered, "APPT_DATE", "MRN")


# -- activity dictionary -------------------------------------------------------

def activity_lookup(cpt: DataFrame, buckets: DataFrame) -> DataFrame:
    """Activity -> code -> bucket, joined among the dictionaries first.

    ``act_key`` is the folded activity code that the schedule's folded activity
    meets; the keys are folded once per dictionary.
    """
    b = buckets.select(fold("actv_code").alias("_code"), "actv_class", "actv_bucket")
    return (cpt.join(b, fold("cpt_code") == F.col("_code"), "left").drop("_code")
               .withColumn("act_key", fold("hsp_code")))


# -- J14 ---------------------------------------------------------------------

def provider_resolution(infusion_prefix: str):
    """The attending when the scheduled staff is an infusion resource or
    missing, else the scheduled staff; "LAST, FIRST" quoted, '' when NULL."""
    attending = F.coalesce(quote_name(F.concat(F.trim(F.col("att_last")), F.lit(", "),
                                               F.trim(F.col("att_first")))), F.lit(""))
    scheduled = F.coalesce(quote_name(F.concat(F.trim(F.col("stf_last_name")), F.lit(", "),
                                               F.trim(F.col("stf_first_name")))), F.lit(""))
    return (F.when(startswith_ci("stf_last_name", infusion_prefix), attending)
             .when(F.col("stf_last_name").isNull(), attending)
             .otherwise(scheduled))


def outreach_two_weeks(vw_schedule: DataFrame, staff: DataFrame, admin: DataFrame, cpt: DataFrame,
                       buckets: DataFrame, ref_patients: DataFrame, patient_race: DataFrame,
                       as_of, races, bucket: str, cancel_code: str, virtual_word: str,
                       infusion_prefix: str, days: int = 14, keep=lambda df: df, ordered: bool = True) -> DataFrame:
    """Valid patients of listed races with a non-cancelled, non-virtual
    physician visit in [today, today + days], with the resolved provider.

    ``keep`` (a temp table in production) holds the two weeks' rows, so that the
    patient and staff dimensions are cut to their keys before the joins.
    """
    acts = (activity_lookup(cpt, buckets)
            .filter(eq_ci("actv_bucket", bucket) & ~contains_ci("short_desc", virtual_word))
            .select("act_key"))
    not_cancelled = not_in_ci("sysdefstatus", [cancel_code]) | F.col("sysdefstatus").isNull()
    s = keep(vw_schedule.filter(day_window_inclusive("app_dttm", as_of, days) & not_cancelled)
                        .join(acts, fold("activity") == F.col("act_key"), "left_semi"))
    valid = for_keys(ref_patients.filter(eq_ci("is_valid", "Y")), s).select("pat_id1")
    race = for_keys(patient_race.filter(in_ci("race", races)), s).select("pat_id1", F.col("race").alias("pat_race"))
    att = staff.select(F.col("staff_id").alias("attending_md_id"),
                       F.col("last_name").alias("att_last"), F.col("first_name").alias("att_first"))
    adm = for_keys(admin, s).select("pat_id1", "pat_postal")
    s = (s.join(valid, "pat_id1", "left_semi")
          .join(race, "pat_id1")
          .join(for_keys(att, s, "attending_md_id"), "attending_md_id", "left")
          .join(adm, "pat_id1", "left"))
    out = s.select(
        F.col("ida").alias("mrn"),
        F.coalesce(quote_name("pat_name"), F.lit("")).alias("pat_name"),
        provider_resolution(infusion_prefix).alias("provider"),
        F.col("app_dttm").alias("app_dttm"),
        F.col("pat_postal").alias("pat_zip"),
        "pat_race",
    ).distinct()
    return _sorted(out, ordered, "app_dttm")


# -- J15 ---------------------------------------------------------------------

def first_diagnosis(diagnoses: DataFrame, patients: DataFrame | None = None) -> DataFrame:
    """U4: first diagnosis code and text per patient (earliest day, then code).

    ``patients`` (optional) cuts the history where it is read (``keyfilter``) and
    the result exactly. The minimum is partial before the shuffle, so a patient with a
    third of the history is one row per task.
    """
    if patients is not None:
        diagnoses = cut_to_keys(diagnoses, patients, "pat_id1")
    first = diagnoses.groupBy("pat_id1").agg(
        F.min(F.struct("appt_date", "diag_code", "diag_desc")).alias("f"))
    if patients is not None:
        first = first.join(patients.select("pat_id1").distinct(), "pat_id1", "left_semi")
    return first.select("pat_id1", F.col("f.diag_code").alias("dx_code"), F.col("f.diag_desc").alias("dx_desc"))


def outreach_one_week(schedule: DataFrame, staff: DataFrame, cpt: DataFrame, buckets: DataFrame,
                      admin: DataFrame, patient: DataFrame, ident: DataFrame, prompt: DataFrame,
                      patient_race: DataFrame, patient_provider: DataFrame, diagnoses: DataFrame,
                      vw_patient: DataFrame, as_of, races, ethnicities, cancel_code: str,
                      days: int = 7, keep=lambda df: df, ordered: bool = True) -> DataFrame:
    """32-column contact list of current appointments in [today, today+days]
    for patients of listed races or ethnicities, paired with every current
    row of the same schedule set.

    ``NOT status = 'X'`` drops NULL status (unlike J14's ``NOT IN .. OR NULL``).
    An activity without a dictionary entry has NULL codes.
    """
    now = as_datetime(as_of)
    sch = schedule.filter((F.col("version") == 0)
                          & day_window_inclusive("app_dttm", as_of, days)
                          & ~eq_ci("schstatus_hist_sd", cancel_code))
    # The window's rows feed three steps (detail, diagnosis lookup, set
    # pairing): ``keep`` (a checkpoint in production) computes them once.
    sch = keep(sch)
    loc = staff.select(F.col("staff_id").alias("location"), F.col("last_name").alias("loc_name"))
    acts = activity_lookup(cpt, buckets)
    adm = for_keys(admin, sch).select(
        "pat_id1", "gender", "pat_adr1", "pat_city", "pat_state", "pat_postal", "pat_home_phone",
        "pat_work_phone", "pat_work_phone_ex", "pat_cellphone", "ethnicity_pro_id",
        F.lit(True).alias("_has_admin"))
    eth = prompt.select(F.col("pro_id").alias("ethnicity_pro_id"), F.col("description").alias("Ethnicity"))
    idn = for_keys(ident, sch).select("pat_id1", "ida", "ident_id", F.col("version").alias("ident_version"))
    pat = for_keys(patient, sch).select("pat_id1", "pat_name", F.lit(True).alias("_has_patient"))
    j = (sch.join(loc, "location", "left")
            .join(acts, fold("activity") == F.col("act_key"), "left")
            .join(adm, "pat_id1", "left")
            .join(pat, "pat_id1", "left")
            .join(eth, "ethnicity_pro_id", "left")
            .join(for_keys(patient_race, sch).select("pat_id1", "race"), "pat_id1", "left"))
    # Ident hangs off Patient in the source: no patient row, no ident row.
    j = j.join(idn, "pat_id1", "left").withColumn(
        "ida", F.when(F.col("_has_patient"), F.col("ida"))).withColumn(
        "ident_id", F.when(F.col("_has_patient"), F.col("ident_id"))).withColumn(
        "ident_version", F.when(F.col("_has_patient"), F.col("ident_version")))
    # Races and age come from Admin's patient key: no admin row, no value.
    race = F.when(F.col("_has_admin"), F.col("race"))
    j = j.filter((F.col("ident_id").isNull() | (F.col("ident_version") == 0))
                 & (in_ci(race, races) | in_ci("Ethnicity", ethnicities)))
    # First diagnoses only for patients with an appointment in the window.
    j = (j.join(for_keys(patient_provider, sch).select("pat_id1", "provider_name"), "pat_id1", "left")
          .join(first_diagnosis(diagnoses, sch), "pat_id1", "left")
          .join(for_keys(vw_patient, sch).select("pat_id1", "birth_dttm"), "pat_id1", "left"))
    detail = j.select(
        "sch_set_id",
        F.col("app_dttm").alias("App_DtTm"),
        F.col("ida").alias("MRN"),
        quote_name(F.coalesce("pat_name", F.lit(""))).alias("Name"),
        quote_name("loc_name").alias("Location"),
        quote_name("description").alias("Activity_Description"),
        quote_name(F.coalesce("provider_name", F.lit(""))).alias("Provider"),
        F.coalesce("dx_code", F.lit("")).alias("DxCode"),
        quote_name(F.coalesce("dx_desc", F.lit(""))).alias("DxDesc"),
        "gender",
        quote_name(race).alias("Races"),
        "Ethnicity",
        F.when(F.col("_has_admin"), age_years("birth_dttm", "app_dttm")).alias("Age"),
        F.col("pat_work_phone").alias("Pat_Work_Phone"),
        F.col("pat_work_phone_ex").alias("Pat_Work_Phone_Ex"),
        F.col("pat_home_phone").alias("Pat_Home_Phone"),
        F.col("pat_cellphone").alias("Mobile"),
        quote_name("pat_adr1").alias("Address"),
        quote_name("pat_city").alias("City"),
        F.col("pat_state").alias("State"),
        F.col("pat_postal").alias("Pat_Postal"),
        quote_name(F.coalesce("notes", F.lit(""))).alias("Notes"),
        F.col("cpt_code").alias("CPT_Code"),
        F.col("hsp_code").alias("Hsp_Code"),
        F.col("hsp_code3").alias("Hsp_Code3"),
        "actv_class", "actv_bucket",
    ).distinct()
    run_day = F.lit(now.date())
    # Only sets with a row in the window can pair: cut the tip side to them
    # before deduplicating, instead of deduplicating all history.
    tip = (cut_to_keys(schedule.filter(F.col("version") == 0), sch, "sch_set_id")
                   .join(sch.select("sch_set_id"), "sch_set_id", "left_semi")
                   .select("sch_set_id",
                           F.col("schstatus_hist_sd").alias("SchStatus_Hist_SD"),
                           F.col("create_dttm").alias("Create_DtTm"),
                           F.col("edit_dttm").alias("Edit_DtTm"))
                   .distinct()
                   .withColumn("Create_DtDiff", F.datediff(run_day, F.to_date("Create_DtTm")).cast("bigint"))
                   .withColumn("Edit_DtDiff", F.datediff(run_day, F.to_date("Edit_DtTm")).cast("bigint")))
    out = detail.join(tip, "sch_set_id").withColumnRenamed("sch_set_id", "Sch_Set_Id")
    out = out.select(
        "App_DtTm", "MRN", "Name", "Location", "Activity_Description", "Provider", "DxCode", "DxDesc",
        "gender", "Races", "Ethnicity", "Age", "Pat_Work_Phone", "Pat_Work_Phone_Ex", "Pat_Home_Phone",
        "Mobile", "Address", "City", "State", "Pat_Postal", "Notes", "CPT_Code", "Hsp_Code", "Hsp_Code3",
        "Sch_Set_Id", "SchStatus_Hist_SD", "Create_DtTm", "Create_DtDiff", "Edit_DtTm", "Edit_DtDiff",
        "actv_class", "actv_bucket")
    return _sorted(out, ordered, "App_DtTm")


# -- J16 / J17 ---------------------------------------------------------------

def infusions(vw_schedule: DataFrame, staff: DataFrame, ident: DataFrame, as_of, staff_group: str,
              excluded_activities=(), app_from_days: float = 0.0, app_to_days: float = 6.0,
              app_from_inclusive: bool = True, created_days: float | None = 1.0,
              schedule: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """Appointments of one staff group in a rolling window after now,
    minus listed activities; optionally only those created in the
    ``created_days`` before now. No status filter, by design.

    The created time is the view's ``create_dttm``, or, with ``schedule``, that
    of the schedule row of the same ``sch_id`` (the view need not have it).

    J16: window [now, now+6d], created in [now-1d, now).
    J17: window (now+6d, now+7d], no created filter.
    """
    window = rolling_window("app_dttm", as_of, app_from_days, app_to_days, lo_inclusive=app_from_inclusive)
    rows = vw_schedule.filter(window & eq_ci("stf_last_name", staff_group) & not_in_ci("activity", excluded_activities))
    if created_days is not None:
        created = rolling_window("create_dttm", as_of, -created_days, 0, hi_inclusive=False)
        rows = (rows.filter(created) if schedule is None
                else rows.join(schedule.filter(window & created).select("sch_id"), "sch_id", "left_semi"))
    s = (rows
                    .join(staff.select("staff_id"), "staff_id", "left_semi")
                    .join(ident.select("pat_id1", F.col("ida").alias("MRN")), "pat_id1"))
    out = s.select(
        F.col("app_dttm").alias("App_DtTm"),
        quote_name("pat_name").alias("PAT_NAME"),
        "MRN",
        quote_name("location_name").alias("Location"),
        F.col("activity").alias("Activity"),
        quote_name("short_desc").alias("Short_Desc"),
    ).distinct()
    return _sorted(out, ordered, "App_DtTm")


# -- J18 ---------------------------------------------------------------------

def clinic_last_visit(vw_patient: DataFrame, vw_schedule: DataFrame, schedule: DataFrame, as_of,
                      location_id, completed_statuses, days: int = 14, keep=lambda df: df,
                      ordered: bool = True) -> DataFrame:
    """Patients at one location in [today, today+days) with the day of
    their latest completed current visit on an earlier day.

    The listed appointments feed the output, the as-of keys and the history
    cut; ``keep`` (a temp table in production) computes them once.
    """
    t = keep(vw_schedule.filter(day_window_half_open("app_dttm", as_of, days)
                                & (F.col("location_id") == F.lit(location_id)))
                        .select("pat_id1", "pat_name", "app_dttm")
                        .join(vw_patient.select("pat_id1", "ida", "birth_dttm"), "pat_id1")
                        .withColumn("day", F.to_date("app_dttm")))
    keys = t.select("pat_id1", "day")
    # History before the last listed day, cut to the listed patients where it is read, then
    # reduced to distinct (patient, day), map-side, and cut exactly.
    hist = (cut_to_keys(schedule.filter((F.col("version") == 0) & in_ci("schstatus_hist_sd", completed_statuses)
                                        & before_day("app_dttm", as_of, days)), t, "pat_id1")
                    .select("pat_id1", F.to_date("app_dttm").alias("day")).distinct()
                    .join(keys.select("pat_id1").distinct(), "pat_id1", "left_semi"))
    last = strict_backward_asof(keys, hist)
    out = t.join(last, ["pat_id1", "day"], "left")
    out = out.select(
        F.col("ida").alias("IDA"),
        F.col("birth_dttm").alias("BIRTH_DTTM"),
        F.col("pat_name").alias("PAT_NAME"),
        F.col("app_dttm").alias("App_DtTm"),
        F.col("last_day").alias("Last_Appt"),
    ).distinct()
    return _sorted(out, ordered, "App_DtTm", "PAT_NAME")


# -- R1 and A2/A3 on their own -------------------------------------------------

def resolved_providers(vw_schedule: DataFrame, staff: DataFrame, as_of, infusion_prefix: str,
                       days: int = 14) -> DataFrame:
    """R1 over every appointment in [today, today + days]: the provider a
    list would show (attending for infusion resources and unstaffed slots)."""
    att = staff.select(F.col("staff_id").alias("attending_md_id"),
                       F.col("last_name").alias("att_last"), F.col("first_name").alias("att_first"))
    s = (vw_schedule.filter(day_window_inclusive("app_dttm", as_of, days))
                    .join(att, "attending_md_id", "left"))
    return s.select(F.col("ida").alias("mrn"), F.col("app_dttm").alias("app_dttm"),
                    F.col("stf_last_name").alias("scheduled_staff"),
                    provider_resolution(infusion_prefix).alias("provider")).distinct()


def edit_minimums(schedule: DataFrame, as_of, include_last_day: bool = False) -> DataFrame:
    """A2 vs A3 per patient and appointment day this month: the minimum of
    the ``MM/dd/yyyy`` edit texts next to the text of the true earliest edit,
    and whether they differ (they do whenever edits span a year end or
    months out of text order)."""
    g = (schedule.filter(month_to_date("app_dttm", as_of, include_last_day))
                 .groupBy("pat_id1", F.to_date("app_dttm").alias("appt_day"))
                 .agg(F.min(fmt_mdy("edit_dttm")).alias("edit_text_min"),
                      F.min("edit_dttm").alias("min_edit")))
    true_min = fmt_mdy("min_edit")
    return g.select("pat_id1", "appt_day", "edit_text_min", true_min.alias("edit_true_min"),
                    F.when(F.col("edit_text_min") == true_min, F.lit("N")).otherwise(F.lit("Y")).alias("differs"))
