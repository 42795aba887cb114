"""Registered queries that go through the sources and sinks.

Each one runs an extract, writes it the way the extract tool does, loads it
with the matching loader spec (rows to the target, rejects to the quarantine
table next to it) and returns what the target table holds:

* ``datamart_refresh`` (J9): coverage datamart refreshed twice; current version.
* ``csv_full_refresh`` (J21): reschedule bumps, header names with blanks.
* ``infusion_append`` (J22): two extracts, two appends into one table, a rerun
  of the second with keys.
* ``infusion_stream_append`` (J22 as a stream): one extract appended as a batch,
  the other taken by a file stream into the same table; the stream runs twice.
* ``clinic_list_load`` (S7, F10, D8), ``volumes_load`` and its 12 and 13 column
  forms, ``monthly_total_load``, ``outreach_two_weeks_load``,
  ``outreach_one_week_load``: the other loaders.
* ``loader_rejects``: the quarantined rows of a load with bad dates, bad numbers
  and blank lines.
* ``quotename_export`` (F1): every document's full text through QUOTENAME.
* ``cancels_export`` (J10, O2, S12): the cancellation list written newest first in
  many parts, and its lines read back with their numbers.

Files go to a fresh folder under the cluster's shared checkpoint
directory. The oracle SQL derives the loaded rows from the extract's SQL:
the CSV round trip removes the quotes that QUOTENAME added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote_name
from ..operators import schedule
from ..sources.csvload import LoadSpec, load_csv
from ..sources.sinks import (export_csv, load_append, load_refresh, read_current, read_export, read_rejects, read_table,
                             refresh, scratch_dir)
from ..streaming.append_stream import stream_append
from . import catalog
from .bindings import Bound
from .export import export_view

# -- loader specs ------------------------------------------------------------
# Each loader's field order, its target column names and its
# STR_TO_DATE formats, as the loaders state them.

BUMPS_LOAD = LoadSpec(
    fields=("pat_name", "mrn", "activity", "provider", "ed", "ad", "calculatedays"),
    target=("pat_name", "mrn", "activity", "provider", "editDate", "apptDate", "calculatedays"),
    dates={"editDate": ("ed", "%m/%d/%Y"), "apptDate": ("ad", "%m/%d/%Y")},
    types={"calculatedays": "bigint"},
    header=("PATIENT", "MRN", "ACTIVITY", "PROVIDER", "EDIT_DATE", "APPT_DATE", "CALCULATED_DAYS"))

INFUSION_LOAD = LoadSpec(
    fields=("ad", "pat_name", "MRN", "Location", "activity"),
    target=("appt_dttm", "pat_name", "MRN", "Location", "activity"),
    dates={"appt_dttm": ("ad", "%Y-%m-%d %H:%i:%s")},
    header=("App_DtTm", "PAT_NAME", "MRN", "Location", "Activity"))

CLINIC_LIST_LOAD = LoadSpec(
    fields=("mrn", "dob", "pat_last", "pat_first", "adate", "ladate"),
    target=("mrn", "birth_date", "pat_last", "pat_first", "app_dttm", "lastapp_dt"),
    dates={"birth_date": ("dob", "%Y-%m-%d"), "app_dttm": ("adate", "%Y-%m-%d %H:%i:%s"),
           "lastapp_dt": ("ladate", "%Y-%m-%d")},
    header=("IDA", "BIRTH_DTTM", "PAT_NAME", "App_DtTm", "Last_Appt"))


_VOLUMES = ("mrn", "dob", "patname", "adate", "is_telemed", "provider", "activity", "status", "fy", "zip", "race", "ethnicity")
_VOLUMES_HEADER = ("MRN", "DOB", "patient_name", "appt_dt", "is_TeleMed", "Provider", "actv_code_desc", "sch_Status_Prim", "FY",
                   "pat_postal", "Race", "Ethnicity")


def _volumes_load(*more: tuple) -> LoadSpec:
    """The 12 columns all volume loaders share, and (field, header) pairs after them."""
    fields = (*_VOLUMES, *(f for f, _ in more))
    return LoadSpec(fields=fields, target=tuple("apptdate" if f == "adate" else f for f in fields),
                    dates={"apptdate": ("adate", "%Y%m%d")}, header=(*_VOLUMES_HEADER, *(h for _, h in more)))


VOLUMES_12_LOAD = _volumes_load()
VOLUMES_13_LOAD = _volumes_load(("gender", "gender"))
VOLUMES_LOAD = _volumes_load(("referringMd", "ReferringMD"), ("referringFac", "ReferringFacility"))

TWO_WEEKS_LOAD = LoadSpec(
    fields=("mrn", "pat_name", "provider", "AppDtTm", "pat_zip", "pat_race"),
    target=("mrn", "pat_name", "provider", "app_dttm", "pat_zip", "pat_race"),
    dates={"app_dttm": ("AppDtTm", "%Y-%m-%d %H:%i:%s")},
    header=("mrn", "pat_name", "provider", "app_dttm", "pat_zip", "pat_race"))

ONE_WEEK_LOAD = LoadSpec(
    fields=("apdttm", "mrn", "patname", "location", "activity", "provider", "dxcode", "dxdesc", "gender", "race", "ethnicity", "age",
            "work_phone", "work_phone_ext", "home_phone", "cell_phone", "address", "city", "state", "zip", "notes", "CPT_Code",
            "Hsp_Code", "Hsp_Code3", "Sch_Set_Id", "SchStatus_Hist_SD", "CteDtTm", "Create_DtDiff", "EdtDtTm", "Edit_DtDiff",
            "actv_class", "actv_bucket"),
    target=("appdttm", "mrn", "patname", "location", "activity", "provider", "dxcode", "dxdesc", "gender", "race", "ethnicity", "age",
            "work_phone", "work_phone_ext", "home_phone", "cell_phone", "address", "city", "state", "zip", "notes", "CPT_Code",
            "Hsp_Code", "Hsp_Code3", "Sch_Set_Id", "SchStatus_Hist_SD", "Create_DtTm", "Create_DtDiff", "Edit_DtTm", "Edit_DtDiff",
            "actv_class", "actv_bucket"),
    dates={"appdttm": ("apdttm", "%Y-%m-%d %H:%i:%s"), "Create_DtTm": ("CteDtTm", "%Y-%m-%d %H:%i:%s"),
           "Edit_DtTm": ("EdtDtTm", "%Y-%m-%d %H:%i:%s")},
    types={"age": "bigint", "Sch_Set_Id": "bigint", "Create_DtDiff": "bigint", "Edit_DtDiff": "bigint"},
    header=("App_DtTm", "MRN", "Name", "Location", "Activity_Description", "Provider", "DxCode", "DxDesc", "gender", "Races", "Ethnicity",
            "Age", "Pat_Work_Phone", "Pat_Work_Phone_Ex", "Pat_Home_Phone", "Mobile", "Address", "City", "State", "Pat_Postal", "Notes",
            "CPT_Code", "Hsp_Code", "Hsp_Code3", "Sch_Set_Id", "SchStatus_Hist_SD", "Create_DtTm", "Create_DtDiff", "Edit_DtTm",
            "Edit_DtDiff", "actv_class", "actv_bucket"))

MONTHLY_TOTAL_LOAD = LoadSpec(
    fields=("totalmoappts", "ad"),
    target=("totalmoappts", "rundate"),
    dates={"rundate": ("ad", "%Y-%m-%d")},
    types={"totalmoappts": "bigint"},
    header=("TotalMoAppts", "runDate"))


def q_datamart_refresh(spark: SparkSession, d: str) -> DataFrame:
    target = scratch_dir(spark, "datamart_refresh")
    mart = catalog.q_visit_vitals_drugs(spark, d)
    refresh(mart, target)
    refresh(mart, target)          # a rerun replaces, never doubles
    return read_current(spark, target)


def _refreshed(spark, name: str, extract: DataFrame, spec: LoadSpec, **export) -> DataFrame:
    """Extract -> CSV -> loader -> refreshed table."""
    root = scratch_dir(spark, name)
    export_csv(extract, f"{root}/extract", charset=spec.charset, **export)
    load_refresh(load_csv(spark, f"{root}/extract", spec), f"{root}/table")
    return export_view(read_current(spark, f"{root}/table"))


def q_csv_full_refresh(spark, d):
    return _refreshed(spark, "csv_full_refresh", catalog.q_bumps_literal(spark, d, ordered=False), BUMPS_LOAD,
                      headers={"EDIT_DATE": "EDIT DATE", "APPT_DATE": "APPT DATE", "CALCULATED_DAYS": "CALCULATED DAYS"})


def _infusion_extracts(spark, d, root):
    export_csv(catalog.q_infusions_next6(spark, d, ordered=False), f"{root}/landing/addon")
    export_csv(catalog.q_infusions_day7(spark, d, ordered=False), f"{root}/landing7/day7")
    return f"{root}/landing/addon", f"{root}/landing7/day7"


def q_infusion_append(spark, d):
    root = scratch_dir(spark, "infusion_append")
    target = f"{root}/table"
    addon, day7 = _infusion_extracts(spark, d, root)
    keys = list(INFUSION_LOAD.target)
    load_append(load_csv(spark, addon, INFUSION_LOAD), target)
    for _ in range(2):                      # the rerun adds nothing
        load_append(load_csv(spark, day7, INFUSION_LOAD), target, dedup_keys=keys)
    return export_view(read_table(spark, target))


def q_infusion_stream_append(spark, d):
    root = scratch_dir(spark, "infusion_stream_append")
    addon, _ = _infusion_extracts(spark, d, root)
    target = f"{root}/table"
    load_append(load_csv(spark, addon, INFUSION_LOAD), target)          # one feed as a batch, one as a stream
    for _ in range(2):                                                  # nothing new the second time
        stream_append(spark, f"{root}/landing7", INFUSION_LOAD, target, f"{root}/_stream_checkpoint")
    return export_view(read_table(spark, target))


def q_clinic_list_load(spark, d):
    return _refreshed(spark, "clinic_list_load", catalog.q_clinic_last_visit(spark, d, ordered=False), CLINIC_LIST_LOAD)


def q_volumes_load(spark, d):
    return _refreshed(spark, "volumes_load", catalog.q_volumes_referral(spark, d), VOLUMES_LOAD)


def q_volumes_12_load(spark, d):
    return _refreshed(spark, "volumes_12_load", catalog.q_volumes_exact(spark, d), VOLUMES_12_LOAD)


def q_volumes_13_load(spark, d):
    return _refreshed(spark, "volumes_13_load", catalog.q_volumes_gender(spark, d), VOLUMES_13_LOAD)


def q_outreach_two_weeks_load(spark, d):
    return _refreshed(spark, "outreach_two_weeks_load", catalog.q_outreach_two_weeks(spark, d, ordered=False), TWO_WEEKS_LOAD)


def q_outreach_one_week_load(spark, d):
    return _refreshed(spark, "outreach_one_week_load", catalog.q_outreach_one_week(spark, d, ordered=False), ONE_WEEK_LOAD)


def q_monthly_total_load(spark, d):
    return _refreshed(spark, "monthly_total_load", catalog.q_monthly_appt_total(spark, d), MONTHLY_TOTAL_LOAD)


def q_loader_rejects(spark, d):
    """A reschedule feed made of the orders, in which some dates and numbers are
    no dates and numbers and some lines are blank; what the load set aside."""
    root = scratch_dir(spark, "loader_rejects")
    o = Bound.of(spark, d).table("orders")
    day = F.date_format("o_orderdate", "MM/dd/yyyy")
    feed = o.select(
        F.when(F.col("o_orderkey") % 7 != 0, F.lit("DOE")).alias("PATIENT"), F.col("o_orderkey").cast("string").alias("MRN"),
        F.lit("a").alias("ACTIVITY"), F.lit("b").alias("PROVIDER"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("n/a")).otherwise(day).alias("EDIT_DATE"),
        F.when(F.col("o_orderpriority").startswith("2"), F.concat(F.lit("on "), day)).otherwise(day).alias("APPT_DATE"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("many")).otherwise(F.lit("3")).alias("CALCULATED_DAYS"))
    blank = o.filter(F.col("o_orderkey") % 11 == 0).select(*[F.lit(None).cast("string").alias(c) for c in feed.columns])
    export_csv(feed.unionByName(blank), f"{root}/extract", charset=BUMPS_LOAD.charset)
    loaded = load_csv(spark, f"{root}/extract", BUMPS_LOAD)
    load_refresh(loaded, f"{root}/table")
    kept = read_current(spark, f"{root}/table").agg(F.count(F.lit(1)).alias("n_loaded"))          # one row
    rejects = read_rejects(spark, f"{root}/table").select("mrn", "ed", "ad", "calculatedays", F.col("_failed").alias("failed"))
    return rejects.join(F.broadcast(kept))


def q_quotename_export(spark, d):
    docs = Bound.of(spark, d).table("documents")
    return docs.select("doc_id", quote_name("text").alias("quoted_text"))


def q_cancels_export(spark, d):
    path = scratch_dir(spark, "cancels_export")
    keys = schedule.cancels(Bound.of(spark, d).status_keys("F"), catalog.KEYS_SINCE, catalog.KEYS_AS_OF, ordered=False)
    export_csv(export_view(keys), path, order_by=[F.col("App_DtTm").desc()])
    return read_export(spark, path)


IO_QUERIES = {
    "datamart_refresh": q_datamart_refresh,
    "csv_full_refresh": q_csv_full_refresh,
    "infusion_append": q_infusion_append,
    "infusion_stream_append": q_infusion_stream_append,
    "clinic_list_load": q_clinic_list_load,
    "volumes_load": q_volumes_load,
    "volumes_12_load": q_volumes_12_load,
    "volumes_13_load": q_volumes_13_load,
    "outreach_two_weeks_load": q_outreach_two_weeks_load,
    "outreach_one_week_load": q_outreach_one_week_load,
    "loader_rejects": q_loader_rejects,
    "monthly_total_load": q_monthly_total_load,
    "quotename_export": q_quotename_export,
    "cancels_export": q_cancels_export,
}

# -- oracle SQL -------------------------------------------------------------


def _unquote(col: str) -> str:
    """What a CSV reader makes of a QUOTENAME'd field; '' reads as NULL."""
    return (f"NULLIF(CASE WHEN {col} LIKE '\"%\"' THEN replace(substr({col}, 2, length({col}) - 2), '\"\"', '\"')"
            f" ELSE {col} END, '')")


def _sub(sql: str) -> str:
    return f"(\n{sql}\n)"


_BUMPS_LOAD_SQL = f"""
SELECT {_unquote('PATIENT')} AS pat_name, MRN AS mrn, ACTIVITY AS activity, {_unquote('PROVIDER')} AS provider,
       strftime(strptime(EDIT_DATE, '%m/%d/%Y'), '%Y-%m-%d') AS editDate,
       strftime(strptime(APPT_DATE, '%m/%d/%Y'), '%Y-%m-%d') AS apptDate,
       CAST(CALCULATED_DAYS AS BIGINT) AS calculatedays
FROM {_sub(catalog.SQL['bumps_literal'])} b"""

_INFUSION_SQL = """
SELECT App_DtTm AS appt_dttm, {pn} AS pat_name, MRN, {loc} AS Location, Activity AS activity
FROM {src} t"""


def _infusion_rows(name: str) -> str:
    return _INFUSION_SQL.format(pn=_unquote("PAT_NAME"), loc=_unquote("Location"),
                                src=_sub(catalog.SQL[name]))


_APPEND_SQL = _infusion_rows("infusions_next6") + "\nUNION ALL\n" + _infusion_rows("infusions_day7")
# Loaded with all target columns as keys: equal rows and rows that are there already are left out.
_KEYED_SQL = (_infusion_rows("infusions_next6") + "\nUNION ALL (" + _infusion_rows("infusions_day7")
              + "\nEXCEPT" + _infusion_rows("infusions_next6") + ")")

_CLINIC_LIST_LOAD_SQL = f"""
SELECT IDA AS mrn, substr(BIRTH_DTTM, 1, 10) AS birth_date,
       split_part(PAT_NAME, ',', 1) AS pat_last,
       NULLIF(substr(PAT_NAME, strpos(PAT_NAME, ',') + 1), '') AS pat_first,
       App_DtTm AS app_dttm, Last_Appt AS lastapp_dt
FROM {_sub(catalog.SQL['clinic_last_visit'])} c"""

def _volumes_load_sql(extract: str, *more: str) -> str:
    return f"""
SELECT MRN AS mrn, DOB AS dob, {_unquote('patient_name')} AS patname,
       strftime(strptime(appt_dt, '%Y%m%d'), '%Y-%m-%d') AS apptdate,
       is_TeleMed AS is_telemed, NULLIF(Provider, '') AS provider, actv_code_desc AS activity,
       sch_Status_Prim AS status, CAST(FY AS VARCHAR) AS fy, pat_postal AS zip,
       NULLIF(Race, '') AS race, NULLIF(Ethnicity, '') AS ethnicity{"".join(", " + m for m in more)}
FROM {_sub(catalog.SQL[extract])} v"""


_TWO_WEEKS_LOAD_SQL = f"""
SELECT mrn, {_unquote('pat_name')} AS pat_name, {_unquote('provider')} AS provider, app_dttm, pat_zip, pat_race
FROM {_sub(catalog.SQL['outreach_two_weeks'])} t"""

_QUOTED = ("patname", "location", "activity", "provider", "dxdesc", "race", "address", "city", "notes")


def _one_week_load_sql() -> str:
    cols = [f"{_unquote(h) if t in _QUOTED else h if t in ONE_WEEK_LOAD.types or t in ONE_WEEK_LOAD.dates else f'NULLIF({h}, {chr(39) * 2})'} AS {t}"
            for t, h in zip(ONE_WEEK_LOAD.target, ONE_WEEK_LOAD.header)]
    return f"SELECT {', '.join(cols)} FROM {_sub(catalog.SQL['outreach_one_week'])} w"


_LOADER_REJECTS_SQL = """
WITH f AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS mrn, strftime(o_orderdate, '%m/%d/%Y') AS day, o_orderpriority[1] AS p, o_orderkey % 5 = 0 AS many,
         (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderkey % 11 = 0) AS lines
  FROM orders),
r AS (
  SELECT mrn, CASE WHEN p = '1' THEN 'n/a' ELSE day END AS ed, CASE WHEN p = '2' THEN 'on ' || day ELSE day END AS ad,
         CASE WHEN many THEN 'many' ELSE '3' END AS calculatedays,
         concat_ws(',', CASE WHEN p = '1' THEN 'editDate' END, CASE WHEN p = '2' THEN 'apptDate' END,
                   CASE WHEN many THEN 'calculatedays' END) AS failed, lines
  FROM f WHERE p IN ('1', '2') OR many)
SELECT mrn, ed, ad, calculatedays, failed, CAST(lines - count(*) OVER () AS BIGINT) AS n_loaded FROM r"""

_MONTHLY_TOTAL_LOAD_SQL = f"""
SELECT TotalMoAppts AS totalmoappts, runDate AS rundate
FROM {_sub(catalog.SQL['monthly_appt_total'])} m"""

_QUOTENAME_SQL = """
SELECT doc_id, '"' || replace(text, '"', '""') || '"' AS quoted_text
FROM documents"""

_CANCELS_EXPORT_SQL = f"""
WITH lines AS (SELECT App_DtTm AS newest, Pat_Id1 || ',' || App_DtTm AS line FROM {_sub(catalog.SQL['cancels'])} c)
SELECT 1::BIGINT AS line_no, 'Pat_Id1,App_DtTm' AS line UNION ALL SELECT 2, '-------,--------' UNION ALL
SELECT 2 + row_number() OVER (ORDER BY newest DESC, line), line FROM lines"""

IO_SQL = {
    "datamart_refresh": catalog.SQL["visit_vitals_drugs"],
    "csv_full_refresh": _BUMPS_LOAD_SQL,
    "infusion_append": _KEYED_SQL,
    "infusion_stream_append": _APPEND_SQL,
    "clinic_list_load": _CLINIC_LIST_LOAD_SQL,
    "volumes_load": _volumes_load_sql("volumes_referral", "NULLIF(ReferringMD, '') AS referringMd",
                                      "NULLIF(ReferringFacility, '') AS referringFac"),
    "volumes_12_load": _volumes_load_sql("volumes_exact"),
    "volumes_13_load": _volumes_load_sql("volumes_gender", "gender"),
    "outreach_two_weeks_load": _TWO_WEEKS_LOAD_SQL,
    "outreach_one_week_load": _one_week_load_sql(),
    "loader_rejects": _LOADER_REJECTS_SQL,
    "monthly_total_load": _MONTHLY_TOTAL_LOAD_SQL,
    "quotename_export": _QUOTENAME_SQL,
    "cancels_export": _CANCELS_EXPORT_SQL,
}
