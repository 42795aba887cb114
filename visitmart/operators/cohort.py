"""First-event cohort and mailing list.

Inputs (column names as produced by ``plans.bindings``):

* ``diagnoses``: pat_id1, appt_date (DATE), diag_code
* ``visits``: pat_id1, patient_name, pat_mrn, appt_dt (yyyyMMdd text),
  appt_date (DATE), actv_code, ...
* ``admin``, ``patient``, ``ident``, ``patlog``, ``prompt``: patient
  demographics, death marker, status log and lookup texts.

Scale notes. Every aggregate runs map-side first, so a patient holding a
large share of the rows collapses to one row per task before the shuffle.
The single-visit check multiplies per-patient counts instead of joining
cohort rows to visit rows, so no per-patient product is ever built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ci, distinct_ci, eq_ci, fold, fold_literal, non_blank
from ..functions.timewin import ts_literal

COHORT_COLUMNS = ("patient_name", "pat_id1", "earliest_diag_date", "appt_dt", "pat_mrn", "np_ind")


def first_event_cohort(diagnoses: DataFrame, code_lo: str, code_hi: str,
                       first_from: dt.date, first_to: dt.date) -> DataFrame:
    """Patients whose first diagnosis in [code_lo, code_hi] lies in a window.

    The minimum runs over the whole history; the window filter is applied
    after the aggregate (moving it below would change the answer).
    Codes compare as text under the case-insensitive collation.
    """
    lo, hi = fold_literal(code_lo), fold_literal(code_hi)
    first = (diagnoses
             .filter(fold("diag_code").between(lo, hi))
             .groupBy("pat_id1")
             .agg(F.min("appt_date").alias("earliest_diag_date")))
    return first.filter(F.col("earliest_diag_date").between(F.lit(first_from), F.lit(first_to)))


def cohort_visit_summary(visits: DataFrame, earliest: DataFrame, visit_from: dt.date,
                         visit_to: dt.date, first_from: dt.date, first_to: dt.date) -> DataFrame:
    """One pass over the cohort's visits, reduced to what J2-J4 read.

    J2/J3 read the visit rows on each patient's first-event day; J4 reads
    how many visits each patient has in the single-visit window. First days lie
    in [first_from, first_to], so only days in either window are read (a
    bound that reaches the scan). Visits are counted per patient, day and
    activity map-side, before the join to the cohort: a patient with a third of
    the visits meets it as one row per task, day and activity. The result is
    one row per distinct first-day visit plus one row per patient for the
    other days, each with its count of in-window visits.
    """
    day = F.col("appt_date")
    lo, hi = min(first_from, visit_from), max(first_to, visit_to)
    per_day = (visits.filter(day.between(F.lit(lo), F.lit(hi)))
               .groupBy("pat_id1", "appt_date", "appt_dt", "patient_name", "pat_mrn", "actv_code")
               .agg(F.count(F.lit(1)).alias("n")))
    first = day == F.col("earliest_diag_date")

    def on_first(c: str):
        return F.when(first, F.col(c)).alias(c)

    in_window = day.between(F.lit(visit_from), F.lit(visit_to))
    return (per_day.join(earliest, "pat_id1")
                   .groupBy("pat_id1", "earliest_diag_date", first.alias("is_first"),
                            on_first("appt_dt"), on_first("patient_name"), on_first("pat_mrn"),
                            on_first("actv_code"))
                   .agg(F.sum(F.when(in_window, F.col("n")).otherwise(0)).cast("bigint").alias("n_window")))


def first_day_visits(summary: DataFrame) -> DataFrame:
    """Distinct cohort visits on the patient's first-event day (shared by J2 and J3).

    ``summary`` comes from ``cohort_visit_summary``. The source's join on
    (patient, day) is a filter here, without a shuffle.
    """
    return (summary.filter(F.col("is_first") & F.col("actv_code").isNotNull())
                   .select("pat_id1", "earliest_diag_date", "appt_dt", "patient_name", "pat_mrn",
                           "actv_code"))


def window_visit_counts(summary: DataFrame) -> DataFrame:
    """Visits per cohort patient in the single-visit window (J4's second factor)."""
    return summary.groupBy("pat_id1").agg(F.sum("n_window").alias("n_visits"))


def new_patient_cohort(first_day: DataFrame, new_code: str) -> DataFrame:
    """Cohort patients with a new-patient visit on their first day; flag 'Y'."""
    j = first_day.filter(eq_ci("actv_code", new_code))
    return j.select(*COHORT_COLUMNS[:-1], F.lit("Y").alias("np_ind")).distinct()


def existing_patient_cohort(first_day: DataFrame, new_code: str, new_patients: DataFrame) -> DataFrame:
    """Other-activity visits on the first day, minus J2 patients; flag 'N'.

    Visits with a NULL activity are in neither J2 nor J3, as in the source.
    ``NOT IN (subquery)`` on a non-null key is a plain anti-join.
    """
    j = first_day.filter(fold("actv_code") != F.lit(fold_literal(new_code)))
    j = j.join(new_patients.select("pat_id1"), "pat_id1", "left_anti")
    return j.select(*COHORT_COLUMNS[:-1], F.lit("N").alias("np_ind")).distinct()


def single_visits_from_counts(existing: DataFrame, visit_counts: DataFrame) -> DataFrame:
    """J4 from per-patient in-window visit counts (``pat_id1``, ``n_visits``).

    The source counts (cohort row x visit) pairs per patient; that count is
    ``cohort rows x visits``, and both factors are aggregated before the
    join, so the pairs are never materialised.
    """
    rows = existing.groupBy("pat_id1").agg(F.count(F.lit(1)).alias("n_rows"))
    pairs = rows.join(visit_counts, "pat_id1")
    return (pairs.select("pat_id1", (F.col("n_rows") * F.col("n_visits")).alias("numb_times"))
                 .filter(F.col("numb_times") == 1))


def single_visit_patients(existing: DataFrame, visits: DataFrame,
                          visit_from: dt.date, visit_to: dt.date) -> DataFrame:
    """Patients of J3 with exactly one (cohort row x visit) pair in the window."""
    seen = (visits.filter(F.col("appt_date").between(F.lit(visit_from), F.lit(visit_to)))
                  .groupBy("pat_id1").agg(F.count(F.lit(1)).alias("n_visits")))
    return single_visits_from_counts(existing, seen)


def single_visit_review(visits: DataFrame, single: DataFrame, ordered: bool = True) -> DataFrame:
    """Every visit of the J4 patients, ordered by name and day."""
    out = visits.join(single.select("pat_id1"), "pat_id1", "left_semi")
    return out.orderBy("patient_name", "appt_dt") if ordered else out


def cohort_union(new_patients: DataFrame, existing: DataFrame, excluded_ids=()) -> DataFrame:
    """J2 UNION J3; the manual id exclusion binds to the J3 branch only.
    Spellings that the collation holds equal are one row (O6)."""
    second = existing
    if excluded_ids:
        second = existing.filter(~F.col("pat_id1").isin(list(excluded_ids)))
    return distinct_ci(new_patients.select(*COHORT_COLUMNS).unionByName(second.select(*COHORT_COLUMNS)))


def mailing_list(cohort: DataFrame, admin: DataFrame, patient: DataFrame, ident: DataFrame,
                 patlog: DataFrame, prompt: DataFrame, as_of, inmate_class,
                 homeless_word: str = "homeless") -> DataFrame:
    """Enrich the cohort with contact data and suppress inmates, the
    deceased and the homeless; stamp the extract time.

    * Inmate: an active status-log row of ``inmate_class``. The source's
      left join + "flag = NO" filter is an anti-join; written as one.
    * Deceased: an expiry time, or a death marker that is not blank.
    * Homeless: either address line contains the word (any case); NULL
      lines count as no.
    The checks are per joined row, as in the source.
    """
    inmates = patlog.filter((F.col("plc_id") == F.lit(inmate_class)) & F.col("inactive_dttm").isNull())
    base = (cohort
            .join(admin, "pat_id1")
            .join(patient.select("pat_id1", "salutation"), "pat_id1")
            .join(ident.select("pat_id1", "idc"), "pat_id1")
            .join(inmates.select("pat_id1"), "pat_id1", "left_anti"))
    deceased = F.col("expired_dttm").isNotNull() | non_blank("idc")
    homeless = (F.coalesce(contains_ci("pat_adr1", homeless_word), F.lit(False))
                | F.coalesce(contains_ci("pat_adr2", homeless_word), F.lit(False)))
    kept = base.filter(~F.coalesce(deceased, F.lit(False)) & ~homeless)
    lang = prompt.select(F.col("pro_id").alias("language_pro_id"), F.col("description").alias("LanguageSpoken"))
    out = kept.join(lang, "language_pro_id", "left")
    return out.select(
        "patient_name",
        F.col("pat_adr1").alias("Addr1"), F.col("pat_adr2").alias("Addr2"),
        F.col("pat_city").alias("City"), F.col("pat_state").alias("State"),
        F.col("pat_postal").alias("Postal"), F.col("pat_home_phone").alias("HomePhone"),
        F.col("pat_email").alias("Pat_EMail"), F.col("pat_cellphone").alias("Pat_CellPhone"),
        "LanguageSpoken", F.col("gender").alias("Gender"), F.col("salutation").alias("Salutation"),
        F.col("pat_mrn").alias("MRN"), "np_ind", "pat_id1",
        ts_literal(as_of).alias("Extract_Date"),
    ).distinct()


def _same(df: DataFrame) -> DataFrame:
    return df


class MailingProcedure:
    """The mailing procedure as one object: its temp tables are the steps.

    Steps are lazy. The one intermediate that several steps read, the
    cohort's visit summary (first-day visits and in-window counts), goes
    through ``keep``: normally a table written to the cluster's shared
    checkpoint folder, as the source materialises its temp tables. Spark
    plans are trees, so without it every reader would recompute the visit
    join from the fact tables; with it the join runs once, and a lost
    executor costs a re-read, not a recomputation. Everything after it is
    small.
    """

    def __init__(self, diagnoses: DataFrame, visits: DataFrame, params, keep=_same):
        self._diagnoses, self._all_visits, self.p, self._keep = diagnoses, visits, params, keep
        self._summary: DataFrame | None = None

    @property
    def earliest(self) -> DataFrame:
        p = self.p
        return first_event_cohort(self._diagnoses, p.code_lo, p.code_hi, p.first_from, p.first_to)

    @property
    def summary(self) -> DataFrame:
        if self._summary is None:
            p = self.p
            self._summary = self._keep(cohort_visit_summary(self._all_visits, self.earliest,
                                                            p.visit_from, p.visit_to, p.first_from, p.first_to))
        return self._summary

    @property
    def first_day(self) -> DataFrame:
        return first_day_visits(self.summary)

    @property
    def new_patients(self) -> DataFrame:
        return new_patient_cohort(self.first_day, self.p.new_patient_code)

    @property
    def existing(self) -> DataFrame:
        return existing_patient_cohort(self.first_day, self.p.new_patient_code, self.new_patients)

    @property
    def single(self) -> DataFrame:
        return single_visits_from_counts(self.existing, window_visit_counts(self.summary))

    @property
    def review(self) -> DataFrame:
        # Whole visit rows, for the few J4 patients: one semi-joined pass.
        return single_visit_review(self._all_visits, self.single)

    @property
    def cohort(self) -> DataFrame:
        return cohort_union(self.new_patients, self.existing, self.p.excluded_ids)

    def mailing(self, admin: DataFrame, patient: DataFrame, ident: DataFrame, patlog: DataFrame,
                prompt: DataFrame, as_of) -> DataFrame:
        return mailing_list(self.cohort, admin, patient, ident, patlog, prompt, as_of,
                            self.p.inmate_class, self.p.homeless_word)
