"""Visit / vitals / drugs coverage datamart.

For every scheduled (patient, day) since a date: was a vital sign taken
that day, and was a drug given that day?

Each input becomes distinct (patient, day) keys before any join, so a patient
with a third of the rows brings one row per day and task to the shuffle.

Plan shape: the three inputs are reduced to distinct (patient, day) keys
with map-side aggregation, then joined on (patient, day). Both right sides
are unique on the join key, so the left joins never multiply rows; the
final DISTINCT is satisfied by the join's hash partitioning and adds no
exchange.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import eq_ci
from ..functions.timewin import on_or_after_day


def visit_vitals_drugs(sets: DataFrame, patients: DataFrame, observations: DataFrame,
                       drugs: DataFrame, since: dt.date, vitals_bucket: str) -> DataFrame:
    sch = (sets.filter(F.col("appt_date") >= F.lit(since))
               .select("pat_id1", "appt_date").distinct()
               .join(patients.select("pat_id1", F.col("ida").alias("MRN"),
                                     F.col("pat_id1_name").alias("Pat_Name")), "pat_id1"))
    vitals = (observations
              .filter(eq_ci("observation_bucket", vitals_bucket)
                      & on_or_after_day("measurement_dttm", since))
              .select("pat_id1", F.to_date("measurement_dttm").alias("appt_date"))
              .distinct()
              .withColumn("Vitals_Date", F.col("appt_date")))
    given = (drugs.filter(on_or_after_day("adm_start_dttm", since))
                  .select("pat_id1", F.to_date("adm_start_dttm").alias("appt_date"))
                  .distinct()
                  .withColumn("Drug_Date", F.col("appt_date")))
    out = (sch.join(vitals, ["pat_id1", "appt_date"], "left")
              .join(given, ["pat_id1", "appt_date"], "left"))
    return out.select("pat_id1", "appt_date", "MRN", "Pat_Name", "Vitals_Date", "Drug_Date").distinct()
