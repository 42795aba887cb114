"""Parameters of the jobs.

The source scripts hard-code dates, code lists and patient ids in place;
here every one of them is a caller-supplied value. No site data lives in
this package: defaults are neutral (empty lists) or structural.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class CohortParams:
    """First-event cohort and mailing list."""

    code_lo: str
    code_hi: str
    first_from: dt.date
    first_to: dt.date
    new_patient_code: str
    visit_from: dt.date
    visit_to: dt.date
    excluded_ids: tuple = ()
    inmate_class: object = None
    homeless_word: str = "homeless"


@dataclass(frozen=True)
class VolumeSpec:
    """One specialty of the visit-volume extracts."""

    specialty: str
    fy_from: int
    match: str = "eq"            # "eq" or "prefix"
    activity_col: str = "actv_code_desc"
    quote_activity: bool = False
    gender: str | None = None    # None, "keep" (NULL kept) or "blank" (NULL to ' ')
    referral: bool = False
    day_from: dt.date | None = None   # first day of fiscal year fy_from: lets the scan skip older visits
