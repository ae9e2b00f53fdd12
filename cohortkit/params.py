"""Run parameters. The reference hardcodes these in its scripts; here they are one frozen record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # cohort definition
    diagnosis_roots: tuple[int, ...] = (132797, 43021283)
    study_start: dt.date = dt.date(2020, 1, 1)
    visit_types: tuple[int, ...] = (9201, 262)
    # visit start relative to diagnosis date; bounds are strict: lo < datediff < hi
    window_lo: int = -7
    window_hi: int = 21
    # extraction
    extract_visit_start: dt.date = dt.date(2020, 3, 1)
    band_days: int = 1          # +-1 day around the visit for measurement/drug/procedure/device
    observation_months: int = 12  # +-1 year around the visit for observation
    # rare-concept generalisation
    min_count: int = 10         # ancestors must have count > min_count
    # de-identification
    deid_start: dt.date = dt.date(2016, 1, 1)
    deid_end: dt.date = dt.date(2029, 12, 31)
    as_of: dt.date | None = None  # must be given: reruns would differ with the day
    salt: str = ""               # must be given: with a known salt every shift can be computed anew
    max_shift: int = 183
    over_age: int = 89
    # profiles
    unmapped_min_count: int = 20

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Parameters of the test fixture (FIXTURES.md §2): the clinical view of the star schema
# spans 1995-2001, so dates and roots are moved into that range.
FIXTURE_PARAMS = Params(
    diagnosis_roots=(20601, 20602, 20603, 30604),
    study_start=dt.date(1997, 1, 1),
    visit_types=(9201, 262),
    extract_visit_start=dt.date(1997, 3, 1),
    as_of=dt.date(2001, 12, 31),
    deid_start=dt.date(1996, 1, 1),
    deid_end=dt.date(2001, 6, 30),
    salt="salt",
    min_count=10,
)
