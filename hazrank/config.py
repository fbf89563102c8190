"""Configuration: the year timeline and the fixed code lists.

The code lists below are fixed values of the risk model's definitions;
they must stay exactly as stated for results to match.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Enforcement types that count as formal enforcement.
FORMAL_ENFORCEMENT_CODES = (
    "310", "210", "380", "385", "410", "420",
    "425", "430", "510", "520", "530", "610",
    "620", "630", "810", "820", "830", "840",
    "850", "860", "865",
)
# Disposition statuses turned into per-inspection shares.
DISPOSITION_CODES = ("AS", "DR", "DS", "PC", "PR", "RI", "RV", "WD")
# Evaluation types that are follow-up evaluations.
FOLLOW_UP_EVALUATION_TYPES = ("CDI", "CSE", "FUI", "NIR")
# Waste minimisation code groups.
WASTE_MIN_NONE = ("N", "X")
WASTE_MIN_INITIATED = ("A", "B")
WASTE_MIN_CONTINUED = ("C", "D")
# Facility activity flags of the annual site report.
FACILITY_FLAGS = ("importer_activity", "mixed_waste_generator", "transporter",
                  "transfer_facility", "tsd_activity", "recycler_activity")
# Unit conversion factors to pounds.
LB_PER_SHORT_TON = 2000.0
LB_PER_KG = 2.205
GALLONS_PER_LITRE = 0.264172
GALLONS_PER_CUBIC_YARD = 201.974
LB_PER_GALLON_WATER = 8.345
# Characteristic waste codes.
IGNITABLE_CODE = "D001"
CORROSIVE_CODE = "D002"
REACTIVE_CODE = "D003"
TOXIC_CODE_LOW_EXCLUSIVE = "D004"
TOXIC_CODE_HIGH_EXCLUSIVE = "D043"
# Window names and their span (years before the feature end, inclusive).
WINDOW_SPAN = {"total": None, "five_year": 4, "three_year": 2, "most_recent": 0}
# Placeholder when an entity was never inspected before the as-of date.
NEVER_INSPECTED_DAYS = 2147483647
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Timeline:
    """Label-year ranges of the experiment (both ends inclusive).

    For a label year L the cohort year is L-1, the feature window ends at
    L-1 and starts ``lookback`` years earlier (L-5 by default).
    """

    train_label_range: tuple[int, int] = (1997, 1999)
    val_label_range: tuple[int, int] = (1998, 2000)
    lookback: int = 4
    windows: tuple[str, ...] = field(default=("total", "five_year", "three_year", "most_recent"))

    def __post_init__(self):
        for name in ("train_label_range", "val_label_range"):
            first, last = getattr(self, name)
            if first > last:
                raise ValueError(f"{name}: {first} is after {last}")

    def label_years(self) -> list[int]:
        lo = min(self.train_label_range[0], self.val_label_range[0])
        hi = max(self.train_label_range[1], self.val_label_range[1])
        return list(range(lo, hi + 1))

    def window_start(self, window: str, end: int) -> int:
        if window == "total":
            return end - self.lookback
        if window not in WINDOW_SPAN:
            raise ValueError(f"unknown window {window!r}")
        return end - WINDOW_SPAN[window]


DEFAULT_TIMELINE = Timeline()
