"""Constants of the data model, in one immutable object that every plan takes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Codes and limits of the data model.
    history_months: int = 24
    plan_year_months: int = 12
    underwriting_lead_months: int = 3
    min_covered_months: int = 6
    spine_months: int = 26
    first_interval: int = 3
    days_per_year: float = 365.25
    days_per_month: float = 30.436875
    platforms: tuple[str, ...] = ("EM", "LV")
    subscriber_code: str = "18"
    rx_code: str = "r"
    inpatient_code: str = "i"
    outpatient_code: str = "o"
    revenue_kind: str = "mr"
    procedure_kind: str = "mc"
    diagnosis_kind: str = "md"
    genetic_code: str = "99999"
    unknown_category: str = "hcup_unk"
    impact_decimals: int = 4
    first_diag: int = 2
    last_diag: int = 25
    hidden_label: str = "Cannot Disclose"
    # Date windows; callers override them for their own data.
    claim_from: dt.date = dt.date(2015, 10, 1)
    claim_to: dt.date = dt.date(2020, 12, 31)
    effective_from: dt.date = dt.date(2018, 1, 1)
    effective_to: dt.date = dt.date(2020, 1, 1)

    @property
    def diag_columns(self) -> list[str]:
        return [f"diag_cd{i}" for i in range(self.first_diag, self.last_diag + 1)]


DEFAULTS = Settings()
