"""Parameters of the label / feature windows and of the stand-in mapping.

The reference works on bank tables (account, trans, disp, card, loan, order,
district). The driver provides a TPC-H-like star schema instead, so every
operator takes its columns and dates from here.  Defaults follow SURVEY §7.1.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Windows:
    """Observation / label windows of the proxy churn label.

    obs window   : d <= obs_end
    base window  : base_start <= d <= obs_end   (the "1997" year of the reference)
    label window : obs_end < d <= label_end
    eligibility  : open_date <= obs_end - min_tenure_days
    """

    obs_end: _dt.date = _dt.date(1998, 12, 31)
    label_end: _dt.date = _dt.date(1999, 12, 31)
    base_start: _dt.date = _dt.date(1998, 1, 1)
    history_start: _dt.date = _dt.date(1995, 1, 1)
    history_years: int = 4
    min_tenure_days: int = 180
    churn_quantile: float = 0.10

    @property
    def obs_end_lit(self) -> str:
        return self.obs_end.isoformat()

    @property
    def label_end_lit(self) -> str:
        return self.label_end.isoformat()

    @property
    def base_start_lit(self) -> str:
        return self.base_start.isoformat()


# Fixed values of the scoring contract (risk tiers, rounding).
TIER_HIGH = 0.20
TIER_MEDIUM = 0.10
PROB_DECIMALS = 4
SWEEP_THRESHOLDS = (0.10, 0.15, 0.20, 0.25, 0.30)
LEAKAGE_TOLERANCE = 0.01
TEST_PERCENT = 20
VALIDATION_PERCENT = 20
SEED = 42


@dataclass(frozen=True)
class StandIn:
    """How the driver's tables play the reference's roles."""

    urgent_priority: str = "1-URGENT"        # loan   -> urgent orders
    bridge_returnflag: str = "R"            # card   -> returned bulk lineitems
    bridge_min_quantity: float = 48.0
    standing_status: str = "O"              # order  -> open orders
    sentinel_every: int = 7                 # '?' text in every 7th key
    incomplete_every: int = 11              # one missing field in every 11th key


WINDOWS = Windows()
STAND_IN = StandIn()
