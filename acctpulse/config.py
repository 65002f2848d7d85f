"""Parameters of the scoring job.

Every date, threshold, ladder and weight the scores use lives here, so a run
over another quarter or another product catalogue is a new ``ScoreConfig``
rather than a code change.  The defaults are the fixed values of the original
scoring rules; ``FIXTURE_CONFIG`` re-targets the windows at the driver's
generated tables (see FIXTURES.md).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date
from decimal import Decimal
from itertools import product as _cartesian

# ---------------------------------------------------------------------------
# Fixed values (must equal the original rules for equal results).
# Ladders are "first match wins", listed from the highest band down as
# (threshold, score) pairs; the score is the fallback when no step matches.
# ---------------------------------------------------------------------------
TREND_STEPS = ((1.2, 100), (1.0, 80), (0.8, 60), (0.6, 40), (0.4, 20))
NO_BASELINE_TREND_SCORE = 70
RECENCY_MAX_DAYS = ((7, 100), (30, 80), (60, 60), (90, 40), (180, 20))
ADOPTION_STEPS = ((1.00, 100), (0.75, 80), (0.50, 60), (0.25, 40))
ADOPTION_ANY_ACTIVE_SCORE = 20
RELATIVE_STEPS = ((1.5, 100), (1.0, 80), (0.75, 60), (0.50, 40), (0.25, 20))
ZERO_PEER_MEDIAN_SCORE = 80
WEIGHTS = (
    ("submission_trend_score", Decimal("0.30")),
    ("mau_trend_score", Decimal("0.25")),
    ("recency_score", Decimal("0.20")),
    ("product_adoption_score", Decimal("0.15")),
    ("relative_activity_score", Decimal("0.10")),
)
HEALTHY_MIN = 70
AT_RISK_MIN = 40
GREEN_MAU_GROWTH = Decimal("1.1")
ENTERPRISE_ARR_ABOVE = 50000
MID_MARKET_ARR_ABOVE = 15000
URGENT_DAYS, URGENT_BELOW = 90, 40
WATCH_DAYS, WATCH_BELOW = 180, 70
HIGHER_ED_SPELLINGS = ("higher ed", "highered")
K12_SPELLING = "k12"
UNKNOWN_REGION = "Unknown"
DIVISIONS = ("Higher Ed", "K12")
REGIONS = ("NAM", "EMEA", "APAC", "LATAM", "Unknown")
HEALTH_TIERS = ("Healthy", "At Risk", "Critical")
URGENCIES = ("Urgent", "Watch", "Monitor")
MAU_STATUSES = ("Green", "Yellow", "Red", "New")
ARR_TIERS = ("Enterprise", "Mid-Market", "SMB")
# Reference windows: as-of date, recent quarter, prior quarter.
AS_OF = date(2025, 6, 30)
RECENT = (date(2025, 4, 1), date(2025, 6, 30))
PRIOR = (date(2025, 1, 1), date(2025, 3, 31))


@dataclass(frozen=True)
class ScoreConfig:
    as_of: date = AS_OF
    recent_start: date = RECENT[0]
    recent_end: date = RECENT[1]
    prior_start: date = PRIOR[0]
    prior_end: date = PRIOR[1]

    trend_steps: tuple = TREND_STEPS
    no_baseline_trend_score: int = NO_BASELINE_TREND_SCORE
    recency_max_days: tuple = RECENCY_MAX_DAYS
    adoption_steps: tuple = ADOPTION_STEPS
    adoption_any_active_score: int = ADOPTION_ANY_ACTIVE_SCORE
    relative_steps: tuple = RELATIVE_STEPS
    zero_peer_median_score: int = ZERO_PEER_MEDIAN_SCORE
    weights: tuple = WEIGHTS

    healthy_min: int = HEALTHY_MIN
    at_risk_min: int = AT_RISK_MIN
    green_mau_growth: Decimal = GREEN_MAU_GROWTH
    enterprise_arr_above: int = ENTERPRISE_ARR_ABOVE
    mid_market_arr_above: int = MID_MARKET_ARR_ABOVE
    urgent_days: int = URGENT_DAYS
    urgent_below: int = URGENT_BELOW
    watch_days: int = WATCH_DAYS
    watch_below: int = WATCH_BELOW

    higher_ed_spellings: tuple = HIGHER_ED_SPELLINGS
    k12_spelling: str = K12_SPELLING
    unknown_region: str = UNKNOWN_REGION

    # accepted values used by the data-quality checks; the product catalogue
    # is the deployment's own list (empty: ``quality.catalog`` raises)
    divisions: tuple = DIVISIONS
    regions: tuple = REGIONS
    products: tuple = ()

    # execution knobs (not semantics)
    broadcast_max_rows: int = 2_000_000
    # "filter": only possible repeats are shuffled (one more pass over the ids);
    # "window": every event is shuffled on its id, cheaper on small tables
    dedup: str = "filter"
    peer_group_cols: tuple = field(default=("division", "segment"))

    def with_windows(self, as_of, recent, prior) -> "ScoreConfig":
        return replace(self, as_of=as_of, recent_start=recent[0], recent_end=recent[1],
                       prior_start=prior[0], prior_end=prior[1])

    def composite_domain_size(self) -> int:
        """Upper bound on distinct composite scores: every weighted sum of one
        value per ladder.  Bounds the peer-percentile histogram."""
        trend = {s for _, s in self.trend_steps} | {0, self.no_baseline_trend_score}
        recency = {s for _, s in self.recency_max_days} | {0}
        adoption = {s for _, s in self.adoption_steps} | {0, self.adoption_any_active_score}
        relative = {s for _, s in self.relative_steps} | {0, self.zero_peer_median_score}
        w = [wt for _, wt in self.weights]
        sums = {
            a * w[0] + b * w[1] + c * w[2] + d * w[3] + e * w[4]
            for a, b, c, d, e in _cartesian(trend, trend, recency, adoption, relative)
        }
        return len(sums)


DEFAULT_CONFIG = ScoreConfig()

# Driver tables (FIXTURES.md): TPC-H-like dates end in 2001, products P0..P5,
# regions are the TPC-H region names.
FIXTURE_PRODUCTS = ("P0", "P1", "P2", "P3", "P4", "P5")
FIXTURE_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown")
FIXTURE_CONFIG = replace(
    DEFAULT_CONFIG,
    as_of=date(2001, 6, 30),
    recent_start=date(2000, 7, 1),
    recent_end=date(2001, 6, 30),
    prior_start=date(1999, 7, 1),
    prior_end=date(2000, 6, 30),
    products=FIXTURE_PRODUCTS,
    regions=FIXTURE_REGIONS,
    dedup="window",
)
# Second window set over the same tables: two calendar quarters.
FIXTURE_QUARTERS_CONFIG = FIXTURE_CONFIG.with_windows(
    date(2001, 6, 30), (date(2001, 4, 1), date(2001, 6, 30)), (date(2001, 1, 1), date(2001, 3, 31))
)
# Overlapping windows over the same tables, for the window report.
FIXTURE_WINDOWS = (
    ("last_30_days", date(2001, 6, 1), date(2001, 6, 30)),
    ("last_quarter", date(2001, 4, 1), date(2001, 6, 30)),
    ("last_half_year", date(2001, 1, 1), date(2001, 6, 30)),
    ("last_year", date(2000, 7, 1), date(2001, 6, 30)),
    ("year_2000", date(2000, 1, 1), date(2000, 12, 31)),
    ("all_before_2000", date(1970, 1, 1), date(1999, 12, 31)),
)
