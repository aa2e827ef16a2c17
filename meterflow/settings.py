"""Default settings. Every function takes these as arguments; nothing is read from disk."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must equal the published model's for results to agree.
TIMEZONE = "Asia/Colombo"
WINDOW_MINUTES = 60
WATERMARK_MINUTES = 30
MAX_LATENESS_MINUTES = 20
READINGS_PER_METER_DAY = 150
SUBSIDY_SHARE = "0.10"
NET_METERING = "import_only"
CURRENCY = "LKR"
TIER_RATES = {"domestic-1": 30.0, "domestic-2": 45.0, "domestic-3": 62.0}
TIER_WEIGHTS = {"domestic-1": 0.35, "domestic-2": 0.45, "domestic-3": 0.20}
SUBSIDY_PROBABILITY = 0.30
RATE_JITTER = 0.05
NO_DATA_SECONDS = 30
FRESHNESS_SLACK_SECONDS = 15
RAW_TRIGGER_SECONDS = 15
METRICS_TRIGGER_SECONDS = 5
LAG_BUDGET_TRIGGERS = 3
MONEY_TOLERANCE = "0.01"
KWH_TOLERANCE = "0.0001"


@dataclass(frozen=True)
class AlertThresholds:
    """Limits of the two zone rules; hours are local and half-open."""

    low_renewable_pct: float = 15.0
    check_from_hour: int = 9
    check_to_hour: int = 16
    overload_kw_per_meter: float = 2.2


@dataclass(frozen=True)
class BillingTerms:
    subsidy_share: str = SUBSIDY_SHARE
    net_metering: str = NET_METERING
    currency: str = CURRENCY

    def __post_init__(self):
        if self.net_metering != NET_METERING:
            raise ValueError(
                f"net metering scheme {self.net_metering!r} is not supported; only "
                f"{NET_METERING!r} is, because paying for exports needs an export rate"
            )


@dataclass(frozen=True)
class StreamSettings:
    """Window and watermark of the live jobs, checked when built.

    A watermark shorter than the gap between two readings of one meter, or shorter
    than the largest expected lateness, would drop good rows without an error.
    """

    timezone: str = TIMEZONE
    window_minutes: int = WINDOW_MINUTES
    watermark_minutes: int = WATERMARK_MINUTES
    max_lateness_minutes: int = MAX_LATENESS_MINUTES
    readings_per_meter_day: int = READINGS_PER_METER_DAY
    zones: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.window_minutes <= 0 or self.readings_per_meter_day <= 0:
            raise ValueError("window length and readings per day must be above zero")
        gap = 1440.0 / self.readings_per_meter_day
        if self.watermark_minutes < gap:
            raise ValueError(
                f"watermark of {self.watermark_minutes} min is shorter than the "
                f"{gap:.1f} min between readings"
            )
        if self.max_lateness_minutes > self.watermark_minutes:
            raise ValueError(
                f"rows may be {self.max_lateness_minutes} min late but the watermark "
                f"allows {self.watermark_minutes} min"
            )
        if self.zones and sum(self.zones.values()) <= 0:
            raise ValueError("the zones must hold at least one meter")


def check_tiers(rates: dict, weights: dict) -> None:
    """Every tier that can be drawn needs a rate."""
    undefined = sorted(set(weights) - set(rates))
    if undefined:
        raise ValueError(f"tiers without a rate: {undefined}")
