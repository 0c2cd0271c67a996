"""Rule thresholds and the other fixed values results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay as they are for results to match the
# behaviour this project reproduces: anomaly thresholds, the far state pairs
# (either direction counts), and the model / basket / forecast settings.
# ---------------------------------------------------------------------------
GEO_TIME_HOURS = 4
VELOCITY_LIMIT = 5
FIRST_ORDER_HIGH_VALUE = 500
OFF_HOURS_START, OFF_HOURS_END = 1, 5
OFF_HOURS_HIGH_VALUE = 1000
AMOUNT_HIGH_VALUE = 3000
FREIGHT_LIMIT = 100
VELOCITY_WINDOW_SECONDS = 3600
FAR_PAIRS = (("SP", "AM"), ("SP", "PA"), ("RJ", "AM"), ("MG", "AC"),
             ("SP", "RR"), ("PR", "AP"), ("RS", "AM"), ("SP", "AC"))
WIRE_TS_FORMAT = "dd-MM-yyyy HH:mm"
ALERT_SCORE = 1.0
RECENT_ALERTS_KEPT = 200

GBT_MAX_ITER = 50
GBT_MAX_DEPTH = 5
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
FP_MIN_SUPPORT = 0.001
FP_MIN_CONFIDENCE = 0.2
FORECAST_TEST_WEEKS = 8
FORECAST_MIN_TRAIN_WEEKS = 15
FORECAST_MIN_DAYS = 30
FORECAST_HORIZON_WEEKS = 12
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the six order-anomaly rules (all comparisons strict)."""

    geo_time_hours: float = GEO_TIME_HOURS
    velocity_limit: int = VELOCITY_LIMIT
    velocity_window_seconds: int = VELOCITY_WINDOW_SECONDS
    first_order_high_value: float = FIRST_ORDER_HIGH_VALUE
    off_hours_start: int = OFF_HOURS_START
    off_hours_end: int = OFF_HOURS_END
    off_hours_high_value: float = OFF_HOURS_HIGH_VALUE
    amount_high_value: float = AMOUNT_HIGH_VALUE
    freight_limit: float = FREIGHT_LIMIT
    far_pairs: tuple = field(default=FAR_PAIRS)

    def far_pair_keys(self) -> list[str]:
        """Order-free pair keys ``"A|B"`` with A <= B."""
        return sorted({"|".join(sorted(p)) for p in self.far_pairs})


DEFAULT_RULES = RuleConfig()
