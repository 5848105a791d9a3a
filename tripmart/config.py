"""Column contract, model settings and month arithmetic.

Everything an operator needs to know about a concrete dataset is in these
frozen dataclasses, so the operators themselves stay plain
``DataFrame -> DataFrame`` functions.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. They must equal the published data contract and rules for the
# results to be right.
# --------------------------------------------------------------------------

# Monthly trip file: column -> type the raw layer stores it in.
RAW_COLUMNS = {
    "VendorID": "double",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# Money columns of the cleaned table, all decimal(10,2).
MONEY_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)

# Components that must add up to total_amount.
TOTAL_COMPONENTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

RATE_CODES = (1, 6)
CARD_PAYMENT = 1
STORED_FLAG = "Y"
PUBLICATION_LAG_DAYS = 90

# Tip classes: above 20 percent of the fare, from 5 percent, below.
TIP_HIGH, TIP_MEDIUM, TIP_LOW = "Alta", "Media", "Baja"
TIP_HIGH_ABOVE, TIP_MEDIUM_FROM = 20, 5

ZONE_PREMIUM = "Premium Zone"
ZONE_FREQUENT = "High Frequency Zone"
ZONE_TIP = "High Tip Zone"
ZONE_STANDARD = "Standard Zone"

REGRESSION_FEATURES = (
    "trip_distance",
    "trip_duration_minutes",
    "passenger_count",
    "PULocationID",
    "DOLocationID",
    "pickup_hour",
    "pickup_day_of_week",
)
CLASSIFICATION_FEATURES = REGRESSION_FEATURES + ("payment_type", "RatecodeID")
ZONE_FEATURES = (
    "avg_revenue",
    "avg_distance",
    "avg_duration_minutes",
    "avg_tip_efficiency",
    "total_trips",
)

# --------------------------------------------------------------------------


@dataclass(frozen=True)
class TripContract:
    """Names, aliases and rule values of a trip table.

    ``aliases`` maps other spellings to contract names (matching ignores
    case, so ``Airport_fee`` needs no alias).  ``components`` is open because
    providers add surcharges over time; a surcharge that is part of the
    reported total but not listed here flags every trip as inconsistent.
    ``money`` must cover ``components``.
    """

    columns: dict[str, str] = field(default_factory=lambda: dict(RAW_COLUMNS))
    aliases: dict[str, str] = field(default_factory=dict)
    money: tuple[str, ...] = MONEY_COLUMNS
    components: tuple[str, ...] = TOTAL_COMPONENTS
    rate_codes: tuple[int, int] = RATE_CODES
    card_payment: int = CARD_PAYMENT
    stored_flag: str = STORED_FLAG
    # A larger distance, infinity or "not a number" (which sorts above all
    # numbers) is rejected: it is no distance.
    distance_most: float = 1e9

    def canonical(self, name: str) -> str:
        """Contract spelling of ``name``, or ``name`` itself if unknown."""
        low = name.lower()
        for alias, target in self.aliases.items():
            if alias.lower() == low:
                return target
        for column in self.columns:
            if column.lower() == low:
                return column
        return name


@dataclass(frozen=True)
class ZoneLabel:
    """A label and the bounds of profile means it asks for: metric -> (above, below), either may be None."""

    name: str
    bounds: dict[str, tuple[float | None, float | None]]


# Tried in order; the label of a cluster that none of them fits comes last.
ZONE_LABELS = (
    ZoneLabel(ZONE_PREMIUM, {"avg_revenue": (20, None), "avg_distance": (5, None)}),
    ZoneLabel(ZONE_FREQUENT, {"total_trips": (5000, None), "avg_distance": (None, 3)}),
    ZoneLabel(ZONE_TIP, {"avg_tip_efficiency": (15, None)}),
    ZoneLabel(ZONE_STANDARD, {}),
)


@dataclass(frozen=True)
class ModelConfig:
    window_months: int = 6
    trees: int = 10
    depth: int = 4
    bins: int = 32
    subsample: float = 0.5
    # Whether a tree draws its rows with replacement; without, and with subsample 1,
    # every tree sees all rows.
    bootstrap: bool = True
    seed: int = 42
    train_percent: int = 80
    # Below 100, the tip classifier is fitted on a repeatable sample of its
    # training side; hold-out rows and the fare model are never sampled.
    sample_percent: int = 100
    clusters: int = 4
    cluster_iterations: int = 20
    horizon_days: int = 30
    regression_features: tuple[str, ...] = REGRESSION_FEATURES
    classification_features: tuple[str, ...] = CLASSIFICATION_FEATURES
    zone_features: tuple[str, ...] = ZONE_FEATURES
    zone_labels: tuple[ZoneLabel, ...] = ZONE_LABELS
    # Partitions that rows are laid out in before a fit, so that the fit does not
    # depend on the splits of a cluster.  For the forests that is a shuffle of
    # all training rows, so it has to be asked for.
    zone_layout: int = 8
    forest_layout: int | None = None
    # Columns whose hash decides on which side of the hold-out split a trip is.
    split_columns: tuple[str, ...] = (
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "total_amount",
    )


@dataclass(frozen=True)
class ForecastConfig:
    """Additive model: trend with hinges + yearly + weekly Fourier terms."""

    yearly_order: int = 10
    weekly_order: int = 3
    hinges: int = 25
    hinge_range: float = 0.8
    # Ridge weight of the trend hinges and of the seasonal terms; intercept
    # and base slope are not penalised.
    hinge_penalty: float = 10.0
    season_penalty: float = 0.1
    # Two-sided 95 percent quantile of the normal distribution.
    band: float = 1.959963984540054

    @property
    def terms(self) -> int:
        return 2 + self.hinges + 2 * self.yearly_order + 2 * self.weekly_order


@dataclass(frozen=True)
class Months:
    """Half-open run of calendar months, counted as ``year * 12 + month - 1``."""

    first: int
    stop: int

    @classmethod
    def of(cls, year: int, month: int, count: int = 1) -> "Months":
        first = int(year) * 12 + int(month) - 1
        return cls(first, first + count)

    @classmethod
    def between(cls, first: str, last: str) -> "Months":
        """``between("1998-01", "1998-03")`` holds three months."""
        y0, m0 = map(int, first.split("-"))
        y1, m1 = map(int, last.split("-"))
        return cls(y0 * 12 + m0 - 1, y1 * 12 + m1)

    def before(self, count: int) -> "Months":
        """The ``count`` months that end where this run starts."""
        return Months(self.first - count, self.first)

    def widened(self, count: int) -> "Months":
        """This run and the ``count`` months before it."""
        return Months(self.first - count, self.stop)

    @staticmethod
    def _day(index: int) -> str:
        return dt.date(index // 12, index % 12 + 1, 1).isoformat()

    @property
    def start_day(self) -> str:
        return self._day(self.first)

    @property
    def stop_day(self) -> str:
        return self._day(self.stop)

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return [(i // 12, i % 12 + 1) for i in range(self.first, self.stop)]


@dataclass(frozen=True)
class Run:
    """One monthly run: the month it is for and the day it is made on."""

    year: int
    month: int
    as_of: dt.date

    @property
    def months(self) -> Months:
        return Months.of(self.year, self.month)
