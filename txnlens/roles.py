"""Column roles and the fixed constants of the transaction data model."""

from __future__ import annotations

from dataclasses import dataclass, replace

KEY = "trans_num"
EVENT_TIME = "datetime"
TARGET = "is_fraud"
EARTH_RADIUS_KM = 6371

# Column lists of the data model, in table order.
BASE_NUMERICAL = ("amt", "lat", "long", "city_pop", "age", "merch_lat", "merch_long")
DRIFT_NUMERICAL = ("amt", "lat", "long", "city_pop", "merch_lat", "merch_long")
DRIFT_CATEGORICAL = ("category", "gender", "city", "state", "zip")
LOW_CARDINALITY = ("category", "gender")
HIGH_CARDINALITY = ("merchant", "street", "city", "state", "zip", "job", "merch_zipcode")
NUMERICAL_GROUP = (KEY, EVENT_TIME, "age", "amt", "lat", "long", "city_pop", "merch_lat", "merch_long")
CATEGORICAL_GROUP = (KEY, EVENT_TIME, "cc_num_hashed", "merchant", "category", "first_hashed", "last_hashed",
                     "gender", "street", "city", "state", "zip", "job", "merch_zipcode")
TARGET_GROUP = (KEY, EVENT_TIME, TARGET)
CYCLE_LENGTHS = {"hour": 24, "weekday": 7, "month": 12, "day": 31}

# US state codes and gender codes a row may carry.
STATES = (
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "IA", "ID", "IL", "IN", "KS",
    "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV",
    "NY", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
)
GENDERS = ("M", "F", "U")

# Inclusive valid ranges and text formats.
VALID_RANGES = {
    "age": (16, 120),
    "amt": (0, 1_000_000),
    "lat": (-90, 90),
    "long": (-180, 180),
    "city_pop": (0, 100_000_000),
    "merch_lat": (-90, 90),
    "merch_long": (-180, 180),
}
ZIP_PATTERN = r"^\d{5}(-\d{4})?\z"
CARD_PATTERN = r"^\d{13,19}\z"
STRFTIME_FORMAT = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class Roles:
    """Ordered role lists; every operation keeps the order so column order is reproducible."""

    numerical: tuple[str, ...] = BASE_NUMERICAL
    low_cardinality: tuple[str, ...] = LOW_CARDINALITY
    high_cardinality: tuple[str, ...] = HIGH_CARDINALITY
    temporal: tuple[str, ...] = (EVENT_TIME,)
    binary: tuple[str, ...] = ()

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.low_cardinality + self.high_cardinality

    def without(self, columns) -> "Roles":
        gone = set(columns)
        return Roles(*(tuple(c for c in getattr(self, f) if c not in gone) for f in self.__dataclass_fields__))

    def extended(self, **added) -> "Roles":
        return replace(self, **{
            role: getattr(self, role) + tuple(c for c in cols if c not in getattr(self, role))
            for role, cols in added.items()
        })
