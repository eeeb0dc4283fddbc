"""Bounds, vocabularies and constants of a listings domain."""

from __future__ import annotations

from dataclasses import dataclass

# Column names of a cleaned listing and of its eight features.
CATEGORICAL = ("brand", "model", "fuel_type", "transmission_type")
NUMERIC = ("car_age", "power_ps", "mileage_in_km", "mileage_per_year")
FEATURES = CATEGORICAL + NUMERIC
TARGET = "price_in_euro"
SEGMENT = "price_segment"
MEASURES = ("price_in_euro", "year", "power_ps", "mileage_in_km")

# Raw columns that never reach the cleaned table.
LOW_VALUE_COLUMNS = (
    "Unnamed: 0",
    "registration_date",
    "power_kw",
    "color",
    "fuel_consumption_l_100km",
    "fuel_consumption_g_km",
    "offer_description",
)


@dataclass(frozen=True)
class Scope:
    """What counts as a general-market listing; the defaults are the German used-car market of 2023."""

    reference_year: int = 2023
    year_min: int = 2000
    price_min: float = 500.0
    price_max: float = 80000.0
    power_min: float = 40.0
    power_max: float = 800.0
    mileage_max: float = 500000.0
    mileage_excluded: float = 0.0
    unknown_transmission: str = "Unknown"
    fuels: tuple[str, ...] = (
        "Petrol", "Diesel", "Hybrid", "Electric", "LPG",
        "CNG", "Diesel Hybrid", "Ethanol", "Hydrogen", "Other",
    )
    # Limits on a valuation request, ends included.
    request_year: tuple[int, int] = (2000, 2023)
    request_power: tuple[float, float] = (41.0, 799.0)
    request_mileage: tuple[float, float] = (1.0, 500000.0)
    default_power: float = 150.0


@dataclass(frozen=True)
class Seeds:
    """Seed and shares of everything that is drawn by hashing a row key."""

    seed: int = 42
    test_percent: int = 20
    folds: int = 3
    min_model_rows: int = 50
