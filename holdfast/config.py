"""The housing contract: column groups, ranges and constants every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

RANDOM_SEED = 42

# Names, order, ranges and cut points of the housing table contract.
TARGET = "median_house_value"

NUMERIC_COLUMNS = [
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
]
CATEGORICAL_COLUMNS = ["ocean_proximity"]
HEAVY_TAILED_COLUMNS = ["total_rooms", "total_bedrooms", "population", "households"]
PLAIN_COLUMNS = ["longitude", "latitude", "housing_median_age", "median_income"]
GEO_COLUMNS = ["latitude", "longitude", "population"]
BINNED_COLUMNS = ["median_income", "housing_median_age"]

# Increasing distance from water.
OCEAN_PROXIMITY_ORDER = ["ISLAND", "NEAR BAY", "NEAR OCEAN", "<1H OCEAN", "INLAND"]

TARGET_CAP = 500_001.0
TARGET_FLOOR = 14_999.0

# Right-closed bands: (0, 1.5], (1.5, 3], (3, 4.5], (4.5, 6], (6, inf).
INCOME_BAND_EDGES = [0.0, 1.5, 3.0, 4.5, 6.0]
INCOME_BAND_LABELS = [1, 2, 3, 4, 5]

VALUE_RANGES = {
    "longitude": (-125.0, -113.0),
    "latitude": (32.0, 43.0),
    "housing_median_age": (1.0, 100.0),
    "total_rooms": (1.0, 100_000.0),
    "total_bedrooms": (1.0, 100_000.0),
    "population": (1.0, 100_000.0),
    "households": (1.0, 100_000.0),
    "median_income": (0.0, 20.0),
    TARGET: (0.0, 600_000.0),
}

# (name, numerator, denominator)
RATIOS = [
    ("rooms_per_household", "total_rooms", "households"),
    ("bedrooms_per_room", "total_bedrooms", "total_rooms"),
    ("population_per_household", "population", "households"),
]

CSV_NAME = "housing.csv"
CSV_ENV_VAR = "HOLDFAST_CSV"
CSV_DEFAULT = "data/raw/housing.csv"

#: Contract schema in file order: numeric columns, target, string columns.
SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in [*NUMERIC_COLUMNS, TARGET]]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL_COLUMNS]
)
