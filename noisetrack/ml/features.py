"""Features and target; nothing that is derived from the measured level may be an input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noisetrack.schemas import AIRCRAFT_FEATURES

TARGET = "laeq_db"
NUMERIC = ("hour", "day_of_week", "is_night", "is_rush_hour", "is_weekend", *AIRCRAFT_FEATURES)
CATEGORICAL = ("airport",)
LEAKING = frozenset({"lmax_db", "laeq_db", "station_id", "station_name"})


def training_frame(enriched: DataFrame) -> DataFrame:
    """Those features that are there, and the target; rows without target go, categories are strings."""
    features = [c for c in (*NUMERIC, *CATEGORICAL) if c in enriched.columns]
    if leaks := LEAKING & set(features):
        raise ValueError(f"these columns give the target away: {sorted(leaks)}")
    out = enriched.select(*features, TARGET).na.drop(subset=[TARGET])
    return out.withColumns({c: F.col(c).cast("string") for c in CATEGORICAL if c in features})
