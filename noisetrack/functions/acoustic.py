"""Sound levels on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ambient levels and source levels.
AMBIENT_DAY_DB, AMBIENT_NIGHT_DB = 44.0, 39.0
SOURCE_LIGHT_DB, SOURCE_HEAVY_DB = 132.0, 139.0


def received_db(source_db: Column, slant_m: Column) -> Column:
    """Level at the ground of a source in the free field, not nearer than 50 m."""
    return source_db - 20 * F.log10(F.when(slant_m < 50, 50.0).otherwise(slant_m)) - 8


def energy(level_db: Column) -> Column:
    return F.pow(F.lit(10.0), level_db / 10)


def energy_sum_db(level_db: Column, ambient_db: Column | float) -> Column:
    """Aggregate: levels add up as energies, over an ambient floor."""
    ambient = ambient_db if isinstance(ambient_db, Column) else F.lit(ambient_db)
    return 10 * F.log10(F.coalesce(F.sum(energy(level_db)), F.lit(0.0)) + energy(ambient))


def ambient_db(hour: Column) -> Column:
    return F.when((hour >= 6) & (hour < 22), AMBIENT_DAY_DB).otherwise(AMBIENT_NIGHT_DB)


def noise_band(level_db: Column) -> Column:
    return F.when(level_db.isNull(), None).when(level_db < 50, "quiet").when(level_db < 60, "moderate").when(level_db < 68, "loud").otherwise("very loud")
