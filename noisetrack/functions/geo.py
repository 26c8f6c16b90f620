"""Geometry on columns; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
EARTH_M = 6_371_000.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    half = F.sqrt(a)
    return 2 * EARTH_KM * F.asin(F.when(half > 1, 1.0).otherwise(half))  # least() would turn null into 1


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The place on a sphere of radius 1.  Made once a row, it spares each pair of rows the trigonometry of ``haversine_km``."""
    phi, turn = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(turn), F.cos(phi) * F.sin(turn), F.sin(phi)


def squared_chord(u: tuple[Column, ...], v: tuple[Column, ...]) -> Column:
    """Squared straight distance of two unit vectors, which orders pairs as their great-circle distance does."""
    x, y, z = (a - b for a, b in zip(u, v, strict=True))
    return x * x + y * y + z * z


def chord_km(square: Column) -> Column:
    """Great-circle distance of a squared chord; equals ``haversine_km`` within 1e-8 km up to a quarter of
    the globe, beyond which both lose digits."""
    half = F.sqrt(square) / 2
    return 2 * EARTH_KM * F.asin(F.when(half > 1, 1.0).otherwise(half))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2) * 1000


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing, degrees clockwise from north in [0, 360)."""
    dlon = F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dlon)
    return (F.degrees(F.atan2(y, x)) + 360) % 360


def ang_diff(a: Column, b: Column) -> Column:
    """Smallest angle between two directions, in [0, 180]."""
    d = F.abs(a - b) % 360
    return F.least(d, 360 - d)


def slant_km(horizontal_km: Column, altitude_m: Column) -> Column:
    """Distance in space; an altitude below zero, or null, counts as zero."""
    up = F.greatest(altitude_m, F.lit(0.0)) / 1000
    return F.sqrt(horizontal_km * horizontal_km + up * up)


def elevation_deg(horizontal_m: Column, altitude_m: Column) -> Column:
    return F.degrees(F.atan2(altitude_m, F.when(horizontal_m < 1, 1.0).otherwise(horizontal_m)))


def advance(lat: Column, lon: Column, heading: Column, distance_m: Column) -> tuple[Column, Column]:
    """Dead reckoning on the sphere."""
    turn, angle, phi = F.radians(heading), distance_m / EARTH_M, F.radians(lat)
    phi2 = F.asin(F.sin(phi) * F.cos(angle) + F.cos(phi) * F.sin(angle) * F.cos(turn))
    lon2 = F.radians(lon) + F.atan2(F.sin(turn) * F.sin(angle) * F.cos(phi), F.cos(angle) - F.sin(phi) * F.sin(phi2))
    return F.degrees(phi2), F.degrees(lon2)


def move(lat: Column, lon: Column, heading: Column, distance_m: Column) -> tuple[Column, Column]:
    """Dead reckoning on a plane, for some seconds of flight."""
    turn = F.radians(heading)
    north, east = distance_m * F.cos(turn) / EARTH_M, distance_m * F.sin(turn) / (EARTH_M * F.cos(F.radians(lat)))
    return lat + F.degrees(north), lon + F.degrees(east)


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    """Inclusive on all sides."""
    return lat.between(south, north) & lon.between(west, east)
