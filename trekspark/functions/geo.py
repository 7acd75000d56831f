"""Column functions on coordinates: distances, local projection, geohash, rounded codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null if any coordinate is."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (p2 - p1) / 2.0, (F.radians(lon2) - F.radians(lon1)) / 2.0
    a = F.pow(F.sin(half_lat), 2.0) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), 2.0)
    return 2.0 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def to_plane(lat: Column, lon: Column, reference: Column) -> tuple[Column, Column]:
    """Equirectangular x and y in metres around a reference latitude."""
    return EARTH_M * F.cos(F.radians(reference)) * F.radians(lon), EARTH_M * F.radians(lat)


def from_plane(x: Column, y: Column, reference: Column) -> tuple[Column, Column]:
    """Latitude and longitude of plane coordinates; the cosine is kept off zero at the poles."""
    return F.degrees(y / EARTH_M), F.degrees(x / (EARTH_M * F.greatest(F.cos(F.radians(reference)), F.lit(1e-12))))


def bearing_change(a: Column, b: Column) -> Column:
    """Smallest angle between two headings, 0 to 180."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def _axis_bits(value: Column, low: float, high: float, bits: int) -> Column:
    """Number of the cell among 2**bits equal ones; the upper edge belongs to the last."""
    cells = 1 << bits
    return F.least(F.greatest(F.floor((value - low) / (high - low) * cells), F.lit(0)), F.lit(cells - 1)).cast("long")


def geohash(lat: Column, lon: Column, precision: int = 7) -> Column:
    """Base-32 geohash, longitude first; null for a null coordinate. Both axes are quantised and their bits interleaved."""
    total = 5 * precision
    x_bits, y_bits = (total + 1) // 2, total // 2
    x, y = _axis_bits(lon, -180.0, 180.0, x_bits), _axis_bits(lat, -90.0, 90.0, y_bits)
    letters = []
    for c in range(precision):
        index = F.lit(0).cast("long")
        for k in range(5):
            place = 5 * c + k
            source, bits = (x, x_bits) if place % 2 == 0 else (y, y_bits)
            bit = F.shiftright(source, bits - 1 - place // 2).bitwiseAND(F.lit(1).cast("long"))
            index = index + F.shiftleft(bit, 4 - k)
        letters.append(F.substring(F.lit(BASE32), (index + 1).cast("int"), F.lit(1)))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(*letters))


def coordinate_text(value: Column, digits: int) -> Column:
    """The value rounded half up to so many decimals, with all of them written. -0 is written as 0."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", F.round(value, digits) + F.lit(0.0)))


def pair_text(lat: Column, lon: Column, digits: int, between: str = "_") -> Column:
    """Both rounded coordinates, `nan` for a missing one."""
    text = lambda v: F.coalesce(coordinate_text(v, digits), F.lit("nan"))
    return F.concat(text(lat), F.lit(between), text(lon))
