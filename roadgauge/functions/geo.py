"""Geohash and distance as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadgauge.functions.columns import _col
from roadgauge.schemas import GEOHASH_ALPHABET, MILES_PER_DEGREE


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the half-open cell holding the value, out of 2**bits equal cells.

    The division may land one cell off for values next to an edge, while the edges
    themselves are exact doubles, so the index is compared with its own edges.
    Values outside the range take the first or last cell.
    """
    width = span / 2 ** bits
    last = 2 ** bits - 1
    guess = F.floor((value - low) / width)
    exact = (
        F.when(value < guess * width + low, guess - 1)
        .when(value >= (guess + 1) * width + low, guess + 1)
        .otherwise(guess)
    )
    # not greatest() and least(), which would turn a null into a cell
    return F.when(exact < 0, F.lit(0)).when(exact > last, F.lit(last)).otherwise(exact)


def _axes(precision: int) -> tuple[int, int]:
    """Bits for longitude and latitude; longitude takes the odd one."""
    total = 5 * precision
    return (total + 1) // 2, total // 2


def geohash(lat="latitude", lon="longitude", precision: int = 6) -> Column:
    """Base-32 geohash text, longitude bit first; null if a coordinate is null."""
    lon_bits, lat_bits = _axes(precision)
    axes = [
        (_cell(_col(lon), -180.0, 360.0, lon_bits), lon_bits),
        (_cell(_col(lat), -90.0, 180.0, lat_bits), lat_bits),
    ]

    def bit(position: int) -> Column:
        cell, bits = axes[position % 2]
        return F.shiftright(cell, bits - 1 - position // 2).bitwiseAND(F.lit(1))

    letters = []
    for start in range(0, 5 * precision, 5):
        code = sum((bit(start + i) * (16 >> i) for i in range(1, 5)), bit(start) * 16)
        letters.append(F.substring(F.lit(GEOHASH_ALPHABET), (code + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def cell_centre(lat="latitude", lon="longitude", precision: int = 6) -> tuple[Column, Column]:
    """Latitude and longitude of the middle of the geohash cell."""
    lon_bits, lat_bits = _axes(precision)
    lat_width, lon_width = 180.0 / 2 ** lat_bits, 360.0 / 2 ** lon_bits
    return (
        (_cell(_col(lat), -90.0, 180.0, lat_bits) + 0.5) * lat_width - 90.0,
        (_cell(_col(lon), -180.0, 360.0, lon_bits) + 0.5) * lon_width - 180.0,
    )


def flat_miles(lat1, lon1, lat2, lon2) -> Column:
    """Distance on a local plane: 69 miles per degree, longitude shrunk by cos(latitude)."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    north = (lat2 - lat1) * MILES_PER_DEGREE
    east = (lon2 - lon1) * MILES_PER_DEGREE * F.cos(F.radians(lat2))
    return F.sqrt(north * north + east * east)
