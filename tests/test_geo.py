import math
import random

import pytest

from roadgauge.functions import geo
from roadgauge.schemas import GEOHASH_ALPHABET


def halved(lat, lon, precision):
    """Geohash by interval halving, for checking."""
    low, high, bits = [-180.0, -90.0], [180.0, 90.0], []
    for i in range(5 * precision):
        axis, value = i % 2, (lon, lat)[i % 2]
        mid = (low[axis] + high[axis]) / 2
        bits.append(value >= mid)
        (low if bits[-1] else high)[axis] = mid
    return "".join(
        GEOHASH_ALPHABET[int("".join(str(int(b)) for b in bits[i:i + 5]), 2)] for i in range(0, len(bits), 5))


@pytest.mark.parametrize("precision", [1, 5, 6, 7])
def test_geohash_equals_halving_also_next_to_cell_edges(spark, precision):
    rng = random.Random(precision)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1500)]
    lat_cell, lon_cell = 180 / 2 ** (5 * precision // 2), 360 / 2 ** ((5 * precision + 1) // 2)
    for _ in range(1500):
        lat = -90 + lat_cell * rng.randrange(int(180 / lat_cell))
        lon = -180 + lon_cell * rng.randrange(int(360 / lon_cell))
        points.append((math.nextafter(lat, rng.choice([-91, 91])), math.nextafter(lon, rng.choice([-181, 181]))))
        points.append((lat, lon))
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (95.0, 181.0), (-95.0, -181.0)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, latitude double, longitude double")
    got = [r[0] for r in rows.repartition(4).select(geo.geohash(precision=precision), "i").orderBy("i").collect()]
    assert got == [halved(*p, precision) for p in points]


def test_known_cell_and_nulls(spark):
    rows = spark.sql("select 40.7128d latitude, -74.0060d longitude union all select null, 1d")
    assert [r[0] for r in rows.select(geo.geohash()).collect()] == ["dr5reg", None]


def test_centre_lies_in_its_cell(spark):
    row = spark.sql("select 40.7128d latitude, -74.0060d longitude")
    lat, lon = geo.cell_centre(precision=5)
    centre = row.select(lat.alias("latitude"), lon.alias("longitude"))
    assert centre.select(geo.geohash(precision=5)).first()[0] == row.select(geo.geohash(precision=5)).first()[0]


def test_flat_distance(spark):
    row = spark.sql("select 40d a, -74d b, 41d c, -74d d, 40d e, -73d f")
    north, east = row.select(geo.flat_miles("a", "b", "c", "d"), geo.flat_miles("a", "b", "e", "f")).first()
    assert north == pytest.approx(69) and east == pytest.approx(69 * math.cos(math.radians(40)))
