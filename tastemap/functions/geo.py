"""Web-Mercator coordinates and address lines."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sphere of Web Mercator, half the side of its square map in
# metres, and the latitude at the edge of that square.
EARTH_RADIUS = 6378137.0
HALF_SIDE = math.pi * EARTH_RADIUS
EDGE_LATITUDE = math.degrees(2 * math.atan(math.exp(math.pi)) - math.pi / 2)


def mercator_x(longitude: str) -> Column:
    return F.radians(F.col(longitude)) * EARTH_RADIUS


def mercator_y(latitude: str) -> Column:
    """Northing in metres, held at the edge of the map towards the poles."""
    lat = F.col(latitude)
    inside = F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * EARTH_RADIUS
    return (F.when(F.abs(lat) > 90, None)
             .when(lat >= EDGE_LATITUDE, HALF_SIDE)
             .when(lat <= -EDGE_LATITUDE, -HALF_SIDE)
             .otherwise(inside))


def address_line(*parts: str) -> Column:
    """The parts joined by ``", "``; a missing part leaves its place empty."""
    texts = [F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws(", ", *texts)
