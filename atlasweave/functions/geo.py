"""Map coordinates, tiles and curves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The drawing's x at longitude 0, degrees in one unit, and the constant of the y axis.
ORIGIN_X, SCALE, CONSTANT_Y = 428.530, 0.017504, 3347.85

# Drawing x and y, and longitude and latitude, of known points.
CALIBRATION = (
    ("Altdorf", 428.519, 407.885, 0.000, 51.460),
    ("Middenheim", 495.376, 187.843, 1.172, 55.312),
    ("Wachdorf", 738.284, 778.673, 5.422, 44.970),
    ("Waldenhof (Sylvania)", 891.496, 479.299, 8.104, 50.210),
)

# The tile frame in degrees, its pixels, and the viewer's full extent and scale.
FRAME_SPAN, TILE_PIXELS, MIN_ZOOM, MAX_ZOOM, BLOCK_TILES = 37.0, 256, 1, 8, 32
EXTENT = (-19.045, 31.949, 18.457, 69.451)
VIEW_RESOLUTION, VIEW_SCALE, QUADRANT_SCALE = 0.15003, 0.9997, 1.56221


def longitude(x: Column) -> Column:
    return (x - ORIGIN_X) * SCALE


def latitude(y: Column) -> Column:
    return (CONSTANT_Y - y) * SCALE


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1))


def rounded(c: Column, places: int) -> Column:
    """A length rounded as DuckDB does it, halves up, in plain doubles: Spark's own ``round`` makes a decimal of each value."""
    scaled = c * 10.0**places
    whole = F.floor(scaled)
    return (whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)) / 10.0**places


def frame_resolution(zoom: Column) -> Column:
    """Degrees a pixel of the frame's tiles."""
    return F.lit(FRAME_SPAN) / (TILE_PIXELS * F.pow(F.lit(2.0), zoom))


def view_resolution(zoom: Column, quadrant: bool = False) -> Column:
    """Degrees a pixel of the viewer's tiles, of a quadrant's or of the whole map's."""
    whole = F.lit(VIEW_RESOLUTION) * VIEW_SCALE / F.pow(F.lit(2.0), zoom)
    return whole / QUADRANT_SCALE if quadrant else whole


def quadrant(lon: Column, lat: Column) -> Column:
    """SW, SE, NW or NE of the extent's centre; null outside of the extent."""
    x0, y0, x1, y1 = EXTENT
    inside = lon.between(x0, x1) & lat.between(y0, y1)
    return F.when(inside, F.concat(F.when(lat < (y0 + y1) / 2, "S").otherwise("N"), F.when(lon < (x0 + x1) / 2, "W").otherwise("E")))


def viewer_row(y: Column) -> Column:
    """The viewer's tile row for the tile grid's, and the other way round."""
    return -1 - y


def tile_path(zoom: Column, x: Column, y: Column) -> Column:
    return F.concat(F.concat_ws("/", zoom.cast("string"), x.cast("string"), y.cast("string")), F.lit(".png"))


def bezier(p0: Column, p1: Column, p2: Column, p3: Column, samples: int = 20) -> Column:
    """``samples`` points (struct of x, y) of a cubic, both ends among them."""

    def at(i: Column) -> Column:
        t = i / F.lit(float(samples - 1))
        m = 1 - t
        axis = lambda k: m * m * m * p0[k] + 3 * m * m * t * p1[k] + 3 * m * t * t * p2[k] + t * t * t * p3[k]
        return F.struct(axis("x").alias("x"), axis("y").alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), at)


def coordinate_text(lon: Column, lat: Column, resolution: Column | None = None) -> Column:
    """A place as the viewer shows it, with its resolution times 100 if there is one."""
    place = F.format_string("X=%.3f, Y=%.3f", lon, lat)
    return place if resolution is None else F.concat(place, F.format_string(", Z=%.3f", resolution * 100))


def polyline_length(points: Column) -> Column:
    """Sum of the lengths between consecutive points (structs of x and y)."""
    ends = F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), lambda a, b: distance(a["x"], a["y"], b["x"], b["y"]))
    return F.aggregate(ends, F.lit(0.0), lambda acc, d: acc + d)


def edge_weight(length: Column, stroke: Column, base: float = 2.05) -> Column:
    """Length that a thicker line makes shorter."""
    return length * (F.lit(base) / stroke)
