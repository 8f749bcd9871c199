"""Geometry of text quads (A-14, G-01 to G-07, G-12, F-12 to F-15), as column expressions.

A quad is array<struct<x double, y double>> of four corners; pixels are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_TILT, CROP_PAD = 0.7, 0.05


def long_edge(quad: Column) -> Column:
    """struct(dx, dy) of the first longest of the four edges."""
    edges = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct(
        (F.pow(quad[(i + 1) % 4]["x"] - quad[i]["x"], 2) + F.pow(quad[(i + 1) % 4]["y"] - quad[i]["y"], 2)).alias("size"), (-i).alias("first"),
        (quad[(i + 1) % 4]["x"] - quad[i]["x"]).alias("dx"), (quad[(i + 1) % 4]["y"] - quad[i]["y"]).alias("dy")))
    return F.array_max(edges)


def page_angle(quad: Column) -> Column:
    """Aggregate: length-weighted mean direction of text lines in degrees, averaged doubled; 0 without lines."""
    edge = long_edge(quad)
    angle, size = F.atan2(edge["dy"], edge["dx"]), F.sqrt(edge["size"])
    return F.coalesce(F.degrees(F.atan2(F.sum(size * F.sin(2 * angle)), F.sum(size * F.cos(2 * angle)))) / 2, F.lit(0.0))


def bounds(quad: Column) -> Column:
    """struct(x, y, w, h) of the axis-aligned extent."""
    xs, ys = quad["x"], quad["y"]
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h"))


def ordered(quad: Column) -> Column:
    """Corners from the top left clockwise: least x+y, least y-x, greatest x+y, greatest y-x; the first wins ties."""
    def pick(key, largest: bool) -> Column:
        sign = -1 if largest else 1
        return F.array_min(F.transform(quad, lambda p, i: F.struct((sign * key(p)).alias("k"), i.alias("i"), p.alias("p"))))["p"]

    return F.array(pick(lambda p: p["x"] + p["y"], False), pick(lambda p: p["y"] - p["x"], False), pick(lambda p: p["x"] + p["y"], True), pick(lambda p: p["y"] - p["x"], True))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))


def rectified(quad: Column, padding: float = CROP_PAD) -> Column:
    """struct(width, height, stands): size of the upright strip; null under 4 pixels; stands: to be turned by 90 degrees."""
    q = ordered(quad)
    width = F.bround((1 + padding) * F.greatest(_distance(q[1], q[0]), _distance(q[2], q[3])), 0).cast("int")
    height = F.bround((1 + padding) * F.greatest(_distance(q[3], q[0]), _distance(q[2], q[1])), 0).cast("int")
    return F.when((width >= 4) & (height >= 4), F.struct(width.alias("width"), height.alias("height"), (height >= width * 1.5).alias("stands")))


def rotated_size(width: Column, height: Column, degrees: Column) -> Column:
    """struct(action, width, height) of rotating a page: none below the least tilt, exact near quarter turns, else grown."""
    quarter = F.bround(degrees / 90, 0).cast("int")
    sin, cos = F.abs(F.sin(F.radians(degrees))), F.abs(F.cos(F.radians(degrees)))
    odd = F.pmod(quarter, F.lit(2)) == 1
    shape = lambda action, w, h: F.struct(F.lit(action).alias("action"), w.cast("int").alias("width"), h.cast("int").alias("height"))
    return (F.when(F.abs(degrees) < MIN_TILT, shape("none", width, height))
            .when(F.abs(degrees - quarter * 90) < MIN_TILT, shape("quarter", F.when(odd, height).otherwise(width), F.when(odd, width).otherwise(height)))
            .otherwise(shape("affine", height * sin + width * cos, height * cos + width * sin)))


def half_turn(quad: Column, width: Column, height: Column) -> Column:
    """The quad on a page turned by 180 degrees, corners in reverse."""
    return F.reverse(F.transform(quad, lambda p: F.struct((width - p["x"]).alias("x"), (height - p["y"]).alias("y"))))


def area(quad: Column) -> Column:
    """Shoelace area."""
    terms = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: quad[i]["x"] * quad[(i + 1) % 4]["y"] - quad[(i + 1) % 4]["x"] * quad[i]["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2


def crop_rectangle(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, pad: float = CROP_PAD) -> Column:
    """struct(left, top, right, bottom): padded, cut toward zero, clamped to the page."""
    cut = lambda c: c.cast("int")
    return F.struct(F.greatest(F.lit(0), cut(x - w * pad)).alias("left"), F.greatest(F.lit(0), cut(y - h * pad)).alias("top"), F.least(width, cut(x + w + w * pad)).alias("right"), F.least(height, cut(y + h + h * pad)).alias("bottom"))


def page_turn(width: Column, height: Column, degrees: Column) -> Column:
    """struct: what all points of a page share that is turned counter-clockwise, on the canvas that `rotated_size` gives. quarter
    is 0 to 3 for turns without interpolation, else null."""
    new = rotated_size(width, height, degrees)
    quarter = F.when(new["action"] == "none", F.lit(0)).when(new["action"] == "quarter", F.pmod(F.bround(degrees / 90, 0).cast("int"), F.lit(4)))
    return F.struct(quarter.alias("quarter"), F.cos(F.radians(degrees)).alias("cos"), F.sin(F.radians(degrees)).alias("sin"), width.alias("width"), height.alias("height"),
                    (width / 2).alias("cx"), (height / 2).alias("cy"), (new["width"] / 2).alias("to_x"), (new["height"] / 2).alias("to_y"))


def point_turned(p: Column, t: Column) -> Column:
    """A point of a page under what `page_turn` gives."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = p["x"] - t["cx"], p["y"] - t["cy"]
    return (F.when(t["quarter"].isNull(), point(x * t["cos"] + y * t["sin"] + t["to_x"], y * t["cos"] - x * t["sin"] + t["to_y"]))
            .when(t["quarter"] == 0, point(p["x"], p["y"]))
            .when(t["quarter"] == 1, point(p["y"], t["width"] - p["x"]))
            .when(t["quarter"] == 2, point(t["width"] - p["x"], t["height"] - p["y"]))
            .otherwise(point(t["height"] - p["y"], p["x"])))


def turned_point(p: Column, width: Column, height: Column, degrees: Column) -> Column:
    """A point of a page that is turned counter-clockwise, on the canvas that `rotated_size` gives."""
    return point_turned(p, page_turn(width, height, degrees))


def perspective(width: Column, height: Column, corners: Column) -> list[list[Column]]:
    """The homography that takes a page's corners, from the top left clockwise, to the four points given; m[2][2] is 1.

    Four points leave eight equations; for a rectangle they fall apart: the two coefficients of the divisor come from a
    2 x 2 system of the sides' differences, the others follow from the corners one by one.
    """
    x, y = [corners[i]["x"] for i in range(4)], [corners[i]["y"] for i in range(4)]
    ax, ay, bx, by = x[1] - x[2], y[1] - y[2], x[3] - x[2], y[3] - y[2]
    cx, cy = x[0] - x[1] + x[2] - x[3], y[0] - y[1] + y[2] - y[3]
    size = ax * by - bx * ay
    g, h = (cx * by - bx * cy) / size, (ax * cy - cx * ay) / size
    return [[(x[1] - x[0] + g * x[1]) / width, (x[3] - x[0] + h * x[3]) / height, x[0]],
            [(y[1] - y[0] + g * y[1]) / width, (y[3] - y[0] + h * y[3]) / height, y[0]],
            [g / width, h / height, F.lit(1.0)]]
