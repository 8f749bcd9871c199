"""Page-level decisions over text quads (A-13, G-05, T-03), boxes on warped pages (G-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.functions.geometry import area


def largest(quads: DataFrame, k: int = 8, quad: str = "q", page: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """The k quads of a page with the greatest area, with their area (6 places) and place; ties go by the columns named."""
    sized = quads.withColumn("area", F.round(area(F.col(quad)), 6))
    order = Window.partitionBy(page).orderBy(F.desc("area"), *ties)
    return sized.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def upright(readings: DataFrame, as_is: str = "as_is", flipped: str = "flipped", page: str = "doc_id") -> DataFrame:
    """(page, flip): a page is turned by 180 degrees only if its lines read strictly better so; a missing score is 0."""
    mean = lambda c: F.avg(F.coalesce(F.col(c), F.lit(0.0)))
    return readings.groupBy(page).agg((mean(flipped) > mean(as_is)).alias("flip"))


def warped_boxes(boxes: DataFrame, m: list[list[float]] | list[list[Column]], width: int, height: int, pad: float = 0.10, min_side: float = 8) -> DataFrame:
    """`boxes` with x, y, w, h of their extent under the homography m, padded and clamped; without those of which a side falls short.

    m may hold columns of `boxes`, which are passed on like all others. Each step is a select of plain arithmetic, so that its
    input is worked out once and compiled; the last is a list of one box or none, as a filter would be worked out before the
    steps and make them twice.
    """
    at = F.col
    others = [c for c in boxes.columns if c not in ("x", "y", "w", "h")]
    corners = [(at("x") + i * at("w") if i else at("x"), at("y") + j * at("h") if j else at("y")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))]
    moved = lambda row, p: (row[0] * p[0] + row[1] * p[1] + row[2]) / (m[2][0] * p[0] + m[2][1] * p[1] + m[2][2])
    q = boxes.select(*others, *[moved(m[axis], p).alias(f"_{name}{k}") for k, p in enumerate(corners) for axis, name in enumerate("uv")])
    e = q.select(*others, *[f(*[f"_{name}{k}" for k in range(4)]).alias(f"_{name}_{end}") for name in "uv" for end, f in (("low", F.least), ("high", F.greatest))])
    px, py = (at("_u_high") - at("_u_low")) * pad, F.greatest((at("_v_high") - at("_v_low")) * pad, F.lit(3.0))
    k = e.select(*others, F.greatest(F.lit(0.0), at("_u_low") - px).alias("_x"), F.greatest(F.lit(0.0), at("_v_low") - py).alias("_y"), F.least(F.lit(float(width)), at("_u_high") + px).alias("_r"), F.least(F.lit(float(height)), at("_v_high") + py).alias("_b"))
    w, h = at("_r") - at("_x"), at("_b") - at("_y")
    return k.select(*others, F.inline(F.when((w >= min_side) & (h >= min_side), F.array(F.struct(at("_x").alias("x"), at("_y").alias("y"), w.alias("w"), h.alias("h"))))))
