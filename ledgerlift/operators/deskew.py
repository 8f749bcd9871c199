"""Levelling pages pass by pass (W-08, G-04): the frame that is worked on shrinks to the pages that still lean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.geometry import MIN_TILT, long_edge, page_turn, point_turned
from ledgerlift.shared import written

PASSES, LEAST_LINES = 3, 4


def lines_angle(quads: Column) -> Column:
    """Length-weighted mean direction of an array of quads in degrees, averaged doubled; 0 without quads."""
    edges = F.transform(quads, lambda q: long_edge(q))
    parts = F.transform(edges, lambda e: F.struct((F.sqrt(e["size"]) * F.cos(2 * F.atan2(e["dy"], e["dx"]))).alias("c"), (F.sqrt(e["size"]) * F.sin(2 * F.atan2(e["dy"], e["dx"]))).alias("s")))
    total = lambda name: F.aggregate(parts, F.lit(0.0), lambda a, p: a + p[name])
    return F.degrees(F.atan2(total("s"), total("c"))) / 2


def turned_quads(quads: Column, width: Column, height: Column, degrees: Column) -> Column:
    """An array of quads on a page that is turned counter-clockwise by `degrees`, as `rotated_size` says how; what its points
    share is worked out once a page."""
    turned = lambda t: F.transform(quads, lambda q: F.transform(q, lambda p: point_turned(p, t)))
    return F.get(F.transform(F.array(page_turn(width, height, degrees)), turned), F.lit(0))


def deskew(pages: DataFrame, detect: Callable[[DataFrame], DataFrame], passes: int = PASSES, least_lines: int = LEAST_LINES) -> DataFrame:
    """`pages` with degrees, quads and n_passes: by how much each is to be turned to be level, and its lines then.

    detect takes pages with a column `degrees` and adds `quads`, the lines found on the original page turned by that much;
    it is asked anew in each pass, for the pages that still lean. A page leaves when its lines lean by less than MIN_TILT
    or are fewer than `least_lines`, or when the next turn would leave fewer (that turn is not taken), or after `passes`.
    One row a page holds its lines, so a pass moves no data; each writes what it found, and only leaning pages go on.
    An empty table gives an empty result. Pages need not have an id.
    """
    names = [*pages.columns, "degrees", "quads", "n_passes"]
    found = detect(pages.withColumn("degrees", F.lit(0.0))).withColumn("n_passes", F.lit(0)).select(*names)
    state, done = written(_leaning(found, least_lines)), None
    for n in range(1, passes + 1):
        level = state.where("NOT leans").select(*names)
        done = level if done is None else done.unionByName(level)
        leaning = state.where("leans")
        if leaning.isEmpty():
            return done
        asked = leaning.withColumnsRenamed({"quads": "_quads", "degrees": "_degrees"}).drop("leans", "n_passes")
        seen = detect(asked.withColumn("degrees", F.col("_degrees") + F.col("angle")).drop("angle"))
        lost = F.size("quads") < least_lines
        kept = [F.when(lost, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("degrees", "quads")]
        after = seen.select(*pages.columns, *kept, F.when(lost, n - 1).otherwise(n).alias("n_passes"), lost.alias("lost"))
        state = _leaning(after, least_lines)
        state = written(state.withColumn("leans", F.col("leans") & ~F.col("lost")).drop("lost"))
    return done.unionByName(state.select(*names))


def _leaning(found: DataFrame, least_lines: int) -> DataFrame:
    angled = found.withColumn("angle", lines_angle(F.col("quads")))
    return angled.withColumn("leans", (F.size("quads") >= least_lines) & (F.abs("angle") >= MIN_TILT))
