"""Ruled bands of a page from its dark scan lines (W-04, G-15, J-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rules(dark: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, y): the centre, in whole lines, of each run of consecutive dark lines (page_id, y); with the columns of
    `keep`, which are the same on all lines of a page."""
    w = Window.partitionBy("page_id").orderBy("y")
    runs = dark.withColumn("island", F.col("y") - F.row_number().over(w))
    return runs.groupBy("page_id", "island").agg(F.floor(F.avg("y")).cast("int").alias("y"), *[F.max(c).alias(c) for c in keep]).select("page_id", "y", *keep)


def bands(lines: DataFrame, height: int | Column, least: float = 0.012, most: float = 0.06) -> DataFrame:
    """(page_id, a, b): neighbouring rules as far apart as a table row."""
    w = Window.partitionBy("page_id").orderBy("y")
    sized = lines.withColumn("_height", height if isinstance(height, Column) else F.lit(height))
    pairs = sized.select("page_id", F.col("y").alias("a"), F.lead("y").over(w).alias("b"), "_height")
    gap = F.col("b") - F.col("a")
    return pairs.where((gap > least * F.col("_height")) & (gap < most * F.col("_height"))).select("page_id", "a", "b")


def free_bands(bands_: DataFrame, used: DataFrame) -> DataFrame:
    """Bands of a page that hold no used y (page_id, u): an anti join on the page with an interval condition."""
    u = used.select(F.col("page_id").alias("up"), "u")
    return bands_.join(u, (F.col("page_id") == F.col("up")) & F.col("u").between(F.col("a"), F.col("b")), "left_anti")
