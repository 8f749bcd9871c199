"""What a page's pixels say: dark scan lines (G-15) and the colour of its ink (G-16).

Pixels are rows (page_id, y, x, r, g, b) or image files. An image is reduced to one number a scan line, or to counts of
colours, in the task that decodes it; from there on all is grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.operators import scanlines

#: The part of the width that is looked at, how much darker than the mean is dark, the share of the span that
#: makes a line, how many boxes give ink, and the ink of a page without any.
LEFT, RIGHT, DARKER, SHARE, INK_BOXES, INK_DEFAULT = 0.10, 0.95, 25, 0.55, 6, (35, 35, 45)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, width, height, channels, data): decoded images below a folder; page_id is the file's path."""
    image = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(path)
    return image.select(F.col("image.origin").alias("page_id"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")


def _array(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """(height, width, 3), red first. Grey images have three like channels; a fourth channel is left out."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, 2) if channels == 1 else a[:, :, 2::-1]


def profile_of_images(pages: DataFrame) -> DataFrame:
    """(page_id, width, height, y, darkness) of every scan line of `read_pages`' images: pixels of the middle part that are
    darker than its mean by DARKER. An image gives one row a line; its pixels leave the task no more."""

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                strip = _array(r.data, r.height, r.width, r.channels)[:, int(r.width * LEFT) : int(r.width * RIGHT)].mean(2)
                if strip.size:
                    dark = (strip < strip.mean() - DARKER).sum(1)
                    yield pd.DataFrame({"page_id": r.page_id, "width": r.width, "height": r.height, "y": np.arange(len(dark)), "darkness": dark})

    return pages.mapInPandas(reduced, "page_id string, width int, height int, y int, darkness long")


def profile_of_pixels(pixels: DataFrame) -> DataFrame:
    """The same of rows (page_id, width, height, y, x, r, g, b): channel sums are whole numbers, so the mean is exact in any
    order. A page's sum and its lines' histograms of sums are one aggregate by (page, line, sum), partial before the shuffle."""
    inside = (F.col("x") >= F.floor(F.col("width") * LEFT)) & (F.col("x") < F.floor(F.col("width") * RIGHT))
    tone = pixels.where(inside).groupBy("page_id", "width", "height", "y", (F.col("r") + F.col("g") + F.col("b")).cast("long").alias("tone")).agg(F.count(F.lit(1)).alias("n"))
    page = Window.partitionBy("page_id")
    mean = F.sum(F.col("tone") * F.col("n")).over(page) / F.sum("n").over(page)
    dark = tone.withColumn("dark", F.when(F.col("tone") < mean - 3 * DARKER, F.col("n")).otherwise(F.lit(0)))
    return dark.groupBy("page_id", "width", "height", "y").agg(F.sum("dark").cast("long").alias("darkness"))


def dark_lines(profile: DataFrame) -> DataFrame:
    """(page_id, y, height): lines of which more than SHARE of the span is dark."""
    return profile.where(F.col("darkness") > F.floor(F.col("width") * (RIGHT - LEFT)) * SHARE).select("page_id", "y", "height")


def ruled_bands(profile: DataFrame) -> DataFrame:
    """(page_id, a, b): gaps of a table row's height between printed rules. The height comes with the dark lines, so that the
    profile, and with it every pixel, is worked out once."""
    return scanlines.bands(scanlines.rules(dark_lines(profile), keep=("height",)), F.col("height"))


def _first_boxes(boxes: DataFrame, most: int) -> DataFrame:
    """The first `most` boxes of a page by box_idx, cut off at the page's left and top, sides in whole pixels."""
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("box_idx"))
    whole = lambda c: F.col(c).cast("int")
    first = boxes.withColumn("_rank", rank).where(F.col("_rank") <= most)
    return first.select("page_id", F.col("_rank").alias("box"), F.greatest(whole("x"), F.lit(0)).alias("x0"), F.greatest(whole("y"), F.lit(0)).alias("y0"), (whole("x") + whole("w")).alias("x1"), (whole("y") + whole("h")).alias("y1"))


def tones_of_pixels(pixels: DataFrame, boxes: DataFrame, most: int = INK_BOXES) -> DataFrame:
    """(page_id, box, tone, n, r, g, b): pixels of each of a page's first boxes counted by channel sum, with channel totals.

    Pixels meet their page's boxes by one join, in which a page is one row of at most `most` boxes; counts are partial from
    there on. Of image files the pixels themselves are never shuffled one by one: see `tones_of_images`.
    """
    first = _first_boxes(boxes, most).groupBy("page_id").agg(F.collect_list(F.struct("box", "x0", "y0", "x1", "y1")).alias("all"))
    holds = lambda b: (F.col("x") >= b["x0"]) & (F.col("x") < b["x1"]) & (F.col("y") >= b["y0"]) & (F.col("y") < b["y1"])
    met = pixels.join(first, "page_id").select("page_id", "r", "g", "b", F.explode(F.filter("all", holds)).alias("at"))
    tone = (F.col("r") + F.col("g") + F.col("b")).cast("int")
    return met.groupBy("page_id", F.col("at.box").alias("box"), tone.alias("tone")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("long").alias(c) for c in "rgb"])


def boxed_pages(pages: DataFrame, boxes: DataFrame, most: int = INK_BOXES) -> DataFrame:
    """(page_id, box, x0, y0, x1, y1): every row of `pages` (page_id) with each of its first boxes."""
    return pages.join(_first_boxes(boxes, most), "page_id")


def tones_of_boxed(pixels: DataFrame) -> DataFrame:
    """The counts of `tones_of_pixels` from pixels that are made of `boxed_pages`' rows: (page_id, box, x0, y0, x1, y1, y, x,
    r, g, b). The bounds are plain conditions that reach the place where pixels are made, and those of a page stay in the
    part that holds its boxes: no pixel is shuffled."""
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    tone = (F.col("r") + F.col("g") + F.col("b")).cast("int")
    return pixels.where(inside).groupBy("page_id", "box", tone.alias("tone")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("long").alias(c) for c in "rgb"])


def tones_of_images(pages: DataFrame, boxes: DataFrame, most: int = INK_BOXES) -> DataFrame:
    """The same counts from `read_pages`' images, made where the image is."""
    first = _first_boxes(boxes, most).groupBy("page_id").agg(F.collect_list(F.struct("box", "x0", "y0", "x1", "y1")).alias("all"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                page = _array(r.data, r.height, r.width, r.channels)
                for b in r.all:
                    patch = page[b["y0"] : max(b["y1"], 0), b["x0"] : max(b["x1"], 0)].reshape(-1, 3).astype(np.int64)
                    tone, at, n = np.unique(patch.sum(1), return_inverse=True, return_counts=True)
                    sums = {c: np.bincount(at, patch[:, i], len(tone)).astype(np.int64) for i, c in enumerate("rgb")}
                    yield pd.DataFrame({"page_id": r.page_id, "box": b["box"], "tone": tone, "n": n, **sums})

    return pages.join(first, "page_id").mapInPandas(counted, "page_id string, box int, tone int, n long, r long, g long, b long")


def ink_colour(pages: DataFrame, tones: DataFrame) -> DataFrame:
    """(page_id, r, g, b) of every row of `pages` (page_id): the mean over boxes of each box's darkest tenth, in whole numbers.

    A box has at most 766 tones, so the darkest tenth is a running sum over counts, whatever the box's size; the tone that
    straddles the border gives its mean for the part that is in. Boxes without pixels count for nothing; a page without any
    has the default ink.
    """
    by_tone = Window.partitionBy("page_id", "box").orderBy("tone")
    need = F.greatest(F.lit(1), F.floor(F.sum("n").over(Window.partitionBy("page_id", "box")) / 10))
    before = F.coalesce(F.sum("n").over(by_tone.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = tones.withColumn("need", need).withColumn("take", F.least(F.col("n"), F.greatest(F.lit(0), F.col("need") - before))).where("take > 0")
    part: dict[str, Column] = {c: F.sum(F.col(c) * F.col("take") / F.col("n")) / F.max("need") for c in "rgb"}
    by_box = taken.groupBy("page_id", "box").agg(*[v.alias(c) for c, v in part.items()])
    found = by_box.groupBy("page_id").agg(*[F.floor(F.round(F.avg(c), 6)).cast("int").alias(c) for c in "rgb"])
    return pages.select("page_id").distinct().join(found, "page_id", "left").select("page_id", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in zip("rgb", INK_DEFAULT, strict=True)])
