"""Audits of an annotated corpus (A-01 to A-06, A-23, A-25 to A-29, F-07 to F-17, J-01 to J-05, T-01): all joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.functions.geometry import crop_rectangle
from ledgerlift.functions.text import is_label, source_id
from ledgerlift.operators.quantiles import exact_quantiles

QUARTERS = (0.25, 0.5, 0.75)


def with_images(annotations: DataFrame, images: DataFrame) -> DataFrame:
    return annotations.join(images.select(F.col("id").alias("image_id"), "file_name", F.col("width").alias("page_w"), F.col("height").alias("page_h")), "image_id")


def box_quality(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """One row of conditional counts over all boxes."""
    a = with_images(annotations, images)
    count = lambda cond, name: F.count_if(cond).alias(name)
    return a.agg(F.count(F.lit(1)).alias("boxes"), count(F.col("w") <= 0, "zero_w"), count(F.col("h") <= 0, "zero_h"), count(F.col("x") < 0, "left_out"), count(F.col("y") < 0, "top_out"), count(F.col("x") + F.col("w") > F.col("page_w"), "right_out"), count(F.col("y") + F.col("h") > F.col("page_h"), "bottom_out"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation) and max of a column, rounded to 6 places."""
    c = F.col(column).cast("double")
    one = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    found = exact_quantiles(df.select(F.lit(column).alias("name"), c.alias("v")), QUARTERS).get(column, [None] * 3)
    return _described(one.withColumn("q", F.array(*[F.lit(q).cast("double") for q in found])))


def _described(one: DataFrame, *names: str) -> DataFrame:
    quarters = [F.round(F.col("q")[i], 6).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return one.select(*names, "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", *quarters, "max")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin 1..bins, n) of equal-width bins between the extremes; the top edge belongs to the last bin."""
    ends = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    placed = df.select(F.col(column).cast("double").alias("v")).crossJoin(F.broadcast(ends))  # a single row
    at = F.least(F.floor((F.col("v") - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))) + 1, F.lit(bins))
    return placed.where("v is not null").groupBy(F.coalesce(at, F.lit(1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def density(df: DataFrame, column: str, points: int = 200, bins: int = 1000) -> DataFrame:
    """(place, x, density): a Gaussian kernel density at `points` places from the least to the greatest value, with Scott's
    bandwidth (sample deviation x n ** -0.2).

    Each value is shared linearly between the two nearest of `bins` + 1 knots, which are then smoothed: the kernel meets
    knots, not values, so the second step has points x knots pairs for any number of values. Null and NaN are left out;
    fewer than two different values have no density.
    """
    v = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    ends = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("sd")).where("hi > lo")
    at = v.crossJoin(F.broadcast(ends)).withColumn("at", (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)  # a single row
    low = F.least(F.floor("at"), F.lit(bins - 1))
    shares = F.array(F.struct(low.alias("knot"), (low + 1 - F.col("at")).alias("w")), F.struct((low + 1).alias("knot"), (F.col("at") - low).alias("w")))
    knots = at.select(F.inline(shares)).groupBy("knot").agg(F.sum("w").alias("w"))
    grid = ends.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("place"))
    width = F.col("hi") - F.col("lo")
    grid = grid.select("place", "n", "lo", width.alias("width"), (F.col("lo") + width * F.col("place") / (points - 1)).alias("x"), (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"))
    far = (F.col("x") - F.col("lo") - F.col("width") * F.col("knot") / bins) / F.col("h")
    met = grid.crossJoin(F.broadcast(knots))  # points x knots, whatever the table
    out = met.groupBy("place", "x", "n", "h").agg(F.sum(F.col("w") * F.exp(-far * far / 2)).alias("s"))
    return out.select("place", "x", (F.col("s") / (F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))).alias("density"))


def label_counts(annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """(name, n) by label; counted by id before the join."""
    counts = annotations.groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id")
    return named.groupBy("name").agg(F.sum("n").alias("n"))


def top_labels(annotations: DataFrame, categories: DataFrame, k: int = 50) -> DataFrame:
    return label_counts(annotations, categories).orderBy(F.desc("n"), "name").limit(k)


def rare_labels(annotations: DataFrame, categories: DataFrame, most: int = 2, k: int = 100) -> DataFrame:
    """Category ids that occur at most `most` times, rarest first."""
    counts = annotations.groupBy("category_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most)
    return counts.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id").orderBy("n", "category_id").limit(k)


def crops(annotations: DataFrame, images: DataFrame, categories: DataFrame, pad: float = 0.05, least_side: float = 4) -> DataFrame:
    """(image_id, category_id, name, source, left, top, right, bottom, reason): reason is null for crops that are cut.

    Boxes with a side below `least_side` are degenerate: 4 for crops, 2 for counting, 6 for composites, 8 after a warp.
    """
    a = annotations.join(images.select(F.col("id").alias("image_id"), "file_name", F.col("width").alias("page_w"), F.col("height").alias("page_h")), "image_id", "left")
    a = a.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id", "left")
    box = crop_rectangle(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("page_w"), F.col("page_h"), pad)
    reason = F.when(F.col("file_name").isNull(), "missing_image").when(~F.coalesce(is_label(F.col("name")), F.lit(False)), "placeholder").when((F.col("w") < least_side) | (F.col("h") < least_side), "degenerate")
    return a.select("image_id", "category_id", "name", source_id(F.col("file_name")).alias("source"), box.alias("box"), reason.alias("reason")).select("image_id", "category_id", "name", "source", "box.*", "reason")


def skip_reasons(cut: DataFrame) -> DataFrame:
    return cut.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def word_classes(words: DataFrame, column: str = "word") -> DataFrame:
    """Counts of tokens and distinct words that are numeric, alphabetic, alphanumeric, hold white space or punctuation."""
    counts = words.groupBy(F.col(column).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    w = F.col("w")
    tests = {"numeric": w.rlike("^[0-9]+$"), "alphabetic": w.rlike("^[A-Za-z]+$"), "alphanumeric": w.rlike("^[A-Za-z0-9]+$"), "with_space": w.rlike(r"\s"), "with_punctuation": w.rlike(r"[^A-Za-z0-9\s]")}
    return counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words"), *[F.count_if(t).alias(name) for name, t in tests.items()])


def charset(texts: DataFrame, column: str) -> DataFrame:
    """(ch, n): distinct characters that are not white space, with the number of distinct texts that hold them."""
    each = texts.select(column).distinct().select(F.explode(F.array_distinct(F.split(column, ""))).alias("ch"))
    return each.where((F.col("ch") != "") & ~F.col("ch").rlike(r"^\s$")).groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def json_keys(rows: DataFrame, column: str) -> DataFrame:
    """(key, records, filled) over JSON objects: how many hold a key, and how many with a value."""
    entries = rows.select(F.explode(F.from_json(column, "map<string,string>")).alias("key", "value"))
    return entries.groupBy("key").agg(F.count(F.lit(1)).alias("records"), F.count("value").alias("filled"))


def dataset_counts(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """(split, images, annotations, categories) of images (id, split) and their annotations; both sides are counted before they meet."""
    per_image = annotations.groupBy("image_id", "category_id").agg(F.count(F.lit(1)).alias("n"))
    seen = images.select(F.col("id").alias("image_id"), "split").join(per_image, "image_id")
    boxes = seen.groupBy("split").agg(F.sum("n").alias("annotations"), F.count_distinct("category_id").alias("categories"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return images.groupBy("split").agg(F.count(F.lit(1)).alias("images")).join(boxes, "split", "left").select("split", "images", zero("annotations"), zero("categories"))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """`describe` of several columns: one row for each, by name."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])
    v = F.col("v")
    values = df.select(F.inline(pairs))
    one = values.groupBy("name").agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    found = df.sparkSession.createDataFrame(list(exact_quantiles(values, QUARTERS).items()), "name string, q array<double>")
    return _described(one.join(F.broadcast(found), "name"), "name")  # a row for each column


def text_fields(rows: DataFrame, column: str, candidates: list[str]) -> DataFrame:
    """(field, n): which of the candidate keys, in their order, is the first with a value in each JSON object; null if none is."""
    entries = F.from_json(column, "map<string,string>")
    first = F.coalesce(*[F.when(entries[key].isNotNull(), key) for key in candidates])
    return rows.groupBy(first.alias("field")).agg(F.count(F.lit(1)).alias("n"))


def text_field_examples(rows: DataFrame, column: str, candidates: list[str], k: int = 5) -> DataFrame:
    """(field, value): the first k distinct values, in their order, of each field that `text_fields` counts."""
    entries = F.from_json(column, "map<string,string>")
    found = F.coalesce(*[F.when(entries[key].isNotNull(), F.struct(F.lit(key).alias("field"), entries[key].alias("value"))) for key in candidates])
    values = rows.select(found.alias("f")).where("f IS NOT NULL").select("f.*").distinct()
    return values.withColumn("n", F.row_number().over(Window.partitionBy("field").orderBy("value"))).where(F.col("n") <= k).drop("n")


def label_summary(annotations: DataFrame) -> DataFrame:
    """(labels, receipts, words, numeric_share) of named annotations (name, source)."""
    numeric = F.coalesce(F.col("name").rlike("^[0-9]+$"), F.lit(False)).cast("double")
    return annotations.agg(F.count("name").alias("labels"), F.count_distinct("source").alias("receipts"), F.count_distinct("name").alias("words"), F.round(F.avg(numeric), 6).alias("numeric_share"))
