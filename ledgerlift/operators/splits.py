"""Leakage-safe splits and their independent verification (T-05 to T-08, W-02, W-03, O-01, O-02, O-05, A-26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.operators.ranks import running


def naive_split(key: Column) -> Column:
    """80/10/10 by the key itself: kept as the leaky arm of the audit."""
    return F.when(F.pmod(key, F.lit(10)) < 8, "train").when(F.pmod(key, F.lit(10)) == 8, "val").otherwise("test")


def order_hash(source: Column) -> Column:
    """A fixed shuffle of sources: what a multiplicative hash of their md5's first 7 hex digits gives."""
    return F.conv(F.substring(F.md5(source.cast("binary")), 1, 7), 16, 10).cast("bigint")


def grouped_split(images: DataFrame, source: str = "source", val: float = 0.15, test: float = 0.15) -> DataFrame:
    """(source, split): each source falls into one split whole; val and test hold just their shares, rounded.

    The shuffled order is a hash of the source; a source's place in it is a rank that is worked out by ranges.
    """
    named = _placed(images.select(F.col(source).alias("group")).distinct(), val, test, 0)
    return named.select(F.col("group").alias("source"), "split")


def _placed(groups: DataFrame, val: float, test: float, least: int) -> DataFrame:
    """(group, split): the first share of the shuffled order is val, the next test, the rest train; at least `least` each."""
    ranked = running(groups, [order_hash(F.col("group")), F.col("group")], {"place": F.lit(1)})
    total = ranked.agg(F.count(F.lit(1)).alias("groups"))  # one row
    many = lambda share: F.greatest(F.lit(least), F.bround(F.col("groups") * share, 0))
    split = F.when(F.col("place") <= many(val), "val").when(F.col("place") <= many(val) + many(test), "test").otherwise("train")
    return ranked.crossJoin(F.broadcast(total)).select("group", split.alias("split"))


def writer_split(images: DataFrame, writers: DataFrame, source: str = "source", val: float = 0.15, test: float = 0.15) -> DataFrame:
    """(source, split) as `grouped_split`, whole writers at a time; a source without a writer is a group of its own.

    writers: (source, writer). Val and test get a group each at least, val first.
    """
    named = images.select(F.col(source).alias("source")).distinct().join(writers.select("source", "writer"), "source", "left")
    named = named.withColumn("group", F.coalesce(F.col("writer").cast("string"), F.concat(F.lit("__unmapped__"), F.col("source"))))
    return named.join(_placed(named.select("group").distinct(), val, test, 1), "group").select("source", "split")


def select_copies(images: DataFrame, splits: DataFrame) -> DataFrame:
    """All copies of train sources, the first by file name of the others."""
    placed = images.join(splits, "source")
    first = placed.where("split <> 'train'").groupBy("source").agg(F.min("file_name").alias("file_name"))
    others = placed.where("split <> 'train'").join(first, ["source", "file_name"], "left_semi")
    return placed.where("split = 'train'").unionByName(others)


def first_copies(images: DataFrame) -> DataFrame:
    w = Window.partitionBy("source").orderBy("file_name")
    return images.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def overlaps(placed: DataFrame) -> DataFrame:
    """(source, n_splits): sources that occur in more than one split; empty for a sound split."""
    return placed.groupBy("source").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")


def untraced(crops: DataFrame, manifest: DataFrame) -> DataFrame:
    """Crop sources that the manifest doesn't have in that split; empty if every crop traces back."""
    return crops.select("source", "split").distinct().join(manifest, ["source", "split"], "left_anti")


def contamination(placed: DataFrame, key: str) -> DataFrame:
    """(split, n, leaked, n_sources, leaked_sources) of val and test: rows whose key also occurs in train."""
    train = placed.where("split = 'train'").select(key).distinct().withColumn("in_train", F.lit(1))
    held = placed.where("split <> 'train'").join(train, key, "left")
    return held.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("in_train").alias("leaked"), F.count_distinct(key).alias("n_sources"), F.count_distinct(F.when(F.col("in_train") == 1, F.col(key))).alias("leaked_sources"))


def first_pages(images: DataFrame, pages: int, source: str = "source") -> DataFrame:
    """The first page of each receipt by id, and of those the first `pages`: a limit that is the feature."""
    first = images.groupBy(source).agg(F.min_by(F.struct("*"), "id").alias("one")).select("one.*")
    return first.orderBy("id").limit(pages)


def layout_holdout(layout: Column, held_out: list) -> Column:
    """'test' for forms whose column order is held out, else 'train'."""
    return F.when(layout.isin(*held_out), "test").otherwise("train")


def display_sample(rows: DataFrame, key: str, n: int = 24) -> DataFrame:
    """n rows in the order of a hash of `key`: a repeatable sample for looking at."""
    return rows.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
