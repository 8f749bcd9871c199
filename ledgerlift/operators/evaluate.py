"""Evaluation of recognition, layouts and forecasts (A-15 to A-20, G-17, R-20, R-21, T-02)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.functions.text import cer, is_number, normalise
from ledgerlift.operators import folds, receipts


def cer_by_stratum(predictions: DataFrame) -> DataFrame:
    """(stratum, n, mean_cer, exact): a crop counts under `all` and under `digits` or `letters`."""
    p = predictions.withColumn("cer", cer(F.col("pred"), F.col("gold"))).withColumn("stratum", F.explode(F.array(F.lit("all"), F.when(is_number(F.col("gold")), "digits").otherwise("letters"))))
    return p.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("cer"), 6).alias("mean_cer"), F.round(F.avg((F.col("pred") == F.col("gold")).cast("double")), 6).alias("exact"))


def worst_misreads(predictions: DataFrame, k: int = 15) -> DataFrame:
    p = predictions.select("id", "gold", "pred", F.round(cer(F.col("pred"), F.col("gold")), 6).alias("cer"))
    return p.where("cer > 0").orderBy(F.desc("cer"), F.desc("gold"), F.desc("pred"), F.desc("id")).limit(k)


def verify_words(predictions: DataFrame) -> DataFrame:
    """(word, files, survived): a word's images stay only if what is read back equals the word, normalised."""
    return predictions.groupBy(normalise(F.col("gold")).alias("word")).agg(F.count(F.lit(1)).alias("files"), F.count_if(normalise(F.col("pred")) == normalise(F.col("gold"))).alias("survived"))


def verified_files(predictions: DataFrame) -> DataFrame:
    """(word, id) of the images that stay: the word's list of files, one row a file, as one word can have very many."""
    return predictions.select(normalise(F.col("gold")).alias("word"), "id").where(normalise(F.col("pred")) == normalise(F.col("gold")))


def band(at: Column) -> Column:
    """The role whose band of the first form a place between 0 and 1 falls into; null in none."""
    return F.when((at >= 0.02) & (at < 0.21), "qty").when((at >= 0.21) & (at < 0.62), "nama").when((at >= 0.62) & (at < 0.77), "harga").when((at >= 0.77) & (at < 0.97), "jumlah")


def banded(boxes: DataFrame, docs: DataFrame) -> DataFrame:
    """`boxes` with band, the role whose band their centre falls into."""
    return boxes.join(docs, "doc_id").withColumn("band", band((F.col("x") + F.col("w") / 2) / F.col("width")))


def fixed_geometry_roles(boxes: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, role, n): boxes by the band that their centre falls into, for documents whose columns stand where the
    first form has them."""
    return banded(boxes, docs).where("band is not null").groupBy("doc_id", F.col("band").alias("role")).agg(F.count(F.lit(1)).alias("n"))


def layout_benchmark(boxes: DataFrame, layout: Column) -> DataFrame:
    """(layout, n_items, n_docs, correct, fixed_correct), by layout, by number of items and overall (the others null):
    documents whose discovered qty, harga and jumlah columns hold mostly that role's boxes, and those whose fixed bands do.

    boxes: what `receipts.gathered` gives, carrying what each box is (`truth`); layout: that of a doc_id. A column made by
    splitting counts off stands for the one it came from. A document is judged within its row: no box is dealt out or joined.
    """
    wanted = ("qty", "harga", "jumlah")
    both = lambda c: F.concat(f"boxes.{c}", f"blank.{c}")
    most = lambda kind: F.arrow_udf(folds.most_frequent, f"map<{kind},string>")
    held = most("string")(F.transform(both("cx"), lambda x: band(x / F.col("width"))), both("role"), both("box_idx"), both("item_row"))
    n_items, roles = F.size(F.array_distinct(F.array_compact(both("item_row")))), F.array_distinct(both("role"))
    grid = receipts.gridded(boxes, held=held, n_items=n_items, roles=roles, role=F.col("boxes.role"), box_idx=F.col("boxes.box_idx"), item_row=F.col("boxes.item_row"))
    found = receipts.assign_roles(grid, got=most("int")("cols", "role", "box_idx", "item_row"), held=F.col("held"), n_items=F.col("n_items"), roles=F.col("roles"))
    column = lambda c: F.when(F.col("was_split") & (F.col(c) == F.col("n_cols")), F.col("split_col")).otherwise(F.col(c))
    right = lambda got, key: reduce(and_, [~F.array_contains("roles", c) | F.coalesce(F.try_element_at(got, key(c)) == c, F.lit(False)) for c in wanted])
    judged = found.select(layout.alias("layout"), "n_items", right(F.col("got"), column).alias("ok"), right(F.col("held"), F.lit).alias("fixed_ok"), F.arrays_overlap("roles", F.array(*map(F.lit, wanted))).alias("asked"))
    docs = judged.groupBy("layout", "n_items").agg(*[F.count_if(c).alias(n) for c, n in (("asked", "n_docs"), (F.col("asked") & F.col("ok"), "correct"), (F.col("asked") & F.col("fixed_ok"), "fixed_correct"))]).where("n_docs > 0")
    return docs.groupingSets([["layout"], ["n_items"], []], "layout", "n_items").agg(*[F.sum(c).alias(c) for c in ("n_docs", "correct", "fixed_correct")])


def truth(boxes: DataFrame) -> DataFrame:
    """`boxes` (.., role, row) with item_row: the row of a box of an item, null for those of headers and totals."""
    return boxes.withColumn("item_row", F.when((F.col("row") > 0) & ~F.col("role").startswith("total"), F.col("row")))


def naive_scale(train: DataFrame) -> DataFrame:
    """(unique_id, scale): mean absolute lag-1 difference, 1 where it is 0 or missing."""
    w = Window.partitionBy("unique_id").orderBy("ds")
    diffs = train.withColumn("d", F.abs(F.col("y") - F.lag("y").over(w)))
    return diffs.groupBy("unique_id").agg(F.coalesce(F.nullif(F.avg("d"), F.lit(0.0)), F.lit(1.0)).alias("scale"))


def naive_scale_of_hits(at: DataFrame) -> DataFrame:
    """`naive_scale` from the days with demand alone (`demand.numbered` rows): between days that do not touch, and at either
    end of the span, the series goes to 0 and comes from there."""
    w = Window.partitionBy("unique_id").orderBy("t")
    near = at.select("unique_id", "y", "t", "n", F.lag("y").over(w).alias("py"), F.lag("t").over(w).alias("pt"), F.lead("t").over(w).alias("nt"))
    size = F.abs("y")
    come = F.when(F.col("pt").isNull(), F.when(F.col("t") > 1, size).otherwise(0)).when(F.col("t") == F.col("pt") + 1, F.abs(F.col("y") - F.col("py"))).otherwise(size)
    go = F.when((F.col("t") < F.col("n")) & (F.coalesce("nt", F.col("n") + 2) > F.col("t") + 1), size).otherwise(0)
    s = near.groupBy("unique_id").agg(F.sum(F.when(F.col("t") <= F.col("n"), come + go).otherwise(0)).cast("double").alias("d"), F.first("n").alias("n")).where("n >= 1")
    return s.select("unique_id", F.coalesce(F.nullif(F.try_divide("d", F.col("n") - 1), F.lit(0.0)), F.lit(1.0)).alias("scale"))


def score(forecasts: DataFrame, test: DataFrame, scale: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(method, [by], n, mase, rmsse_mae, rmse): pooled over rows that have both a forecast and an observation.

    rmsse_mae divides squared errors by the squared naive MAE, as the source system does.
    """
    return pooled(forecasts.join(test.select("unique_id", "ds", "y"), ["unique_id", "ds"]).join(scale, "unique_id"), by)


def pooled(met: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`score` of rows (method, [by], yhat, y, scale) in which forecasts and observations have met."""
    e = met.withColumn("e", F.col("yhat") - F.col("y"))
    return e.groupBy("method", *(by or [])).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs("e") / F.col("scale")), 6).alias("mase"), F.round(F.sqrt(F.avg(F.pow(F.col("e") / F.col("scale"), 2))), 6).alias("rmsse_mae"), F.round(F.sqrt(F.avg(F.pow("e", 2))), 6).alias("rmse"))
