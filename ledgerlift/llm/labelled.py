"""A bounded sample of labelled documents for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import whole_text


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0: such rows are never learned from. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drawn(text: Column, longest: int, window: int = 512) -> Column:
    """A text as it is up to `longest` characters; else as many windows as fit into that, evenly spread from its beginning
    to its end, with a space between them."""
    many = max(2, longest // window)
    at = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda i: F.substring(text, (F.floor(i * (F.length(text) - window) / (many - 1)) + 1).cast("int"), F.lit(window)))
    return F.when(F.length(text) <= longest, text).otherwise(F.array_join(at, " "))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int | None = None) -> tuple[list[str], list[int]]:
    """At most `rows` texts that are not held out, with their labels 0 or 1: whole, or drawn to about `longest` characters.

    Which rows is settled by a hash of doc_id, so that the sample does not depend on partitioning; ids with both labels are
    left out, and of an id's texts the first in order is taken. Only ids and labels are ordered; texts are then fetched for
    that bounded set of ids.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = usable.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other")
    picked = picked.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    if not picked:
        return [], []
    by_id = {row["doc_id"]: row["label"] for row in picked}
    text = whole_text(F.col("text"))
    texts = docs.where(F.col("doc_id").isin(list(by_id))).select("doc_id", (text if longest is None else drawn(text, longest)).alias("text"))
    found = {row["doc_id"]: row["text"] for row in texts.groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    ids = sorted(found)
    return [found[i] for i in ids], [by_id[i] for i in ids]
