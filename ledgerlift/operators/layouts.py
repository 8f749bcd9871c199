"""Synthetic receipt forms without pixels: draws, sampled layouts and the boxes that a renderer would leave (T-09, G-09, G-10).

Draws are hashes of a key, so that a form is the same wherever and however often it is drawn.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.splits import order_hash

#: Column orders of the forms, and relative widths of columns before they are jittered.
COLUMN_ORDERS = (("qty", "nama", "harga", "jumlah"), ("nama", "qty", "harga", "jumlah"), ("qty", "nama", "jumlah"), ("nama", "harga", "qty", "jumlah"), ("no", "nama", "qty", "harga", "jumlah"))
BASE_WIDTHS = {"nama": 3.2, "qty": 0.8, "harga": 1.3, "jumlah": 1.4, "no": 0.5}


def fraction(key: Column, what: str | Column) -> Column:
    """A draw from 0 up to 1 that `key` and what it is for settle."""
    return order_hash(F.concat_ws(":", key.cast("string"), F.lit(what) if isinstance(what, str) else what)) / F.lit(float(16**7))


def weighted_choice(at: Column, weights: dict[str, float]) -> Column:
    """The choice whose share of the weights, laid end to end in order, a draw falls into."""
    total, so_far, out = sum(weights.values()), 0.0, None
    for choice, weight in weights.items():
        so_far += weight
        out = (F if out is None else out).when(at * total < so_far, choice)
    return out.otherwise(list(weights)[-1])


def _each(column: str) -> Column:
    """The rows of an array. Of a bare column Spark infers a filter, which works out what the array is made of over again."""
    return F.inline(F.slice(column, F.lit(1), F.size(column)))


def sample_forms(docs: DataFrame) -> DataFrame:
    """(doc_id, layout, n_rows, ruled, header_y, row_h, columns array<struct<place, role, left, width>>), one row per form.

    docs: (doc_id), each once. The order is drawn evenly, widths are jittered by 0.8 to 1.25 and scaled to one page. All is plain
    arithmetic of a row: no column of a form is a row of its own that would have to be gathered.
    """
    key = F.col("doc_id")
    form = docs.select(
        "doc_id", F.floor(fraction(key, "order") * len(COLUMN_ORDERS)).cast("int").alias("layout"), (F.floor(fraction(key, "rows") * 9) + 8).cast("int").alias("n_rows"),
        (fraction(key, "ruled") < 0.75).alias("ruled"), (fraction(key, "header") * 0.12 + 0.16).alias("header_y"), (fraction(key, "row") * 0.017 + 0.038).alias("row_h"),
        *[(F.lit(base) * (fraction(key, role) * 0.45 + 0.8)).alias(f"_{role}") for role, base in BASE_WIDTHS.items()])

    def laid(order: tuple[str, ...]) -> Column:
        upto = list(accumulate((F.col(f"_{role}") for role in order), initial=F.lit(0.0)))
        return F.array(*[F.struct(F.lit(i).alias("place"), F.lit(role).alias("role"), (upto[i] / upto[-1]).alias("left"), (F.col(f"_{role}") / upto[-1]).alias("width")) for i, role in enumerate(order)])

    columns = F.coalesce(*[F.when(F.col("layout") == i, laid(order)) for i, order in enumerate(COLUMN_ORDERS)])
    return form.select("doc_id", "layout", "n_rows", "ruled", "header_y", "row_h", columns.alias("columns"))


def sample_layouts(docs: DataFrame) -> DataFrame:
    """(doc_id, layout, place, role, left, width, n_rows, ruled, header_y, row_h), one row per column of a form."""
    return sample_forms(docs).select("doc_id", "layout", "n_rows", "ruled", "header_y", "row_h", _each("columns"))


def truth_boxes(forms: DataFrame, width: int = 1536, height: int = 2048, places: int | None = None) -> DataFrame:
    """(doc_id, row, role, x, y, w, h): the cells of a form's item rows in pixels, as a renderer would place them.

    forms: what `sample_forms` gives. places: decimal places, all if none. What is the same for all cells of a row or column is
    worked out and rounded before they are made.
    """
    shown = lambda c: c if places is None else F.round(c, places)
    rows = F.transform(F.sequence(F.lit(1), F.col("n_rows")), lambda r: F.struct(r, shown((F.col("header_y") + r * F.col("row_h")) * height)))
    columns = forms.select("doc_id", rows.alias("rows"), shown(F.col("row_h") * height).alias("h"), _each("columns"))
    sized = columns.select("doc_id", "role", "rows", "h", shown(F.col("left") * width).alias("x"), shown(F.col("width") * width).alias("w"))
    return sized.select("doc_id", _each("rows").alias("row", "y"), "role", "x", "w", "h").select("doc_id", "row", "role", *"xywh")
