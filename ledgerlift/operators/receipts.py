"""From text boxes to validated receipts: grid, column roles, reconciliation (R-01 to R-19).

Boxes meet by document, and a document stays one row from its boxes to its receipt: cells, profiles and candidate roles are
short folds over its arrays. Nothing is repaired: what does not add up is flagged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.functions.text import has_digit, is_number, split_count, to_int
from ledgerlift.operators import folds

MIN_CONFIDENCE = 0.70


def upper_median(values: Column) -> Column:
    """The element at half the size of the sorted array; null for an empty one."""
    return F.when(F.size(values) > 0, F.sort_array(values)[F.floor(F.size(values) / 2).cast("int")])


def cluster_1d(points: Column, gap: Column) -> Column:
    """array<struct<idx, cluster>> from array<struct<v, idx>>, clusters ascending.

    A value joins the current cluster if it is at most `gap` above its running mean. The mean is recursive, so this is a
    fold over the sorted values, not a window. The gap travels in the state: it is worked out once, not at every step.
    """
    out_type = "array<struct<idx:int,cluster:int>>"
    start = F.struct(F.lit(0.0).alias("centre"), F.lit(0).alias("n"), F.lit(-1).alias("k"), gap.cast("double").alias("gap"), F.array().cast(out_type).alias("out"))

    def step(a: Column, p: Column) -> Column:
        joins = (a["n"] > 0) & (p["v"] - a["centre"] <= a["gap"])
        k = F.when(joins, a["k"]).otherwise(a["k"] + 1)
        return F.struct(
            F.when(joins, a["centre"] + (p["v"] - a["centre"]) / (a["n"] + 1)).otherwise(p["v"]).alias("centre"),
            F.when(joins, a["n"] + 1).otherwise(F.lit(1)).alias("n"), k.alias("k"), a["gap"].alias("gap"),
            F.concat(a["out"], F.array(F.struct(p["idx"].alias("idx"), k.alias("cluster")))).alias("out"))

    return F.aggregate(F.array_sort(points), start, step, lambda a: a["out"])


def with_predictions(boxes: DataFrame, predictions: DataFrame) -> DataFrame:
    """`boxes` with text and conf of the prediction at the same place of their document, as far as both lists go (J-14).

    boxes: (doc_id, box_idx, ..), in the order of box_idx; predictions: (doc_id, at, text, conf), in that of at. A missing
    text is empty, a missing confidence 0. Both lists of a document are gathered and meet as one row each: a join by document
    and place would deal rows out anew that already lie by document.
    """
    listed = lambda rows, name: rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*[c for c in rows.columns if c != "doc_id"]))).alias(name))
    others = [c for c in boxes.columns if c not in ("doc_id", "box_idx")]
    read = predictions.select("doc_id", "at", F.trim(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce("conf", F.lit(0.0)).alias("conf"))
    both = listed(boxes.select("doc_id", "box_idx", *others), "boxes").join(listed(read, "read"), "doc_id")
    pairs = F.slice(F.arrays_zip("boxes", "read"), F.lit(1), F.least(F.size("boxes"), F.size("read")))
    return both.select("doc_id", F.inline(pairs).alias("box", "seen")).select("doc_id", *[F.col(f"box.{c}") for c in boxes.columns if c != "doc_id"], "seen.text", "seen.conf")


def gathered(boxes: DataFrame, docs: DataFrame, carried: tuple[str, ...] = (), how: str = "inner", judged: bool = True) -> DataFrame:
    """(doc_id, width, height, boxes, blank, gap_x, gap_y), one row per document, by one shuffle by document.

    boxes: array<struct<box_idx, cx, cy, w, h, text, conf, digits, number, digit, carried..>> of the boxes that have text, in
    order; blank: array<struct<box_idx, cx, carried..>> of the others, empty if nothing is carried. What a text says is worked out
    before it is gathered, unless judged is false: then digits, number and digit are left out. The gaps are those of
    `folds.gridded`. With how='left', documents without boxes stay.
    """
    text, digits = F.col("text"), F.col("digits")
    placed = boxes.select("doc_id", F.col("box_idx").cast("int").alias("box_idx"), (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy"), "w", "h", "text", F.col("conf").cast("double").alias("conf"), F.regexp_replace("text", "[^0-9]+", "").alias("digits"), *carried)
    has = F.trim(text) != ""
    number = (digits != "") & ~F.lower(text).rlike("[a-z]")  # is_number, where the digits are known
    says = [digits, number.alias("number"), F.when(digits != "", True).otherwise(has_digit(text)).alias("digit")] if judged else []
    seen = F.struct("box_idx", "cx", "cy", "w", "h", "text", "conf", *says, *carried)
    # Structs are made before they are collected: an aggregate's arguments are interpreted.
    if carried:
        b = placed.select("doc_id", F.when(has, seen).alias("boxes"), F.when(~F.coalesce(has, F.lit(False)), F.struct("box_idx", "cx", *carried)).alias("blank"))
    else:
        b = placed.where(has).select("doc_id", seen.alias("boxes"))
    b = b.groupBy("doc_id").agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in b.columns[1:]])
    # The documents, small rows, are looked up by hash: rows with arrays are not sorted once more to be merged.
    b = docs.select("doc_id", "width", "height").hint("shuffle_hash").join(b, "doc_id", how)
    filled = [F.coalesce(c, F.array().cast(b.schema[c].dataType)).alias(c) for c in b.columns[3:]]
    gap_x, gap_y = F.greatest(upper_median(F.col("boxes.w")) * 0.6, F.col("width") * 0.02), F.greatest(upper_median(F.col("boxes.h")) * 0.8, F.col("height") * 0.008)
    return b.select("doc_id", "width", "height", *filled, gap_x.cast("double").alias("gap_x"), gap_y.cast("double").alias("gap_y"))


def build_grid(boxes: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, box_idx, row_id, col_id, text, conf, pitch) of every box that has text.

    boxes: (doc_id, box_idx, x, y, w, h, text, conf); docs: (doc_id, width, height). One shuffle by document: a document's
    boxes are gathered once, columns, pitch and rows are folds over that array, many documents at a time within an Arrow batch
    (`folds`), and it is laid out once at the end.
    """
    b = gathered(boxes, docs, judged=False)
    laid = F.arrow_udf(folds.laid_out, "struct<cols:array<int>,rows:array<int>,pitch:double>")(F.col("boxes.cx"), F.col("boxes.cy"), "gap_x", "gap_y")
    b = b.select("doc_id", "boxes", laid.alias("laid")).select("doc_id", F.col("laid.pitch").alias("pitch"), F.inline(F.arrays_zip("boxes", F.col("laid.rows").alias("row_id"), F.col("laid.cols").alias("col_id"))).alias("box", "row_id", "col_id"))
    return b.select("doc_id", "pitch", "box.box_idx", "row_id", "col_id", "box.text", "box.conf")


def gridded(gathered: DataFrame, **also: Column) -> DataFrame:
    """(doc_id, cols, at, text, digits, columns, rows, also..), one row per document: what `folds.gridded` says of `gathered`.
    also: what else is worked out of `gathered`, within the same pass if it is an Arrow function."""
    kind = "struct<cols:array<int>,at:array<bigint>,text:array<string>,digits:array<string>,columns:array<struct<col_id:int,n:bigint,numeric_frac:double,digit_frac:double,mean_digits:double>>,rows:array<struct<row_id:int,confidence:double>>>"
    box = lambda c: F.col(f"boxes.{c}")
    made = F.arrow_udf(folds.gridded, kind)(box("box_idx"), box("cx"), box("cy"), "gap_x", "gap_y", box("text"), box("digits"), box("number"), box("digit"), box("conf"))
    return gathered.select("doc_id", *[c.alias(name) for name, c in also.items()], made.alias("grid")).select("doc_id", "grid.*", *also)


def unmerge_counts(cells: DataFrame, strict: bool = False) -> DataFrame:
    """The cells of documents that have a column whose rule is a count welded to a name: names stay, counts get a new last
    column. Adds split_col, the first such column, and new_col. Columns and documents are windows over one order: texts are
    judged once, and cells that lie by document are neither joined nor dealt out anew."""
    by_col, by_doc = Window.partitionBy("doc_id", "col_id"), Window.partitionBy("doc_id")
    seen = cells.where("doc_id IS NOT NULL").withColumn("s", split_count(F.col("text"), strict))
    counted = seen.withColumns({"filled": F.count_if(F.col("text") != "").over(by_col), "n": F.count("s").over(by_col)})
    rule = F.when((F.col("filled") >= 2) & (F.col("n") >= F.col("filled") * 0.5), F.col("col_id"))
    both = counted.withColumns({"split_col": F.min(rule).over(by_doc), "new_col": F.max("col_id").over(by_doc) + 1}).where("split_col IS NOT NULL")
    hit = (F.col("col_id") == F.col("split_col")) & F.col("s").isNotNull()
    parts = F.when(hit, F.array(F.struct(F.col("col_id").alias("c"), F.col("s.name").alias("t")), F.struct(F.col("new_col").alias("c"), F.col("s.count").cast("string").alias("t")))).otherwise(F.array(F.struct(F.col("col_id").alias("c"), F.col("text").alias("t"))))
    return both.select("doc_id", "row_id", "split_col", "new_col", F.inline(parts).alias("col_id", "text"))


_BEST = "matched:int,plausible:double,score:double,qty:int,harga:int,jumlah:int,nama:int"
_PROFILE = ("columns.n", "columns.numeric_frac", "columns.digit_frac", "columns.mean_digits")


def plain_roles(grid: DataFrame) -> DataFrame:
    """(doc_id, matched, plausible, score, qty, harga, jumlah, nama), one row per document, of its cells as they are.

    grid: what `gridded` gives. All ordered triples first; pairs with an implied quantity of one for documents of which no
    triple matches a row; the layout that the forms share where no pair does either. The search is over many documents at a
    time within an Arrow batch (`folds`): a pair of columns is one operation over all rows of the batch.
    """
    best = F.arrow_udf(folds.plain_roles, f"struct<{_BEST}>")("at", "digits", *_PROFILE)
    return grid.select("doc_id", best.alias("best")).select("doc_id", F.inline(F.array("best")))


def assign_roles(grid: DataFrame, strict: bool = False, **also: Column) -> DataFrame:
    """(doc_id, was_split, split_col, n_cols, matched, plausible, score, qty, harga, jumlah, nama, at, text, split, rows, also..),
    one row per document.

    grid: what `gridded` gives. The reading with counts split off is taken if it matches at least as many rows; the split column
    keeps its profile. split: count and name of each cell in which they are welded; also: as in `gridded`. A document stays one
    row: nothing is dealt out or gathered again.
    """
    # As rows of their own, one a document: else the optimizer works them out anew for each argument and for the result.
    welded = grid.select("*", F.explode(F.array(F.transform("text", lambda t: split_count(t, strict)))).alias("split"))
    welded = welded.select("*", F.transform("split", lambda s: F.regexp_replace(s["name"], "[^0-9]+", "")).alias("names"))
    best = F.arrow_udf(folds.split_roles, f"struct<{_BEST},split_col:int>")("at", "digits", "split.count", "names", *_PROFILE)
    kept = ["at", "text", "split", "rows"]
    found = welded.select("doc_id", *kept, F.size("columns").alias("n_cols"), best.alias("best"), *[c.alias(name) for name, c in also.items()])
    return found.select("doc_id", F.col("best.split_col").isNotNull().alias("was_split"), "n_cols", "best.*", *kept, *also)


def reconcile(qty: Column, harga: Column, jumlah: Column) -> Column:
    """struct(reconciled, warnings): whether qty x harga = jumlah; never repaired."""
    product = F.try_multiply(qty, harga)
    said = F.concat(F.lit("arithmetic_mismatch: "), qty.cast("string"), F.lit(" x "), harga.cast("string"), F.lit(" = "), product.cast("string"), F.lit(", receipt says "), jumlah.cast("string"))
    whole = qty.isNotNull() & harga.isNotNull() & jumlah.isNotNull()
    right = whole & F.coalesce(product == jumlah, F.lit(False))
    none = F.array().cast("array<string>")
    return F.struct(right.alias("reconciled"), F.when(~whole, F.array(F.lit("incomplete_row"))).when(right, none).otherwise(F.array(said)).alias("warnings"))


def read_rows(assigned: DataFrame) -> DataFrame:
    """(doc_id, rows), one row per document; rows: array<struct<row_id, nama, qty, harga, jumlah, confidence, reconciled, warnings,
    is_item>> of every grid row, in order. assigned: what `assign_roles` gives."""
    roles = ("nama", "qty", "harga", "jumlah")
    whole = F.col("was_split")
    spots = [F.when(whole & (F.col(c) == F.col("n_cols")), F.col("split_col")).otherwise(F.col(c)).alias(f"{c}_at") for c in roles]
    placed = assigned.select("doc_id", "at", "text", "split", "rows", "n_cols", "was_split", *[F.when(whole, F.col(c) == F.col("n_cols")).otherwise(False).alias(f"{c}_count") for c in roles], *[F.when(whole, F.col(c) == F.col("split_col")).otherwise(False).alias(f"{c}_name") for c in roles], *spots)

    def cell(r: Column, c: str) -> Column:
        at = F.array_position("at", r["row_id"] * F.col("n_cols").cast("bigint") + F.col(f"{c}_at")).cast("int") - 1
        text, split = F.get("text", at), lambda name: F.get("split", at)[name]
        return F.when(F.col(f"{c}_count"), split("count").cast("string")).when(F.col(f"{c}_name"), F.coalesce(split("name"), text)).otherwise(text)

    def judged(r: Column) -> Column:
        check = r["check"]
        low = F.when(r["confidence"] < MIN_CONFIDENCE, F.array(F.lit("low_confidence"))).otherwise(F.array().cast("array<string>"))
        is_item = (r["nama"] != "") & ~is_number(r["nama"]) & r["harga"].isNotNull()
        return F.struct(*[r[c].alias(c) for c in ("row_id", *roles, "confidence")], check["reconciled"].alias("reconciled"), F.concat(check["warnings"], low).alias("warnings"), is_item.alias("is_item"))

    # One step after another: within a lambda, what an expression names twice is worked out twice.
    steps = [
        lambda r: F.struct(r["row_id"].alias("row_id"), r["confidence"].alias("confidence"), *[cell(r, c).alias(c) for c in roles]),
        lambda r: F.struct(r["row_id"].alias("row_id"), r["confidence"].alias("confidence"), F.trim(F.coalesce(r["nama"], F.lit(""))).alias("nama"), *[to_int(r[c]).alias(c) for c in roles[1:]]),
        lambda r: F.struct(*[r[c].alias(c) for c in ("row_id", "confidence", *roles)], F.when(r["qty"].isNull(), split_count(r["nama"])).alias("welded")),
        lambda r: F.struct(r["row_id"].alias("row_id"), r["confidence"].alias("confidence"), F.coalesce(r["welded"]["name"], r["nama"]).alias("nama"), F.coalesce(r["qty"], r["welded"]["count"].cast("decimal(38,0)")).alias("qty"), r["harga"].alias("harga"), r["jumlah"].alias("jumlah")),
        lambda r: F.struct(*[r[c].alias(c) for c in ("row_id", "confidence", *roles)], reconcile(r["qty"], r["harga"], r["jumlah"]).alias("check")),
        judged,
    ]
    rows = F.col("rows")
    for step in steps:
        rows = F.transform(rows, step)
    return placed.select("doc_id", rows.alias("rows"))


def line_items(read: DataFrame) -> DataFrame:
    whole = lambda c: F.col(c).try_cast("bigint").alias(c)
    rows = read.select("doc_id", F.inline(F.filter("rows", lambda r: r["is_item"])))
    return rows.select("doc_id", "row_id", "nama", whole("qty"), whole("harga"), whole("jumlah"), F.bround("confidence", 3).alias("confidence"), "reconciled", "warnings")


def receipts(read: DataFrame) -> DataFrame:
    """(doc_id, items, computed, stated, matches, warnings, needs_review), one row per document of `read`: (doc_id, rows), no
    rows where it has no text."""
    totalled = lambda r: (r["nama"] == "") | is_number(r["nama"])
    bought = read.select("doc_id", "rows", F.filter("rows", lambda r: r["is_item"]).alias("bought"))
    below = F.filter("rows", lambda r: ~r["is_item"] & r["jumlah"].isNotNull() & (r["row_id"] > F.get("bought", F.size("bought") - 1)["row_id"]) & totalled(r))
    item = lambda r: F.struct(r["row_id"].alias("row_id"), r["nama"].alias("nama"), *[r[c].try_cast("bigint").alias(c) for c in ("qty", "harga", "jumlah")], F.bround(r["confidence"], 3).alias("confidence"), r["reconciled"].alias("reconciled"), r["warnings"].alias("warnings"))
    computed = F.aggregate("bought", F.lit(0).cast("decimal(38,0)"), lambda a, r: F.try_add(a, F.coalesce(r["jumlah"], F.lit(0))).cast("decimal(38,0)"))
    out = bought.select("doc_id", F.transform("bought", item).alias("items"), (F.size("rows") > 0).alias("read"), computed.alias("computed"), F.get(below, F.lit(0))["jumlah"].alias("stated"))
    read_, matches = F.col("read"), F.when(F.col("read"), F.col("computed") == F.col("stated"))
    said = F.concat(F.lit("total_mismatch: rows sum to "), F.col("computed").cast("string"), F.lit(", receipt says "), F.col("stated").cast("string"))
    no_items = F.size("items") == 0
    warnings = F.when(~read_, F.array(F.lit("no_text_detected"))).otherwise(F.array_compact(F.array(F.when(no_items, "no_line_items_found"), F.when(F.col("stated").isNull(), "grand_total_not_found").when(~matches, said))))
    flagged = F.exists("items", lambda i: ~i["reconciled"] | (F.size(i["warnings"]) > 0))
    review = ~read_ | no_items | ~F.coalesce(matches, F.lit(False)) | flagged
    return out.select("doc_id", "items", F.coalesce(F.col("computed").try_cast("bigint"), F.lit(0)).alias("computed"), F.col("stated").try_cast("bigint").alias("stated"), matches.alias("matches"), warnings.alias("warnings"), F.coalesce(review, F.lit(True)).alias("needs_review"))


def extract_receipts(boxes: DataFrame, docs: DataFrame) -> DataFrame:
    """Boxes to receipts, one row per document of `docs`."""
    return receipts(read_rows(assign_roles(gridded(gathered(boxes, docs, how="left")))))
