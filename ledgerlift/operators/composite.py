"""Planning new handwriting on real pages (G-14): which empty ruled bands get rows, and what stands where. No pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.operators.layouts import fraction
from ledgerlift.operators.ranks import running

#: Columns of the form as shares of the page's width, and how often a quantity is drawn.
CENTRES = {"qty": 0.115, "nama": 0.40, "harga": 0.695, "jumlah": 0.86}
WIDTHS = {"qty": 0.17, "nama": 0.38, "harga": 0.13, "jumlah": 0.17}
QUANTITIES = (1, 1, 2, 2, 3, 4, 5, 10, 12)
BODY, FOOT, PITCH, MOST_ROWS, PAD, LEAST_SIZE = 0.62, 0.70, 2.1, 4, 4, 8


def pages(boxes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, height, used, last, text_h) and the greatest of the columns of `keep`: what a page's boxes say, in one pass.

    boxes: (page_id, y, h, height). used: the centres of all boxes, in whole lines; last, text_h: the centre of the lowest box of
    a page's body, and the upper median height there. The body ends at 0.62 of the page; below it stand the total and the
    signature. The median is a rank by counted heights, of which a page has few. Pages without a body have no row.
    """
    cy = F.col("y") + F.col("h") / 2
    body = cy < F.col("height") * BODY
    most = {c: F.max(c).alias(c) for c in dict.fromkeys(("height", *keep))}
    heights = boxes.groupBy("page_id", "h").agg(F.count_if(body).alias("n"), F.max(F.when(body, cy)).alias("last"), F.collect_set(F.rint(cy)).alias("used"), *most.values())
    whole = Window.partitionBy("page_id")
    ranked = heights.select("*", F.sum("n").over(whole.orderBy("h")).alias("upto"), F.sum("n").over(whole).alias("all"))
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col("h")))
    paged = ranked.groupBy("page_id").agg(F.max("last").alias("last"), middle.alias("text_h"), F.flatten(F.collect_list("used")).alias("used"), *most.values())
    return paged.where("last IS NOT NULL")


def free_rows(boxes: DataFrame, bands: DataFrame, most: int = MOST_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, row, cy, text_h, band_h) and the columns of `keep` by page: up to `most` empty bands of a page below its last
    item row, in a drawn order.

    bands: (page_id, a, b). A band is free if it begins more than 0.4 pitches below the last row, ends above 0.70 of the
    page, and the centre of no box, in whole lines, is in it. Pages without a body have none.
    """
    every = bands.join(pages(boxes, keep), "page_id").withColumn("band_h", F.min(F.col("b") - F.col("a")).over(Window.partitionBy("page_id")))
    below = (F.col("a") > F.col("last") + F.col("text_h") * PITCH * 0.4) & (F.col("b") < F.col("height") * FOOT)
    free = every.where(below & ~F.exists("used", lambda u: u.between(F.col("a"), F.col("b"))))
    drawn = Window.partitionBy("page_id").orderBy(fraction(F.col("page_id"), F.concat(F.lit("band"), F.col("a").cast("string"))), "a")
    placed = free.withColumn("row", F.row_number().over(drawn)).where(F.col("row") <= most)
    return placed.select("page_id", "row", ((F.col("a") + F.col("b")) / 2).alias("cy"), "text_h", "band_h", *keep)


def plan_rows(boxes: DataFrame, bands: DataFrame, vocabulary: DataFrame, advance: float = 0.5, most: int = MOST_ROWS) -> DataFrame:
    """(page_id, row, role, text, x, y, w, h): the cells of new rows, as they would be written over empty bands.

    boxes: (page_id, y, h, width, height); vocabulary: (word, base), a word and its usual price, drawn evenly. A row has a
    quantity, a name, a price in steps of 500 and their product. Writing is centred in its column and shrinks until it fits
    85 % of it, to LEAST_SIZE at least; `advance` is a character's width as a share of the size. A box has PAD pixels
    around it; cells whose box leaves the page are left out. Draws are settled by page, row and what they are for. Words
    are numbered by a distributed rank; empty tables give an empty result.
    """
    rows = free_rows(boxes, bands, most, keep=("width", "height"))
    key = F.concat_ws("/", F.col("page_id").cast("string"), F.col("row").cast("string"))
    draw = lambda what: fraction(key, what)
    words = running(vocabulary.select("word", "base"), [F.col("word"), F.col("base")], {"number": F.lit(1)})
    many = words.agg(F.max("number").alias("many"))
    picked = rows.crossJoin(F.broadcast(many)).withColumn("number", F.floor(draw("word") * F.col("many")) + 1).join(words, "number")
    qty = F.get(F.array(*map(F.lit, QUANTITIES)), F.floor(draw("qty") * len(QUANTITIES)).cast("int"))
    price = F.greatest(F.lit(500), F.floor(F.floor(F.col("base") * (draw("price") * 0.35 + 0.85)) / 500) * 500).cast("long")
    priced = picked.withColumns({"qty": qty.cast("long"), "price": price})
    cell = lambda role, text: F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"), F.lit(CENTRES[role]).alias("centre"), F.lit(WIDTHS[role]).alias("room"))
    cells = priced.select("*", F.inline(F.array(cell("qty", F.col("qty")), cell("nama", F.col("word")), cell("harga", F.col("price")), cell("jumlah", F.col("qty") * F.col("price")))))
    size = F.floor(F.least(F.col("text_h"), F.col("band_h") * 0.72) * (draw(F.concat(F.lit("size"), F.col("role"))) * 0.16 + 0.92))
    fits = F.floor(F.col("room") * F.col("width") * 0.85 / (advance * F.length("text")))
    sized = cells.where(F.length("text") > 0).withColumn("size", F.greatest(F.lit(LEAST_SIZE), F.least(size, fits)))
    wide = F.col("size") * advance * F.length("text")
    edge = lambda middle, half, sign: (middle + sign * half).cast("int") + sign * PAD
    cx = F.col("centre") * F.col("width")
    boxed = sized.select("page_id", "row", "role", "text", "width", "height", edge(cx, wide / 2, -1).alias("x0"), edge(F.col("cy"), F.col("size") / 2, -1).alias("y0"), edge(cx, wide / 2, 1).alias("x1"), edge(F.col("cy"), F.col("size") / 2, 1).alias("y1"))
    inside = (F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= F.col("width")) & (F.col("y1") <= F.col("height"))
    box = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y"), (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h"))
    return boxed.select("page_id", "row", "role", "text", F.inline(F.when(inside, F.array(box))))  # a filter would draw all sizes a second time
