"""A document stays one row from its boxes to its receipt: nothing is dealt out anew, kept or read twice."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import evaluate, receipts
from ledgerlift.plans import queries as Q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name, counts", [("layout_benchmark", 2), ("role_search", 0), ("receipt_summary", 0), ("line_items", 0), ("assigned_roles", 0)])
def test_lines_and_documents_are_dealt_out_once(spark, name, counts):
    """Lines once, documents once; the benchmark's counts, a row for each layout and number of items, twice more."""
    df = Q.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange \w", plan)) - len(re.findall(r"BroadcastExchange", plan)) <= 2 + counts
    assert len(re.findall(r"ArrowEvalPython ", plan)) == 2 and "InMemoryTableScan" not in plan and "SortMergeJoin" not in plan
    df.collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


BOX = "doc_id string, box_idx int, x double, y double, w double, h double, text string, conf double"


def box(doc, idx, c, r, text, conf=0.9, dx=0.0):
    return (doc, idx, 90.0 + 300 * c + dx, 200.0 + 63 * r, 120.0, 74.0, text, conf)


def read(spark, boxes):
    docs = spark.createDataFrame([(d, 1536, 2048) for d in sorted({b[0] for b in boxes})], "doc_id string, width int, height int")
    return receipts.assign_roles(receipts.gridded(receipts.gathered(spark.createDataFrame(boxes, BOX), docs)))


def test_counts_are_split_off_cells_of_several_boxes(spark):
    rows = [(2, "teh", 500), (3, "kopi", 700), (4, "gula", 900)]
    boxes = []
    for r, (n, name, price) in enumerate(rows):
        boxes += [box("a", 10 * r, 0, r, str(n)), box("a", 10 * r + 1, 0, r, f" {name} ", dx=9.0), box("a", 10 * r + 2, 1, r, str(price)), box("a", 10 * r + 3, 2, r, str(n * price), 0.6 if r == 1 else float("nan"))]
    found = read(spark, boxes)
    got = found.first()
    assert (got["was_split"], got["split_col"], got["n_cols"], got["matched"], got["qty"], got["harga"], got["jumlah"], got["nama"]) == (True, 0, 3, 3, 3, 1, 2, 0)
    items = receipts.line_items(receipts.read_rows(found)).orderBy("row_id").collect()
    assert [(i["qty"], i["nama"], i["harga"], i["jumlah"], i["confidence"], i["warnings"]) for i in items] == [(n, name, p, n * p, 0.6 if r == 1 else 0.9, ["low_confidence"] if r == 1 else []) for r, (n, name, p) in enumerate(rows)]


def test_numbers_beyond_64_bits_and_38_digits(spark):
    big = 10**19 + 3
    boxes = [box("a", 10 * r + c, c, r, t) for r, row in enumerate([("3", "teh", str(big), str(3 * big)), ("0004", "kopi", str(big), str(4 * big)), ("5", "gula", "9" * 39, "1")]) for c, t in enumerate(row)]
    boxes += [box("b", c, c, 0, t) for c, t in enumerate(["7", "teh", "7"])]
    found = {r["doc_id"]: r for r in read(spark, boxes).collect()}
    assert (found["a"]["matched"], found["a"]["score"], found["a"]["qty"], found["a"]["harga"], found["a"]["jumlah"]) == (2, 1.0, 0, 2, 3)
    assert (found["b"]["matched"], found["b"]["qty"], found["b"]["harga"], found["b"]["jumlah"]) == (1, None, 0, 2)


def test_benchmark_judges_documents_with_blank_boxes(spark):
    roles = ("qty", "nama", "harga", "jumlah")
    rows = [("2", "teh", "500", "1000"), ("3", "kopi", "700", "2100"), ("4", "gula", "900", "3600")]
    boxes = [(*box(d, 10 * r + c, c, r + 1, t), roles[c], r + 1) for d in "ab" for r, row in enumerate(rows) for c, t in enumerate(row)]
    boxes += [(*box("a", 90, 0, 4, "  "), "qty", 4), (*box("c", 0, 0, 1, " "), "qty", 1), (*box("d", 0, 0, 1, "teh"), "nama", 1), (*box("b", 91, 3, 5, "6700"), "total_value", 5)]
    df = spark.createDataFrame(boxes, f"{BOX}, role string, row int")
    docs = spark.createDataFrame([(d, 1536, 2048) for d in "abcde"], "doc_id string, width int, height int")
    placed = receipts.gathered(evaluate.truth(df), docs, carried=("role", "item_row"))
    got = evaluate.layout_benchmark(placed, F.length("doc_id") - 1).collect()
    # a: four items by its blank box; b: three; c has no text, so that no column is found for it, but its box is in its band; d asks for no role
    assert {(r["layout"], r["n_items"]): (r["n_docs"], r["correct"], r["fixed_correct"]) for r in got} == {(0, None): (3, 2, 1), (None, 4): (1, 1, 0), (None, 3): (1, 1, 0), (None, 1): (1, 0, 1), (None, None): (3, 2, 1)}


@pytest.mark.parametrize("name", ["receipt_summary", "line_items", "assigned_roles", "layout_benchmark"])
def test_welded_counts_are_looked_for_once(spark, name):
    """Not in the arguments of a Python function, where each one works them out for itself, and in its result again."""
    plan = Q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "split_roles" in plan and not re.search(r"ArrowEvalPython [^\n]*RLIKE", plan)
    assert len(re.findall(r"\n[^\n]*transform\(text#", plan)) == 1


def test_lines_come_in_order_with_the_rows_of_their_document(spark):
    """Several documents of a batch, one without text: each line keeps its document, row, worst confidence and warnings."""
    boxes = [box("a", 10 * r + c, c, r, t, conf) for r, (row, conf) in enumerate([(("2", "teh", "500", "1000"), 0.9), (("3", "kopi", "700", "2101"), 0.65)]) for c, t in enumerate(row)]
    boxes += [box("b", 0, 0, 0, "  ")] + [box("c", 10 * r + c, c, r, t) for r, row in enumerate([("teh", "4", "250", "1000"), ("es", "1", "900", "900")]) for c, t in enumerate(row)]
    got = receipts.line_items(receipts.read_rows(read(spark, boxes))).orderBy("doc_id", "row_id").collect()
    assert [(r["doc_id"], r["row_id"], r["nama"], r["qty"], r["harga"], r["jumlah"], r["reconciled"]) for r in got] == [("a", 0, "teh", 2, 500, 1000, True), ("a", 1, "kopi", 3, 700, 2101, False), ("c", 0, "teh", 4, 250, 1000, True), ("c", 1, "es", 1, 900, 900, True)]
    assert [r["warnings"] for r in got] == [[], ["arithmetic_mismatch: 3 x 700 = 2100, receipt says 2101", "low_confidence"], [], []]


def test_layout_that_forms_share_settles_roles_where_nothing_adds_up(spark):
    """The largest money is the total, the next of three digits the price; the quantity is neither those nor the wordiest."""
    boxes = [box("a", 10 * r + c, c, r, t) for r, row in enumerate([("9", "teh", "500", "7001"), ("8", "kopi", "700", "9001"), ("7", "gula", "800", "9501")]) for c, t in enumerate(row)]
    boxes += [box("b", 10 * r + c, c, r, t) for r, row in enumerate([("teh", "susu"), ("kopi", "es")]) for c, t in enumerate(row)]
    got = {r["doc_id"]: r for r in read(spark, boxes).collect()}
    assert [got["a"][c] for c in ("matched", "qty", "harga", "jumlah", "nama")] == [0, 0, 2, 3, 1]
    assert [got["b"][c] for c in ("matched", "qty", "harga", "jumlah", "nama")] == [0, None, None, None, 0]
