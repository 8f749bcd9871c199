"""Hand-checked results of the receipt, geometry and demand rules."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions import geometry as G
from ledgerlift.functions import text as T
from ledgerlift.operators import demand, receipts, scanlines


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("r"), "i").orderBy("i").collect()]


def test_split_count(spark):
    texts = ["2 tempe", "2 kg gula pasir", "2 kg. gula", "10kopi", " 3dus teh", "1 gorengan", "2 pakaian", "3 setrika", "67.500", "2 kg", "12 pcs", "5 es", "1000 batu", "1 2 pensil", "hvs a 4 sidu", "300"]
    got = [None if r is None else (r["count"], r["name"]) for r in column(spark, texts, "string", T.split_count)]
    assert got == [(2, "tempe"), (2, "gula pasir"), (2, "gula"), (10, "kopi"), (3, "teh"), (1, "gorengan"), (2, "aian"), (3, "rika")] + [None] * 8
    strict = [None if r is None else r["name"] for r in column(spark, ["2 pakaian", "2 kg gula"], "string", lambda c: T.split_count(c, strict=True))]
    assert strict == ["pakaian", "gula"]


def test_numbers(spark):
    texts = ["67.500", "Rp 5.000", "", "--", "kopi", None]
    assert [None if v is None else int(v) for v in column(spark, texts, "string", T.to_int)] == [67500, 5000, None, None, None, None]
    assert column(spark, texts[:5], "string", T.is_number) == [True, False, False, False, False]


def test_source_id(spark):
    assert column(spark, ["nota203_jpg.rf.93fc.jpg", "plain.jpg"], "string", T.source_id) == ["nota203", "plain.jpg"]


def test_cer(spark):
    df = spark.createDataFrame([("12000", "120000"), ("relur", "telur"), ("", "ab"), ("ab", "")], "p string, g string")
    assert [r[0] for r in df.select(T.cer(F.col("p"), F.col("g"))).collect()] == pytest.approx([1 / 6, 1 / 5, 1, 2])


@pytest.mark.parametrize(("values", "gap", "want"), [([1, 2, 10, 11, 12], 3, [0, 0, 1, 1, 1]), ([0, 4, 8, 12], 5, [0, 0, 1, 1]), ([0, 5], 5, [0, 0]), ([], 1, [])])
def test_cluster_1d(spark, values, gap, want):
    points = F.array(*[F.struct(F.lit(float(v)).alias("v"), F.lit(i).alias("idx")) for i, v in enumerate(values)]) if values else F.array().cast("array<struct<v:double,idx:int>>")
    got = spark.range(1).select(receipts.cluster_1d(points, F.lit(float(gap))).alias("c")).first()["c"]
    assert [r["cluster"] for r in sorted(got, key=lambda r: r["idx"])] == want


def test_upper_median(spark):
    assert column(spark, [[1, 2, 3, 4], [1, 2, 3], []], "array<int>", receipts.upper_median) == [3, 2, None]


def test_reconcile(spark):
    df = spark.createDataFrame([(2, 5000, 10000), (2, 6000, 120000), (None, 5, 5)], "q bigint, h bigint, j bigint")
    got = [(r[0]["reconciled"], r[0]["warnings"]) for r in df.select(receipts.reconcile(F.col("q"), F.col("h"), F.col("j"))).collect()]
    assert got == [(True, []), (False, ["arithmetic_mismatch: 2 x 6000 = 12000, receipt says 120000"]), (False, ["incomplete_row"])]


def test_page_angle(spark):
    def quad(degrees):
        dx, dy = 100 * math.cos(math.radians(degrees)), 100 * math.sin(math.radians(degrees))
        nx, ny = -dy / 20, dx / 20
        return [(0.0, 0.0), (dx, dy), (dx + nx, dy + ny), (nx, ny)]

    kind = "d string, q array<struct<x:double,y:double>>"
    df = spark.createDataFrame([("a", quad(10)), ("a", quad(20)), ("b", quad(90)), ("b", quad(-90))], kind)
    got = {r["d"]: r["angle"] for r in df.groupBy("d").agg(G.page_angle(F.col("q")).alias("angle")).collect()}
    assert got["a"] == pytest.approx(15) and abs(got["b"]) == pytest.approx(90)
    assert df.where("d = 'z'").agg(G.page_angle(F.col("q"))).first()[0] == 0


def panel(spark, series):
    day = datetime.date(2024, 1, 1)
    return spark.createDataFrame([(k, day + datetime.timedelta(i), y) for k, ys in series.items() for i, y in enumerate(ys)], "unique_id bigint, ds date, y bigint")


def test_quadrants(spark):
    got = {r["unique_id"]: r for r in demand.quadrants(panel(spark, {1: [1, 1, 1, 1], 2: [1, 9, 1, 9], 3: [0, 5, 0, 0, 5, 0, 0, 5, 0, 0], 4: [0, 1, 0, 9, 0, 0, 1, 9], 5: [0, 0, 0, 7]})).collect()}
    assert [got[k]["quadrant"] for k in range(1, 6)] == ["smooth", "erratic", "intermittent", "lumpy", "slow"]
    assert got[5]["adi"] == math.inf and got[2]["cv2"] == 0.64


def test_forecasts(spark):
    s = spark.createDataFrame([([0.0, 0.0, 4.0, 0.0, 2.0],), ([0.0, 0.0],)], "ys array<double>")
    got = s.select(demand.croston_sba(F.col("ys")).alias("c"), demand.tsb(F.col("ys")).alias("t")).collect()
    assert got[0]["c"] == pytest.approx(1.2448276) and got[0]["t"] == pytest.approx(1.1808) and got[1]["c"] == got[1]["t"] == 0


def test_ledger_conserves_stock(spark):
    rows = demand.simulate_shop(panel(spark, {7: [3, 0, 5, 9, 1, 0, 2, 8, 4, 4, 1, 6], 8: [0, 0, 1, 0, 0, 0, 2, 0, 0, 0, 0, 1]})).collect()
    assert len(rows) == 24
    for r in rows:
        assert r["closing"] == r["opening"] - r["sold"] and r["sold"] + r["lost"] == r["demand"] and min(r["sold"], r["lost"], r["closing"]) >= 0


def test_free_bands(spark):
    dark = spark.createDataFrame([(1, y) for y in (10, 11, 12, 50, 90, 91, 400)], "page_id int, y int")
    bands = scanlines.bands(scanlines.rules(dark), 1000)
    assert {(r["a"], r["b"]) for r in bands.collect()} == {(11, 50), (50, 90)}
    used = spark.createDataFrame([(1, 60), (2, 20)], "page_id int, u int")
    assert {(r["a"], r["b"]) for r in scanlines.free_bands(bands, used).collect()} == {(11, 50)}


def test_rotated_size(spark):
    got = column(spark, [0.5, 90.2, 10.0, -89.9], "double", lambda c: G.rotated_size(F.lit(100), F.lit(200), c))
    assert [(g["action"], g["width"], g["height"]) for g in got] == [("none", 100, 200), ("quarter", 200, 100), ("affine", 133, 214), ("quarter", 200, 100)]


def receipt_boxes(doc, rows, order, welded=False):
    out = []
    for r, row in enumerate(rows):
        for c, role in enumerate(order):
            if row.get(role) is not None:
                out.append((doc, len(out), 90.0 + 300 * c, 200.0 + 63 * r, 120.0, 74.0, str(row[role]), row.get("conf", 0.9)))
    return out


ROWS = [{"qty": "BANYAKNYA", "nama": "NAMA", "harga": "HARGA", "jumlah": "JUMLAH"}, {"qty": 2, "nama": "teh celup", "harga": "5.000", "jumlah": "10.000"}, {"qty": 10, "nama": "kopi sachet", "harga": "1500", "jumlah": "15000"}, {"qty": 1, "nama": "gula pasir", "harga": "15000", "jumlah": "15000", "conf": 0.618}, {"jumlah": "40.000"}]


def test_receipts(spark):
    boxes = receipt_boxes("a", ROWS, ["qty", "nama", "harga", "jumlah"]) + receipt_boxes("b", ROWS, ["nama", "harga", "qty", "jumlah"]) + [("blank", 0, 1.0, 1.0, 5.0, 5.0, "  ", 0.5)]
    welded = [{"nama": "BARANG", "harga": "HARGA", "jumlah": "JUMLAH"}, *({"nama": f"{r['qty']} {r['nama']}", "harga": r["harga"], "jumlah": r["jumlah"], "conf": r.get("conf", 0.9)} for r in ROWS[1:4]), ROWS[4]]
    boxes += receipt_boxes("w", welded, ["nama", "harga", "jumlah"])
    boxes = spark.createDataFrame(boxes, "doc_id string, box_idx int, x double, y double, w double, h double, text string, conf double")
    docs = spark.createDataFrame([("a", 1536, 2048), ("b", 1536, 2048), ("w", 1536, 2048), ("blank", 1536, 2048), ("none", 1536, 2048)], "doc_id string, width int, height int")
    got = {r["doc_id"]: r for r in receipts.extract_receipts(boxes, docs).collect()}
    for doc in ("a", "b", "w"):
        r = got[doc]
        assert [(i["nama"], i["qty"], i["harga"], i["jumlah"], i["reconciled"]) for i in r["items"]] == [("teh celup", 2, 5000, 10000, True), ("kopi sachet", 10, 1500, 15000, True), ("gula pasir", 1, 15000, 15000, True)]
        assert (r["computed"], r["stated"], r["matches"], r["warnings"], r["needs_review"]) == (40000, 40000, True, [], True)
        assert r["items"][2]["warnings"] == ["low_confidence"] and r["items"][2]["confidence"] == 0.618
    for doc in ("blank", "none"):
        assert got[doc]["warnings"] == ["no_text_detected"] and got[doc]["needs_review"] and got[doc]["items"] == []


def test_registered_functions_agree_with_the_columns(spark):
    from ledgerlift.functions import register
    from ledgerlift.functions import text as T

    assert "split_count" in register.register_functions(spark)
    texts = ["2 tempe", "2 kg gula pasir", "10kopi", "2 pakaian", "67.500", "Rp 5.000", "5 es", " objects ", "", None, "n1_jpg.rf.a.jpg"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    built = df.select(T.to_int(t), T.is_number(t), T.normalise(t), T.source_id(t), T.is_label(t), T.split_count(t), T.cer(t, F.lit("2 tempeh")), T.thousands(F.lit(15000)))
    named = df.selectExpr("to_int(t)", "is_number(t)", "normalise(t)", "source_id(t)", "is_label(t)", "split_count(t)", "cer(t, '2 tempeh')", "thousands(15000)")
    assert [tuple(r) for r in named.collect()] == [tuple(r) for r in built.collect()]


def test_describe_columns_equals_describe(spark):
    from ledgerlift.operators import audit

    df = spark.createDataFrame([(1.0, 5), (2.0, None), (4.0, 9)], "a double, b int")
    each = {r["name"]: tuple(r)[1:] for r in audit.describe_columns(df, ["a", "b"]).collect()}
    assert each == {c: tuple(audit.describe(df, c).first()) for c in ("a", "b")}
