"""Levelling, perspective, exact quantiles and shares, running sums and composite plans against plain Python."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.functions import geometry as G
from ledgerlift.operators import audit, composite, deskew, quantiles, ranks, splits

QUAD = "array<struct<x double, y double>>"


def line(x, y, length, degrees, t=10):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(float(a), float(b)) for a, b in ((x, y), (x + length * c, y + length * s), (x + length * c - t * s, y + length * s + t * c), (x - t * s, y + t * c))]


def pages(spark, rows):
    return spark.createDataFrame(rows, f"doc_id bigint, degrees string, lines array<{QUAD}>").drop("degrees")


def all_lines(frame):
    return frame.withColumn("quads", deskew.turned_quads(F.col("lines"), F.lit(1000), F.lit(1400), F.col("degrees")))


def test_pages_are_levelled_and_leave(spark):
    rows = [(i, "x", [line(100, 100 + 50 * k, 300 + k, lean) for k in range(6)]) for i, lean in enumerate([0.3, 5, -12, 86, 90, -89.9])]
    rows += [(10, "x", [line(0, 0, 100, 20)] * 3), (11, "x", []), (None, "x", [line(0, 9 * k, 100, 3) for k in range(4)])]
    got = {r["doc_id"]: r for r in deskew.deskew(pages(spark, rows), all_lines).collect()}
    assert [round(got[i]["degrees"], 4) for i in (0, 1, 2, 3)] == [0, 5, -12, 86] and abs(got[4]["degrees"]) == pytest.approx(90) and got[5]["degrees"] == pytest.approx(-89.9)
    assert [got[i]["n_passes"] for i in (0, 1, 2, 3, 10, 11, None)] == [0, 1, 1, 1, 0, 0, 1]
    for i in range(6):  # the lines found on a levelled page are level, and lie on its canvas's own coordinates
        edges = [(q[1]["x"] - q[0]["x"], q[1]["y"] - q[0]["y"]) for q in got[i]["quads"]]
        assert all(abs(math.degrees(math.atan2(dy, dx)) % 180 - 180 * (math.degrees(math.atan2(dy, dx)) % 180 > 90)) < 0.7 for dx, dy in edges)
    assert deskew.deskew(pages(spark, rows).limit(0), all_lines).count() == 0


def test_a_detector_that_errs_is_asked_again(spark):
    asked = []

    def halfway(frame):  # sees lines turned back by a tenth of what they lean
        asked.append(frame.count())
        lean = deskew.lines_angle(F.col("q"))
        return all_lines(frame).withColumnRenamed("quads", "q").withColumn("quads", deskew.turned_quads(F.col("q"), F.lit(1), F.lit(1), lean * 0.1)).drop("q")

    rows = [(i, "x", [line(10, 40 * k, 200, lean) for k in range(5)]) for i, lean in enumerate([40, 6, 0])]
    got = {r["doc_id"]: r for r in deskew.deskew(pages(spark, rows), halfway).collect()}
    assert got[0]["degrees"] == pytest.approx(40, abs=0.7) and got[0]["n_passes"] == 2 and got[1]["n_passes"] in (1, 2) and got[2]["n_passes"] == 0
    assert asked[0] == 3 and asked[1] == 2 and asked[2] <= 2 and len(asked) <= 4


def test_a_turn_that_loses_the_lines_is_not_taken(spark):
    def blind(frame):
        return all_lines(frame).withColumn("quads", F.when(F.col("degrees") != 0, F.slice("quads", 1, 2)).otherwise(F.col("quads")))

    got = deskew.deskew(pages(spark, [(1, "x", [line(0, 30 * k, 100, 8) for k in range(5)])]), blind).collect()[0]
    assert (got["degrees"], got["n_passes"], len(got["quads"])) == (0, 0, 5)


def test_points_turn_as_a_page_does(spark):
    w, h, p = 40, 30, (7.0, 11.0)
    for degrees in (0.5, 90, 180.3, -90, 270, 25, -140):
        got = spark.range(1).select(G.turned_point(F.struct(F.lit(p[0]).alias("x"), F.lit(p[1]).alias("y")), F.lit(w), F.lit(h), F.lit(float(degrees))).alias("p")).first()["p"]
        quarter = round(degrees / 90) if abs(degrees - 90 * round(degrees / 90)) < 0.7 else None
        if abs(degrees) < 0.7:
            want = p
        elif quarter is not None:
            x, y, ww, hh = *p, w, h
            for _ in range(quarter % 4):
                x, y, ww, hh = y, ww - x, hh, ww
            want = (x, y)
        else:
            c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
            out = int(h * abs(s) + w * abs(c)), int(h * abs(c) + w * abs(s))
            want = (c * (p[0] - w / 2) + s * (p[1] - h / 2) + out[0] / 2, -s * (p[0] - w / 2) + c * (p[1] - h / 2) + out[1] / 2)
        assert (got["x"], got["y"]) == pytest.approx(want)


def test_perspective_takes_corners_to_corners(spark):
    rng = np.random.default_rng(3)
    w, h = 1536, 2048
    src = np.array([[0, 0], [w, 0], [w, h], [0, h]], float)
    for dst in [src + rng.uniform(-90, 90, (4, 2)) for _ in range(5)] + [src, src * 0.5 + 7]:
        corners = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in dst])
        m = G.perspective(F.lit(w), F.lit(h), corners)
        got = np.array(spark.range(1).select(*[m[i][j].alias(f"m{i}{j}") for i in range(3) for j in range(3)]).first(), float)
        rows = [r for (x, y), (u, v) in zip(src, dst, strict=True) for r in ([x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y])]
        assert np.allclose(got[:8], np.linalg.solve(np.array(rows), dst.ravel()), rtol=1e-9, atol=1e-9) and got[8] == 1


@pytest.mark.parametrize("buckets", [2, 1024])
def test_exact_quantiles(spark, buckets):
    rng = random.Random(4)
    columns = {"even": [rng.random() for _ in range(501)], "heavy": [7.0] * 300 + [rng.gauss(0, 1) for _ in range(50)], "one": [3.5], "two": [1.0, 2.0], "wide": [(-1.0) ** k * 10.0 ** rng.uniform(-300, 308) for k in range(60)], "same": [2.0] * 9}
    rows = [(name, v) for name, values in columns.items() for v in values] + [("even", None), ("none", None), ("one", math.nan)]
    fractions = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = quantiles.exact_quantiles(spark.createDataFrame(rows, "name string, v double").repartition(4), fractions, buckets)
    for name, values in columns.items():
        ordered = sorted(values)
        for q, v in zip(fractions, got[name], strict=True):
            place = q * (len(ordered) - 1)
            low, share = int(place), place - int(place)
            want = ordered[low] if not share else ordered[low] * (1 - share) + ordered[low + 1] * share
            assert v == pytest.approx(want, rel=1e-12)
    assert got["none"] == [None] * len(fractions)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "name string, v double"), fractions) == {}


def test_density_is_that_of_a_plain_kernel_sum(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(400)] + [rng.gauss(6, 0.5) for _ in range(200)]
    got = sorted(tuple(r) for r in audit.density(spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "v double"), "v").collect())
    h = statistics.stdev(values) * len(values) ** -0.2
    for n, (place, x, density) in enumerate(got):
        want = sum(math.exp(-(((x - v) / h) ** 2) / 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
        assert place == n and density == pytest.approx(want, rel=1e-3, abs=1e-6)
    assert len(got) == 200 and got[0][1] == min(values) and got[-1][1] == pytest.approx(max(values))
    assert audit.density(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").count() == 0


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(5) if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i bigint, v bigint").repartition(6)
    got = ranks.running(df, [F.col("g").asc_nulls_last(), F.col("i")], {"upto": F.col("v"), "place": F.lit(1)}).collect()
    upto, want = 0, {}
    for n, (_, i, v) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))):
        upto += v or 0
        want[i] = (upto, n + 1)
    assert {r["i"]: (r["upto"], r["place"]) for r in got} == want
    assert ranks.running(df.limit(0), [F.col("i")], {"n": F.lit(1)}).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 10, 30, 333])
def test_shares_are_exact(spark, n):
    images = spark.createDataFrame([(f"s{i % max(n, 1)}",) for i in range(n * 2)], "source string")
    got = [r["split"] for r in splits.grouped_split(images).collect()]
    assert (len(got), got.count("val"), got.count("test")) == (n, round(n * 0.15), min(n - round(n * 0.15), round(n * 0.15)))
    writers = spark.createDataFrame([(f"s{i}", i % 3) for i in range(0, n, 2)], "source string, writer int")
    placed = splits.writer_split(images, writers).collect()
    groups = {r["source"]: str(int(r["source"][1:]) % 3) if int(r["source"][1:]) % 2 == 0 else r["source"] for r in placed}
    split_of = {}
    for r in placed:
        assert split_of.setdefault(groups[r["source"]], r["split"]) == r["split"]
    many = max(1, round(len(split_of) * 0.15))
    assert [list(split_of.values()).count(s) for s in ("val", "test")] == [min(many, len(split_of)), min(many, max(0, len(split_of) - many))]


def test_composite_plan_by_hand(spark):
    rng = random.Random(2)
    boxes, bands = [], []
    for page in range(40):
        boxes += [(page, rng.uniform(100, 900), rng.uniform(30, 50), 1000, 1500) for _ in range(rng.randint(0, 9))]
        bands += [(page, 60 * k + page % 5, 60 * k + page % 5 + rng.choice([40, 55, 60])) for k in range(3, 24)]
    boxes += [(99, 1400.0, 40.0, 1000, 1500), (98, 300.0, 200.0, 30, 1500)]  # nothing in the body; a page too narrow
    bands += [(99, 600, 650), (98, 900, 950)]
    frame = spark.createDataFrame(boxes, "page_id bigint, y double, h double, width int, height int")
    free = composite.free_rows(frame, spark.createDataFrame(bands, "page_id bigint, a int, b int")).collect()
    got = {}
    for r in free:
        got.setdefault(r["page_id"], []).append(r["cy"])
    for page in {b[0] for b in boxes}:
        own = [b for b in boxes if b[0] == page]
        body = [b for b in own if b[1] + b[2] / 2 < 1500 * 0.62]
        if not body:
            assert page not in got
            continue
        text_h, last = sorted(b[2] for b in body)[len(body) // 2], max(b[1] + b[2] / 2 for b in body)
        used = {round(b[1] + b[2] / 2) for b in own}
        want = {(a + b) / 2 for p, a, b in bands if p == page and a > last + text_h * 2.1 * 0.4 and b < 1500 * 0.7 and not any(a <= u <= b for u in used)}
        found = got.get(page, [])
        assert set(found) <= want and len(found) == len(set(found)) == min(4, len(want))
    words = spark.createDataFrame([("semen", 50000), ("paku 2 inci", 700), ("", 100)], "word string, base bigint")
    plan = composite.plan_rows(frame, spark.createDataFrame(bands, "page_id bigint, a int, b int"), words).collect()
    assert plan and all(0 <= r["x"] and r["x"] + r["w"] <= 1000 and 0 <= r["y"] and r["y"] + r["h"] <= 1500 for r in plan)
    rows = {}
    for r in plan:
        rows.setdefault((r["page_id"], r["row"]), {})[r["role"]] = r["text"]
    for cells in rows.values():
        if {"qty", "harga", "jumlah"} <= set(cells):
            assert int(cells["qty"]) * int(cells["harga"]) == int(cells["jumlah"]) and int(cells["harga"]) % 500 == 0
    assert composite.plan_rows(frame.limit(0), spark.createDataFrame(bands, "page_id bigint, a int, b int"), words).count() == 0
