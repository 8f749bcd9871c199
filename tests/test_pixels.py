"""Pixels of image files against plain numpy."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import pixels as P


def write_png(path, page):
    h, w, _ = page.shape
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = b"".join(b"\0" + page[y].tobytes() for y in range(h))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def scans(spark, tmp_path_factory):
    folder, rng, made = tmp_path_factory.mktemp("scans"), np.random.default_rng(0), {}
    for i in range(3):
        page = rng.integers(190, 250, (300, 120, 3)).astype(np.uint8)
        if i < 2:  # the third page has no rules
            for y in range(20 + i, 280, 10):
                page[y : y + 2, 5:115] = rng.integers(20, 60, (2, 110, 3))
        write_png(folder / f"{i}.png", page)
        made[f"{i}.png"] = page
    return P.read_pages(spark, str(folder)), made


def name(row):
    return row["page_id"].rsplit("/", 1)[1]


def test_profiles_and_bands(spark, scans):
    pages, made = scans
    profile = P.profile_of_images(pages)
    got = {(name(r), r["y"]): r["darkness"] for r in profile.collect()}
    for file, page in made.items():
        strip = page[:, 12:114].astype(float).sum(2) / 3
        assert [got[file, y] for y in range(300)] == [int((row < strip.mean() - 25).sum()) for row in strip]
    bands = sorted((name(r), r["a"], r["b"]) for r in P.ruled_bands(profile).collect())
    assert bands == [(f"{i}.png", y, y + 10) for i in range(2) for y in range(20 + i, 270, 10)]
    rows = [(f, 120, 300, y, x, *map(int, page[y, x])) for f, page in made.items() for y in range(300) for x in range(0, 120)]
    as_rows = spark.createDataFrame(rows, "page_id string, width int, height int, y int, x int, r int, g int, b int")
    assert {(r["page_id"], r["y"]): r["darkness"] for r in P.profile_of_pixels(as_rows).collect()} == got


def test_ink(spark, scans):
    pages, made = scans
    ids = {name(r): r["page_id"] for r in pages.select("page_id").collect()}
    boxes = {"0.png": [(5.7, 15.2, 60.0, 30.0), (-9.0, -3.0, 30.0, 25.0), (500.0, 10.0, 5.0, 5.0), *[(10.0 * k, 40.0, 9.0, 22.0) for k in range(5)]], "1.png": [(3.0, 3.0, 1.0, 1.0)]}
    frame = spark.createDataFrame([(ids[f], k, *b) for f, all_ in boxes.items() for k, b in enumerate(all_)], "page_id string, box_idx int, x double, y double, w double, h double")
    got = {name(r): (r["r"], r["g"], r["b"]) for r in P.ink_colour(pages, P.tones_of_images(pages, frame)).collect()}
    assert got["2.png"] == P.INK_DEFAULT and got["1.png"] == tuple(int(v) for v in made["1.png"][3, 3])
    samples = []
    for x, y, w, h in (tuple(map(int, b)) for b in boxes["0.png"][:6]):
        patch = made["0.png"][max(0, y) : y + h, max(0, x) : x + w].reshape(-1, 3).astype(float)
        if len(patch):
            order = np.argsort(patch.sum(1), kind="stable")[: max(1, len(patch) // 10)]
            samples.append(patch[order].mean(0))
    assert np.abs(np.mean(samples, 0) - np.array(got["0.png"])).max() <= 2  # tones that straddle the border give their mean
    assert P.ink_colour(pages.limit(0), P.tones_of_images(pages, frame)).count() == 0
    assert P.profile_of_images(pages.where(F.lit(False))).count() == 0
