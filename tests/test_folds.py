"""Folds over many documents at once: the clusters of the SQL fold, and searches beyond 64-bit numbers."""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlift.operators import folds, receipts


def test_clusters_are_those_of_the_fold(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [None if rng.random() < 0.05 else float(v) for v in rng.integers(0, 400, rng.integers(1, 40)) / 4], float(rng.integers(1, 9))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v array<double>, gap double")
    points = F.transform("v", lambda v, i: F.struct(v.alias("v"), i.alias("idx")))
    want = df.select("id", F.transform(F.array_sort(receipts.cluster_1d(points, F.col("gap"))), lambda c: c["cluster"]).alias("k"))
    wanted = [k for r in sorted(want.collect()) for k in r["k"]]
    flat = pa.array([x for _, v, _ in rows for x in v], pa.float64())
    got = folds.clusters(folds._masked(flat), np.array([len(v) for _, v, _ in rows]), np.array([g for _, _, g in rows]))
    assert got.tolist() == wanted


def test_search_compares_products_beyond_64_bits_whole():
    big = 10**20
    maps = [[{0: 2, 1: big, 2: 2 * big}, {0: 3, 1: big, 2: 3 * big}], [{0: 2, 1: 5, 2: 10}], [{0: 7, 1: 7}], [{0: 1, 1: None}], [{0: 2**32, 1: 2**32, 2: 0}]]
    g = pa.array([[[(k, None if v is None else Decimal(v)) for k, v in m.items()] for m in doc] for doc in maps], pa.list_(pa.map_(pa.int32(), pa.decimal128(38, 0))))
    p = pa.array([[2.0, 1e20, 2e20], [2.0, 5.0, 10.0], [7.0, 7.0], [1.0, float("inf")], [1.0, 1.0, 0.0]], pa.list_(pa.float64()))
    got = [tuple(r.values()) for r in folds.searched(g, p).to_pylist()]
    assert got[:4] == [(2, 1.0, 1.0, 0, 1, 2), (1, 1.0, 1.0, 0, 1, 2), (1, 1.0, 1.0, None, 0, 1), (None,) * 6]
    assert got[4] == (1, 1.0, 1.0, None, 0, 1)  # 2^64 is not 0; what is left is that two columns are equal
