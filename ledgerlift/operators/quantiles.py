"""Exact quantiles by distributed selection (A-05): histograms narrow down the ranks that are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def exact_quantiles(values: DataFrame, fractions: tuple[float, ...], buckets: int = BUCKETS) -> dict[str, list[float | None]]:
    """The quantiles of each name's values (name, v), with linear interpolation between neighbouring ranks; None without any.

    values: few names (columns), any number of values; null and NaN are left out. Each round counts the values between the
    bounds of every rank that is still open in equal buckets, and goes on within the one bucket that holds the rank, between
    the least and greatest value there. The greatest value never shares a bucket with the least, so that every round
    leaves values out; it ends where both are one. Only the histograms, of `buckets` rows a rank, reach the driver.
    """
    known = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    out: dict[str, list[float | None]] = {r["name"]: [None] * len(fractions) for r in values.select("name").distinct().collect()}
    open_: dict[tuple[str, int], list] = {}  # rank: [least, greatest, how many values are below least]
    counts = {}
    for r in known.groupBy("name").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        counts[r["name"]] = r["n"]
        for q in fractions:
            for rank in _ranks(q, r["n"])[:2]:
                open_[r["name"], rank] = [r["lo"], r["hi"], 0]
    while wanted := [(name, rank, b[0], b[1]) for (name, rank), b in open_.items() if b[0] != b[1]]:
        bounds = known.sparkSession.createDataFrame(wanted, "name string, rank long, lo double, hi double")
        inside = known.join(F.broadcast(bounds), "name").where(F.col("v").between(F.col("lo"), F.col("hi")))  # a few rows
        at = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halves do not overflow
        bucket = F.when(F.col("v") == F.col("hi"), buckets).otherwise(F.least(F.floor(F.coalesce(at, F.lit(0.0)) * buckets), F.lit(buckets - 1)))
        found: dict[tuple[str, int], list] = {}
        for r in inside.groupBy("name", "rank", bucket.alias("bucket")).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            found.setdefault((r["name"], r["rank"]), []).append((r["bucket"], r["n"], r["lo"], r["hi"]))
        for key, histogram in found.items():
            below = open_[key][2]
            for _, n, lo, hi in sorted(histogram):
                if below + n > key[1]:
                    open_[key] = [lo, hi, below]
                    break
                below += n
    for name, n in counts.items():
        for i, q in enumerate(fractions):
            low, high, share = _ranks(q, n)
            a, b = open_[name, low][0], open_[name, high][0]
            out[name][i] = a if low == high else a * (1 - share) + b * share
    return out


def _ranks(fraction: float, n: int) -> tuple[int, int, float]:
    """The ranks, from 0, between which a quantile of n values lies, and how far from the lower one."""
    place = fraction * (n - 1)
    return int(place), min(n - 1, int(place) + (place > int(place))), place - int(place)
