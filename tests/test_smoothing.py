"""Exponential smoothing against brute-force searches, simulated parameters and any partitioning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import smoothing as S

M = 7


def naive_errors(y, alpha, level, beta=0.0, trend=0.0, phi=1.0):
    """One series, one day at a time."""
    out = []
    for v in y:
        e = v - (level + phi * trend)
        out.append(e)
        level, trend = level + phi * trend + alpha * e, phi * trend + beta * e
    return np.array(out)


def best_linear(y, grid):
    """Least sum of squares over a grid of weights, the first states by least squares: errors are linear in them."""
    best = math.inf
    for alpha, beta, phi in grid:
        zero = naive_errors(y, alpha, 0.0, beta, 0.0, phi)
        columns = [zero - naive_errors(y, alpha, 1.0, beta, 0.0, phi)]
        if beta is not None and (beta or phi != 1.0):
            columns.append(zero - naive_errors(y, alpha, 0.0, beta, 1.0, phi))
        x = np.stack(columns, 1)
        best = min(best, ((zero - x @ np.linalg.lstsq(x, zero, rcond=None)[0]) ** 2).sum())
    return best


@pytest.fixture(scope="module")
def walks():
    rng = np.random.default_rng(3)
    return 30 + np.cumsum(rng.normal(0.1, 1.0, (60, 8)), 0) * 0.6 + rng.normal(0, 1, (60, 8))


def test_simple_form_is_as_good_as_a_fine_grid(walks):
    _, sse = S.fitted(S.Form("A", "N", "N", False), walks, np.full(8, 60), M)
    grid = [(a, 0.0, 1.0) for a in np.linspace(0.001, 0.999, 400)]
    assert all(sse[i] <= best_linear(walks[:, i], grid) * 1.0005 for i in range(8))


def test_trended_and_damped_forms_are_as_good_as_a_grid(walks):
    weights = [(a, a * b) for a in np.linspace(0.02, 0.98, 25) for b in np.linspace(0.02, 0.98, 13)]
    for damped, phis in ((False, (1.0,)), (True, (0.81, 0.86, 0.91, 0.97))):
        _, sse = S.fitted(S.Form("A", "A", "N", damped), walks[:, :3], np.full(3, 60), M)
        for i in range(3):
            assert sse[i] <= best_linear(walks[:, i], [(a, b, phi) for a, b in weights for phi in phis]) * 1.01


def test_multiplicative_errors_are_as_good_as_a_grid(walks):
    y = walks[:, :3]
    _, got = S.fitted(S.Form("M", "N", "N", False), y, np.full(3, 60), M)
    for i in range(3):
        best = math.inf
        for alpha in np.linspace(0.01, 0.99, 60):
            for first in np.linspace(y[:, i].min() - 2, y[:, i].max() + 2, 60):
                level, squares, logs = first, 0.0, 0.0
                for v in y[:, i]:
                    squares, logs = squares + ((v - level) / level) ** 2, logs + math.log(level)
                    level += alpha * (v - level)
                best = min(best, squares * math.exp(2 * logs / len(y)))
        assert got[i] <= best * 1.001


def test_simulated_parameters_come_back():
    rng = np.random.default_rng(5)
    y, level, trend = np.zeros((400, 30)), np.full(30, 20.0), np.full(30, 0.3)
    for t in range(400):
        e = rng.normal(size=30)
        y[t] = level + trend + e
        level, trend = level + trend + 0.4 * e, trend + 0.1 * e
    form = S.Form("A", "A", "N", False)
    theta, _ = S.fitted(form, y, np.full(30, 400), M)
    p = S.unpacked(form, theta, M)
    assert abs(np.median(p["alpha"]) - 0.4) < 0.05 and abs(np.median(p["beta"]) - 0.1) < 0.03


def test_seasons_that_scale_are_chosen_and_carried_on():
    rng, share = np.random.default_rng(1), np.array([0.6, 0.8, 0.9, 1.0, 1.1, 1.2, 1.4])
    truth = lambda t: (50 + 0.5 * t) * share[t % 7]
    y = np.array([truth(t) * (1 + 0.03 * rng.normal(size=6)) for t in range(98)])
    names, ahead = S.choose(y, np.full(6, 98), M, 14)
    assert all(n.endswith("M") and n[1] == "A" for n in names)
    assert np.abs(ahead / np.array([truth(t) for t in range(98, 112)])[:, None] - 1).max() < 0.1


def test_zeros_bar_multiplicative_forms_and_short_series_get_their_mean():
    y = np.random.default_rng(2).poisson(1.0, (40, 20)).astype(float)
    y[0] = 0
    n = np.full(20, 40)
    n[:3] = 1, 2, 3
    names, ahead = S.choose(y, n, M, 3)
    assert list(names[:3]) == ["mean"] * 3 and not any(s.startswith("M") or s.endswith("M") for s in names)
    assert ahead[:, 1].tolist() == [y[:2, 1].mean()] * 3 and np.isfinite(ahead).all()


def test_a_series_fit_does_not_hang_on_its_neighbours():
    y = np.random.default_rng(4).gamma(3.0, 4.0, (35, 9))
    n = np.array([35, 20, 35, 9, 30, 35, 28, 14, 35])
    together = S.choose(y, n, M, 5)
    for i in range(9):
        name, alone = S.choose(y[: n[i], [i]], n[[i]], M, 5)
        assert name[0] == together[0][i] and np.allclose(alone[:, 0], together[1][:, i], rtol=1e-3, atol=1e-3)


def test_frames_of_any_partitioning_give_the_same_forecasts(spark):
    days = spark.range(0, 30 * 12).select((F.col("id") % 12).alias("unique_id"), F.expr("date_add(date'2024-01-01', cast(id div 12 AS int))").alias("ds"), F.when(F.col("id") % 29 != 3, F.col("id") * 7 % 11).alias("y"), F.lit("x").alias("form"))
    got = [sorted((r["unique_id"], str(r["ds"]), r["form"], round(r["yhat"], 4)) for r in S.auto_ets(days.repartition(k, "ds"), 4).collect()) for k in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == 48 and got[0][0][1] == "2024-01-31"
    assert S.auto_ets(days.limit(0), 4).count() == 0
