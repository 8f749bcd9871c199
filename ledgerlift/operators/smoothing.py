"""Exponential smoothing chosen by AICc (Y-04): state-space forms fitted by likelihood, many series at a time.

A series is one row with its days in an array, so a series is a unit of work and an Arrow batch holds many. All series of a
block are fitted together: every step of the recursion is one operation over the block, and the least squares of the
one-step errors are sought by damped Gauss-Newton steps whose normal equations are solved as one stack.

A form is three letters and a damping mark: error (A, M), trend (N, A), season (N, A, M). Multiplicative errors and seasons
are tried only for series above zero throughout; an additive error goes with no multiplicative season.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.shared import spread

BLOCK = 256  # series fitted together
STEPS = 60  # most steps of the search from one start; it ends where no step gains a part in TOLERANCE
TOLERANCE = 1e-8
PHI_LOW, PHI_HIGH = 0.80, 0.98
STARTS = ((0.1, 0.12), (0.6, 0.12), (0.05, 0.7), (0.5, 0.7))  # alpha and beta / alpha that the search begins at


class Form(NamedTuple):
    error: str
    trend: str
    season: str
    damped: bool

    def __str__(self) -> str:
        return f"{self.error}{self.trend}{'d' if self.damped else ''}{self.season}"


TRENDS = (("N", False), ("A", False), ("A", True))
FORMS = tuple(Form(e, t, s, d) for e in "AM" for s in "NAM" for t, d in TRENDS if (e, s) != ("A", "M"))


def size_of(form: Form, m: int) -> int:
    """Free parameters: weights, damping and first states, of which one season is settled by the others."""
    return 2 + 2 * (form.trend != "N") + form.damped + m * (form.season != "N")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def unpacked(form: Form, theta: np.ndarray, m: int) -> dict[str, np.ndarray]:
    """Named parameters from free ones (rows of `theta`): 0 < alpha < 1, 0 < beta < alpha, 0 < gamma < 1 - alpha."""
    rows = iter(theta)
    out = {"alpha": 1e-4 + (1 - 2e-4) * _sigmoid(next(rows)), "level": next(rows)}
    zero = np.zeros_like(out["level"])
    out |= {"beta": zero, "trend": zero, "gamma": zero, "phi": zero + 1}
    if form.trend != "N":
        out |= {"beta": out["alpha"] * _sigmoid(next(rows)), "trend": next(rows)}
    if form.damped:
        out["phi"] = PHI_LOW + (PHI_HIGH - PHI_LOW) * _sigmoid(next(rows))
    if form.season != "N":
        out["gamma"] = (1 - out["alpha"]) * _sigmoid(next(rows))
        first = np.array([next(rows) for _ in range(m - 1)]).reshape(m - 1, *zero.shape)
        out["season"] = np.concatenate([first, (m * (form.season == "M") - first.sum(0))[None]])
    return out


def errors(form: Form, p: dict[str, np.ndarray], y: np.ndarray, n: np.ndarray, m: int) -> tuple[np.ndarray, tuple]:
    """(residuals (days, series), last states). Days from n[i] on are no part of series i: residual 0, states stay.

    The residuals' sum of squares is the likelihood's: with multiplicative errors each is scaled by the geometric mean of
    the fitted values, so that n log(sum) + const is minus twice the log likelihood in both cases.
    """
    level, trend = p["level"].copy(), p["trend"].copy()
    season = p["season"].copy() if form.season != "N" else None
    out, logs, bad = np.zeros_like(y), np.zeros_like(level), np.zeros(level.shape, bool)
    for t in range(len(y)):
        live = t < n
        base = level + p["phi"] * trend
        s = season[t % m] if season is not None else 0.0
        fitted = base * s if form.season == "M" else base + s
        gap = y[t] - fitted
        if form.error == "M" or form.season == "M":
            bad |= live & ((fitted <= 1e-8) | (base <= 1e-8) | (np.asarray(s) <= 1e-8 if form.season == "M" else False))
            fitted = np.maximum(fitted, 1e-8)
        if form.error == "M":
            out[t] = np.where(live, gap / fitted, 0.0)
            logs += np.where(live, np.log(fitted), 0.0)
        else:
            out[t] = np.where(live, gap, 0.0)
        to_level = gap / np.maximum(s, 1e-8) if form.season == "M" else gap
        if season is not None:
            to_season = gap / np.maximum(base, 1e-8) if form.season == "M" else gap
            season[t % m] = np.where(live, s + p["gamma"] * to_season, s)
        level = np.where(live, base + p["alpha"] * to_level, level)
        trend = np.where(live, p["phi"] * trend + p["beta"] * to_level, trend)
    if form.error == "M":
        out *= np.exp(logs / np.maximum(n, 1))
    return np.where(bad, 1e6 * (1 + np.abs(y)), out), (level, trend, season)


def _begin(form: Form, y: np.ndarray, n: np.ndarray, m: int, alpha: float, share: float) -> np.ndarray:
    """Free parameters to begin at: level, slope and seasons of the first cycles."""
    day = np.arange(len(y))[:, None]
    head = (day < np.minimum(n, 2 * m if len(y) >= 2 * m else len(y))).astype(float)
    count = head.sum(0)
    mean, at = (y * head).sum(0) / count, (day * head).sum(0) / count
    slope = ((day - at) * (y - mean) * head).sum(0) / np.maximum((((day - at) * head) ** 2).sum(0), 1e-9)
    rows = [np.full(len(n), np.log(alpha / (1 - alpha))), mean - slope * at if form.trend != "N" else mean]
    if form.trend != "N":
        rows += [np.full(len(n), np.log(share / (1 - share))), slope]
    if form.damped:
        rows.append(np.full(len(n), 1.0))
    if form.season != "N":
        rows.append(np.full(len(n), -2.0))
        around = mean + slope * (day - at) if form.trend != "N" else mean + 0 * day
        rest = y / np.maximum(around, 1e-8) if form.season == "M" else y - around
        by = np.stack([(rest[i::m] * head[i::m]).sum(0) / np.maximum(head[i::m].sum(0), 1) for i in range(m)])
        by = by / np.maximum(by.mean(0), 1e-8) if form.season == "M" else by - by.mean(0)
        rows += list(np.maximum(by, 0.05)[:-1] if form.season == "M" else by[:-1])
    return np.array(rows)


def _search(form: Form, y: np.ndarray, n: np.ndarray, m: int, theta: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(theta, sum of squares) where damped Gauss-Newton steps from `theta` end, for each series on its own."""
    d = len(theta)
    loss = lambda th, at: (errors(form, unpacked(form, th, m), y[:, at], n[at], m)[0] ** 2).sum(0)
    best, damp = loss(theta, slice(None)), np.full(theta.shape[1], 1e-2)
    active = np.arange(theta.shape[1])
    season = _season_rows(form, m)
    states = [1, *([3] if form.trend != "N" else []), *([] if form.season == "M" else season)]  # in units of y
    for _ in range(STEPS):
        if not len(active):
            break
        here, ya, na = theta[:, active], y[:, active], n[active]
        width = np.full((d, len(active)), 1e-5)
        width[states] = 1e-5 * scale[active]
        moved = np.repeat(here[:, None, :], d + 1, 1)  # (parameter, moved parameter, series); the last is not moved
        moved[np.arange(d), np.arange(d)] += width
        found = errors(form, unpacked(form, moved.reshape(d, -1), m), np.tile(ya, d + 1), np.tile(na, d + 1), m)[0].reshape(len(y), d + 1, -1)
        r = found[:, d]
        jac = (found[:, :d] - r[:, None]) / width[None]
        by_series = np.ascontiguousarray(jac.transpose(2, 1, 0))
        normal, slope = by_series @ by_series.transpose(0, 2, 1), (by_series @ r.T[:, :, None])[:, :, 0]
        diagonal = np.einsum("sii->si", normal)
        ridge = damp[active][:, None] * diagonal + 1e-12 * (1 + diagonal.max(1, keepdims=True))
        step = np.linalg.solve(normal + ridge[:, :, None] * np.eye(d), -slope[:, :, None])[:, :, 0].T
        new = here + np.where(np.isfinite(step), step, 0.0)
        got = loss(new, active)
        better = got < best[active]
        gain = best[active] - got
        done = np.where(better, gain <= TOLERANCE * best[active], damp[active] > 1e6) | (best[active] <= 1e-12 * scale[active] ** 2)
        theta[:, active] = np.where(better, new, here)
        best[active] = np.where(better, got, best[active])
        damp[active] = np.where(better, damp[active] / 5, damp[active] * 6)
        active = active[~done]
    return theta, best


def _season_rows(form: Form, m: int) -> list[int]:
    d = size_of(form, m)
    return list(range(d - (m - 1), d)) if form.season != "N" else []


def fitted(form: Form, y: np.ndarray, n: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(free parameters, sum of squares) of `form` for each series, the best of all starts. y: (days, series)."""
    live = np.arange(len(y))[:, None] < n
    mean = (y * live).sum(0) / n
    scale = np.sqrt((((y - mean) * live) ** 2).sum(0) / n) + 1e-6 * (1 + np.abs(mean))
    best, least = None, np.full(len(n), np.inf)
    for alpha, share in STARTS if form.trend != "N" else STARTS[:2]:
        theta, sse = _search(form, y, n, m, _begin(form, y, n, m, alpha, share), scale)
        best = theta if best is None else np.where(sse < least, theta, best)
        least = np.minimum(least, sse)
    return best, least


def _ahead(form: Form, p: dict[str, np.ndarray], y: np.ndarray, n: np.ndarray, m: int, horizon: int) -> np.ndarray:
    _, (level, trend, season) = errors(form, p, y, n, m)
    out, grown = [], np.zeros_like(level)
    for h in range(horizon):
        grown = grown + p["phi"] ** (h + 1)
        base = level + grown * trend
        s = season[(n + h) % m, np.arange(len(n))] if season is not None else 0.0
        out.append(base * s if form.season == "M" else base + s)
    return np.array(out)


def choose(y: np.ndarray, n: np.ndarray, m: int, horizon: int, forms: tuple[Form, ...] = FORMS) -> tuple[np.ndarray, np.ndarray]:
    """(names of the chosen forms, forecasts (horizon, series)) for series y (days, series) of n days each.

    The least AICc wins, the earlier of FORMS in a tie. A form is tried where its parameters leave at least three days, a
    season where there are two cycles; where none can be, the mean is the forecast and the name is `mean`.
    """
    live = np.arange(len(y))[:, None] < n
    mean = (y * live).sum(0) / n
    above = np.where(live, y, 1.0).min(0) > 0
    floor = 1e-10 * (1 + np.abs(mean)) ** 2
    names, least, out = np.full(len(n), "mean", object), np.full(len(n), np.inf), np.repeat(mean[None], horizon, 0)
    for form in forms:
        k = size_of(form, m) + 1
        may = (n >= k + 3) & (above | ((form.error == "A") & (form.season != "M"))) & ((form.season == "N") | (n >= 2 * m))
        at = np.flatnonzero(may)
        if not len(at):
            continue
        theta, sse = fitted(form, y[:, at], n[at], m)
        aicc = n[at] * np.log(np.maximum(sse, floor[at]) / n[at]) + 2 * k + 2 * k * (k + 1) / (n[at] - k - 1)
        wins = aicc < least[at] - 1e-9
        least[at[wins]], names[at[wins]] = aicc[wins], str(form)
        out[:, at[wins]] = _ahead(form, unpacked(form, theta[:, wins], m), y[:, at[wins]], n[at[wins]], m, horizon)
    return names, out


def auto_ets(train: DataFrame, horizon: int, season_length: int = 7) -> DataFrame:
    """(unique_id, ds, method, form, yhat): forecasts of the next `horizon` days after each series' last.

    train: (unique_id, ds, y), one row a day of a series; days are taken as following one another, a null y counts as 0. A
    series is gathered once (one shuffle by series); an empty table gives an empty result.
    """
    m = season_length
    days = F.array_sort(F.collect_list(F.struct("ds", F.coalesce(F.col("y").cast("double"), F.lit(0.0)).alias("y"))))
    # dealt out in a stated number of parts: a fit takes long for the few bytes of a series, by which parts would be put together
    series = spread(train, "unique_id", 2).groupBy("unique_id").agg(days.alias("days"), F.max("ds").alias("last")).select("unique_id", "last", F.col("days.y").alias("y"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                block = batch.iloc[first : first + BLOCK]
                n = np.array([len(v) for v in block["y"]])
                y = np.zeros((n.max(), len(n)))
                for i, v in enumerate(block["y"]):
                    y[: n[i], i] = v
                names, ahead = choose(y, n, m, horizon)
                yield pd.DataFrame({"unique_id": block["unique_id"], "last": block["last"], "form": names, "yhat": list(ahead.T)})

    kind = train.schema["unique_id"].dataType.simpleString()
    done = series.mapInPandas(fit, f"unique_id {kind}, last date, form string, yhat array<double>")
    flat = done.select("unique_id", "last", "form", F.posexplode("yhat").alias("h", "yhat"))
    return flat.select("unique_id", F.expr("date_add(last, h + 1)").alias("ds"), F.lit("AutoETS").alias("method"), "form", "yhat")
