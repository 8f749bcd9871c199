"""Hard-negative mining over k-means inverted lists with stored radii.

Rows are filed by their nearest centroid; a list stores the largest distance of its members from the centroid. By the
inequality of Cauchy and Schwarz, no member x of a list scores above q.c + |q| r or below q.c - |q| r with an anchor q.
Anchors visit lists from the highest bound down, pass over lists outside the score window that is asked for, and stop
where the bound falls strictly below the k-th score found so far.

Anchors are dealt into groups and rows into shards; each pair of a group and a shard is one piece of work, in which rows
stream by list and only the group is held. A row goes to a group only if some anchor of it may visit the row's list, judged
by the k-th score within a bounded sample of rows, which can only be too low: so nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.llm.common import cut_lineage, written

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
SAMPLE_ROWS, MOST_LISTS, ROWS_PER_LIST = 16_384, 1024, 512
GROUP, LEAST_SHARD, MOST_SHARD, CHUNK = 8192, 2048, 65_536, 512
EXACT = float(2**52)  # products of norms up to which double precision adds whole numbers exactly
LONG = 2**63 - 1


def quantised(vector: bytes, wire: type, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component, as whole numbers in double precision."""
    return np.floor(np.frombuffer(vector, wire).astype(np.float64) * scale)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly; what no long holds counts as the largest or smallest long."""
    with np.errstate(over="ignore", invalid="ignore"):
        sure = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :] < EXACT
        products = a @ b.T
    if sure.all():
        return products.astype(np.int64)
    out = np.where(sure, products, 0).astype(np.int64)
    for i, j in zip(*np.nonzero(~sure), strict=True):  # huge components: whole numbers of any size
        out[i, j] = max(-LONG, min(LONG, sum(int(x) * int(y) for x, y in zip(a[i], b[j], strict=True))))
    return out


@dataclass(frozen=True)
class Lists:
    """Centroids of the lists by vector length, with the radius of each list and how many rows it holds."""

    centroids: dict[int, np.ndarray]
    first: dict[int, int]  # the number of the first list of a vector length
    radius: dict[int, float] = field(default_factory=dict)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, distance) of each row; lengths that the sample does not have are one list each, around zero."""
        dims = x.shape[1]
        if dims not in self.centroids:
            return np.full(len(x), -1 - dims, np.int64), np.linalg.norm(x, axis=1)
        c = self.centroids[dims]
        with np.errstate(over="ignore", invalid="ignore"):
            near = np.nan_to_num((c * c).sum(1)[None, :] - 2 * x @ c.T, nan=np.inf).argmin(1)
            return self.first[dims] + near, np.linalg.norm(x - c[near], axis=1)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lists, least, most): between which scores the members of each list that holds rows lie, for each anchor."""
        dims = q.shape[1]
        if dims in self.centroids:
            numbers = [n for n in range(self.first[dims], self.first[dims] + len(self.centroids[dims])) if n in self.radius]
            c = self.centroids[dims][[n - self.first[dims] for n in numbers]]
        else:
            numbers, c = [n for n in (-1 - dims,) if n in self.radius], np.zeros((int(-1 - dims in self.radius), dims))
        with np.errstate(over="ignore", invalid="ignore"):
            size = np.linalg.norm(q, axis=1)[:, None]
            middle, reach = q @ c.T, size * np.array([self.radius[n] for n in numbers])[None, :]
            reach += 1e-9 * (np.abs(middle) + reach + size * np.linalg.norm(c, axis=1)[None, :]) + 1e-6  # for rounding
            least, most = middle - reach, middle + reach
        least, most = np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)
        return np.array(numbers, np.int64), np.clip(least, -LONG, LONG), np.clip(most, -LONG, LONG)  # as scores are


def fit_lists(vectors: list[np.ndarray], rows: int, seed: int = 7, rounds: int = 8) -> Lists:
    """k-means on sampled vectors, for each vector length; about ROWS_PER_LIST of `rows` rows a list, MOST_LISTS at most."""
    rng, centroids, first, at = np.random.default_rng(seed), {}, {}, 0
    by_dims: dict[int, list[np.ndarray]] = {}
    for v in vectors:
        by_dims.setdefault(len(v), []).append(v)
    for dims, found in sorted(by_dims.items()):
        if not dims:
            continue
        x = np.stack(found)
        x = x[np.abs(x).max(1) < 1e100]
        k = max(1, min(MOST_LISTS, math.ceil(rows * len(x) / max(1, len(vectors)) / ROWS_PER_LIST), len(x) // 8))
        if not len(x):
            continue
        c = x[rng.choice(len(x), k, replace=False)].copy()
        for _ in range(rounds):
            near = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
            sums, counts = np.zeros_like(c), np.bincount(near, minlength=k)
            np.add.at(sums, near, x)
            c[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        centroids[dims], first[dims] = c, at
        at += k
    return Lists(centroids, first)


class _Best:
    """The k best (score, then smaller id) of each of n queries, kept as arrays of what is found and cut from time to time."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.copy()
        self.held, self.fresh = [(np.zeros(0, np.int64),) * 3], 0

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(query):
            self.held.append((query, score, ids))
            self.fresh += len(query)
            if self.fresh > max(20_000, len(self.held[0][0])):
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query, score, ids = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        start = np.searchsorted(query, query, "left")
        rank = np.arange(len(query)) - start
        last = rank == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        best = rank < self.k
        self.held, self.fresh = [(query[best], score[best], ids[best])], 0
        return self.held[0]


@dataclass
class _Anchors:
    """Anchors of one vector length in arrays. Windows: for each anchor, score ranges [low, high], as many for all."""

    key: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    q: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray


def _anchors(rows: pd.DataFrame, wire: type, windows: int, scale: int) -> _Anchors:
    grid = lambda name: np.array(rows[name].tolist(), np.int64).reshape(len(rows), windows)
    q = np.stack([quantised(v, wire, scale) for v in rows["vector"]])
    return _Anchors(rows["akey"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(), q, grid("low"), grid("high"), grid("floor"))


def _collect(a: _Anchors, some: np.ndarray, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool, best: _Best) -> None:
    """Offer rows to the anchors at `some`: those of another id, of the same label or of another, within each window."""
    windows = a.low.shape[1]
    for at in range(0, len(some), CHUNK):
        part = some[at : at + CHUNK]
        found = scores(a.q[part], x)
        fit = ((a.label[part][:, None] == labels[None, :]) == same) & (a.vec_id[part][:, None] != ids[None, :])
        for w in range(windows):
            floor = best.floor[part * windows + w]
            i, j = np.nonzero(fit & (found >= np.maximum(a.low[part, w], floor)[:, None]) & (found <= a.high[part, w][:, None]))
            best.add(part[i] * windows + w, found[i, j], ids[j])


def _sampled_floors(rows: pd.DataFrame, wire: type, scale: int, windows: int, same: bool, k: int, sample: dict[int, tuple]) -> list[list[int]]:
    """The k-th score of each window within the sample, which bounds the k-th of all rows from below; the least long if fewer."""
    out = [[-LONG] * windows for _ in range(len(rows))]
    dims = rows["vector"].map(len).to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        found = sample.get(int(d))
        if found is None:
            continue
        a = _anchors(rows.iloc[at].assign(floor=[[-LONG] * windows] * len(at)), wire, windows, scale)
        best = _Best(len(at) * windows, k, a.floor.ravel())
        for start in range(0, len(found[0]), 2048):
            part = slice(start, start + 2048)
            _collect(a, np.arange(len(at)), found[0][part], found[1][part], found[2][part], same, best)
        best.cut()
        for i, floor in zip(at, best.floor.reshape(len(at), windows).tolist(), strict=True):
            out[i] = floor
    return out


def _wanted(a: _Anchors, floor: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which (anchor, list) may hold something: for some window the bounds meet it and are not strictly below the k-th score."""
    out = np.zeros(least.shape, bool)
    for w in range(a.low.shape[1]):
        need = np.maximum(a.low[:, w], floor[:, w])[:, None]
        out |= (most >= need) & (least <= a.high[:, w][:, None]) & (a.low[:, w] <= a.high[:, w])[:, None]
    return out


def _search(batches: Iterator[pd.DataFrame], lists: Lists, wire: type, windows: int, same: bool, k: int, scale: int) -> Iterator[pd.DataFrame]:
    """(akey, window, score, vec_id): the best of each piece of work. Rows come by piece, its anchors first, then by list."""
    piece, held, a, best, order = None, [], None, None, None

    def results() -> Iterator[pd.DataFrame]:
        if best is not None:
            query, score, ids = best.cut()
            yield pd.DataFrame({"akey": a.key[query // windows], "window": (query % windows).astype(np.int32), "score": score, "vec_id": ids})

    for batch in batches:
        pieces, turn = batch["piece"].to_numpy(), batch["turn"].to_numpy()
        edges = np.flatnonzero((pieces[1:] != pieces[:-1]) | (turn[1:] != turn[:-1])) + 1
        for start, end in zip([0, *edges], [*edges, len(batch)], strict=True):
            if start == end:
                continue
            if pieces[start] != piece:
                yield from results()
                piece, held, a, best = pieces[start], [], None, None
            part = batch.iloc[start:end]
            if turn[start] < 0:
                held.append(part)
                continue
            if a is None:
                if not held:
                    continue
                a = _anchors(pd.concat(held), wire, windows, scale)
                best = _Best(len(a.key) * windows, k, a.floor.ravel())
                numbers, least, most = lists.bounds(a.q)
                order = {n: i for i, n in enumerate(numbers.tolist())}
            x = np.stack([quantised(v, wire, scale) for v in part["vector"]])
            ids, labels, number = part["vec_id"].to_numpy(np.int64), part["label"].to_numpy(), int(part["list"].iloc[0])
            column = [order[number]]
            some = np.flatnonzero(_wanted(a, best.floor.reshape(-1, windows), least[:, column], most[:, column])[:, 0])
            if len(some):
                _collect(a, some, x, ids, labels, same, best)
    yield from results()


def _best_of_lists(anchors: DataFrame, filed: DataFrame, index: tuple, wire: type, windows: int, same: bool, k: int, scale: int) -> DataFrame:
    """(akey, window, rank, score, vec_id): the k best rows of each anchor's windows.

    anchors: (akey, vec_id, label, vector, list, low, high), low and high arrays of a value for each window.
    filed: (vec_id, label, vector, list).
    """
    lists, sample, shards = index

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(floor=_sampled_floors(batch, wire, scale, windows, same, k, sample.value))

    columns = "akey long, vec_id long, label long, vector binary, list long, grp long, low array<long>, high array<long>"
    ready = cut_lineage(anchors.mapInPandas(prepare, f"{columns}, floor array<long>"))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(grp, list, bound) of the lists that some anchor of a batch may visit."""
        for batch in batches:
            for (grp, _), part in batch.groupby(["grp", batch["vector"].map(len)]):
                a = _anchors(part, wire, windows, scale)
                numbers, least, most = lists.value.bounds(a.q)
                wanted = _wanted(a, a.floor, least, most)
                at = np.flatnonzero(wanted.any(0))
                yield pd.DataFrame({"grp": np.full(len(at), grp), "list": numbers[at], "bound": most[:, at].max(0) if len(at) else np.zeros(0)})

    # from the highest bound down: a list's turn in the work of a group
    asked = ready.mapInPandas(visits, "grp long, list long, bound double").groupBy("grp", "list").agg(F.max("bound").alias("bound"))
    asked = written(asked.withColumn("turn", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("bound"), "list"))).drop("bound"))
    deal = lambda *columns: F.xxhash64(*columns)
    shard = F.pmod(deal("vec_id", "label", "vector"), F.lit(shards))
    nothing = F.array().cast("array<long>")
    rows = filed.join(asked, "list").select(deal("grp", shard).alias("piece"), "turn", "list", F.lit(0).cast("long").alias("akey"), "vec_id", "label", "vector", nothing.alias("low"), nothing.alias("high"), nothing.alias("floor"))
    held = ready.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    held = held.select(deal("grp", "shard").alias("piece"), F.lit(-1).alias("turn"), "list", "akey", "vec_id", "label", "vector", "low", "high", "floor")
    work = held.unionAll(rows).repartition("piece").sortWithinPartitions("piece", "turn")
    found = work.mapInPandas(lambda it: _search(it, lists.value, wire, windows, same, k, scale), "akey long, window int, score long, vec_id long")
    best = Window.partitionBy("akey", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where `is_anchor` holds.

    A component x counts as floor(scale * x), and a score is the inner product of two rows. Higher scores come first, equal
    ones by smaller id. An anchor's positives are its first `positives` rows of the same label; with each, its negatives
    are the first `negatives` rows of other labels with low * positive_score <= 100 * score <= high * positive_score.
    All rows are searched, exactly: the lists only save work.

    Rows without an id, label or vector, or with a component that is null, not finite or not finite when scaled, take no
    part. Vectors of different length have no score with one another; that of two empty ones is 0. Scores beyond a long
    count as the largest or smallest long. A row is never a partner of an anchor with its own id; rows that repeat an id are
    candidates each on their own, and an anchor that is repeated whole is one anchor. An anchor without a positive, or
    without a negative in a window, gives no rows for it. An empty table gives an empty result; other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    wire = np.float32 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(fine)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(vector=[np.asarray(v, dtype=wire).tobytes() for v in batch["vector"]])

    encoded = cut_lineage(rows.mapInPandas(encode, "vec_id long, label long, vector binary, anchor boolean"))
    total = encoded.count()
    taken = encoded.orderBy(F.xxhash64("vec_id", F.lit(13)), "vec_id").limit(SAMPLE_ROWS).collect()
    found = [(quantised(r["vector"], wire, scale), r["vec_id"], r["label"]) for r in taken]
    lists = fit_lists([f[0] for f in found], total)
    sample = {}
    for size in {len(r["vector"]) for r in taken}:
        part = [f for f, r in zip(found, taken, strict=True) if len(r["vector"]) == size]
        sample[size] = (np.stack([p[0] for p in part]), np.array([p[1] for p in part], np.int64), np.array([p[2] for p in part], np.int64))
    fitted = spark.sparkContext.broadcast(lists)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number, distance = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            width = batch["vector"].map(len).to_numpy()
            for size in np.unique(width):
                at = np.flatnonzero(width == size)
                number[at], distance[at] = fitted.value.nearest(np.stack([quantised(v, wire, scale) for v in batch["vector"].iloc[at]]))
            yield batch.assign(list=number, distance=distance)

    filed = cut_lineage(encoded.mapInPandas(file, "vec_id long, label long, vector binary, anchor boolean, list long, distance double"))
    radius = {r["list"]: r["radius"] for r in filed.groupBy("list").agg(F.max("distance").alias("radius")).collect()}  # a number for each list
    index = (spark.sparkContext.broadcast(Lists(lists.centroids, lists.first, radius)), spark.sparkContext.broadcast(sample), math.ceil(total / max(LEAST_SHARD, min(MOST_SHARD, total // 64))) or 1)
    members = filed.select("vec_id", "label", "vector", "list")
    anchors = cut_lineage(filed.where("anchor").select("vec_id", "label", "vector", "list").distinct())
    anchors = cut_lineage(_grouped(anchors).withColumn("akey", F.monotonically_increasing_id()))

    # the whole range of a long; a window is one range of scores
    first = anchors.select("akey", "vec_id", "label", "vector", "list", "grp", F.array(F.lit(-LONG)).alias("low"), F.array(F.lit(LONG)).alias("high"))
    near = cut_lineage(_best_of_lists(first, members, index, wire, 1, True, positives, scale).select("akey", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    whole = lambda c: c.cast("decimal(38,0)")
    up, down = whole(F.ceil(whole(F.col("positive_score")) * low / 100)), whole(F.floor(whole(F.col("positive_score")) * high / 100))
    bounds = near.groupBy("akey").agg(F.collect_list(F.struct("place", up.cast("long").alias("low"), down.cast("long").alias("high"))).alias("w"))
    window = lambda name, none: F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda p: F.coalesce(F.get(F.filter("w", lambda w: w["place"] == p), 0)[name], F.lit(none)))
    asking = anchors.join(bounds, "akey").select("akey", "vec_id", "label", "vector", "list", "grp", window("low", LONG).alias("low"), window("high", -LONG).alias("high"))
    far = _best_of_lists(asking, members, index, wire, positives, False, negatives, scale)
    out = far.withColumn("place", F.col("window") + 1).join(near, ["akey", "place"]).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    named = out.join(anchors.select("akey", F.col("vec_id").alias("anchor_id")), "akey")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _grouped(anchors: DataFrame) -> DataFrame:
    """`anchors` with a group: GROUP anchors or so of lists that follow one another, a large list's by a hash.

    Only a count for each list, MOST_LISTS for each vector length at most, is brought to the driver.
    """
    counts = sorted((r["list"], r["width"], r["n"]) for r in anchors.groupBy("list", F.length("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect())
    last, room, width_before, out = -1, 0, None, []
    for number, width, n in counts:
        parts = -(-n // GROUP)
        if n > room or width != width_before:
            last, room, width_before = last + parts, GROUP, width
        out.append((number, last - parts + 1, parts))
        room = room - n if parts == 1 else 0
    table = anchors.sparkSession.createDataFrame(out, "list long, first long, parts long")
    return anchors.join(F.broadcast(table), "list").withColumn("grp", F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))).drop("first", "parts")


ORACLE_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""
