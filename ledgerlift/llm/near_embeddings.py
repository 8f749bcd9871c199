"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut into halves, each with a codebook of its own; the product of the codebooks is a grid of cells, and
every vector is filed in the cell of its nearest centroids. Each vector then visits cells in the order of the
multi-sequence algorithm, nearest first, up to the reach beyond which no link can lie, and is compared in full with all
that is filed there. Comparisons run as matrix products over tiles of a cell; pairs never leave a tile.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import cut_lineage, groups
from ledgerlift.llm.components import connected_components, ties_by_id

THRESHOLD = 0.98
SAMPLE_ROWS, ROWS_PER_CELL, MOST_CENTROIDS, TILE = 16_384, 64, 2048, 512
SALTS = 8  # into how many parts the join of a cell's members with the cell's size is dealt


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves, and the reach at which a traversal ends."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def dims(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _distances(unit[:, :half], self.first), _distances(unit[:, half:], self.second)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """The cell that each unit vector is filed in."""
        one, two = self.distances(unit)
        return one.argmin(1) * len(self.second) + two.argmin(1)

    def detours(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each half from the plane midway between its nearest centroid and each other centroid.

        If two unit vectors are within r of each other, the sum of the two for the other's cell is at most r**2: a half
        filed with a centroid lies on that centroid's side of the plane. So a reach of r**2 misses nothing.
        """
        out = []
        for d, centroids in zip(self.distances(unit), (self.first, self.second), strict=True):
            gaps = np.stack([np.linalg.norm(centroids - c, axis=1) for c in centroids])[d.argmin(1)]
            squared = d * d
            out.append(((squared - squared.min(1, keepdims=True)) / np.where(gaps > 1e-6, 2 * gaps, np.inf)) ** 2)
        return tuple(out)

    def visited(self, one: np.ndarray, two: np.ndarray) -> list[int]:
        """The cells within reach for a vector with these detours, nearest first (multi-sequence traversal)."""
        by_one, by_two = one.argsort(kind="stable"), two.argsort(kind="stable")
        heap, seen, out = [(one[by_one[0]] + two[by_two[0]], 0, 0)], {(0, 0)}, []
        while heap:
            cost, i, j = heapq.heappop(heap)
            if cost > self.reach:
                break
            out.append(int(by_one[i]) * len(two) + int(by_two[j]))
            for ahead in ((i + 1, j), (i, j + 1)):
                if ahead[0] < len(one) and ahead[1] < len(two) and ahead not in seen:
                    seen.add(ahead)
                    heapq.heappush(heap, (one[by_one[ahead[0]]] + two[by_two[ahead[1]]], *ahead))
        return out


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None, :]
    return np.sqrt(np.maximum(squared, 0))


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centroids).argmin(1)
        sums, counts = np.zeros_like(centroids), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


def unit_vectors(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """(which are usable, their unit vectors in double precision): not null, not zero, all components finite."""
    usable, rows = np.zeros(len(vectors), bool), []
    for i, v in enumerate(vectors):
        if v is None or not len(v):
            continue
        x = np.array([np.nan if c is None else c for c in v], dtype=float)
        big = np.abs(x).max()
        if np.isfinite(big) and big > 0:  # scaled first, so that squares neither overflow nor vanish
            x = x / big
            usable[i] = True
            rows.append(x / math.sqrt(float(x @ x)))
    return usable, rows


def _key(label: str, vector: bytes) -> bytes:
    named = label.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(len(named).to_bytes(8) + named + vector, digest_size=16).digest()


def _copies(index: MultiIndex, x: np.ndarray, rows: float, tile: int) -> float:
    """About how many copies of a vector go to tiles, for a label of `rows` rows that are spread as x is."""
    one, two = index.detours(x)
    visits = float(np.mean([np.count_nonzero(a[:, None] + b[None, :] <= index.reach) for a, b in zip(one, two, strict=True)]))
    filed = rows / (len(index.first) * len(index.second))
    away = (visits - 1) / 2
    return math.ceil(filed / tile) * (1 + away) + (math.ceil(filed * away / tile) if away else 0)


def fit_index(vectors: list, labels: list, rows: int, threshold: float = THRESHOLD, seed: int = 11, tile: int = TILE) -> MultiIndex:
    """Codebooks for about `rows` vectors, fitted on a sample, with the reach that misses nothing.

    Of codebooks of ever half the size, those are taken that send the fewest copies of a vector to tiles. The choice
    settles only the work: no result depends on it.
    """
    usable, units = unit_vectors(vectors)
    by_dims: dict[int, int] = {}
    for u in units:
        by_dims[len(u)] = by_dims.get(len(u), 0) + 1
    certain = 2 - 2 * threshold + 1e-6
    if not units:
        return MultiIndex(np.zeros((1, 1)), np.zeros((1, 1)), certain)
    dims = max(by_dims, key=by_dims.get)
    x, rng = np.stack([u for u in units if len(u) == dims]), np.random.default_rng(seed)
    shares = np.unique([str(label) for label, ok in zip(labels, usable, strict=True) if ok], return_counts=True)[1] / len(units)
    k = max(1, min(MOST_CENTROIDS, math.isqrt(max(1, rows // ROWS_PER_CELL)), len(x) // 8))
    half, some = dims // 2, x[:: max(1, len(x) // 256)]
    found = []
    while k:
        index = MultiIndex(_codebook(x[:, :half], k, rng), _codebook(x[:, half:], k, rng), certain)
        found.append((_copies(index, some, rows * float((shares * shares).sum()), tile), len(found), index))
        k //= 2
    return min(found)[2]


def _compare(batches: Iterator[pd.DataFrame], wire: type, threshold: float) -> Iterator[pd.DataFrame]:
    """(cls, links, root) for classes of a tile with a link there; links counts vectors, not classes.

    A tile holds filed classes (query false) and visitors (query true), or classes that meet one another (query null).
    No two classes meet in more than one tile, so each link found counts for both its ends.
    """
    for tile in groups(batches, "tile"):
        query = tile["query"]
        among = query.isna().to_numpy(dtype=bool)
        visitors, filed = np.flatnonzero(among | (query == True).to_numpy(dtype=bool)), np.flatnonzero(among | (query == False).to_numpy(dtype=bool))  # noqa: E712
        if not len(visitors) or not len(filed):
            continue
        ids, rows = tile["cls"].to_numpy(), tile["n"].to_numpy()
        vectors = np.frombuffer(b"".join(tile["vector"]), wire).reshape(len(tile), -1).astype(np.float64)
        vectors /= np.abs(vectors).max(1, keepdims=True)
        vectors /= np.sqrt((vectors * vectors).sum(1, keepdims=True))
        a, b = np.nonzero(vectors[visitors] @ vectors[filed].T >= threshold)
        a, b = visitors[a], filed[b]
        once = (a < b) | ~among[a]
        a, b = a[once], b[once]
        if not len(a):
            continue
        names, place = np.unique(ids, return_inverse=True)
        links = np.zeros(len(names), np.int64)
        np.add.at(links, place[a], rows[b])
        np.add.at(links, place[b], rows[a])
        label = np.arange(len(names))
        while True:
            low = np.minimum(label[place[a]], label[place[b]])
            after = label.copy()
            np.minimum.at(after, place[a], low)
            np.minimum.at(after, place[b], low)
            after = after[after]
            if (after == label).all():
                break
            label = after
        some = links > 0
        yield pd.DataFrame({"cls": names[some], "links": links[some], "root": names[label][some]})


def near_embeddings(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors`.

    Rows are compared when their labels are equal and not null, and linked at a cosine of at least `threshold` in double
    precision. Null, empty and zero vectors and those with null or non-finite components link with nothing; vectors of
    another length than most are compared among themselves. Rows that agree in vec_id, label and vector are one vector and
    share a result. A vec_id with several vectors or labels has as many vectors: n_links of a row counts what links with
    its own one, and all of them that are usable are in one component. A row without a vec_id links with nothing, has no
    component and is kept. An empty table gives an empty result; other columns are not looked at.

    Equal vectors of a label are one class from the start, so that copies are neither filed nor compared. The codebooks
    are fitted on SAMPLE_ROWS rows picked by a hash of vec_id; every class is filed, and every link found.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    index = fit_index([r["vector"] for r in sample], [r["label"] for r in sample], rows.count(), threshold, tile=tile)
    shared = spark.sparkContext.broadcast(index)
    wire = np.float32 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            usable, _ = unit_vectors(list(batch["vector"]))
            wired = [np.array(v, dtype=wire).tobytes() if ok and label is not None else None for v, ok, label in zip(batch["vector"], usable, batch["label"], strict=True)]
            keys = [None if v is None else _key(label, v) for v, label in zip(wired, batch["label"], strict=True)]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "key": keys, "vector": wired})

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = unit_vectors([np.frombuffer(v, wire) for v in batch["vector"]])[1]
            same = np.array([len(u) == shared.value.dims for u in units], bool)
            cells, visits = np.full(len(batch), -1, np.int64), [[]] * len(batch)
            if same.any():
                matrix = np.stack([u for u, s in zip(units, same, strict=True) if s])
                cells[same] = shared.value.cells(matrix)
                for i, one, two in zip(np.flatnonzero(same), *shared.value.detours(matrix), strict=True):
                    visits[i] = [at for at in shared.value.visited(one, two) if at > cells[i]]  # the other end of a link does not visit back
            yield batch.assign(dims=[len(u) for u in units], cell=cells, visits=visits)

    encoded = cut_lineage(rows.where("vec_id IS NOT NULL").mapInPandas(encode, "vec_id long, label string, key binary, vector binary"))
    usable, alone = encoded.where("key IS NOT NULL"), encoded.where("key IS NULL").select("vec_id").unionAll(rows.where("vec_id IS NULL").select("vec_id"))
    classes = usable.groupBy("label", "key").agg(F.min("vec_id").alias("least"), F.countDistinct("vec_id").alias("n"), F.first("vector").alias("vector"))
    classes = classes.withColumn("cls", F.monotonically_increasing_id())
    filed = cut_lineage(classes.mapInPandas(file, "label string, key binary, least long, n long, vector binary, cls long, dims int, cell long, visits array<long>"))

    cell = ["label", "dims", "at"]
    sizes = filed.groupBy("label", "dims", F.col("cell").alias("at")).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("filed_tiles"))
    own, salt = F.xxhash64("cls", F.lit(3)), F.pmod(F.xxhash64("cls", F.lit(5)), F.lit(SALTS))
    probes = filed.select("cls", "n", "label", "dims", "vector", F.explode("visits").alias("at"))
    asking = probes.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("query_tiles"))
    salted = lambda grid: grid.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    sizes, grid = salted(sizes), salted(sizes.join(asking, cell))
    here = filed.withColumn("at", F.col("cell")).withColumn("salt", salt)
    parts = here.join(sizes, [*cell, "salt"]).withColumn("p", F.pmod(own, F.col("filed_tiles")))
    parts = parts.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("filed_tiles") - 1)))
    parts = parts.withColumn("query", F.when(F.col("p") != F.col("o"), F.col("p") > F.col("o"))).withColumn("f", F.least("p", "o")).withColumn("q", -1 - F.greatest("p", "o"))
    stored = here.join(grid, [*cell, "salt"]).withColumn("f", F.pmod(own, F.col("filed_tiles")))
    stored = stored.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("query_tiles") - 1))).withColumn("query", F.lit(False))
    asked = probes.withColumn("salt", salt).join(grid, [*cell, "salt"]).withColumn("q", F.pmod(own, F.col("query_tiles")))
    asked = asked.withColumn("f", F.explode(F.sequence(F.lit(0), F.col("filed_tiles") - 1))).withColumn("query", F.lit(True))
    wanted = ["cls", "n", "vector", "query", F.xxhash64(*cell, F.col("f").cast("long"), F.col("q").cast("long")).alias("tile")]
    tiles = parts.select(*wanted).unionAll(stored.select(*wanted)).unionAll(asked.select(*wanted)).repartition("tile").sortWithinPartitions("tile")
    found = cut_lineage(tiles.mapInPandas(lambda it: _compare(it, wire, threshold), "cls long, links long, root long"))

    known = filed.select("key", "cls", "n", "least")
    ties = ties_by_id(usable, "vec_id", "key", known)
    component = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")).unionAll(ties)).withColumnRenamed("node", "cls")
    known = known.join(component, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = known.join(smallest, "component").join(links, "cls", "left")
    known = cut_lineage(known.select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    out = usable.select("vec_id", "key").join(known, "key").select("vec_id", "n_links", "component_id")
    out = out.unionAll(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
