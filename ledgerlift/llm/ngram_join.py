"""Jaccard self-join on word shingles with Bayesian candidate pruning.

Texts become sets of five-word shingles; texts with equal sets are one class from the start. Classes that agree on a band
of MinHash values meet in a block. There their remaining values are compared a few at a time, and a pair is dropped once
the posterior probability that its similarity reaches the threshold falls below a tolerance; what is left is compared
exactly. Pairs never leave a block: it returns how many texts each class is linked with and enough links to connect
them. Large blocks are cut into tiles, so a task never holds more than two tiles whatever a block's size.

Where only the groups are wanted and no counts, each block is first compared with one class of its own, its leader.
Blocks whose classes all turn out to be connected need nothing more; only what is left of the others is met in tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import cut_lineage, groups, whole_text
from ledgerlift.llm.bits import bits_of, marked as _marked
from ledgerlift.llm.components import connected_components, ties_by_id

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP, TOLERANCE = 32, 4, 16, 1e-8
TILE, LEADERS = 384, 4
_rng = np.random.default_rng(20240607)
MULTIPLY = (_rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
ADD = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)[:, None]


class _WordHashes(dict):
    """Word to 64-bit hash; emptied when full, so that its memory is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _WordHashes()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's runs of `words` words; a shorter text is one run, an empty one none."""
    found = (text or "").split()
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    n = max(1, len(each) - words + 1)
    mixed = np.full(n, len(found) if len(found) < words else words, np.uint64)
    for k in range(min(words, len(found))):
        mixed = (mixed ^ each[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(found: np.ndarray) -> np.ndarray:
    """The smallest of each of BANDS * ROWS hash functions over a set that is not empty."""
    low = (found >> np.uint64(32)).astype(np.uint32)[None, :]
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, low.shape[1], 2048):
        np.minimum(best, (low[:, at : at + 2048] * MULTIPLY + ADD).min(1), out=best)
    return best


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, step: int, total: int) -> tuple[int, ...]:
    """For step, 2 step, ... compared values, the fewest matches with which a pair stays.

    With a uniform prior, m matches of n leave P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(step, total + 1, step):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _candidate_pairs(left: np.ndarray, right: np.ndarray | None, band: int, threshold: float, groups_: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a block that survive the pruning and whose first common band is this one. right: None for left itself.

    groups_: what group each of left and right is in; pairs within one are left out.
    """
    other = left if right is None else right
    a, b = np.triu_indices(len(left), 1) if right is None else (x.ravel() for x in np.indices((len(left), len(other))))
    if groups_ is not None:
        apart = groups_[0][a] != groups_[1][b]
        a, b = a[apart], b[apart]
    matches = np.zeros(len(a), np.int16)
    for n, least in enumerate(least_matches(threshold, TOLERANCE, STEP, BANDS * ROWS)):
        part = slice(n * STEP, (n + 1) * STEP)
        if not len(a):
            break
        equal = left[a, part] == other[b, part]
        matches = matches + equal.sum(1)
        bands = equal.reshape(len(a), -1, ROWS).all(2)
        before = bands[:, : max(0, min(STEP // ROWS, band - n * (STEP // ROWS)))].any(1)
        stays = (matches >= least) & ~before
        a, b, matches = a[stays], b[stays], matches[stays]
    return a, b


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (a, b) of sets reach the threshold, exactly."""
    size = np.array([len(s) for s in sets])
    possible = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9
    out = np.zeros(len(a), bool)
    order = np.flatnonzero(possible)
    order = order[np.argsort(a[order], kind="stable")]
    at = 0
    while at < len(order):
        end = at
        one = a[order[at]]
        while end < len(order) and a[order[end]] == one:
            end += 1
        mates = b[order[at:end]]
        joined = np.concatenate([sets[m] for m in mates])
        where = np.searchsorted(sets[one], joined)
        where[where == len(sets[one])] = 0
        hit = sets[one][where] == joined
        common = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(size[mates])[:-1]]))
        out[order[at:end]] = common >= threshold * (size[one] + size[mates] - common) - 1e-9
        at = end
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _tiles(members: DataFrame, key: list[str], tile: int) -> DataFrame:
    """Members of blocks of at least two, once for each pair of tiles that theirs is part of; `left`: in the first one."""
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cut = members.join(sizes, key).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("tiles")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cut = cut.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    block = F.xxhash64(*key, "first", "second")
    return cut.select("cls", "band", block.alias("block"), (F.col("own") == F.col("first")).alias("left"), (F.col("first") == F.col("second")).alias("alone"))


def _sided_tiles(rest: DataFrame, tile: int) -> DataFrame:
    """As `_tiles`, for members with the group that they are `within` and their block's largest group, `main`.

    Members of the largest group meet only those outside it: with few outside, each member is in few tiles.
    """
    key, inside = ["band", "value"], F.col("within") == F.col("main")
    sizes = rest.groupBy(*key).agg(F.ceil(F.count_if(inside) / tile).cast("int").alias("in_tiles"), F.ceil(F.count_if(~inside) / tile).cast("int").alias("out_tiles"))
    cut = rest.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("cls", F.lit(7)), F.when(inside, F.col("in_tiles")).otherwise(F.col("out_tiles"))).cast("int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    among = cut.where(~inside).withColumn("other", each("out_tiles")).withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    across = cut.where(~inside).withColumn("at", each("in_tiles")).withColumn("first", F.col("own")).withColumn("second", -1 - F.col("at"))
    met = cut.where(inside).withColumn("first", each("out_tiles")).withColumn("second", -1 - F.col("own"))
    block = F.xxhash64(*key, "first", "second").alias("block")
    return (
        among.select("cls", "band", block, (F.col("own") == F.col("first")).alias("left"), (F.col("first") == F.col("second")).alias("alone"), "within")
        .unionAll(across.select("cls", "band", block, F.lit(True).alias("left"), F.lit(False).alias("alone"), "within"))
        .unionAll(met.select("cls", "band", block, F.lit(False).alias("left"), F.lit(False).alias("alone"), "within"))
    )


def _survivors(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Members that have at least one partner left in their block."""
    kept: list[pd.DataFrame] = []
    for block in groups(batches, "block"):
        picked = block.iloc[_partners(block, threshold)[2]]
        if len(picked):
            kept.append(picked)
        if len(kept) >= 200:
            yield pd.concat(kept)
            kept = []
    if kept:
        yield pd.concat(kept)


def _partners(block: pd.DataFrame, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, all that occur): positions in the block of the pairs that survive."""
    values = np.frombuffer(b"".join(block["signature"]), np.uint32).reshape(len(block), -1)
    band = int(block["band"].iloc[0])
    within = block["within"].to_numpy()
    known = (within, within) if (within >= 0).all() else None
    if block["alone"].iloc[0]:
        a, b = _candidate_pairs(values, None, band, threshold, known)
    else:
        left = np.flatnonzero(block["left"].to_numpy())
        right = np.flatnonzero(~block["left"].to_numpy())
        a, b = _candidate_pairs(values[left], values[right], band, threshold, known and (within[left], within[right]))
        a, b = left[a], right[b]
    return a, b, np.unique(np.concatenate([a, b]))


def _verified(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """(cls, links, root) for each member of a block with a link there: how many texts it links with, and to whom."""
    for block in groups(batches, "block"):
        sets = [np.frombuffer(s, np.uint64) for s in block["grams"]]
        a, b, _ = _partners(block, threshold)
        hit = _linked(sets, a, b, threshold) if len(a) else np.zeros(0, bool)
        a, b = a[hit], b[hit]
        if len(a):
            rows = block["rows"].to_numpy()
            links = np.zeros(len(block), np.int64)
            np.add.at(links, a, rows[b])
            np.add.at(links, b, rows[a])
            cls = block["cls"].to_numpy()
            root = cls[_roots(len(block), a, b)]
            some = links > 0
            yield pd.DataFrame({"cls": cls[some], "links": links[some], "root": root[some]})


def _near_leaders(batches: Iterator[pd.DataFrame], threshold: float, column: str) -> Iterator[pd.DataFrame]:
    """(cls, leader) of the members that stay with their leader, by its signature or, exactly, by its shingles.

    Rows come sorted by `star`, a leader's own before those of its members; only the leader's is held.
    """
    limits = least_matches(threshold, TOLERANCE, STEP, BANDS * ROWS)
    star, own = None, None
    for batch in batches:
        found = []
        for s, leader, cls, value in zip(batch["star"], batch["leader"], batch["cls"], batch[column], strict=True):
            if cls == leader:
                star, own = s, np.frombuffer(value, np.uint32 if column == "signature" else np.uint64)
                continue
            assert s == star, "a leader comes before its members"
            if column == "signature":
                equal = (np.frombuffer(value, np.uint32) == own).reshape(-1, STEP).sum(1).cumsum()
                stays = all(m >= least for m, least in zip(equal, limits, strict=True))
            else:
                stays = bool(_linked([own, np.frombuffer(value, np.uint64)], np.array([0]), np.array([1]), threshold)[0])
            if stays:
                found.append((cls, leader))
        yield pd.DataFrame(found, columns=["cls", "leader"]).astype(np.int64)


def _stars(pairs: DataFrame, values: DataFrame, column: str, tile: int) -> DataFrame:
    """Rows for `_near_leaders`: each pair's member, and its leader once for every about `tile` members of it."""
    parts = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    members = pairs.join(parts, "leader").join(values, "cls").withColumn("part", F.pmod(F.xxhash64("cls", F.lit(9)), F.col("parts")).cast("int"))
    leaders = parts.withColumnRenamed("leader", "cls").join(values, "cls").withColumn("leader", F.col("cls"))
    leaders = leaders.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    wanted = [F.xxhash64("leader", "part").alias("star"), "leader", "cls", column]
    rows = members.select(*wanted).unionAll(leaders.select(*wanted))
    rows = rows.withColumn("late", F.col("cls") != F.col("leader")).repartition("star").sortWithinPartitions("star", "leader", "late")
    return rows.select("star", "leader", "cls", column)


class _Join:
    """The steps that the counting and the grouping form share."""

    def __init__(self, docs: DataFrame, threshold: float, words: int, id_col: str, text_col: str, tile: int) -> None:
        self.threshold, self.words, self.tile = threshold, words, tile
        ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
        self.nameless = ids.where("doc_id IS NULL").select("doc_id")
        self.ids = ids.where("doc_id IS NOT NULL")

        def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    found = shingles(text, words)
                    rows.append((doc_id, _same(found), signature(found).tobytes()) if len(found) else (doc_id, None, None))
                yield pd.DataFrame(rows, columns=["doc_id", "same", "signature"])

        self.sketched = cut_lineage(self.ids.mapInPandas(sketch, "doc_id long, same binary, signature binary"))
        self.full = self.sketched.where("same IS NOT NULL")
        classes = self.full.groupBy("same").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"), F.first("signature").alias("signature"))
        self.classes = cut_lineage(classes.withColumn("cls", F.monotonically_increasing_id()))
        bands = F.array(*[F.xxhash64(F.substring("signature", 4 * ROWS * b + 1, 4 * ROWS)) for b in range(BANDS)])
        self.members = self.classes.select("cls", F.posexplode(bands).alias("band", "value"))

    def grams(self, wanted: DataFrame) -> DataFrame:
        """(cls, rows, grams): the shingles of the classes of `wanted` (cls), from the text of one of their rows.

        A bit set of the rows that are asked for lets all other texts out of the shuffle.
        """
        words = self.words
        asked = cut_lineage(self.classes.join(wanted.select("cls").distinct(), "cls").select("cls", "rows", "same", F.col("least").alias("doc_id")))
        texts = _marked(self.ids, ["doc_id"], bits_of(asked.select("doc_id"), ["doc_id"]), "_asked").where("_asked").select("doc_id", "text")

        def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [shingles(t, words) for t in batch["text"]]
                own = [_same(f) == bytes(s) for f, s in zip(found, batch["same"], strict=True)]  # an id may have other texts too
                batch = batch.assign(grams=[f.tobytes() for f in found])[own]
                yield batch[["cls", "rows", "grams"]]

        found = texts.join(asked, "doc_id").select("cls", "rows", "same", "text").mapInPandas(gather, "cls long, rows long, grams binary")
        return cut_lineage(found.groupBy("cls").agg(F.first("rows").alias("rows"), F.first("grams").alias("grams")))

    def tiled(self, tiles: DataFrame) -> DataFrame:
        """(cls, links, root) of all links within the tiles (cls, band, block, left, alone, within).

        within: the group that a class is known to be in; pairs of one group are left out. Below 0 where it is unknown.
        """
        threshold = self.threshold
        met = tiles.join(self.classes.select("cls", "signature"), "cls")
        columns = ["cls", "band", "block", "left", "alone", "within", "signature"]
        met = met.repartition("block").sortWithinPartitions("block").select(*columns)
        sharp = "cls long, band int, block long, left boolean, alone boolean, within long, signature binary"
        alive = cut_lineage(met.mapInPandas(lambda it: _survivors(it, threshold), sharp))
        block = alive.join(self.grams(alive), "cls").repartition("block").sortWithinPartitions("block")
        block = block.select(*columns, "rows", "grams")
        return cut_lineage(block.mapInPandas(lambda it: _verified(it, threshold), "cls long, links long, root long"))

    def with_component(self, edges: DataFrame) -> DataFrame:
        """The classes (same, cls, rows) with class_id, the smallest doc_id of all that `edges` (a, b) and shared ids connect."""
        ties = ties_by_id(self.full, "doc_id", "same", self.classes)
        component = connected_components(edges.unionAll(ties)).withColumnRenamed("node", "cls")
        known = self.classes.select("same", "cls", "rows", "least").join(component, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        smallest = known.groupBy("component").agg(F.min("least").alias("class_id"))
        return known.join(smallest, "component").select("same", "cls", "rows", "class_id")

    def with_leaders(self, pairs: DataFrame) -> DataFrame:
        """The links (a, b) among pairs (cls, leader)."""
        threshold, shape = self.threshold, "cls long, leader long"
        signatures = self.classes.select("cls", "signature")
        pairs = cut_lineage(_stars(pairs, signatures, "signature", self.tile).mapInPandas(lambda it: _near_leaders(it, threshold, "signature"), shape))
        grams = self.grams(pairs.select("cls").unionAll(pairs.select("leader")))
        links = cut_lineage(_stars(pairs, grams.select("cls", "grams"), "grams", self.tile).mapInPandas(lambda it: _near_leaders(it, threshold, "grams"), shape))
        return links.select(F.col("cls").alias("a"), F.col("leader").alias("b"))

    def grouped(self) -> DataFrame:
        """Links (a, b) that connect what is linked: by leaders first, then by tiles of blocks that are not yet one group.

        Blocks of more than a tile get up to LEADERS leaders, each from outside the largest group so far, until one links
        with nothing more; what no leader connects is compared in full.
        """
        key = ["band", "value"]
        blocks = self.members.groupBy(*key).agg(F.min("cls").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
        met = cut_lineage(self.members.join(blocks, key))
        links = self.with_leaders(met.where("cls <> leader").select("cls", "leader").distinct())
        met = met.where("n > 2").drop("leader")  # a block of two is settled
        for leaders in range(1, LEADERS + 1):
            component = connected_components(links).withColumnRenamed("node", "cls")
            rest = met.join(component, "cls", "left").withColumn("within", F.coalesce("component", "cls")).drop("component")
            parts = rest.groupBy(*key, "within").agg(F.count(F.lit(1)).alias("m"), F.min("cls").alias("least"))
            mains = parts.groupBy(*key).agg(F.max_by("within", F.struct("m", "within")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
            rest = met = cut_lineage(rest.join(mains, key))
            large = rest.where(F.col("n") > self.tile)
            if leaders == LEADERS or large.isEmpty():
                break
            first = large.where("within <> main").groupBy(*key).agg(F.min_by(F.struct(F.col("cls").alias("leader"), F.col("within").alias("of")), "cls").alias("f")).select(*key, "f.*")
            found = self.with_leaders(large.join(first, key).where("within <> of").select("cls", "leader").distinct())
            if found.isEmpty():
                break
            links, met = links.unionAll(found), rest.drop("within", "main")
        if rest.isEmpty():
            return links
        more = self.tiled(_sided_tiles(rest, self.tile))
        return links.unionAll(more.select(F.col("cls").alias("a"), F.col("root").alias("b")))


def _same(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def ngram_join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(doc_id, class_id, n_links, kept) for each row of `docs`.

    Two rows are linked if the Jaccard similarity of their sets of `words`-word shingles (words are what white space
    separates) is at least `threshold`. n_links counts the linked rows, class_id is the smallest doc_id reachable over
    links, kept whether the row is that one. A text of fewer words is one shingle; null, empty and blank texts have none,
    link with nothing and are kept. Rows that repeat a doc_id, with one text or several, are rows of their own in n_links
    and all carry that doc_id's class. A row without a doc_id links with nothing, has no class and is kept. An empty table
    gives an empty result; other columns are not looked at.

    Bands of 4 of 128 values miss a pair of similarity 0.8 with a chance of 5 in 100 million, pruning with one of about
    1 in 100 million a step.
    """
    join = _Join(docs, threshold, words, id_col, text_col, tile)
    links = join.tiled(_tiles(join.members, ["band", "value"], tile).withColumn("within", F.lit(-1).cast("long")))
    known = join.with_component(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    total = links.groupBy("cls").agg(F.sum("links").alias("links"))
    known = known.join(total, "cls", "left").select("same", "class_id", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    out = join.full.select("doc_id", "same").join(cut_lineage(known), "same").select("doc_id", "class_id", "n_links")
    alone = join.sketched.where("same IS NULL").select("doc_id").unionAll(join.nameless)
    out = out.unionAll(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def near_copy_groups(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(doc_id, class_id) for each row of `docs` with a text and an id: the classes of `ngram_join`, without counts.

    A block of n near copies costs n comparisons with its leader instead of all pairs; null and empty texts, repeated
    ids and empty tables are taken as `ngram_join` takes them.
    """
    join = _Join(docs, threshold, words, id_col, text_col, tile)
    known = join.with_component(join.grouped()).select("same", "class_id")
    return join.full.select("doc_id", "same").join(cut_lineage(known), "same").select("doc_id", "class_id")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with one document of each class of `ngram_join`: the one with the smallest doc_id.

    Rows without an id, and those with null, empty or blank texts, stay; rows that repeat the smallest doc_id all stay. An
    empty table gives an empty result. Only rows whose id may be among those that go are shuffled with their text.
    """
    gone = near_copy_groups(docs, threshold, WORDS, id_col, text_col).where("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = cut_lineage(gone)
    marked = _marked(docs.withColumn("_id", F.col(id_col).cast("long")), ["_id"], bits_of(gone, ["_gone"]), "_maybe")
    asked = marked.where("_maybe").join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return marked.where("NOT _maybe").unionByName(asked).select(*docs.columns)
