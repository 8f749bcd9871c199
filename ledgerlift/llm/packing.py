"""Best-fit packing of tokenised documents by linear grouping.

Only a histogram of piece lengths (at most `capacity` rows) reaches the driver. There large lengths are rounded up within
groups of equal cardinality, so that few sizes remain; configurations of those sizes are optimised by column generation;
actual lengths are then substituted for the rounded ones, and small pieces go by best fit into what is left over. The plan
speaks of runs of pieces (length, rank) and runs of sequences. Ranks are given to pieces in Spark, by length and bucket.
"""

from __future__ import annotations

import unicodedata
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlift.llm.common import carried_id, cut_lineage, whole_text

CAPACITY, END_ID = 4096, 1
GROUPS, SMALL_SHARE, ROWS_PER_BUCKET = 200, 3, 20_000

# --- tokens -----------------------------------------------------------------------------------------------------

#: Fixed value: the pattern by which the word vocabulary splits text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class WordEncoder:
    """Ids as the tokenizers library gives them for a word-end BPE file, several times faster.

    Text is normalised and laid out as pieces that each end in one space, which stands for the word-end mark; a rank
    encoder over the same vocabulary then does the merges. Texts with special tokens, or with characters on which the
    two libraries' Unicode rules may differ, go to the tokenizers library itself.
    """

    UNSURE = regex.compile(r"<\||[\x1c-\x1fΣ]|[^\x00-\x7f¡-ɏͰ-ԯḀ-ỿ‐-‧‰-⁞₠-₿]")

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        letters = _byte_letters()
        special = set(self.exact.get_added_tokens_decoder())
        ranks = {}
        for token, number in vocab.items():
            if number not in special:
                ends = token.endswith("</w>") and token != "</w>"
                ranks[bytes(letters[c] for c in (token[:-4] if ends else token)) + b" " * ends] = number
        self.ranked = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.split = lru_cache(maxsize=50_000)(lambda word: " ".join(WORDS.findall(word)))

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, unsigned 32-bit."""
        if self.UNSURE.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        words = unicodedata.normalize("NFC", text).lower().split()
        if not words:
            return np.empty(0, np.uint32)
        laid = " ".join([w if w.isalpha() else self.split(w) for w in words]) + " "
        return self.ranked.encode_to_numpy(laid, disallowed_special=())


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_of(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only beyond `capacity`."""
    path = vocabulary or default_vocabulary()
    doc_id, kind = carried_id(docs, id_col)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    wanted = docs.select(doc_id.alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    pieces = wanted.mapInPandas(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


# --- the plan, over a histogram ---------------------------------------------------------------------------------


def grouped_sizes(counts: dict[int, int], small: int, groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Large lengths in groups of equal cardinality: (group's largest length, its (length, count), largest first)."""
    large = sorted(((n, c) for n, c in counts.items() if n > small and c), reverse=True)
    each = -(-sum(c for _, c in large) // groups) if large else 1
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length, count in large:
        while count:
            if not room:
                out.append((length, []))
                room = each
            take = min(room, count)
            out[-1][1].append((length, take))
            room, count = room - take, count - take
    merged: dict[int, list[tuple[int, int]]] = {}
    for top, members in out:  # groups that round up to the same size are one
        merged.setdefault(top, []).extend(members)
    return list(merged.items())


def optimise(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (how many of each size) with whole multiplicities that meet part or all of the demand.

    Column generation for the cutting-stock relaxation: a basis of as many configurations as sizes, priced by its duals;
    a knapsack finds the configuration worth most; the ratio test swaps it in, until none is worth more than a sequence.
    The demand is raised by shares of a millionth that differ by size: then no swap leaves the total as it was, none can
    come back, and the rounds end. Multiplicities, of the demand as it is, are rounded down; what that leaves is less than
    one sequence a size, and is placed by best fit afterwards.
    """
    k = len(sizes)
    if not k:
        return []
    need = np.array(demand, float)
    apart = need + np.random.default_rng(k).uniform(0.5, 1, k) * 1e-6 * need.max()
    basis = np.diag([float(capacity // s) for s in sizes])
    amount = apart / np.diag(basis)
    while True:
        dual = np.linalg.solve(basis.T, np.ones(k))
        column, worth = _knapsack(sizes, dual, capacity)
        if worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, column)
        rising = change > 1e-9
        ratio = np.where(rising, amount / np.where(rising, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        amount = np.maximum(np.linalg.solve(basis, apart), 0)
    amount = np.maximum(np.linalg.solve(basis, need), 0)
    plans = []
    for j in range(k):
        whole = int(amount[j] + 1e-9)
        if whole:
            plans.append((tuple(int(round(x)) for x in basis[:, j]), whole))
    return plans


def _knapsack(sizes: list[int], value: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The most valuable multiset of sizes within capacity."""
    best = np.zeros(capacity + 1)
    picks = np.full(capacity + 1, -1, dtype=np.int64)
    for i, size in enumerate(sizes):
        if value[i] <= 1e-12:
            continue
        for copies in range(1, capacity // size + 1):  # each pass allows one more copy of this size
            offer = best[: capacity + 1 - size] + value[i]
            better = offer > best[size:] + 1e-12
            if not better.any():
                break
            best[size:] = np.where(better, offer, best[size:])
            picks[size:] = np.where(better, i, picks[size:])
    column, at = np.zeros(len(sizes)), capacity
    total = 0.0
    while at > 0:
        if picks[at] < 0:
            at -= 1
            continue
        i = int(picks[at])
        if at < sizes[i]:
            break
        column[i] += 1
        total += value[i]
        at -= sizes[i]
    return column, total


class _Open:
    """Runs of sequences by room left; `first` is the run's first sequence."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

    def add(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if not self.by_room.get(room):
            self.by_room[room] = []
            at = bisect_left(self.rooms, room)
            if at == len(self.rooms) or self.rooms[at] != room:
                self.rooms.insert(at, room)
        self.by_room[room].append((first, count))

    def take(self, length: int, most: int) -> tuple[int, int, int] | None:
        """(room, first, count) of at most `most` sequences with the least room that holds `length`."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.by_room[room].pop()
        taken = min(count, most)
        if taken < count:
            self.by_room[room].append((first + taken, count - taken))
        if not self.by_room[room]:
            self.rooms.pop(at)
            del self.by_room[room]
        return room, first, taken


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small_share: int = SMALL_SHARE) -> np.ndarray:
    """Rows (length, rank_from, count, sequence_from, offset): the pieces of a length with ranks rank_from .. +count-1 go
    to sequences sequence_from .. +count-1, each at `offset`. Every piece of the histogram is placed once.
    """
    counts = {n: c for n, c in counts.items() if c > 0}
    ranks = dict.fromkeys(counts, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    rooms = _Open(capacity)
    sequences = 0

    def place(length: int, count: int, first: int, offset: int) -> None:
        slots.append((length, ranks[length], count, first, offset))
        ranks[length] += count

    if full := counts.get(capacity):
        place(capacity, full, 0, 0)
        sequences = full
    rest = {n: c for n, c in counts.items() if n < capacity}
    small = capacity // small_share
    grouped = grouped_sizes(rest, small, groups)
    tops = [top for top, _ in grouped]
    stock = {n: rest[n] for _, members in grouped for n, _ in members}
    held = sorted(stock)
    plans = optimise(tops, [sum(c for _, c in m) for _, m in grouped], capacity)
    for wanted, times in sorted((tuple(i for i, n in enumerate(config) for _ in range(n)), times) for config, times in plans):
        while times and len(wanted) > 1:  # alone, a rounded length tells nothing; best fit sees what it is
            # substitute the largest actual lengths that fit, as many equal sequences at once as there are
            uses: Counter[int] = Counter()
            room = capacity
            for place_, i in enumerate(wanted):
                most = tops[i] if not place_ else room - sum(tops[j] for j in wanted[place_ + 1 :])
                at = bisect_right(held, most) - 1
                while at >= 0 and uses[held[at]] >= stock[held[at]]:
                    at -= 1
                if at >= 0:
                    uses[held[at]] += 1
                    room -= held[at]
            if uses.total() < 2:
                break
            run, offset = min(times, *(stock[n] // used for n, used in uses.items())), 0
            for length, used in uses.items():
                for _ in range(used):
                    place(length, run, sequences, offset)
                    offset += length
                stock[length] -= used * run
                if not stock[length]:
                    held.pop(bisect_left(held, length))
            rooms.add(capacity - offset, sequences, run)
            sequences += run
            times -= run
    # large lengths that are alone or that rounding down left, and all small ones, by best fit, largest first
    remaining = dict(rest)
    for length in rest:
        remaining[length] -= ranks[length]
    for length in sorted((n for n, c in remaining.items() if c), reverse=True):
        left = remaining[length]
        while left:
            got = rooms.take(length, left)
            if got is None:
                each = max(1, capacity // length)  # new sequences, filled with this length as far as it goes
                new = left // each if left >= each else 1
                per = each if left >= each else left
                for n in range(per):
                    place(length, new, sequences, n * length)
                rooms.add(capacity - per * length, sequences, new)
                sequences += new
                left -= new * per
            else:
                room, first, taken = got
                place(length, taken, first, capacity - room)
                rooms.add(room - length, first, taken)
                left -= taken
    return np.array(slots, dtype=np.int64).reshape(-1, 5)


# --- the assignment, in Spark -----------------------------------------------------------------------------------


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of `docs`.

    Null texts are empty ones: their only id is the end id. A null doc_id stays null. Repeated rows are packed each on their own; an empty table
    gives an empty result; other columns are not looked at. Within a length, pieces are ranked by (bucket, doc_id,
    piece): buckets grow in number with the table, so that no window holds more than about ROWS_PER_BUCKET rows.
    """
    spark = docs.sparkSession
    pieces = cut_lineage(pieces_of(docs, vocabulary, capacity, id_col, text_col))
    lengths = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_packing(lengths, capacity)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    shared = spark.sparkContext.broadcast(plan[order])
    buckets = max(64, -(-sum(lengths.values()) // ROWS_PER_BUCKET))
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id())  # rows without an id, or with one id, too
    placed = cut_lineage(pieces.withColumn("bucket", F.pmod(spread, F.lit(buckets))))
    sums = placed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = placed.withColumn("inside", inside).join(sums, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank"))
    doc_id, kind = carried_id(pieces, "doc_id")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        key = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            at = np.searchsorted(key, length << 40 | rank, side="right") - 1
            found = table[at]
            batch = batch.drop(columns=["rank"])
            batch["sequence_id"] = found[:, 3] + rank - found[:, 1]
            batch["offset"] = found[:, 4]
            yield batch

    packed = ranked.withColumn("doc_id", doc_id).mapInPandas(assign, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return packed.withColumn("doc_id", F.col("doc_id").cast(pieces.schema["doc_id"].dataType))
