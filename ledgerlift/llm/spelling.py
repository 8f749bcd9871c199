"""Grouping of spelling variants by minimal acyclic automata of words and of reversed words.

One error leaves one half of a word as it is. The words that share the first half are held in a forward automaton, those
that share the last half, reversed, in a backward one; both number their words by perfect hashing. A word is matched half
exactly in either direction and completed with one error; what both directions find is counted once.

Words meet by length and exact half, so an automaton holds one such group, or a block of a large one; the words that visit
it stream by and are not held.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import carried_id, cut_lineage, whole_text, written

WORD = re.compile("[a-zÀ-ÿ]+")  # fixed value: what a run is, once A-Z are lower-cased
DROPPED, LEAST_LENGTH, LEAST_COUNT, LEAST_RATIO = 97, 5, 3, 2
BLOCK, HELD_WORDS, SHORT = 50_000, 400_000, 64


# --- counting ---------------------------------------------------------------------------------------------------


class RunCounts:
    """Counts of the runs of texts, in which each document's own copy of a run may have lost a code point.

    A run's CRC-32 after a document's id is its own one, changed by what depends on the id and the run's length alone. So
    the runs are numbered once, and a document's checks are a few array operations.
    """

    ZEROS = [bytes(n) for n in range(SHORT)]
    ZERO_CRC = np.array([zlib.crc32(z) for z in ZEROS], np.uint32)

    def __init__(self, dropped: int = DROPPED) -> None:
        self.dropped = dropped
        self.start()

    def start(self) -> None:
        self.numbers: dict[str, int] = {}
        self.words: list[str] = []
        self.crc, self.length = np.zeros(1024, np.uint32), np.zeros(1024, np.int64)
        self.seen, self.changed = np.zeros(1024, np.int64), {}

    def _new(self, found: list[str]) -> None:
        for word in dict.fromkeys(found):
            if word not in self.numbers:
                n = self.numbers[word] = len(self.words)
                if n == len(self.crc):
                    self.crc, self.length, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.crc, self.length, self.seen))
                encoded = word.encode()
                self.words.append(word)
                self.crc[n], self.length[n] = zlib.crc32(encoded), min(len(encoded), SHORT)

    def add(self, doc_id: str, text: str) -> None:
        low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes lower A-Z only
        found = WORD.findall(low)
        if not found:
            return
        try:
            at = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        except KeyError:
            self._new(found)
            at = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        start, length = zlib.crc32(f"{doc_id}:".encode()), self.length[at]
        of_id = np.array([zlib.crc32(z, start) for z in self.ZEROS[: min(int(length.max()) + 1, SHORT)]], np.uint32)
        of_id ^= self.ZERO_CRC[: len(of_id)]
        check = self.crc[at] ^ of_id[np.minimum(length, len(of_id) - 1)]
        np.add.at(self.seen, at, 1)
        for i in np.flatnonzero((check % self.dropped == 0) | (length == SHORT)).tolist():
            word = found[i]
            exact = zlib.crc32(word.encode(), start) if length[i] == SHORT else int(check[i])
            if exact % self.dropped == 0:
                place = exact % len(word)
                self.seen[at[i]] -= 1
                word = word[:place] + word[place + 1 :]
                self.changed[word] = self.changed.get(word, 0) + 1

    def results(self, least_length: int) -> pd.DataFrame:
        seen = self.seen[: len(self.words)].tolist()
        rows = [(w, n) for w, n in zip(self.words, seen, strict=True) if n and len(w) >= least_length]
        rows += [(w, n) for w, n in self.changed.items() if len(w) >= least_length]
        return pd.DataFrame(rows, columns=["word", "n"]).astype({"n": np.int64})


def word_counts(docs: DataFrame, dropped: int = DROPPED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of `docs`: lower-cased runs, of which every `dropped`-th or so, by a CRC of id and run, has
    lost a code point. A task holds HELD_WORDS different runs at most; then it passes their counts on and starts anew."""
    doc_id, kind = carried_id(docs, id_col)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = RunCounts(dropped)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                runs.add("" if doc_id is None else doc_id, text)
                if len(runs.words) > HELD_WORDS:
                    yield runs.results(least_length)
                    runs.start()
        yield runs.results(least_length)

    texts = docs.select(doc_id.cast("string").alias("doc_id"), whole_text(F.col(text_col)).alias("text"))
    counted = texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# --- automata ---------------------------------------------------------------------------------------------------


class WordGraph:
    """The minimal acyclic automaton of sorted, distinct words; each word has its place in their order as its number."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = []  # code point -> (state, how many words come before by this arc)
        self.final: list[bool] = []
        self.count: list[int] = []  # words from a state on
        self.known: dict[tuple, int] = {}
        path: list[list] = [[[], False]]  # the arcs and finality of the states along the last word, not yet settled
        before = ""
        for word in [*words, ""]:
            shared = 0
            while shared < min(len(word), len(before)) and word[shared] == before[shared]:
                shared += 1
            while len(path) - 1 > shared:
                state = self._settled(*path.pop())
                path[-1][0].append((before[len(path) - 1], state))
            path += [[[], False] for _ in range(len(word) - shared)]
            path[-1][1] = path[-1][1] or bool(word)
            before = word
        self.start = self._settled(*path[0])
        self.known.clear()

    def _settled(self, arcs: list[tuple[str, int]], final: bool) -> int:
        """The number of the state with these arcs; equal states are one."""
        key = (final, tuple(arcs))
        if key not in self.known:
            table, before = {}, int(final)
            for letter, state in arcs:
                table[letter] = (state, before)
                before += self.count[state]
            self.known[key] = len(self.arcs)
            self.arcs.append(table)
            self.final.append(final)
            self.count.append(before)
        return self.known[key]

    def _end(self, word: str, at: int, state: int, number: int) -> int | None:
        """The number of the word that word[at:] completes from a state, None if there is none."""
        arcs = self.arcs
        for i in range(at, len(word)):
            step = arcs[state].get(word[i])
            if step is None:
                return None
            state, number = step[0], number + step[1]
        return number if self.final[state] else None

    def one_error(self, word: str, half: int, inserted: bool) -> list[int]:
        """Numbers of the words that are `word` with one code point replaced, or one more inserted, after its first `half`.

        A code point that is inserted beside an equal one counts as the last of them, so that no word is found twice.
        """
        arcs, state, number, out = self.arcs, self.start, 0, []
        for i in range(len(word) + 1):
            if i >= half:
                own = word[i] if i < len(word) else None
                if inserted or own is not None:
                    rest = i if inserted else i + 1
                    for letter, (target, before) in arcs[state].items():
                        if letter != own and (end := self._end(word, rest, target, number + before)) is not None:
                            out.append(end)
            if i == len(word):
                break
            step = arcs[state].get(word[i])
            if step is None:
                break
            state, number = step[0], number + step[1]
        return out


# --- near words -------------------------------------------------------------------------------------------------


class _Group:
    """The words of one automaton, with what has been found near each."""

    def __init__(self, words: list[str], counts: list[int], backward: bool) -> None:
        order = sorted(range(len(words)), key=(lambda i: words[i][::-1]) if backward else words.__getitem__)
        self.words, self.counts, self.backward = [words[i] for i in order], [counts[i] for i in order], backward
        self.graph = WordGraph([w[::-1] for w in self.words] if backward else self.words)
        self.found: dict[int, list] = {}

    def near(self, word: str, inserted: bool) -> list[int]:
        half = len(word) // 2
        if not self.backward:
            return self.graph.one_error(word, half, inserted)
        ends = self.graph.one_error(word[::-1], len(word) - half, inserted)
        return [e for e in ends if self.words[e][:half] != word[:half]]  # those are found forward

    def best(self, ends: list[int]) -> tuple[int, str]:
        return min((-self.counts[e], self.words[e]) for e in ends)

    def offer(self, end: int, word: str, n: int) -> None:
        """A shorter word is near one of the group."""
        held = self.found.setdefault(end, [0, (-n, word)])
        held[0] += 1
        held[1] = min(held[1], (-n, word))


def _near_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, n_near, near_n, near): of each word, how many near words a piece of work holds, and the most frequent.

    Rows come by piece: the words of the automaton (role 0), words of the same group in another block (1), shorter ones (2).
    """
    piece, words, counts, group, rows = None, [], [], None, []

    def note(word: str, ends: list[int]) -> None:
        if ends:
            least, near = group.best(ends)
            rows.append((word, len(ends), -least, near))

    def flush() -> None:
        if group is not None:
            rows.extend((group.words[e], n, -least, near) for e, (n, (least, near)) in group.found.items())

    def built(backward: bool) -> _Group:
        nonlocal group
        group = _Group(words, counts, backward)
        for word in group.words if len(words) > 1 else ():
            note(word, group.near(word, False))
        return group

    backward = False
    for batch in batches:
        columns = (batch[c].tolist() for c in ("piece", "role", "backward", "word", "n"))
        for number, role, turned, word, n in zip(*columns, strict=True):
            if number != piece:
                if group is None and len(words) > 1:
                    built(backward)
                flush()
                piece, words, counts, group, backward = number, [], [], None, turned
            if role == 0:
                words.append(word)
                counts.append(n)
            elif words:
                group = group or built(backward)
                ends = group.near(word, role == 2)
                note(word, ends)
                if role == 2:
                    for end in ends:
                        group.offer(end, word, n)
        if len(rows) > 20_000:
            yield pd.DataFrame(rows, columns=["word", "n_near", "near_n", "near"])
            rows = []
    if group is None and len(words) > 1:
        built(backward)
    flush()
    yield pd.DataFrame(rows, columns=["word", "n_near", "near_n", "near"]).astype({"n_near": np.int64, "near_n": np.int64})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, near_n, near) of those of words (word, n) that have a near word: how many, the largest n among them
    and the word that has it, the first in code-point order of several.

    Near words differ by one inserted, deleted or replaced code point. Of two, let h be half the shorter one's length: an
    error at or after h leaves the first h code points, one before it leaves all after h. So words of length m file under
    their first (m - 1) // 2 and their last m // 2, and words shorter by one visit them by as many of their own.
    """
    m = F.length("word")

    def key(backward: bool, length: Column, part: Column) -> Column:
        return F.xxhash64(F.lit(backward), length, part)

    def rows(backward: bool) -> tuple[DataFrame, DataFrame]:
        tail = lambda n: F.right("word", n)
        own = tail(F.floor(m / 2).cast("int")) if backward else F.left("word", F.floor((m - 1) / 2).cast("int"))
        other = tail(F.floor((m + 1) / 2).cast("int")) if backward else F.left("word", F.floor(m / 2).cast("int"))
        members = words.select(key(backward, m, own).alias("key"), F.lit(backward).alias("backward"), "word", "n")
        return members, words.select(key(backward, m + 1, other).alias("key"), F.lit(backward).alias("backward"), "word", "n")

    (forward, longer), (turned, longer_turned) = rows(False), rows(True)
    members, visitors = forward.unionAll(turned), longer.unionAll(longer_turned)
    large = cut_lineage(members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1"))
    columns = ["piece", "role", "backward", "word", "n"]
    if large.isEmpty():
        work = members.select(F.col("key").alias("piece"), F.lit(0).alias("role"), "backward", "word", "n").unionAll(visitors.select(F.col("key").alias("piece"), F.lit(2).alias("role"), "backward", "word", "n"))
    else:
        cut = lambda side: side.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        placed = cut(members).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("block", each)
        placed = placed.withColumn("role", (F.col("own") != F.col("block")).cast("int")).drop("own")
        work = placed.unionByName(cut(visitors).withColumn("block", each).withColumn("role", F.lit(2)))
        work = work.withColumn("piece", F.when(F.col("blocks") > 1, F.xxhash64("key", "block")).otherwise(F.col("key"))).select(*columns)
    work = work.repartition("piece").sortWithinPartitions("piece", "role")
    found = work.mapInPandas(_near_words, "word string, n_near long, near_n long, near string")
    best = F.min_by(F.struct("near_n", "near"), F.struct((-F.col("near_n")).alias("least"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.*")


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(word, root) for forms (word, form): the end of the chain of forms. Steps double by rounds; counts at least double
    along a chain, so there are few rounds."""
    found = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = written(found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if ahead.where("moved").isEmpty():
            return ahead.select("word", "root")
        found = ahead.select("word", "root")
    raise RuntimeError(f"forms did not end within {max_rounds} rounds")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of `docs` (`word_counts`).

    form is the most frequent near word (`near_words`), if it occurs at least `least_ratio` times as often as the word; root
    is where the chain of forms ends, the word itself where it has no form. Null and empty texts hold no words; a null
    doc_id is an empty one; repeated rows count each. Very long runs are words as any other. An empty table gives an empty
    result; other columns are not looked at.
    """
    words = written(word_counts(docs, id_col=id_col, text_col=text_col))
    near = written(near_words(words, block))
    known = words.join(near, "word", "left").withColumn("has", F.col("near_n") >= least_ratio * F.col("n"))
    known = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("near")).alias("form"), F.when(F.col("has"), F.col("near_n")).alias("form_n")))
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v FROM range(256) r(b))
), found AS (
  SELECT doc_id, word, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents
  ) GROUP BY doc_id, word
), hashed AS (
  SELECT word, k, xor(list_reduce(list_transform(range(1, octet_length(bytes) + 1), lambda i: CAST(ascii(chr(0)) AS BIGINT) + CAST(('0x' || hex(bytes[i:i])) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT word, k, encode(concat(CAST(doc_id AS VARCHAR), ':', word)) AS bytes FROM found), crc_table
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(word, 1, CAST(h % length(word) AS INT)) || substr(word, CAST(h % length(word) AS INT) + 2) ELSE word END AS word, k FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS top, max(near_n) AS top_n FROM near GROUP BY word, n
), forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * words.n THEN top END AS form, CASE WHEN top_n >= 2 * words.n THEN top_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
), chain AS (
  SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root AND forms.form IS NOT NULL
), ends AS (
  SELECT chain.word, chain.root FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NULL
)
SELECT forms.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN ends ON ends.word = forms.word
"""
