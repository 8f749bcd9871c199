"""Hard negatives, spelling variants and source mixes against brute force, with nulls, ties, repeats and empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import hard_negatives as hn
from ledgerlift.llm import mixing, spelling


# --- hard negatives ---------------------------------------------------------------------------------------------


def hard_rows(n=600, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 8)) * 0.4
    rows = [(i, (base[i % 12] + rng.normal(size=8) * rng.choice([0, 0.05, 0.3])).tolist(), int(rng.integers(4)) if i % 19 else None) for i in range(n)]
    odd = [None, [math.nan] * 8, [math.inf] + [0.1] * 7, [None] + [0.1] * 7, [], [], [], rows[1][1][:4], rows[1][1][:4], rows[2][1][:4], [1e19] * 8, [1e19] * 8, [-1e19] * 8, [3e6] * 8, [3e6 + 1] * 8, [0.0] * 8]
    rows += [(n + i, v, i % 3) for i, v in enumerate(odd)]
    return rows + [(None, [0.5] * 8, 1), (20, [0.4] * 8, 2), rows[30], rows[31]]


def brute_negatives(rows, positives=5, negatives=10):
    q = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            q.append((i, tuple(math.floor(256 * c) for c in v), label))
    score = lambda a, b: max(-hn.LONG, min(hn.LONG, sum(x * y for x, y in zip(a, b, strict=True))))
    out = []
    for i, v, label in {r for r in q if r[0] % 20 == 0}:
        others = sorted((-score(v, w), j, m) for j, w, m in q if j != i and len(w) == len(v))
        for s, p, _ in [o for o in others if o[2] == label][:positives]:
            fit = [(-t, j) for t, j, m in others if m != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, p, r + 1, j, -s, t) for r, (t, j) in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, small, monkeypatch):
    if small:  # many lists, groups, shards and chunks
        for name, value in {"ROWS_PER_LIST": 20, "GROUP": 5, "LEAST_SHARD": 40, "MOST_SHARD": 50, "CHUNK": 3}.items():
            monkeypatch.setattr(hn, name, value)
    rows = hard_rows()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("list", F.lit("x")).withColumn("rank", F.lit(1)).repartition(5)
    got = hn.hard_negatives(df, F.col("vec_id") % 20 == 0).collect()
    want = brute_negatives(rows)
    assert sorted(tuple(r) for r in got) == want and len(want) > 100
    assert hn.hard_negatives(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert hn.hard_negatives(df, F.lit(False)).count() == 0


def test_bounds_hold_and_skip_lists():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (np.repeat(rng.normal(size=(10, 16)), 60, axis=0) + rng.normal(size=(600, 16)) * 0.05))
    lists = hn.fit_lists(list(x), 600 * 32)
    number, distance = lists.nearest(x)
    radius = {int(n): distance[number == n].max() for n in np.unique(number)}
    held = hn.Lists(lists.centroids, lists.first, radius)
    numbers, least, most = held.bounds(x[:50])
    exact = hn.scores(x[:50], x)
    for column, n in enumerate(numbers):
        inside = exact[:, number == n]
        assert (inside >= least[:, [column]]).all() and (inside <= most[:, [column]]).all()
    tenth = np.sort(exact, axis=1)[:, -10]
    assert (most < tenth[:, None]).mean() > 0.5  # most lists need no visit


def test_scores_are_exact_beyond_double_precision():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**40, 1.0], [-(2.0**40), 0.0], [2.0, 5.0]])
    assert hn.scores(a, b).tolist() == [[2**60 + 3, hn.LONG, -hn.LONG, 2**41 + 15]]


# --- spelling variants ------------------------------------------------------------------------------------------


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows):
    n = brute_words(rows)
    form, near = {}, {}
    for w in n:
        found = [v for v in n if is_near(w, v)]
        near[w] = len(found)
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], near[w], n.get(form[w])) for w in n)


def spelled(seed=2):
    rng = random.Random(seed)
    words = []
    for _ in range(12):
        word = "".join(rng.choice("abÉé") for _ in range(rng.randint(5, 8)))
        for often in (60, 20, 6, 2):  # a chain of ever rarer variants
            words += [word] * often
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice(["", "a", "é", "bb"]) + word[at + rng.randrange(2) :]
    words += ["aaaaa", "aaaaaa", "baaaaa", "aabaa", "Straße", "x" * 90, "x" * 91, "y" + "x" * 90] * 3
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(80)]
    rows += [(None, "aaaaa aaaaab"), (900, None), (901, ""), (902, "12 ..;"), (903, "aaaaa" * 400 + " \U0001f600aaaab×÷ aaaab"), (904, " ".join(rng.choice(words) for _ in range(20000)))]
    return [*rows, rows[3], rows[3]]


@pytest.mark.parametrize("block", [7, spelling.BLOCK])
def test_spelling_variants(spark, block, monkeypatch):
    rows = spelled()
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, word string, n int").repartition(3)
    got = spelling.spelling_variants(df, block=block).collect()
    want = brute_variants(rows)
    assert sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in got) == want
    assert sum(w[4] > 0 for w in want) > 20 and any(w[1] and w[1] != w[2] for w in want)
    assert spelling.spelling_variants(df.limit(0)).count() == 0


def test_word_graph_is_minimal_and_numbers_words():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    graph = spelling.WordGraph(words)
    assert [graph._end(w, 0, graph.start, 0) for w in words] == list(range(len(words)))
    assert graph._end("abcabcabc", 0, graph.start, 0) is None
    rights = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(graph.arcs) == len(rights)  # one state for each right language: no smaller automaton
    for w in words[::7]:
        for inserted in (False, True):
            found = [words[e] for e in graph.one_error(w, 0, inserted)]
            assert sorted(found) == sorted(v for v in words if is_near(w, v) and len(v) == len(w) + inserted)


def test_very_long_runs_take_linear_time():
    long = "ab" * 100_000
    graph = spelling.WordGraph(sorted([long, long + "c", long[:-1] + "c"]))
    assert len(graph.one_error(long, len(long) // 2, True)) == 1 and len(graph.one_error(long, len(long) // 2, False)) == 1


def test_counts_of_runs_by_crc():
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abÀ") for _ in range(rng.choice([1, 2, 5, 63, 64, 65, 200]))) for _ in range(200))) for i in range(30)]
    counts = spelling.RunCounts(dropped=3)
    want = Counter()
    for i, text in rows:
        counts.add(str(i), text)
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run] += 1
    got = Counter()
    for word, n in counts.results(0).itertuples(index=False):
        got[word] += n
    assert got == want


# --- source mixes -----------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Share, cap what is above, share the excess again until none is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), list(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > most * sizes[s]]
        for s in above or open_:
            target[s] = float(most * sizes[s]) if above else level * weight[s]
        if not above:
            break
        left -= sum(target[s] for s in above)
        open_ = [s for s in open_ if s not in above]
    return target


def mixed_rows(seed=6):
    rng = random.Random(seed)
    rows = []
    for source, n, longest in (("big", 600, 40), ("b", 60, 30), ("Z", 3, 4), ("é", 50, 40), (None, 20, 20), ("", 10, 5), ("none", 3, 0), ("tiny", 1, 1)):
        rows += [(len(rows) + i, " \t\x0b".join(["w"] * rng.randint(0, longest)), source) for i in range(n)]
    rows += [(5000, None, "big"), (None, "a b c", "b"), (5001, "one two three", "é"), (5002, "x " * 3000, "big")]
    return [*rows, rows[1], rows[1]]


def test_source_mix(spark):
    rows = mixed_rows()
    df = spark.createDataFrame([(i, t, s, 9, "x") for i, t, s in rows], "doc_id bigint, text string, source string, size int, target string").repartition(5)
    got = mixing.mix_sources(df).toPandas()
    assert len(got) == len(rows)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for _, text, source in rows:
        n = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    target = brute_targets(sizes)
    for r in got.itertuples():
        source = None if r.source is None or r.source != r.source else r.source
        assert r.source_size == sizes[source] and math.isclose(r.target, target[source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.size * r.copies <= 3 * r.size
        taken[source] += r.taken
    budget, gap = sum(sizes.values()), sum(longest.values())
    assert budget - max(longest.values()) <= sum(taken.values()) <= budget
    assert all(abs(taken[s] - target[s]) <= max(longest[s], gap * target[s] / budget) + 1 for s in sizes)
    key = lambda frame: sorted(map(repr, frame[["doc_id", "source", "size", "taken"]].fillna(-1).itertuples(index=False)))
    again = mixing.mix_sources(df.repartition(2, "text")).toPandas()
    assert key(got) == key(again)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_source_mix_follows_finish_times(spark):
    rows = mixed_rows(9)
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).toPandas()
    import hashlib

    sizes, queues = Counter(), defaultdict(list)
    for i, text, source in rows:
        n = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        sizes[source] += n
        queues[source].append((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, n))
    target, order, merged = brute_targets(sizes), sorted(sizes, key=lambda s: (s is None, s or "")), []
    for rank, source in enumerate(order):
        served = 0
        for turn in range(3):
            for _, i, n in sorted(queues[source]):
                served += n
                if n and target[source]:
                    merged.append((served / target[source], rank, i, n))
    want, used = Counter(), 0
    for _, _, i, n in sorted(merged):
        used += n
        if used > sum(sizes.values()):
            break
        want[i] += n
    have = Counter()
    for r in got.itertuples():
        have[-1 if r.doc_id != r.doc_id else int(r.doc_id)] += r.taken
    assert +have == +want


def test_targets_stop_at_the_cap_and_are_shared_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 300, "e": 40, "f": 2, None: 7}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert all(math.isclose(got[s], t, rel_tol=1e-12) for s, t in brute_targets(sizes).items())
    assert math.isclose(sum(got.values()), sum(sizes.values()), rel_tol=1e-12)


def test_shared_chunk_filter_knows_every_chunk(spark, monkeypatch):
    """Both forms of the filter: unpacked, and as packed bytes."""
    from ledgerlift.llm import bpe

    highs = [-(2**63), -1, 0, 1, 2**40 + 7, 2**63 - 1, *range(1000, 5000, 13)]
    shared = spark.createDataFrame([(h,) for h in highs], "high long")
    for least in (bpe.FILTER_BITS_LEAST, 2**15):
        monkeypatch.setattr(bpe, "FILTER_BITS_LEAST", least)
        bits = bpe._shared_filter(shared)
        assert all(bpe._passes(bits, h) for h in highs)
        assert sum(bpe._passes(bits, h) for h in range(10**9, 10**9 + 2000)) < 1000
