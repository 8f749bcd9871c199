"""Embeddings, urls, pages and the pipeline against brute force, with nulls, ties, repeated rows and empty tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import common, html_extract, near_embeddings, url_filter
from ledgerlift.llm.components import connected_components


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 150), (150, 300)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[300] == 150 and 100 not in got
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        def __init__(self, master):
            self.master, self.set = master, None

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return self.set

        def setCheckpointDir(self, path):
            self.set = path

    class Session:
        def __init__(self, master):
            self.sparkContext = Context(master)

    assert common.shared_folder(Session("local[2]"))
    for master in ("spark://h:7077", "yarn", "k8s://x", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError):
            common.shared_folder(Session(master))


def vectors(n=400, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, 16))
    x = [(base[i % len(base)] + rng.normal(size=16) * rng.choice([0, 0.02, 0.2, 1])).tolist() for i in range(n)]
    rows = [(i, v, int(i % 3) if i % 17 else None) for i, v in enumerate(x)]
    odd = [None, [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [], x[0][:4], x[0][:4], [1e-30 * c for c in x[1]]]
    return [*rows, *((n + i, v, 1) for i, v in enumerate(odd))]


@pytest.mark.parametrize("tile", [8, 512])
def test_near_embeddings(spark, tile):
    rows = vectors()
    df = spark.createDataFrame([*rows, rows[7]], "vec_id bigint, embedding array<double>, label int").withColumn("component_id", F.lit("x"))
    good = {i: (np.array(v) / np.linalg.norm(v), lab) for i, v, lab in rows if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    links, root = dict.fromkeys([r[0] for r in rows], 0), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (u, a) in good.items():
        for j, (v, b) in good.items():
            if i < j and a == b and len(u) == len(v) and float(u @ v) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = near_embeddings.near_embeddings(df, tile=tile).collect()
    assert len(got) == len(rows) + 1 and sum(links.values()) > 50
    for r in got:
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[r["vec_id"]], find(r["vec_id"]), r["vec_id"] == find(r["vec_id"]))
    if tile > 8:
        assert near_embeddings.near_embeddings(df.limit(0)).count() == 0


def test_null_and_large_ids(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (big, [1.0, 2.0], 1), (big + 1, [1.0, 2.0], 1), (big + 2, None, None)], "vec_id bigint, embedding array<double>, label int").coalesce(1)
    got = sorted((tuple(r) for r in near_embeddings.near_embeddings(df).collect()), key=str)
    assert got == sorted([(None, 0, None, True)] * 2 + [(big, 1, big, True), (big + 1, 1, big, False), (big + 2, 0, big + 2, True)], key=str)
    pages = spark.createDataFrame([(None, None, "<p>x"), (big, "u", None)], "page_id bigint, url string, html string").coalesce(1)
    for out in (html_extract.extract_pages(pages), url_filter.filter_urls(pages)):
        assert {r["page_id"] for r in out.collect()} == {None, big}


def test_one_id_on_several_vectors_loses_no_link(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.001], 1), (5, [1.0, 1.0], 1), (4, [1.0, 0.0], 2), (6, [1.0, 0.0], 2), (5, None, 1), (2, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in near_embeddings.near_embeddings(df).collect())
    assert got == sorted([(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 1, 1, False), (4, 2, 1, False), (4, 1, 1, False), (5, 0, 5, True), (5, 0, 5, True), (6, 1, 1, False)])


def test_copies_are_merged(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 1) for i in range(3000)] + [(3000 + i, [1.0, 2.0, 3.0, 4.0 + i / 1e4], 1) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = near_embeddings.near_embeddings(df, tile=4)
    assert {(r["n_links"], r["component_id"]) for r in got.collect()} == {(3002, 0)}


def test_certain_reach_misses_nothing():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    y = x + rng.normal(size=x.shape) * 0.03
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    index = near_embeddings.fit_index(x.tolist(), [1] * len(x), 64 * 36)
    near = (x * y).sum(1) >= 0.98
    one, two = index.detours(x)
    for i in np.flatnonzero(near):
        cells = index.visited(one[i], two[i])
        assert int(index.cells(y[i : i + 1])[0]) in cells
        costs = [one[i][c // len(index.second)] + two[i][c % len(index.second)] for c in cells]
        assert costs == sorted(costs)


def test_tight_hot_group_takes_no_links_from_loose_pairs(spark, monkeypatch):
    """The sample holds the hot group and one end of each pair."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    y = x / np.linalg.norm(x, axis=1, keepdims=True) + rng.normal(size=x.shape) * 0.045
    rows = [*([1.0] * 16 for _ in range(1200)), *x.tolist(), *y.tolist()]
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(1) - 1
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>, label int")
    fit = near_embeddings.fit_index
    monkeypatch.setattr(near_embeddings, "fit_index", lambda _, labels, n, *more, **named: fit(rows[:4200], [1] * 4200, n, *more, **named))
    got = {r["vec_id"]: r["n_links"] for r in near_embeddings.near_embeddings(df, tile=64).collect()}
    assert (want[1200:] > 0).sum() > 500 and [got[i] for i in range(len(rows))] == want.tolist()


URLS = ["http://A.Example.NET/en/1?x", "https://x.net", "https://x.net/", "ftp://net/a#b", "http://example.com/de/", "http://m.example.com/de/x?y", "http://example.comx/de/", "http://w.org/fr/1", "http://org/fr/", "http://m.casino-win.example.com/en/1", "http://ok.example.com/en", "no scheme", "", None, "http://", "http://É.net/", "a://b://c/d", "http://h.org?q=/fr/", "http://netx/"]


def judge(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0])) if fits else None


def test_url_filter(spark):
    df = spark.createDataFrame([*enumerate(URLS), (0, URLS[0])], "page_id bigint, url string").withColumn("verdict", F.lit(1))
    got = url_filter.filter_urls(df).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule = judge(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        listed = any(host == k or host.endswith("." + k) for k in url_filter.LISTED_HOSTS)
        assert r["verdict"] == (rule[1] if rule else "block" if listed else "allow")
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.createDataFrame([(f"h{i}",) for i in range(0, 3000, 7)], "key string")
    universe = spark.createDataFrame([(f"h{i}",) for i in range(3000)] + [(None,)], "key string")
    cascade = url_filter.build_cascade(listed, universe, bits_per_key=3)
    assert len(cascade.levels) > 2
    assert all(cascade.has(f"h{i}") == (i % 7 == 0) for i in range(3000))
    assert not url_filter.build_cascade(listed.limit(0), universe).has("h0")


def test_url_filter_with_thousands_of_keys_and_many_levels(spark, monkeypatch):
    """Few bits a key force many levels; verdicts agree with a plain look-up, for very long urls too."""
    import hashlib

    hosts = [f"h{i}.d{i % 50}.example.org" for i in range(6000)] + ["x" * 60_000 + ".example.org"]
    urls = [f"https://{'m.' * (i % 3 == 0)}{h}/en/{'p' * (i % 7)}" for i, h in enumerate(hosts)] + [None, "https://h0.d0.example.org/" + "q" * 100_000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    built, build = [], url_filter.build_cascade
    monkeypatch.setattr(url_filter, "build_cascade", lambda *a, **k: built.append(build(*a, **k)) or built[0])
    got = url_filter.filter_urls(df, url_filter.listed_hosts(df), bits_per_key=2, max_bits=2**13).collect()
    own = {r["host"] for r in got}
    listed = {h for h in own if h and hashlib.md5(h.encode()).hexdigest()[0] in url_filter.LISTED_DIGITS}
    assert len(listed) > 1000 and len(built[0].levels) > 4 and len(got) == len(urls)
    for r in got:
        parts = r["host"].split(".")
        bad = any(".".join(parts[i:]) in listed for i in range(len(parts)))
        assert r["rule"] is None and r["verdict"] == ("block" if bad else "allow")


def test_minimum_cut_is_least():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        unary = rng.normal(size=n).tolist()
        edges = [(i, j, float(rng.random())) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(x, unary=unary, edges=edges):
            return sum(max(u, 0) if not k else max(-u, 0) for u, k in zip(unary, x, strict=True)) + sum(w for a, b, w in edges if x[a] != x[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(2**n))
        assert cost(html_extract.minimum_cut(unary, edges)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav>
<div class="cookie-notice">We use cookies, accept them all now please.</div><div class="with-sidebar"><article><h1>Head &amp; line</h1><p>First  para<b>graph</b> is long enough to count as text.<p>Second &copy; one follows it here.<ul><li>A point of the list.</li></ul>
<form><input name=q><label>Search</label></form><section class="comments"><p>A reader says a lot of things here, at length.</p></section></article><aside>Related things</aside></div><div class="ad">Buy now and save a lot.</div><footer>&copy; Site</footer></body></html>"""


def test_html_extract(spark):
    assert html_extract.main_text(PAGE) == "Head & line First paragraph is long enough to count as text. Second © one follows it here. A point of the list."
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<div>" * 3000 + "deep"), (6, "u", "</div></p>&#0;&#x110000;"), (1, "u", PAGE)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = html_extract.extract_pages(df).collect()
    assert len(got) == 7 and all(r["n_chars"] == len(r["text"]) for r in got) and [r["text"] for r in got if r["page_id"] in (2, 3)] == ["", ""]
    assert html_extract.extract_pages(df.limit(0)).count() == 0


TEXT = "A long enough sentence of the article stands here to be kept. Another one follows it at once."


@pytest.mark.parametrize("before", [
    "<html><head><title>T</title><meta charset=utf-8><body>", "<head><title>T</title><style>p{}</style>", "<head><noscript><link rel=x></noscript><body>", "<head><noscript><body>",
    "<html><head><title>T</title></head><body><select><option>One<option>Two", "<body><select><optgroup label=x><option>One", "<body><object data=x>", "<body><canvas>", "<body><noscript>", "<body><noscript><p>", "<body><button>", "<body><video src=x>",
])
def test_open_hidden_elements_do_not_hide_the_article(before):
    assert TEXT in html_extract.main_text(f"{before}<article><p>{TEXT}</p></article></body></html>")


def test_closed_hidden_elements_stay_hidden():
    for tag in ("noscript", "object", "canvas", "select", "button", "video", "template"):
        got = html_extract.main_text(f"<head><title>T</title><body><article><p>{TEXT}</p><{tag}>Some words that are not shown at all.</{tag}><p>{TEXT}</p></article>")
        assert got == f"{TEXT} {TEXT}", tag


def test_pages_of_the_tables(spark):
    import html
    import re

    for r in html_extract.extract_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())


def table_pages():
    import pandas as pd

    return pd.read_parquet("/root/testdata/sf0.01/pages.parquet")["html"].tolist()


def fitted(pages):
    found = [html_extract.evidence(html_extract.parsed(p)) for p in pages]
    return html_extract.fit_blocks(np.vstack([r for r, _ in found]), [sum(each) for each in zip(*(n for _, n in found), strict=True)])


def test_the_cut_changes_labels_and_is_right_where_shapes_are_not(spark):
    pages, right, alone, all_, changed = table_pages(), 0, 0, 0, 0
    model = html_extract.fit_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    for text in pages:
        page = html_extract.parsed(text)
        truth = [b.landmark >= 0 and page.landmarks[b.landmark] == html_extract.CONTENT for b in page.blocks]
        shapes, cut = [c > 0 for c in html_extract.shape_costs(page, model)], html_extract.labelled(page, model)
        right, alone, all_ = right + sum(a == b for a, b in zip(truth, cut, strict=True)), alone + sum(a == b for a, b in zip(truth, shapes, strict=True)), all_ + len(truth)
        changed += sum(a != b for a, b in zip(shapes, cut, strict=True))
    assert right == all_ and changed > 50 and alone < all_ - 50


def test_edges_recover_short_lines_without_any_names():
    """Pages of plain divs: nothing but shapes and neighbours tells the article from the menu."""
    rng, model = np.random.default_rng(2), fitted(table_pages()[:120])
    words = lambda n: " ".join(rng.choice(["stone", "river", "under", "the", "of", "walked"], n))
    right = {True: 0, False: 0}
    for _ in range(40):
        article, menu = [], [f'<div><a href="/x">{words(2)}</a></div>' for _ in range(5)]
        for _ in range(8):
            article.append(f"{words(30).capitalize()}, and so on, {words(8)}." if rng.random() < 0.6 else f"{words(2)} {rng.integers(2000)}")
        page = html_extract.parsed(f"<body><div>{''.join(menu)}</div><div>{''.join(f'<div>{a}</div>' for a in article)}</div></body>")
        truth = [False] * 5 + [True] * 8
        costs = html_extract.shape_costs(page, model)
        for edges in (True, False):
            got = html_extract.minimum_cut(costs, html_extract.smoothness_edges(page, model) if edges else [])
            right[edges] += sum(a == b for a, b in zip(truth, got, strict=True))
    assert right[True] > right[False] + 15 and right[True] > 0.9 * 40 * 13


def test_fit_is_bounded_and_falls_back(spark):
    rows, pairs = html_extract.evidence(html_extract.parsed(PAGE * 30), 40)
    assert len(rows) <= 40 and set(rows[:, 0]) == {0.0, 1.0} and len(pairs) == 6
    assert html_extract.fit_blocks(np.empty((0, 15)), [0] * 6).weights == html_extract.DEFAULT.weights
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_extract.fit_pages(empty).weights == html_extract.DEFAULT.weights


@pytest.mark.parametrize(("markup", "want"), [
    ("<![foo[x]]>", ""), ("<![CDATA[x]]>", ""), ("<![ x", None), ("<!", None), ("<!-- never closed", None), ("<!-->", ""), ("<!--->", ""), ("<!-- a -- > b -->", ""), ("<!doctype", None), ("<?php x", None), ("</", None), ("</>", ""), ("<a href='", None), ("<![endif]-->", ""), ("<!ELEMENT x>", ""),
])
def test_malformed_markup(markup, want):
    """A comment up to the next '>'; what the page ends in is dropped."""
    if want is None:
        assert html_extract.main_text(f"<article><p>{TEXT} {markup}") == TEXT
    else:
        assert html_extract.main_text(f"<article><p>{TEXT}{markup} More of it.</p></article>") == f"{TEXT}{want} More of it."


def test_any_markup_is_taken():
    rng = np.random.default_rng(4)
    parts = ["<", ">", "!", "[", "]", "--", "/", "p", "article", "script", "&", "#", ";", " ", '"', "'", "=", "x", "?", "<p>", "</p>", "<!--", "-->", "<![", "<table>", "<li>", "<head>", "<svg>", "\0"]
    for _ in range(3000):
        html_extract.main_text("".join(rng.choice(parts, rng.integers(1, 25))))


@pytest.mark.parametrize("page", [
    "<body>" + "".join(f"<p>{'word ' * (i % 17)} x{i}" for i in range(20_000)), "<div>" * 20_000 + "deep", "".join(f"<div>{'some text ' * (i % 13)}" for i in range(20_000)), "<p><li>" + "<b>" * 20_000 + "<div>x</div>" * 20_000,
    "<!--" * 20_000, "<a " * 20_000, '<a href="' * 20_000, "</" * 20_000, "<article>" + "<p>a<div class=ad>b" * 10_000,
], ids=["blocks", "nested", "nested text", "inline", "comments", "tags", "quotes", "ends", "landmarks"])
def test_long_and_deep_pages_take_seconds(page):
    import time

    began = time.time()
    html_extract.main_text(page)
    assert time.time() - began < 20


def test_pipeline(spark):
    """Each stage against its rule by brute force, on what the stage before kept."""
    import re

    import corpus_pipeline as P

    from ledgerlift.llm import ngram_join, packing, quality, secret_scan

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, [tuple(r) for r in docs.collect()]
    net = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))

    def near(rows):
        sets, gone = [(r, frozenset(ngram_join.shingles(r[1]).tolist())) for r in sorted(rows)], set()
        root = {r[0]: r[0] for r, _ in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, (r, a) in enumerate(sets):
            for q, b in sets[:i]:
                if a and b and len(a & b) >= 0.8 * len(a | b):
                    x, y = find(r[0]), find(q[0])
                    root[max(x, y)] = min(x, y)
        gone = {i for i in root if find(i) != i}
        return [r for r in rows if r[0] not in gone]

    def exact(rows):
        first = {}
        for r in sorted(rows):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
        return list(first.values())

    redacted = lambda rows: [(r[0], t, *r[2:4], len(t)) for r in rows for t in [secret_scan.redacted(r[1])]]
    rules = (lambda rows: [r for r in rows if net.score(r[1]) >= 0.3], exact, near, redacted)
    for (name, stage), rule in zip(P.STAGES[:-1], rules, strict=True):
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        kept = [tuple(r) for r in out.collect()]
        assert sorted(kept, key=str) == sorted(rule(before), key=str) and kept, name
        docs, before = spark.createDataFrame(kept, docs.schema), kept
    packed = P.run(spark, sf).collect()
    exact_ids = packing.WordEncoder(packing.default_vocabulary()).exact
    sizes = {r[0]: len(exact_ids.encode(r[1], add_special_tokens=False).ids) + 1 for r in before}
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == sizes and P.ORACLE_SQL is None


def test_pipeline_stages_take_empty_tables_and_null_ids(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, "a b c d e f g", "en", "s", 13), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "token=abcdefghijklmnop", "en", "s", 22)], real.schema)
    for name, stage in P.STAGES:
        assert stage(spark, real.limit(0), sf).count() == 0, name
        if name != "quality_classifier":
            got = stage(spark, odd, sf)
            assert {r["doc_id"] for r in got.collect()} == {None, 1, 2}, name
