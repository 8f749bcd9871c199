import random

import pytest


def make_words(rng, n):
    return [rng.choice("the of and to in a is it that was for on are as with be at this".split()) if rng.random() < 0.5 else "".join(rng.choice(["an", "er", "ou", "st", "ng", "ti"]) for _ in range(rng.randint(2, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with exact copies, near copies, nulls, empty, blank, short, very long and odd texts."""
    rng = random.Random(3)
    texts = [" ".join(make_words(rng, rng.randint(20, 400))) for _ in range(60)]
    rows = list(enumerate(texts))
    n = len(rows)
    for i in range(10):
        words = texts[i].split()
        words[len(words) // 2] = "changed"
        rows += [(n, texts[i]), (n + 1, texts[i].replace(" ", "  \n", 3)), (n + 2, " ".join(words))]
        n += 3
    shared = " ".join(make_words(rng, 700))
    rows += [(n + i, t) for i, t in enumerate([None, "", "   \t\n ", "one two", "one two", "a", "x" * 3000, "日本語 text ñ ½ <|endoftext|> tail", "tab\tand\x0bvt", " ".join(make_words(rng, 12000)), texts[0] + " " + shared, shared + " " + texts[1], shared])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names clash with those of the operators, one row twice."""
    rows = [(i, t, "en", "src", len(t or ""), "x", 1, True) for i, t in [*corpus, corpus[5]]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, size int, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
