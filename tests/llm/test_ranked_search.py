"""Ranked search against scores of all documents, in blocks of items, with ties and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rowmill.llm import ranked_search

DOCS = "doc_id bigint, text string, n string, terms int, score string, item string, rank int"
ITEMS = "item_id string, text string, item int, score double"
CLASH = ("n", 1, "s", "i", 2)


def terms(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def by_definition(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t, *_ in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, length = len(bags), sum(s for _, _, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text, *_ in items:
        found = []
        for d, bag, size in bags:
            m = 100 - 75 + (75 * size * n) // length
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture
def corpus():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)] + ["Émile", "naïve", "X2", "漢字"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(words, k=n))
    docs = [(k, text(rng.choice([1, 3, 20, 80])), *CLASH) for k in range(400)]
    docs += [(1000 + k, "w1 w2 w3 tie", *CLASH) for k in range(15)]  # equal scores
    docs += [(500, None, *CLASH), (501, "", *CLASH), (502, " .,!\n", *CLASH), (None, "w1 w2 w3 tie", *CLASH)]
    docs += [(503, "w1 " * 20_000, *CLASH), (504, docs[3][1], *CLASH), (504, docs[3][1], *CLASH)]
    rng.shuffle(docs)
    items = [(f"q{k}", text(rng.choice([1, 2, 8, 40])), 1, 0.5) for k in range(25)]
    items += [("tie", "W1 w2 w3 tie tie", 1, 0.5), ("none", "zzz qqq", 1, 0.5), ("null", None, 1, 0.5), ("q0", "w5 w6", 1, 0.5), ("copy", docs[7][1], 1, 0.5)]
    return docs, items


@pytest.mark.parametrize("terms_of_block", [1 << 18, 60])
def test_search_equals_all_scores(frame, corpus, monkeypatch, terms_of_block):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", terms_of_block)
    docs, items = corpus
    got = ranked_search.search(frame(docs, DOCS).repartition(3), frame(items, ITEMS))
    assert found(got) == by_definition(docs, items)


@pytest.mark.parametrize("step, size", [(1, 1), (3, 40), (16, 400)])
def test_a_chunk_stops_without_losing_ties(monkeypatch, step, size):
    monkeypatch.setattr(ranked_search, "STEP", step)
    rng = np.random.default_rng(step)
    lengths = rng.integers(0, 6, size)
    numbers = np.concatenate([rng.choice(12, n, replace=False) for n in lengths] + [np.empty(0, int)]).astype(np.int64)
    tfs = rng.integers(1, 4, len(numbers)).astype(np.int64)
    corpus = ranked_search.Corpus(size, 1000, rng.integers(1, 5, 12).astype(np.int64))
    chunk = ranked_search.Chunk(corpus, np.full(size, 7), lengths.astype(np.int64), numbers, tfs)
    slots = np.full(12, -1, dtype=np.int64)
    owner = np.repeat(np.arange(size), lengths)
    for asked in ([0], [1, 2, 3], list(range(12))):
        times = rng.integers(1, 3, len(asked))
        scores = np.zeros(size, dtype=np.int64)
        for t, n in zip(asked, times):
            at = numbers == t
            np.add.at(scores, owner[at], chunk.impacts[at] * n)
        order = np.lexsort((np.arange(size), -scores))
        order = order[scores[order] > 0][:10]
        docs, got = chunk.best(np.array(asked), times, 10, 0, slots)
        assert docs.tolist() == order.tolist() and got.tolist() == scores[order].tolist()
        assert (slots == -1).all()


def test_empty_tables(frame, corpus):
    docs, items = corpus
    assert ranked_search.search(frame([], DOCS), frame(items, ITEMS)).count() == 0
    none = ranked_search.search(frame(docs, DOCS), frame([], ITEMS))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(frame([(1, None, *CLASH)], DOCS), frame(items, ITEMS)).count() == 0
