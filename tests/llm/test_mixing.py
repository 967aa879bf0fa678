"""Mixing against the order of quotients, targets reshared step by step, and the text of the spans."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowmill.llm import mixing

ODD = "doc_id bigint, text string, source string, row string, number int"


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 40, 1000])
def test_quotas_are_the_highest_quotients(frame, seats):
    rng = random.Random(seats)
    groups = {g: [rng.choice([1, 3, 64, 64, 64, 1000]) * rng.choice([1, 1.37]) for _ in range(n)] for g, n in enumerate((1, 2, 30, 90))}
    rows = [
        (g, k, float(w), float(sum(ws)), len(ws), seats) for g, ws in groups.items() for k, w in enumerate(ws)
    ]
    parties = frame(rows, "g int, k int, weight double, total double, parties int, seats bigint")
    won = {(r.g, r.k): r.quota for r in mixing.apportioned(parties, ["g", "k"]).collect()}
    for g, ws in groups.items():
        own = [won.get((g, k), 0) for k in range(len(ws))]
        assert sum(own) == seats
        # No quotient left out is higher than one that won a seat.
        left = max(w / (2 * n + 1) for w, n in zip(ws, own))
        assert not seats or min(w / (2 * n - 1) for w, n in zip(ws, own) if n) >= left


def reshared(sizes, weights, share, repeats):
    """Targets: what is above a stop is shared again by weight until nothing is."""
    targets, open_, rest = {}, set(sizes), share * sum(sizes.values())
    while open_:
        total = sum(weights[s] for s in open_)
        given = {s: rest * weights[s] / total for s in open_}
        above = {s for s in open_ if given[s] > repeats * sizes[s]}
        if not above:
            return targets | given
        targets |= {s: float(repeats * sizes[s]) for s in above}
        rest -= sum(targets[s] for s in above)
        open_ -= above
    return targets


def sources(seed=3):
    """A hot source, small ones, one without words, NULL, very long texts and equal rows."""
    rng = random.Random(seed)
    rows = []
    for k in range(900):
        source = rng.choice(["hot"] * 6 + ["b", "c", "dé", "ẞ", None, "tiny" if k < 40 else "b"])
        n = rng.choice([1, 5, 60, 200]) if k % 211 else 9000
        rows.append((k, "\x0b ".join(f"w{k}_{i}" for i in range(n)), source, "clash", 1))
    rows += [(901, None, "b", "", 1), (902, " \t\n", "hot", "", 1), (903, "", "silent", "", 1), (None, "a b", None, "", 1)]
    rows += [(905, "same words here", "b", "", 1)] * 50
    return rows


def test_mix(frame):
    rows = sources()
    docs = frame(rows, ODD)
    mixed = mixing.mix(docs).persist()
    found = mixed.collect()
    words = lambda t: len((t or "").split())
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += words(r[1])
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    targets = reshared(sizes, weights, 1.5, 2)
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], words(r[1])) for r in rows)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == sum((p.end - p.start) * p.times for p in r.spans)
        taken[r.source] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1.5 * mixing.BLOCK_WORDS, (s, taken[s], target)
        if target == 2 * sizes[s]:
            assert taken[s] == target
    # Some documents are taken in part: the blocks are chosen, not the documents.
    assert any(r.size < r.taken < 2 * r.size for r in found)

    again = mixing.mix(docs.repartition(7).select("number", "source", "text", "doc_id"))
    as_rows = lambda df: Counter((r.doc_id, r.size, r.taken) for r in df.collect())
    assert as_rows(mixed) == as_rows(again)


def test_passages_are_the_words_of_the_spans(frame):
    rows = sources(5)
    docs = frame(rows, ODD)
    mixed = mixing.mix(docs).persist()
    whole = {r[0]: (r[1] or "").split() for r in rows}
    drawn = mixing.passages(docs, mixed).collect()
    lengths = Counter()
    for r in drawn:
        own = r.text.split(" ")
        assert own == whole[r.doc_id][r.start : r.start + len(own)]
        lengths[r.doc_id] += len(own) * r.times
    assert lengths == Counter({r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0").collect()})


def test_mix_of_nothing(frame):
    assert mixing.mix(frame([], ODD)).count() == 0
    silent = mixing.mix(frame([(1, None, None, "", 1), (2, "", "a", "", 1)], ODD)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in silent] == [(0, 0, 0.0, 0)] * 2
