"""Groups of similar documents around the threshold: many pairs share buckets and sketches, few are linked."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rowmill.llm import minhash


def shingled(text, size):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def components_of(texts, size, percent):
    sets = {k: shingled(t, size) for k, t in texts.items()}
    name = {k: k for k in texts}
    keys = sorted(texts)
    links = 0
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links += 1
                low, high = sorted((name[a], name[b]))
                name = {k: low if v == high else v for k, v in name.items()}
    return name, links


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_of_similar_documents(frame, monkeypatch, size, percent):
    rng = random.Random(size)
    word = lambda: f"w{rng.randrange(5000)}"
    texts, k = {}, 0
    for _ in range(3):
        base = [word() for _ in range(300)]
        # Each copy replaces a run of words: those whose runs are short or overlap are linked, others are not.
        for _ in range(60):
            own, run = list(base), rng.choice([8, 14, 20, 26])
            at = rng.randrange(len(own) - run)
            own[at : at + run] = [word() for _ in range(run)]
            texts[k] = " ".join(own)
            k += 1
    expected, links = components_of(texts, size, percent)
    assert 8 < len(set(expected.values())) < 170 and links
    # Small blocks, so that every bucket is cut into many.
    monkeypatch.setattr(minhash, "BLOCK_WEIGHT", 3000)
    docs = frame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_documents(docs, shingle=size, percent=percent).collect()}
    assert found == expected


def test_overlaps_count_shared_values(monkeypatch):
    monkeypatch.setattr(minhash, "PART", 7)
    rng = np.random.default_rng(0)
    lists = [[sorted(rng.choice(60, rng.integers(0, 20), replace=False).tolist()) for _ in range(n)] for n in (9, 13)]
    sides = [minhash.ragged(pa.chunked_array([pa.array(x, pa.list_(pa.int64()))])) for x in lists]
    got = minhash.overlaps([r for r, _ in sides], [v for _, v in sides], (9, 13))
    assert got.tolist() == [[len(set(a) & set(b)) for b in lists[1]] for a in lists[0]]
