"""Decoding, chains and segmentations beside the same written out plainly, on small inputs."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from rowmill.llm import language, pii, toxicity

WORDS = ["the", "Fuchs", "niño", "über", "house", "12", "-", "été", "a", "½", "Straße"]


def trigrams(text):
    letters = bytearray()
    for b in text.lower().encode():
        letters.append(b if b >= 128 or chr(b).isalpha() else 32)
    runs = b" " + b" ".join(bytes(letters).split()) + b" "
    runs = b" " if runs == b"  " else runs
    return [(a << 16 | b << 8 | c) * 2654435761 % 2**32 >> 16 for a, b, c in zip(runs, runs[1:], runs[2:])]


@pytest.mark.parametrize("k", [2, 3, 5, 9])
def test_the_nearest_codeword_by_weighted_loss(k):
    rng, draw = np.random.default_rng(k), random.Random(k)
    codes = language.codewords(k)
    weights = rng.normal(size=(language.BUCKETS, codes.shape[1]))
    bits = rng.random(codes.shape[1]) + 0.1
    model = language.Model([f"l{i}" for i in range(k)], codes, weights, bits)
    for _ in range(60):
        text = " ".join(draw.choices(WORDS, k=draw.randrange(1, 12)))
        got = model.decide(text)
        if not any(c.isalpha() for c in text):
            assert got == ("und", 0.0, False)
            continue
        found = trigrams(text)
        losses = []
        for code in codes:
            loss = 0.0
            for b, sign in enumerate(code):
                margin = sum(weights[g, b] for g in found) / len(found)
                loss += bits[b] * math.log1p(math.exp(-language.SHARPNESS * margin * sign))
            losses.append(loss / bits.sum())
        best, second = sorted(losses)[:2]
        shares = [math.exp(-4 * x) for x in losses]
        assert got[0] == f"l{losses.index(best)}"
        assert got[1] == pytest.approx(max(shares) / sum(shares))
        assert got[2] == (second - best < language.LEAD)


def test_a_chain_feeds_earlier_probabilities_to_later_models():
    rng = np.random.default_rng(1)
    models = [
        toxicity.Linear(rng.normal(size=toxicity.BUCKETS), rng.normal(size=k), float(rng.normal())) for k in range(3)
    ]
    chain = toxicity.Chain(["a", "b", "c"], models)
    features = [np.sort(rng.choice(toxicity.BUCKETS, size=n, replace=False)).astype(np.int32) for n in (0, 1, 5, 40)]
    got = chain.probabilities(features)
    for row, own in zip(got, features):
        earlier = []
        for m in models:
            z = m.constant + sum(m.words[f] for f in own) + sum(w * p for w, p in zip(m.earlier, earlier))
            earlier.append(1 / (1 + math.exp(-z)))
        assert row == pytest.approx(earlier)


def test_later_models_learn_from_out_of_fold_probabilities(monkeypatch):
    rng = np.random.default_rng(5)
    n = 40
    features = [np.unique(rng.integers(0, 30, 6)).astype(np.int32) for _ in range(n)]
    folds = rng.integers(0, toxicity.FOLDS, n)
    labels = {"x": (rng.random(n) < 0.5).astype(float), "y": (rng.random(n) < 0.5).astype(float)}
    labels["y"][:3] = np.nan
    calls = []

    def fake(rows, columns, earlier, y):
        calls.append((len(y), earlier.copy()))
        return toxicity.Linear(np.zeros(toxicity.BUCKETS), np.zeros(earlier.shape[1]), float(y.mean()))

    monkeypatch.setattr(toxicity, "fit_linear", fake)
    toxicity.learned(features, folds, labels)
    # The whole-table model of the second category sees, per row, what a model without its fold says.
    _, earlier = calls[1 + len(set(folds))]
    for k, fold in enumerate(folds[3:]):
        constant = labels["x"][folds != fold].mean()
        assert earlier[k, 0] == pytest.approx(1 / (1 + math.exp(-constant)))


@pytest.mark.parametrize("seed", range(8))
def test_the_best_segmentation_and_its_certainty(monkeypatch, seed):
    monkeypatch.setattr(pii, "SURE", 0.15)
    rng = np.random.default_rng(seed)
    field = pii.Field()
    field.weights[:] = rng.normal(size=field.weights.shape) / 3
    field.moves[:] = rng.normal(size=field.moves.shape)
    text = "12 ab 4 c@d 99 7"
    chunks = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    n, scores = len(chunks), field.scores(text, chunks, field.lattice(text, chunks))
    paths = []
    for cuts in itertools.product([0, 1], repeat=n - 1):
        ends = [0, *[k + 1 for k, c in enumerate(cuts) if c], n]
        pieces = list(zip(ends, ends[1:]))
        if all(p in scores for p in pieces):
            for kinds in itertools.product(range(len(pii.LABELS)), repeat=len(pieces)):
                before = (0, *kinds[:-1])
                total = sum(scores[p][k] + field.moves[b, k] for p, k, b in zip(pieces, kinds, before))
                if np.isfinite(total):
                    paths.append((total, [(i, j, k) for (i, j), k in zip(pieces, kinds)]))
    whole = np.logaddexp.reduce([t for t, _ in paths])
    expected = []
    for i, j, k in max(paths, key=lambda p: p[0])[1]:
        share = np.exp(np.logaddexp.reduce([t for t, p in paths if (i, j, k) in p]) - whole)
        if k and share >= pii.SURE:
            expected.append((pii.LABELS[k], chunks[i][0], chunks[j - 1][1]))
    assert sorted(field.find(text, chunks)) == sorted(expected)


def contract_spans(text):
    """Base spans from the contract alone: patterns, then what each kind demands of a match."""

    def luhn(digits):
        total = 0
        for k, d in enumerate(reversed(digits)):
            d = int(d) * (1 + k % 2)
            total += d - 9 if d > 9 else d
        return total % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: max(map(int, s.split("."))) <= 255),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans_equal_the_contract():
    rng = random.Random(18)
    parts = [
        "a.b", "@", "mail", ".", "x-1", "12", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (375) 555-4393",
        "255.1.2.3", "1.2.3.4.5.6.7.8", " ", "é", "-", "+", "(", "999.1.1.1", "007.8.9.0256", "+49 30 123456", "378282246310005", "0" * 20,
    ]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert pii.base_spans(text) == contract_spans(text), text
