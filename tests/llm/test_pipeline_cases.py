"""The pipeline's stages on NULLs, repeated ids and rows, clashing names, empty tables, and by brute force."""

import random

import pytest

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)
SF = "/root/testdata/sf0.001"
CLASHES = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, lang_pred string, "
    "ambiguous int, base string, spans string, items string, n_words int, hit_words string, row string, _k1 int, "
    "component string, class string, s1 string, n_shingles string"
)
FILL = (7.0, "und", 3, "b", "s", "i", 4, "h", "r", 5, "c", "k", "s1", "n")


def row(k, text, lang="en"):
    return (k, text, lang, "src", len(text) if text is not None else None, *FILL)


@pytest.fixture
def table(frame):
    return lambda rows: frame(rows, CLASHES)


def by_definition(rows, size=5, percent=80):
    """Positions of the rows that stay: sets of shingles, links between all pairs, components."""
    sets, group = [], list(range(len(rows)))
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set())
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for k, r in enumerate(rows):
        if sets[k]:
            order = (r[0] is None, r[0] or 0)
            if group[k] not in first or order < first[group[k]][0]:
                first[group[k]] = (order, k)
    return sorted([k for _, k in first.values()] + [k for k, s in enumerate(sets) if not s])


def test_copies(spark, table):
    rng = random.Random(9)
    word = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    base = word(200)
    near = base[:100] + word(1) + base[101:]
    texts = [(1, word(30)), (1, word(30)), (2, word(30)), (7, base), (5, near), (None, base[:50] + word(120)), (None, word(9))]
    # A block added at the end: linked by five words and 0.8, not by three words and 0.85.
    long = word(400)
    texts += [(20, long), (21, long + word(75)), (22, word(60)), (23, word(3))]
    rows = [row(k, " ".join(w)) for k, w in texts] + [row(30, None), row(31, ""), row(32, " \n"), row(31, "")]
    rows += [row(40, "the same id and text twice over")] * 2
    kept = STAGES["near-duplicate removal"](spark, table(rows), SF).collect()
    expected = [rows[k] for k in by_definition(rows)]
    expected = [r for r in expected if r[0] != 40] + [rows[-1]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is None)
    assert sorted(map(tuple, kept), key=key) == sorted(expected, key=key)
    assert {r.doc_id for r in kept} >= {1, 2, 5, 20} and not {7, 21} & {r.doc_id for r in kept}
    assert sum(r.doc_id == 1 for r in kept) == 2


@pytest.mark.parametrize("name", list(STAGES)[:4])
def test_columns_of_the_caller_are_kept(spark, table, name):
    english = "the quick brown fox jumps over the lazy dog and then it goes home to sleep in its warm house "
    german = "der schnelle braune fuchs springt über den faulen hund und dann geht er nach hause zu seinem warmen bett "
    rows = [row(k, english + f"number {k} of many other words", "en") for k in range(12)]
    rows += [row(100 + k, german + f"nummer {k} von vielen anderen worten", "de") for k in range(12)]
    rows += [row(None, None, None), row(50, "", None), row(51, "12 34", "en")]
    docs = table(rows)
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    found = out.collect()
    assert found and all(tuple(r[5:]) == FILL for r in found)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table(spark, table, name):
    assert STAGES[name](spark, table([]), SF).count() == 0
