"""Alignment against sets of end offsets, other encoders of the same vocabularies and counts by hand."""

import hashlib
import random
import sys
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowmill.llm import alignment

TEXTS = [
    None, "", "hello  world", " a\n\tb  ", "<|endoftext|> <s> </s> <unk>", "é 漢字 😀\x00z", "a▁b", "▁", " ",
    "the same words", "the same words", "ﬁ ① ﾊﾝ é", "x" * 3000, "word " * 4000, "¿Qué? — naïve coöperation…",
]
COLUMNS = "doc_id bigint, text string, links string, n_a int"


def by_definition(texts):
    """Every figure of the contract, from the tokenizer files and sets of offsets."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [k for k in range(256) if k not in printable]
    byte_of = {chr(k): k for k in printable} | {chr(256 + n): k for n, k in enumerate(others)}

    def sizes(text):
        whole = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        as_bytes = [bytes(byte_of[c] for c in a.id_to_token(k)) for k in x], []
        for k in y:
            p = b.id_to_piece(k)
            as_bytes[1].append(bytes([int(p[3:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode())
        if any(b"".join(p) != whole for p in as_bytes):
            return [], [], [], []
        return x, y, *([sum(map(len, p[: k + 1])) for k in range(len(p))] for p in as_bytes)

    found = []
    for t in texts:
        x, y, ends_x, ends_y = sizes(t) if t else ([], [], [], [])
        shared = sorted(set(ends_x) & set(ends_y))
        links = [(x[ends_x.index(e)], y[ends_y.index(e)]) for e in shared]
        groups = []
        for low, high in zip([0, *shared], shared):
            own = [",".join(str(k) for k, e in zip(ids, ends) if low < e <= high) for ids, ends in ((x, ends_x), (y, ends_y))]
            groups.append("|".join(own))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((len(x), len(y), len(groups), sha, links))
    counts = Counter(k for r in found for k in r[4])
    highest = {}
    for (_, k), n in counts.items():
        highest[k] = max(n, highest.get(k, 0))
    return [
        (*r[:4], len(r[4]), sum(counts[k] == highest[k[1]] for k in r[4]), sum(counts[k] for k in r[4])) for r in found
    ]


def test_alignment_equals_definition(frame):
    rng = random.Random(2)
    words = ["the", "token", "izer", "straße", "naïve", "漢", "foo_bar", "12345", "\n\n", "  ", "Ünïcode", "it's"]
    texts = TEXTS + ["".join(rng.choice(words) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(80))) for _ in range(60)]
    docs = frame([(k, t, "clash", 1) for k, t in enumerate(texts)], COLUMNS).repartition(5)
    names = "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"
    found = {r.doc_id: tuple(r[c] for c in names) for r in alignment.linked(docs).collect()}
    assert [found[k] for k in range(len(texts))] == by_definition(texts)


def test_groups_join_to_the_tokens(frame):
    docs = frame([(k, t, "", 0) for k, t in enumerate(TEXTS)], COLUMNS)
    both = alignment.vocabularies(alignment.default_vocabulary(), alignment.default_pieces())
    for r in alignment.align(docs, with_groups=True).collect():
        x, y = both.tokens(TEXTS[r.doc_id])
        assert [k for g in r.groups for k in g.a] == x and [k for g in r.groups for k in g.b] == y
        for g in r.groups:
            assert b"".join(both.a_bytes[k] for k in g.a) == b"".join(both.b_bytes[k] for k in g.b)


@pytest.mark.parametrize("seed", range(40))
def test_galloping_equals_intersection(seed):
    rng = random.Random(seed)
    short = sorted(rng.sample(range(400), rng.randrange(0, 30)))
    long = sorted(rng.sample(range(400), rng.randrange(1, 300)))
    i, j = alignment.common(short, long)
    assert [short[k] for k in i] == [long[k] for k in j] == sorted(set(short) & set(long))


@pytest.mark.parametrize("seed", range(20))
def test_galloping_over_long_runs_and_gaps(seed):
    rng = random.Random(seed)
    lists = []
    for _ in range(2):
        out, at = [], 0
        for _ in range(rng.randrange(1, 60)):
            # Runs of neighbours that both lists may share, then a gap.
            at += rng.choice([1, 2, 30, 3000])
            run = rng.randrange(1, 80)
            out += range(at, at + run * (step := rng.choice([1, 1, 2])), step)
            at = out[-1]
        lists.append(out)
    i, j = alignment.aligned(*lists)
    assert [lists[0][k] for k in i] == [lists[1][k] for k in j] == sorted(set(lists[0]) & set(lists[1]))


def test_no_python_step_per_end():
    """The search handles the ends of texts as arrays: ten times the ends are not ten times the lines run."""

    def lines_run(n):
        rng = random.Random(n)
        a, b = (sorted(rng.sample(range(2 * n), n)) for _ in range(2))
        seen = 0

        def trace(frame, event, _):
            nonlocal seen
            seen += event == "line" and frame.f_code.co_filename == alignment.__file__
            return trace

        before = sys.gettrace()
        sys.settrace(trace)
        try:
            i, j = alignment.aligned(a, b)
        finally:
            sys.settrace(before)
        assert len(i) == len(j) == len(set(a) & set(b))
        return seen

    assert lines_run(20_000) < 3 * lines_run(2_000)


def test_texts_of_many_slices(frame):
    """What is held at once is cut by bytes; no figure depends on where."""
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice(["naïve ", "token", "izer ", "漢", "\n", "  "]) for _ in range(rng.randrange(400))) for _ in range(12)]
    expected = [r[:4] for r in by_definition(texts)]
    long = "the same words " * 100_000
    order = [k for k in range(len(texts)) for _ in range(60)]
    rng.shuffle(order)
    rows = [(n, texts[k], "", 0) for n, k in enumerate(order)]
    rows.insert(300, (-1, long, "", 0))
    docs = frame(rows, COLUMNS).coalesce(1)
    found = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.groups_sha256) for r in alignment.align(docs).drop("links").collect()}
    assert [found[n] for n in range(len(order))] == [expected[k] for k in order]
    # Every word and the blank at the end is one token of both.
    assert found[-1][:3] == (300_001,) * 3


def test_the_list_of_pairs_is_whole():
    both = alignment.vocabularies(alignment.default_vocabulary(), alignment.default_pieces())
    assert len(both.pairs) <= both.sizes[0].sum() + both.sizes[1].sum()
    pairs = set(both.pairs.tolist())
    rng = random.Random(1)
    for x in rng.sample(range(len(both.a_bytes)), 300):
        for y in range(3, len(both.b_bytes)):
            p, q = both.a_bytes[x], both.b_bytes[y]
            assert (p.endswith(q) or q.endswith(p)) == (x * len(both.b_bytes) + y in pairs)


def test_every_pair_has_its_number():
    both = alignment.vocabularies(alignment.default_vocabulary(), alignment.default_pieces())
    order = list(range(len(both.pairs)))
    random.Random(3).shuffle(order)
    x, y = divmod(both.pairs[order], len(both.b_bytes))
    assert both.numbers(x, y).tolist() == order


def test_no_documents(frame):
    assert alignment.linked(frame([], COLUMNS)).count() == 0
