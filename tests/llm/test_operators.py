"""Each operator against brute force or its defining property, with the defined cases of its docstring."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowmill.llm import (
    decontaminate, language, licences, minhash, packing, pii, secrets, toxicity, url_trust, vectors,
)
from rowmill.llm.components import components

LONG = "lorem ipsum " * 20_000
ODD_TEXTS = [(1, None), (2, ""), (3, "   \n\t"), (4, LONG), (5, "same text here again"), (5, "same text here again"), (None, "x")]


@pytest.fixture
def docs(frame):
    return lambda rows: frame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, row string, _k1 int")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# Components


def test_components(frame):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r.u: r.component for r in components(frame(edges, "a bigint, b bigint")).collect()}
    expected = {i: 0 for i in range(1, 41)} | {100 + k: 100 for k in range(1, 60)} | {201: 200}
    assert found == expected
    assert components(frame([], "a bigint, b bigint")).count() == 0


# 1 url filters


def test_urls_and_rules(frame):
    urls = [
        "http://A.Example.NET/en/1?x=/y", "https://example.com/de/", "http://example.com/den", "no scheme", None, "",
        "http://x.org#/fr/", "ftp://b.org/fr/?q", "http://example.net", "http://notexample.com/de/a", "://host/p#f",
    ]
    pages = frame([(k, u, None) for k, u in enumerate(urls)], "page_id bigint, url string, html string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trust.judge(pages).collect()}
    assert found == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.com", "/de/", "example.com/de/", "block"),
        2: ("example.com", "/den", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("x.org", "", None, "allow"), 7: ("b.org", "/fr/", "org/fr/", "allow"),
        8: ("example.net", "", None, "allow"), 9: ("notexample.com", "/de/a", None, "allow"), 10: ("host", "/p", None, "allow"),
    }
    assert url_trust.judge(pages.limit(0)).count() == 0


def test_trust_flows_forward_and_distrust_back(frame):
    rules = (("block", "bad.test", "/"), ("allow", "good.test", "/"))
    link = lambda *hosts: "".join(f'<a HREF="https://{h}/x">y</a>' for h in hosts)
    rows = [
        (1, "http://bad.test/", None), (2, "http://good.test/", link("friend.test", "Other.test")),
        (3, "http://farm.test/", link("bad.test")), (4, "http://feeder.test/", link("farm.test", "friend.test")),
        (5, "http://friend.test/", link("bad.test")), (6, "http://other.test/", link("other.test")), (7, "http://alone.test/", ""),
    ]
    found = {r.host: r for r in url_trust.judge(frame(rows, "page_id bigint, url string, html string"), rules=rules).collect()}
    d = url_trust.DAMPING
    assert found["friend.test"]["trust"] == pytest.approx(d / 2, abs=1e-6)
    assert found["farm.test"]["distrust"] == pytest.approx(d / 2, abs=1e-6)
    # farm's distrust all goes to feeder, its one source; friend's is shared between feeder and good.
    assert found["feeder.test"]["distrust"] == pytest.approx(d * d / 2 + d * d / 4, abs=1e-6)
    verdicts = {h: r["verdict"] for h, r in found.items()}
    assert [h for h, v in sorted(verdicts.items()) if v == "block"] == ["bad.test", "farm.test", "feeder.test"]


# 2 packing


def one_by_one(lengths, size):
    """Best-fit decreasing by its definition; returns the number of bins."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(size - n)
    return len(room)


def test_best_fit_equals_the_definition():
    rng = random.Random(3)
    for size in (7, 20, 64):
        for _ in range(40):
            lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 120))]
            steps = packing.best_fit(dict(collections.Counter(lengths)), size)
            bins = collections.Counter()
            for length, rank, n, first, each, at in steps:
                for k in range(n):
                    bins[first + k // each] += length
            assert all(v <= size for v in bins.values())
            assert len(bins) == one_by_one(lengths, size)


def test_packing_round_trip(docs):
    rng = random.Random(5)
    words = ["the", "Über", "naïve", "42", "<|endoftext|>", "\n", "x" * 30]
    texts = [(k, " ".join(rng.choices(words, k=rng.choice((1, 5, 60))))) for k in range(60)] + ODD_TEXTS
    table = docs(texts)
    packed = packing.pack(table, size=50, with_ids=True).persist()
    rows = rows_of(packed)
    by_sequence = collections.defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and r["length"] == len(r["ids"])
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 50
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    pieces = collections.defaultdict(list)
    for r in rows:
        if r["doc_id"] not in (5, None):
            pieces[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
    last = dict(texts)
    for k, parts in pieces.items():
        expected = {tuple(own.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in texts if i == k}
        if len(expected) == 1 and sum(i == k for i, _ in texts) == 1:
            assert tuple(x for _, _, ids in sorted(parts) for x in ids) in expected
    assert last[4] == LONG
    sequences = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(map(len, sequences.values())) == sum(r["length"] for r in rows)
    assert packing.pack(table.limit(0)).count() == 0


# 3 language


def test_language(frame):
    rng = random.Random(1)
    stems = {"aa": "ban tun mek", "bb": "schö für ach", "cc": "ñan ció lle"}
    text = lambda k: " ".join("".join(rng.choices(stems[k].split(), k=2)) for _ in range(rng.randint(2, 30)))
    rows = [(i, text(k), k, 9.0) for i in range(300) for k in [rng.choice("abc") * 2]]
    table = frame(rows, "doc_id bigint, text string, lang string, score double")
    model = language.fit(table)
    odd = frame([(1, None, 0.0), (2, "", 0.0), (3, "123 !?", 0.0), (4, text("bb") * 5000, 0.0), (5, "schö", 0.0), (5, "schö", 0.0)], "doc_id bigint, text string, score double")
    found = rows_of(language.identify(odd, model).orderBy("doc_id"))
    assert [r["lang_pred"] for r in found] == ["und", "und", "und", "bb", "bb", "bb"]
    assert all(0 <= r["score"] <= 1 for r in found) and set(found[0]) == {"doc_id", "text", "lang_pred", "score", "ambiguous"}
    right = {i: k for i, _, k, _ in rows}
    guessed = rows_of(language.identify(table.select("doc_id", "text"), model))
    assert np.mean([r["lang_pred"] == right[r["doc_id"]] for r in guessed]) > 0.98
    held = {r["doc_id"] for r in table.where(language.held_out("doc_id")).collect()}
    assert held == {i for i in right if zlib.crc32(str(i).encode()) % 4 == 2}
    empty = language.fit(table.limit(0))
    assert {r["lang_pred"] for r in rows_of(language.identify(odd, empty))} == {"und"}


def test_codewords_differ():
    for k in (2, 3, 4, 6, 9, 20):
        codes = language.codewords(k)
        distances = [(codes[i] != codes[j]).sum() for i in range(k) for j in range(i)]
        assert min(distances) >= max(1, codes.shape[1] // 2)


# 4 near documents


def shingle_set(text, size=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return frozenset()
    return frozenset([tuple(ws)] if len(ws) < size else [tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)])


def grouped(ids, links):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        least[r] = min(least.get(r, i), i)
    return [least[find(k)] for k in range(len(ids))]


def test_near_documents_equal_brute_force(docs):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.choice((3, 40, 150)))
        for _ in range(rng.choice((1, 3, 25))):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 8))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
        texts.append(" ".join(base).upper())
    texts += [None, "", " \t", "Two words", "two  WORDS", "é É", "É É", LONG]
    ids = list(range(50, 50 + len(texts)))
    rng.shuffle(ids)
    sets = [shingle_set(t) for t in texts]
    links = [
        (a, b) for a in range(len(sets)) for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    found = {r.doc_id: r for r in minhash.near_documents(docs(list(zip(ids, texts)))).collect()}
    expected = grouped(ids, links)
    assert [found[i].component_id for i in ids] == expected
    assert [found[i].n_shingles for i in ids] == [len(s) for s in sets]
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_near_documents_defined_cases(docs):
    found = sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_documents(docs(ODD_TEXTS)).collect())
    assert found == [(-1, None, False), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (5, 5, True)]
    assert minhash.near_documents(docs(ODD_TEXTS).limit(0)).count() == 0


def test_odd_sketch_estimates(frame):
    rng = np.random.default_rng(4)
    rows = []
    for size in (3, 30, 300, 1500, 4000):
        for percent in (70, 85, 100):
            for _ in range(20):
                both = rng.integers(0, 1 << 64, round(2 * size / (1 + 100 / percent)), dtype=np.uint64)
                own = rng.integers(0, 1 << 64, (2, size - len(both)), dtype=np.uint64)
                sides = []
                for side in own:
                    filled, sketch = minhash.odd_sketch(np.unique(np.concatenate([both, side])))
                    sides.append((size, filled, tuple(sketch.tolist())))
                rows.append((size, percent, *sides))
    bits = ", ".join(f"w{i}: bigint" for i in range(minhash.SKETCH_WORDS))
    side = f"struct<n_shingles: bigint, filled: bigint, sketch: struct<{bits}>>"
    df = frame(rows, f"size int, percent int, l {side}, r {side}")
    found = df.select("size", "percent", minhash.excess(F.col("l"), F.col("r"), 85).alias("x")).collect()
    # Pairs at the threshold lie around it and equal ones stay; of much less similar ones none stays.
    assert all(abs(r.x) < minhash.DEVIATIONS for r in found if r.percent == 85)
    assert all(r.x < minhash.DEVIATIONS for r in found if r.percent == 100)
    assert all(r.x > minhash.DEVIATIONS for r in found if r.percent == 70 and 300 <= r.size <= 1500)


# 5 licences


def test_licences(docs):
    texts = [
        (1, "intro\nReleased under the MIT License.\nLicensed under the Apache License, version 2.0!"), (2, None), (3, ""),
        (4, LONG), (5, "MIT License"), (5, "MIT License"), (None, "LICENSED UNDER CC BY-NC 4.0"),
    ]
    found = licences.report(licences.find_licences(docs(texts)))
    got = {(r.doc_id, r.licences, r.lines, r.n_findings) for r in found.collect()}
    assert got == {
        (1, "Apache-2.0,MIT", "1:MIT,2:Apache-2.0", 2), (2, "", "", 0), (3, "", "", 0), (4, "", "", 0), (5, "", "", 0),
        (None, "CC-BY-NC-4.0", "0:CC-BY-NC-4.0", 1),
    }
    assert licences.find_licences(docs(texts), templates=()).where(F.size("findings") > 0).count() == 0


def test_licences_across_lines_and_within_them(docs):
    mit = (
        'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated '
        'documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\n'
    )
    texts = [
        (1, "Some words first.\n\n" + mit + "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"),
        (2, "This file is released under the MIT License. See LICENSE for details and the full terms of use."),
        (3, "See below\nfor it: licensed under the GNU Lesser General\nPublic License, version 3. Other words follow it here, and more of them."),
        (4, "Either of two. Licensed under CC BY 4.0. Or, if you like, it is also released under the MIT License. Take it."),
        (5, "the license of the software and the rights of the public"), (6, "x\n" + mit), (6, "x\n" + mit),
    ]
    found = [(r.doc_id, r.lines) for r in licences.report(licences.find_licences(docs(texts))).orderBy("doc_id").collect()]
    assert found[:5] == [(1, "2:MIT"), (2, "0:MIT"), (3, "1:LGPL-3.0"), (4, "0:CC-BY-4.0,0:MIT"), (5, "")]
    assert found[5] == found[6] and "MIT" in found[5][1]


def test_size_bounds_prune_nothing_that_passes():
    for size in range(1, 40):
        low, high = licences.bounds(size, 0.75)
        for n in range(1, 120):
            best = 2 * min(n, size) / (n + size)
            assert (low <= n <= high) == (best >= 0.75 - 1e-12)


# 6 near vectors


def test_near_vectors_equal_brute_force(frame, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((8, 16))
    rows = [centres[k % 8] + rng.standard_normal(16) * (0.1 if k % 3 else 0.6) for k in range(240)]
    rows += [rows[0]] * 20 + [np.zeros(16)] * 2
    values = [(k, [float(x) for x in v], 1) for k, v in enumerate(rows)]
    values += [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [None] * 16, 1), (903, [], 1), (904, [1.0, 2.0], 1), (905, [float("inf")] + [0.0] * 15, 1)]
    found = {r.vec_id: r for r in vectors.near_vectors(frame(values, "vec_id bigint, embedding array<float>, n_links int")).collect()}
    a = np.array([np.float32(v) for v in rows], dtype=float)
    norm = np.linalg.norm(a, axis=1)
    norm[norm == 0] = np.inf
    link = (a / norm[:, None]) @ (a / norm[:, None]).T >= 0.9
    np.fill_diagonal(link, False)
    expected = grouped(list(range(len(rows))), np.argwhere(link))
    same = [found[k].n_links == link[k].sum() and found[k].component_id == expected[k] for k in range(len(rows))]
    assert np.mean(same) > 0.99
    assert all(found[k].n_links <= link[k].sum() for k in range(len(rows)))
    assert all(found[k].n_links == 0 and found[k].kept for k in range(900, 906))


# 7 decontamination


def test_decontamination_equals_brute_force(docs, frame):
    rng = random.Random(6)
    ws = [f"w{k}" for k in range(30)] + ["é", "Z9"]
    items = [" ".join(rng.choices(ws, k=k)) for k in (25, 12, 10, 4, 1)] + ["", None, "..."]
    texts = [" ".join(rng.choices(ws, k=rng.randint(0, 60))) for _ in range(40)]
    texts += ["x, " + items[0].upper() + " y", items[1][3:], items[2] + "; " + items[2], "a-" + items[3].replace(" ", "--"), None, "", LONG]
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    found = {r.doc_id: r for r in decontaminate.report(decontaminate.find_hits(
        docs(list(enumerate(texts))), frame(list(enumerate(items)), "item_id bigint, text string"))).collect()}
    for k, t in enumerate(texts):
        own, hit, held = split(t), set(), set()
        for i, item in enumerate(items):
            b = split(item)
            n = min(len(b), 10)
            for s in range(len(b) - n + 1 if b else 0):
                for p in range(len(own) - n + 1):
                    if own[p : p + n] == b[s : s + n]:
                        hit |= set(range(p, p + n))
                        held.add(i)
        r = found[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(own), len(hit), len(held), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest()


def test_removal(docs, frame):
    item = frame([(1, "one two three")], "item_id bigint, text string")
    table = docs([(1, "A one, TWO three. B"), (2, "one two"), (None, None), (3, "one two three"), (3, "one two three")])
    spans = decontaminate.decontaminate(table, item, remove="spans")
    assert spans.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in spans.where("text is not null").collect()) == [(1, "A. B"), (2, "one two"), (3, ""), (3, "")]
    assert {r.doc_id for r in decontaminate.decontaminate(table, item).collect()} == {2, None}
    assert decontaminate.decontaminate(table, item.limit(0)).count() == 5


# 8 personal data


def plain_spans(text):
    """The contract's patterns, run as they are written."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    return [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if pii.passes(k, m[0])]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(8)
    parts = ["a.b", "@", "mail", ".", "x-1", "12", "4111 1111 1111 1111", "4111111111111111", "+1 (375) 555-4393", "255.1.2.3", "1.2.3.4.5.6.7.8", " ", "é", "-", "+", "(", "999.1.1.1"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data(docs):
    rng = random.Random(4)
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(k, f"words before {phone()} and after {rng.randint(10, 99)} more words x{k}@mail.example.com end") for k in range(150)]
    field = pii.fit(docs(rows))
    odd = docs(ODD_TEXTS[:3] + [(4, LONG + phone()), (6, "call (375) 555-4393 now"), (7, "in 1999 it was 12 of 40")])
    found = {r.doc_id: r for r in pii.report(pii.find(odd, field)).collect()}
    assert found[1].spans == found[2].spans == found[3].spans == found[7].spans == ""
    assert found[4].n_phone == 1 and found[4].spans == f"phone:{len(LONG)}:{len(LONG) + 17}"
    assert found[6].n_phone == 0 and found[6].spans == "phone:5:19"
    redacted = {r.doc_id: r.text for r in pii.find(odd, field, redact=True).collect()}
    assert redacted[6] == "call [PHONE] now" and redacted[1] is None and redacted[7] == "in 1999 it was 12 of 40"
    assert pii.find(docs(rows).limit(0), pii.fit(docs(rows).limit(0))).count() == 0


def test_best_segmentation_equals_enumeration():
    rng = np.random.default_rng(0)
    field = pii.Field()
    field.weights[:] = rng.normal(size=field.weights.shape)
    field.moves[:] = rng.normal(size=field.moves.shape)
    text = "12 ab 4 c@d 99"
    chunks = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    scores = field.scores(text, chunks, field.lattice(text, chunks))
    n = len(chunks)

    def every(i, before):
        if i == n:
            yield 0.0
        for j in range(i + 1, n + 1):
            for k in range(len(pii.LABELS)):
                if (i, j) in scores and np.isfinite(scores[i, j][k]):
                    for rest in every(j, k):
                        yield rest + scores[i, j][k] + field.moves[before, k]

    whole = list(every(0, 0))
    assert np.logaddexp.reduce(field.forward(n, scores)[n]) == pytest.approx(np.logaddexp.reduce(whole))
    assert field.backward(n, scores)[0, 0] == pytest.approx(np.logaddexp.reduce(whole))


# 9 secrets


def test_ledger_scans_only_what_is_new(docs, spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    key = "AKIA" + "B" * 16
    first = docs([(1, f"x {key} password = '{'a' * 12}'"), (2, f"x {key} password = '{'a' * 12}'"), (3, None), (4, "plain")])
    base = secrets.BASE_RULES
    found = {r.doc_id: r for r in secrets.report(secrets.scan_versions(first, ledger, rules=base), base).collect()}
    assert found[1].spans == found[2].spans == "access:2:22,assign:23:47" and found[3].spans == found[4].spans == ""
    assert spark.read.parquet(ledger).count() == 3
    more = docs([(1, f"x {key} password = '{'a' * 12}'"), (9, "é ghp_" + "Z" * 36)])
    again = {r.doc_id: r for r in secrets.report(secrets.scan_versions(more, ledger)).collect()}
    assert again[1].spans == found[1].spans and again[9].spans == "github:2:42"
    rows = [(r.blob, sorted(r.scanned)) for r in spark.read.parquet(ledger).collect()]
    added = sorted(r.key for r in secrets.MORE_RULES)
    assert len(rows) == 5 and sum(s == added for _, s in rows) == 1
    secrets.scan_versions(more, ledger).count()
    assert spark.read.parquet(ledger).count() == 5
    empty = secrets.scan_versions(docs(ODD_TEXTS).limit(0), str(tmp_path / "other"))
    assert empty.count() == 0


# 10 toxicity


def test_toxicity(docs, frame):
    rng = random.Random(2)
    ws = [f"w{k}" for k in range(300)]
    bad = ["nasty", "awful", "vile"]
    rows, labels = [], []
    for k in range(600):
        toxic, low = k % 4 == 0, k % 5 == 0
        own = rng.choices(ws, k=40) + (rng.choices(bad, k=2) if toxic else []) + (["junk"] * low)
        rows.append((k, " ".join(own)))
        if k < 400:
            labels.append((k, int(not low), int(toxic) if k % 7 else None))
    chain = toxicity.fit(docs(rows), frame(labels, "doc_id bigint, quality int, toxic int"), {"low": "quality = 0", "toxic": "toxic = 1"})
    found = {r.doc_id: r for r in toxicity.predict(docs(rows), chain).collect()}
    assert all((found[k].p_toxic >= 0.5) == (k % 4 == 0) for k in range(400, 600))
    odd = rows_of(toxicity.predict(docs(ODD_TEXTS), chain))
    assert len(odd) == len(ODD_TEXTS) and all(0 <= r["p_toxic"] < 0.5 for r in odd)
    none = toxicity.fit(docs(rows), frame([], "doc_id bigint, quality int, toxic int"), {"toxic": "toxic = 1"})
    assert {r["p_toxic"] < 1e-9 for r in rows_of(toxicity.predict(docs(ODD_TEXTS), none))} == {True}
