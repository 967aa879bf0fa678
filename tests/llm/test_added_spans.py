"""Recall of spans that only the field finds: items rewritten so that no base pattern holds, none of them learned from."""

import random

import pytest

from rowmill.llm import pii

WORDS = "please call me write to server order today before number is and then at home or office".split()


def card(rng):
    digits = [4, *(rng.randrange(10) for _ in range(14))]
    total = sum(d if k % 2 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
    return "".join(map(str, [*digits, -total % 10]))


def number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


FORMS = {
    "brackets": lambda rng: f"({rng.randint(200, 999)}) 555-{number(rng, 4)}",
    "dots": lambda rng: f"{rng.randint(200, 999)}.555.{number(rng, 4)}",
    "dashes": lambda rng: f"{rng.randint(200, 999)}-555-{number(rng, 4)}",
    "card": lambda rng: rng.choice("./").join(c[i : i + 4] for c in [card(rng)] for i in range(0, 16, 4)),
}


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))


@pytest.mark.parametrize("form", list(FORMS))
def test_recall_of_rewritten_items(field, form):
    rng, found = random.Random(form), 0
    for _ in range(200):
        before, item = " ".join(rng.choices(WORDS, k=6)) + " ", FORMS[form](rng)
        base, spans = pii.all_spans(before + item + " " + " ".join(rng.choices(WORDS, k=6)), field)
        assert base == []
        found += any(b == len(before) and e == len(before) + len(item) for _, b, e in spans)
    assert found >= 180


def test_plain_numbers_are_left_alone(field):
    rng = random.Random(1)
    for _ in range(300):
        text = f"in {rng.randint(1900, 2020)} it was {number(rng, 2)} of {number(rng, 3)} and {number(rng, 5)} tons at {number(rng, 2)}:{number(rng, 2)}"
        assert pii.all_spans(text, field)[1] == []
