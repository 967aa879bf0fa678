"""Long islands and long numbers in personal data."""

import random
import tracemalloc

import pytest

from rowmill.llm import pii


@pytest.fixture(scope="module")
def field():
    texts = [f"call +1 ({200 + k}) 555-01{k:02d} for more" for k in range(60)]
    return pii.learned(texts + [f"row {k} of {k + 7}" for k in range(60)])


def numbers(n):
    draw = random.Random(n)
    return " ".join(
        f"({draw.randrange(200, 999)}) 555-{draw.randrange(10000):04d}" if k % 9 == 4 else str(draw.randrange(10**6))
        for k in range(n)
    )


def test_many_leading_zeros():
    assert pii.passes("ip", "0" * 5000 + ".1.2.3") and pii.passes("ip", "0" * 5000 + "7.1.2.3")
    assert not pii.passes("ip", "0" * 5000 + "256.1.2.3")


def test_a_span_does_not_depend_on_its_place_in_an_island():
    field = pii.learned([f"call +1 ({200 + k}) 555-01{k:02d} for more" for k in range(60)] + [f"row {k} of {k + 7}" for k in range(60)])
    number = "(212) 555-0142"
    found = {}
    for k in (10, 397, 398, 399, 400, 401, 799):
        text = "a1 " * k + "call " + number + " b2" * 5
        at = text.index(number)
        found[k] = [(b - at, e - at) for _, b, e in pii.all_spans(text, field)[1]]
    assert found[10] and all(f == found[10] for f in found.values())


@pytest.mark.parametrize("block", [1, 5, 6, 7, 64])
def test_blocks_of_an_island_do_not_show(field, monkeypatch, block):
    text = numbers(300)
    (chunks,) = pii.islands(text)
    whole = field.find(text, chunks)
    assert len(whole) >= 20 and whole == sorted(whole, key=lambda s: s[1])
    monkeypatch.setattr(pii, "BLOCK", block)
    assert field.find(text, chunks) == whole


def test_memory_of_a_long_island_is_bounded(field):
    """What grows with the island is a few numbers per chunk, not its segments and their features."""
    peaks = []
    for n in (4000, 8000):
        text = numbers(n)
        (chunks,) = pii.islands(text)
        field.find(text, chunks)  # fills the bounded memory of names
        tracemalloc.start()
        field.find(text, chunks)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 4000 * 400
