"""Trust on host links with cycles is iterated until it holds."""

import pytest

from rowmill.llm import url_trust


def test_scores_on_a_cycle_converge(frame):
    rules = (("allow", "good.test", "/"), ("block", "bad.test", "/"))
    link = lambda h: f'<a href="https://{h}/x">y</a>'
    rows = [
        (1, "http://good.test/", link("b.test")), (2, "http://b.test/", link("good.test")),
        (3, "http://bad.test/", None),
    ]
    found = {r.host: r for r in url_trust.judge(frame(rows, "page_id bigint, url string, html string"), rules=rules).collect()}
    d = url_trust.DAMPING
    assert found["good.test"].trust == pytest.approx(1 / (1 - d * d), abs=1e-4)
    assert found["b.test"].trust == pytest.approx(d / (1 - d * d), abs=1e-4)


def test_no_end_is_an_error(frame, monkeypatch):
    monkeypatch.setattr(url_trust, "MOST_ROUNDS", 2)
    edges = frame([("a", "b"), ("b", "a")], "a string, b string")
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        url_trust.propagated(frame([("a",)], "host string"), edges)


def test_parts_of_a_host_do_not_show(frame, monkeypatch):
    edges = frame(
        [("hub", f"h{k}") for k in range(40)] + [(f"h{k}", "hub") for k in range(0, 40, 3)], "a string, b string"
    )
    seeds = frame([("hub",), ("h1",)], "host string")
    found = []
    for size in (10_000, 3):
        monkeypatch.setattr(url_trust, "EDGES_A_PART", size)
        found.append({r.host: r.score for r in url_trust.propagated(seeds, edges).collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) == 41
    assert all(found[1][h] == pytest.approx(s) for h, s in found[0].items())
