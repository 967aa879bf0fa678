"""Short values of assignments take their text before they are dropped."""

import re

from rowmill.llm import secrets


def test_short_value_that_is_a_keyword(frame, tmp_path):
    texts = [
        "token=secret: abcdefghijklmnop", 'api_key=token="abcdefghijklmnop"', 'password = secret="abcdefghijklmnop123"',
        "token=short secret: abcdefghijklmnop", "é passwd==abcdefghijk token=abcdefghijk", "secret: 'abcdefghijkl' token=x",
    ]
    rule = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    expected = {
        k: ",".join(f"assign:{m.start()}:{m.end()}" for m in rule.finditer(t) if len(m[1]) >= 12) for k, t in enumerate(texts)
    }
    table = frame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = secrets.report(secrets.scan_versions(table, str(tmp_path / "ledger"))).collect()
    assert {r.doc_id: r.spans for r in rows} == expected
    assert [expected[k] for k in range(3)] == ["", "", ""] and expected[3] == "assign:12:36"
