"""Text files cut into many byte ranges, against Python's own CSV reader."""

import csv
import io
import random
from contextlib import contextmanager

import pytest

import rowmill as rm
from rowmill.sources import records


@contextmanager
def ranges_of(spark, size):
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, (size, 1, 1)):
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(text, separator=";"):
    """Rows after the header, as text; blank lines left out, empty fields missing."""
    read = csv.reader(io.StringIO(text, newline=""), delimiter=separator)
    found = [[v or None for v in r] for r in read if r and not (len(r) == 1 and not r[0].strip())]
    return sorted((tuple(r + [None] * (len(found[0]) - len(r))) for r in found[1:]), key=repr)


PARTS = ["plain", 'say ""hi""', "two\nlines", "cr\r\nlf", "sep;inside", "", '""', "é", "\n", "long " * 30]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [48, 1 << 20])
def test_quoted_breaks_equal_the_csv_module(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    lines = ["a;b;c"]
    for _ in range(60):
        fields = []
        for _ in range(3):
            kind = rng.random()
            if kind < 0.5:
                fields.append(rng.choice(["x", "5", 'inch 5"', "a b", "", "ü"]))
            else:
                fields.append('"' + "".join(rng.choice(PARTS) for _ in range(rng.randrange(3))) + '"')
        lines.append(";".join(fields))
    text = rng.choice(["\n", "\r\n"]).join(lines) + "\n"
    (tmp_path / "t.csv").write_bytes(text.encode())
    with ranges_of(spark, size):
        loaded = rm.read_delimited(spark, str(tmp_path / "t.csv"), infer=False)
        df = loaded.df
        want = [tuple(None if v in records_null() else v for v in r) for r in expected(text)]
        assert rows(df) == sorted(want, key=repr)
        if size == 48:
            assert df.rdd.getNumPartitions() > 3


def records_null():
    from rowmill.sources.delimited import NULL_TOKENS

    return set(NULL_TOKENS)


def test_each_file_has_its_own_encoding(spark, tmp_path):
    for k, charset in enumerate(["utf-8", "latin1", "utf-8", "latin1"]):
        (tmp_path / f"{k}.csv").write_bytes(f"n;t\n{k};señal {k}\n".encode(charset))
    loaded = rm.read_delimited(spark, str(tmp_path))
    assert rows(loaded.df) == [(k, f"señal {k}") for k in range(4)]
    assert loaded.encoding == "latin1, utf-8"


def test_latin1_lines_end_where_they_end(spark, tmp_path):
    # 0xF1 would begin a character of four bytes in UTF-8.
    (tmp_path / "t.csv").write_bytes("a;b\r\nxñ;1\r\nñ;2\r\n".encode("latin1"))
    assert rows(rm.read_delimited(spark, str(tmp_path)).df) == [("xñ", 1), ("ñ", 2)]


def test_lone_carriage_returns_end_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('a;b\rx;1\r"y\rz";2\r\nw;3\n'.encode())
    assert rows(rm.read_delimited(spark, str(tmp_path)).df) == [("w", 3), ("x", 1), ("y\rz", 2)]


def test_control_characters_stay(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b"a1b\nx\x01y2z\nu3\x00v\n")
    df = rm.read_delimited(spark, str(tmp_path), separator="[0-9]", regex_separator=True).df
    assert rows(df) == [("u", "\x00v"), ("x\x01y", "z")]
    (tmp_path / "t.csv").write_bytes(b"a;b\nx\x01y;z\n")
    assert rows(rm.read_delimited(spark, str(tmp_path)).df) == [("x\x01y", "z")]


def test_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a;b\n1;x\n")
    (tmp_path / "2.csv").write_text("b;a\ny;2\n")
    (tmp_path / "3.csv").write_text('"a";"b"\n3;z\n')
    assert rows(rm.read_delimited(spark, str(tmp_path)).df) == [(1, "x"), (2, "y"), (3, "z")]
    (tmp_path / "4.csv").write_text("a;c\n4;z\n")
    with pytest.raises(ValueError, match="4.csv differ"):
        rm.read_delimited(spark, str(tmp_path))


@pytest.mark.parametrize("row", ["1;2;", "1;2;3", '"1;1";2;', '1;"2\n2";3'])
def test_surplus_fields_are_refused(spark, tmp_path, row):
    (tmp_path / "t.csv").write_text(f"a;b\n{row}\n4;5\n")
    with pytest.raises(ValueError, match="1 rows have more than 2 fields"):
        rm.read_delimited(spark, str(tmp_path))


def test_open_quote_is_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a;b\n1;"x\n2;y\n')
    with pytest.raises(records.UnclosedQuote, match="t.csv"):
        rm.read_delimited(spark, str(tmp_path))


def test_names_that_differ_by_case(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;A;a\n1;2;3\n")
    df = rm.read_delimited(spark, str(tmp_path)).df
    assert df.columns == ["a", "A.1", "a.2"] and rows(df) == [(1, 2, 3)]


def test_row_ids_follow_reading_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k;t\n" + "".join(f'{k};"line\n{k}"\n' if k % 3 else f"{k};x\n" for k in range(80)))
    with ranges_of(spark, 64):
        df = rm.read_delimited(spark, str(tmp_path), row_id=True).df
        assert [r.k for r in df.orderBy("_row_id").collect()] == list(range(80))
