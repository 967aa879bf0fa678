import datetime
import os

import pytest

import rowmill as rm
from rowmill.sources.delimited import resolve_separator


@pytest.fixture
def text(tmp_path):
    def write(content, name="t.csv", encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode(encoding))
        return str(path)

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_types_follow_the_values(spark, text):
    path = text("i;f;b;d;s;e;g\n1;1.5;True;2024-01-01;x;;True\n-2;2e3;FALSE;2024-01-02;1d;;\n")
    loaded = rm.read_delimited(spark, path)
    assert loaded.df.dtypes == [
        ("i", "bigint"), ("f", "double"), ("b", "boolean"), ("d", "string"), ("s", "string"),
        ("e", "double"), ("g", "string"),
    ]
    assert rows(loaded.df) == [
        (1, 1.5, True, "2024-01-01", "x", None, "True"),
        (-2, 2000.0, False, "2024-01-02", "1d", None, None),
    ]
    as_text = rm.read_delimited(spark, path, infer=False).df
    assert {t for _, t in as_text.dtypes} == {"string"}
    assert rm.infer_types(as_text).dtypes == loaded.df.dtypes


@pytest.mark.parametrize(
    "value,kind",
    [("+5", "bigint"), (" 7 ", "bigint"), ("1.", "double"), ("9223372036854775808", "double"),
     ("-Infinity", "double"), ("inf", "double"), ("5.e1", "double"), ("1d", "string"),
     ("1f", "string"), ("1F\t", "string"), ("0x1p3", "string"), ("1_0", "string"),
     ("NAN", "string"), ("1e", "string"), ("yes", "string")],
)
def test_what_counts_as_a_number(frame, value, kind):
    assert rm.infer_types(frame([(value,)], "x string")).dtypes == [("x", kind)]


def test_null_tokens(spark, text):
    path = text('a;b\n1;x\nNA;null\nnull;None\n#N/A; \n"";"q"\n')
    df = rm.read_delimited(spark, path).df
    assert rows(df) == [(1, "x"), (None, None), (None, None), (None, " "), (None, "q")]


@pytest.mark.parametrize(
    "separator,used", [("semicolon", ";"), ("comma", ","), ("tab", "\t"), ("|", "|"), ("::", "::")]
)
def test_separators(spark, text, separator, used):
    path = text(f"a{used}b\n1{used}x\n2{used}y\n")
    loaded = rm.read_delimited(spark, path, separator)
    assert rows(loaded.df) == [(1, "x"), (2, "y")] and loaded.separator == used


def test_separator_choice():
    assert resolve_separator(None) == ";" and resolve_separator("custom") == "|"
    assert resolve_separator("custom", "#") == "#" and resolve_separator("tab") == "\t"


@pytest.mark.parametrize("header", [True, False])
def test_regex_separator(spark, text, header):
    path = text("a1b\nx22y\nz3\n")
    df = rm.read_delimited(spark, path, r"\d+", header=header, regex_separator=True).df
    body = [("x", "y"), ("z", None)]
    assert rows(df) == (body if header else [("a", "b"), *body])
    assert df.columns == (["a", "b"] if header else ["0", "1"])
    with pytest.raises(ValueError, match="more than 2 fields"):
        rm.read_delimited(spark, text("a1b\nx1y1z\n"), r"\d", regex_separator=True)


def test_headerless(spark, text):
    df = rm.read_delimited(spark, text("1;x\n2;y\n"), header=False).df
    assert df.columns == ["0", "1"] and rows(df) == [(1, "x"), (2, "y")]
    assert rm.suggested_columns(df) == ["0", "1"]


def test_ragged_rows(spark, text):
    with pytest.raises(ValueError, match="1 rows have more than 2 fields"):
        rm.read_delimited(spark, text("a;b\n1;2\n3;4;5\n"))
    assert rows(rm.read_delimited(spark, text("a;b\n1;2\n6\n")).df) == [(1, 2), (6, None)]


def test_odd_headers(spark, text):
    df = rm.read_delimited(spark, text("a;;a;x.y\n1;2;3;4\n")).df
    assert df.columns == ["a", "Unnamed: 1", "a.1", "x.y"]
    with pytest.raises(ValueError, match="no columns"):
        rm.read_delimited(spark, text("", "empty.csv"))


@pytest.mark.parametrize(
    "stored,asked,used",
    [("utf-8", "utf-8", "utf-8"), ("latin-1", "utf-8", "latin1"), ("latin-1", "cp1252", "latin1"),
     ("utf-8", "cp1252", "utf-8"), ("utf-16", "utf-16", "utf-16"), ("utf-8", "ascii", "utf-8"),
     ("latin-1", "latin1", "latin1"), ("utf-8", None, "utf-8")],
)
def test_encodings(spark, text, stored, asked, used):
    path = text("a;b\nñandú;1\n", encoding=stored)
    loaded = rm.read_delimited(spark, path, encoding=asked)
    assert loaded.encoding == used and rows(loaded.df) == [("ñandú", 1)]


def test_quotes_and_line_breaks(spark, text):
    path = text('a;b\n"x;y ""z""";1\n"two\nlines";2\n')
    df = rm.read_delimited(spark, path, multiline=True).df
    assert rows(df) == [('x;y "z"', 1), ("two\nlines", 2)]


def test_any_extension_folder_glob_or_list(spark, text, tmp_path):
    one, two = text("a\tb\n1\tx\n", "one.tsv"), text("a\tb\n2\ty\n", "two.txt")
    wanted = [(1, "x"), (2, "y")]
    for path in (str(tmp_path), str(tmp_path / "*.t*"), [one, two]):
        assert sorted(rows(rm.read_delimited(spark, path, "tab").df)) == wanted


def test_record_and_row_ids(spark, text):
    path = text("a;b\n" + "".join(f"{i};v{i % 3}\n" for i in range(500)))
    loaded = rm.read_delimited(spark, path, row_id=True)
    assert tuple(loaded.record().first()) == (path, ";", "infer", "utf-8", 500, 2)
    assert [r["a"] for r in loaded.df.orderBy("_row_id").collect()] == list(range(500))
    assert loaded.log_lines()[0].endswith("(500 rows x 2 columns)")
    assert rm.with_row_id(loaded.df.drop("_row_id"), "a").filter("_row_id = a").count() == 500


def test_written_files_read_back(spark, frame, tmp_path):
    body = [(1, 'say "hi"; ok', 1.5), (2, None, None), (3, "ñ,é", 2.0)]
    df = frame([(i, *r) for i, r in enumerate(body)], "_row_id int, k int, s string, x double")
    out = str(tmp_path / "out")
    rm.write_csv(df, out, single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out, parts[0]), encoding="utf-8") as f:
        assert f.readline().strip() == "k,s,x"
    assert rows(rm.read_delimited(spark, out, ",").df) == body


def test_preview(frame):
    day = datetime.datetime(2024, 1, 1)
    body = [(9 - i, float(i), day if i else None) for i in range(10)]
    p = rm.preview(frame(body, "_row_id int, x double, t timestamp_ntz"))
    assert (p.shown, p.total, p.columns) == (8, 10, 2)
    shown = rows(p.rows)
    assert shown[0] == ("9.0", "2024-01-01 00:00:00") and len(shown) == 8
    first = rm.preview(frame([(1, None)], "a int, b double"))
    assert rows(first.rows) == [("1", "NaN")]
