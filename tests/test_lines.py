"""Line splitting, blank lines, decoding, field splitting."""

from regline.functions.columns import split_fields
from regline.sources.text import read_lines


def lines_of(spark, d):
    return sorted(r.line for r in read_lines(spark, d).collect())


def test_crlf_lines(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"Recife;PE\r\nNatal;RN\r\n"})) == ["Natal;RN", "Recife;PE"]


def test_lf_lines(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"1;um\n2;dois\n3;\n"})) == ["1;um", "2;dois", "3;"]


def test_last_line_without_newline(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"primeira\nultima"})) == ["primeira", "ultima"]


def test_last_line_trailing_cr_removed(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"antes\ndepois\r"})) == ["antes", "depois"]


def test_empty_file_gives_nothing(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"", "b.csv": b"x\n"})) == ["x"]


def test_lone_cr_is_data(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"mid\rdle;y\r\n"})) == ["mid\rdle;y"]


def test_only_one_cr_removed(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"dbl\r\r\n"})) == ["dbl\r"]


def test_blank_lines_dropped_spaces_kept(spark, write_files):
    d = write_files({"a.csv": b"a\r\n\r\n\n  \r\nb\n"})
    assert lines_of(spark, d) == ["  ", "a", "b"]


def test_latin1_decoded(spark, write_files):
    assert lines_of(spark, write_files({"a.csv": b"b\xe7\r\n"})) == ["bç"]


def test_file_lineage(spark, write_files):
    d = write_files({"x.csv": b"1\n", "y.csv": b"2\n"})
    got = sorted((r.file_name, r.line) for r in read_lines(spark, d).collect())
    assert got == [("x.csv", "1"), ("y.csv", "2")]


def split(spark, s):
    return spark.createDataFrame([(s,)], "line string").select(split_fields("line").alias("f")).first().f


def test_split_fields(spark):
    assert split(spark, "PE;Olinda;50.1") == ["PE", "Olinda", "50.1"]
    assert split(spark, ";;fim;;") == ["", "", "fim", "", ""]
    assert split(spark, "inteiro") == ["inteiro"]
    assert split(spark, '"q;r";t') == ['"q', 'r"', "t"]
    assert split(spark, ";;") == ["", "", ""]
