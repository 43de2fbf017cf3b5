"""Strict scan, typed scan and lookup edge cases (FIXTURES §5)."""

from pyspark.sql import types as T

from covlens.sources.scan import (
    line_row_check, lookup_scan, strict_scan, typed_scan, with_source_file,
)
from tests.conftest import write_lines

SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("code", T.StringType(), True),
    T.StructField("tone", T.DoubleType(), True),
    T.StructField("value", T.StringType(), True),   # a data column named like read.text's column
])


def _scan(spark, tmp_path, lines):
    p = write_lines(tmp_path / "slice.tsv", lines)
    return strict_scan(spark, p, SCHEMA)


def test_good_rows_and_null_semantics(spark, tmp_path):
    valid, rejects = _scan(spark, tmp_path, [
        "1\t010\t1.5\tx", "2\tNA\t1e3\ty", "3\t\t-0.25\t", '4\t"abc\t2\tde"f'])
    rows = {r.id: r for r in valid.collect()}
    assert rejects.count() == 0
    assert rows[1].code == "010"                      # leading zero kept
    assert rows[2].code == "NA" and rows[2].tone == 1000.0
    assert rows[3].code is None and rows[3].value is None   # empty field → NULL
    assert rows[4].code == '"abc' and rows[4].value == 'de"f'  # quotes never merge rows
    assert valid.columns == ["id", "code", "tone", "value"]


def test_every_violation_kind_is_rejected_with_reason(spark, tmp_path):
    valid, rejects = _scan(spark, tmp_path, [
        "xx\tA\t1.0\tv",        # bad type
        "2\tA\t1.0",            # short row
        "3\tA\t1.0\tv\textra",  # long row
        "\tA\t1.0\tv",          # empty required field
        " 12 \tA\t1.0\tv",      # padded number
        "6\tA\t1d\tv",          # type suffix a bare cast would accept
        "7\tA\tNaN\tv",         # NaN is not a measure
        "8\tA\t2.5\tv",         # the one good row
    ])
    assert [r.id for r in valid.collect()] == [8]
    got = {r._raw: r.violations for r in rejects.collect()}
    assert len(got) == 7
    assert got["xx\tA\t1.0\tv"] == ["id: not a bigint"]
    assert got["2\tA\t1.0"] == ["expected 4 fields, found 3"]
    assert got["3\tA\t1.0\tv\textra"] == ["expected 4 fields, found 5"]
    assert got["\tA\t1.0\tv"] == ["id: required"]
    assert got[" 12 \tA\t1.0\tv"] == ["id: not a bigint"]
    assert got["6\tA\t1d\tv"] == ["tone: not a double"]
    assert got["7\tA\tNaN\tv"] == ["tone: not a double"]
    assert all(r.file_name == "slice.tsv" for r in rejects.collect())


def test_failfast_count_does_not_validate_but_strict_scan_does(spark, tmp_path):
    p = write_lines(tmp_path / "bad.tsv", ["1\tA\t1.0\tv", "xx\tB\t2.0\tw"])
    # The CSV reader prunes columns: count() never parses the bad value (trap T1).
    assert typed_scan(spark, p, SCHEMA).count() == 2
    check = line_row_check(spark, p, SCHEMA).collect()[0]
    assert (check.n_lines, check.n_valid, check.n_rejected, check.all_valid) == (2, 1, 1, False)


def test_multi_path_and_glob_are_one_table(spark, tmp_path):
    a = write_lines(tmp_path / "d" / "20240101000000.export.CSV", ["1\tA\t1\tv"])
    write_lines(tmp_path / "d" / "20240101001500.export.CSV", ["2\tB\t2\tw"])
    valid, _ = strict_scan(spark, [a, str(tmp_path / "d" / "*1500.export.CSV")], SCHEMA)
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    glob, _ = strict_scan(spark, str(tmp_path / "d" / "*.export.CSV"), SCHEMA)
    assert glob.count() == 2
    files = with_source_file(glob).select("source_file").distinct().count()
    assert files == 2


def test_crlf_lookup_has_no_trailing_cr(spark, tmp_path):
    p = write_lines(tmp_path / "geo.txt", ["AF\tAfghanistan", "RI\tSerbia"], newline="\r\n")
    rows = lookup_scan(spark, p, ("code", "label")).collect()
    assert [(r.code, r.label) for r in rows] == [("AF", "Afghanistan"), ("RI", "Serbia")]
    h = write_lines(tmp_path / "actors.txt", ["CODE\tLABEL", "USA\tUnited States"], newline="\r\n")
    assert lookup_scan(spark, h, ("code", "label"), header=True).collect()[0].label == "United States"


def test_failfast_raises_only_when_every_column_is_read(spark, tmp_path):
    import pytest

    p = write_lines(tmp_path / "bad2.tsv", ["1\tA\t1.0\tv", "xx\tB\t2.0\tw"])
    df = typed_scan(spark, p, SCHEMA)
    assert df.select("code").count() == 2          # pruned: the bad id is never parsed
    with pytest.raises(Exception):
        df.collect()                               # all columns read: FAILFAST fires


def test_literal_path_reads_a_file_with_glob_characters(spark, tmp_path):
    from covlens.sources.scan import literal_path

    odd = write_lines(tmp_path / "slice[1]{a}.tsv", ["1\tA\t1.0\tv"])
    write_lines(tmp_path / "slice1a.tsv", ["2\tB\t2.0\tw"])
    valid, _ = strict_scan(spark, literal_path("file:" + odd), SCHEMA)
    assert [r.id for r in valid.collect()] == [1]


def test_values_are_the_text_or_the_line_is_rejected(spark, tmp_path):
    p = tmp_path / "odd.tsv"
    p.write_bytes("\n".join([
        "1\t\x00q\t1.5\t\x00", "2\t\"a\t1\tb\"", "3\t#c\t-0\t\\t", "+4\ta\t.5\tx", "007\ta\t1.\tx", "-8\ta\t1E5\tx", "9\ta b \t12345678.125\t é",
        "٣\ta\t1\tx", "10\ta\t1e400\tx", "11\ta\t-1e400\tx", "12\ta\tInfinity\tx", "13\ta\tNaN\tx", "9223372036854775808\ta\t1\tx", "14\ta\t1 \tx",
        "1.0\ta\t1\tx", "0x1\ta\t1\tx", "15\ta\t1f\tx", "16\ta\t٣\tx", "\x0017\ta\t1\tx", "- 1\ta\t1\tx", "", "\t\t\t"]).encode() + b"\n18\t\xff\t1\tx\n")
    valid, rejects = strict_scan(spark, str(p), SCHEMA)
    got = {r.id: (r.code, r.tone, r.value) for r in valid.collect()}
    assert got == {1: ("\x00q", 1.5, "\x00"), 2: ('"a', 1.0, 'b"'), 3: ("#c", 0.0, "\\t"), 4: ("a", 0.5, "x"), 7: ("a", 1.0, "x"), -8: ("a", 1e5, "x"),
                   9: ("a b ", 12345678.125, " é")}
    reasons = {r._raw: r.violations for r in rejects.collect()}
    assert len(reasons) == 16 and reasons["10\ta\t1e400\tx"] == ["tone: not a double"] and reasons["٣\ta\t1\tx"] == ["id: not a bigint"]
    assert reasons["\t\t\t"] == ["id: required"] and ["not valid UTF-8"] in reasons.values()
    assert line_row_check(spark, str(p), SCHEMA).first()[:3] == (23, 7, 16)


def test_a_line_with_a_line_end_inside_is_no_line(spark):
    from covlens.sources.scan import parse_delimited, violations

    lines = spark.createDataFrame([("1\ta\rb\t1\tx",), ("2\ta\t1\tx\n3\tb\t1\ty",), (None,), ("4\té\t1\tx",), ("\r",)], "_raw string")
    rows = parse_delimited(lines, SCHEMA).withColumn("why", violations(SCHEMA)).collect()
    assert [r._ok for r in rows] == [False, False, False, True, False]
    assert rows[0].why == ["holds a line end"] and "holds a line end" in rows[1].why and rows[2].why[0] == "no line" and rows[3].why == []


def test_every_typed_text_comes_back(spark):
    """A value that is kept prints as its text, or has a text form of its type."""
    import random
    import re

    from covlens.sources.scan import DECIMAL_PATTERN, INTEGER_PATTERN, parse_delimited, violations

    r = random.Random(1)
    alphabet = "0123456789+-.eEdfL \t٣NaInfiy\x00"
    texts = ["".join(r.choice(alphabet.replace("\t", "")) for _ in range(r.randrange(1, 8))) for _ in range(3000)]
    texts += [repr(r.uniform(-1e6, 1e6)) for _ in range(300)] + [str(r.randrange(-(2**63), 2**63)) for _ in range(300)]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("d", T.DoubleType()), T.StructField("s", T.StringType())])
    lines = spark.createDataFrame([(f"{t}\t\t{t}",) for t in texts] + [(f"\t{t}\t{t}",) for t in texts], "_raw string")
    rows = parse_delimited(lines, schema).withColumn("why", violations(schema)).collect()
    for row in rows:
        whole, text = row._raw.startswith("\t") is False, row._raw.split("\t")[2]
        fits = re.fullmatch(INTEGER_PATTERN if whole else DECIMAL_PATTERN, text) is not None
        value = float(text) if fits else None
        fits = fits and (-(2**63) <= int(text) < 2**63 if whole else abs(value) != float("inf"))
        assert row._ok == fits == (row.why == []) and row.s == text
        if fits:
            assert (row.i if whole else row.d) == (int(text) if whole else value)


def test_rows_and_rejects_from_one_parse(spark, tmp_path):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from covlens.sources.scan import parse_delimited, read_lines, strict_scan_once, valid_and_rejected

    p = write_lines(tmp_path / "s.tsv", ["1\tA\t1.0\tv", "xx\tB\t2.0\tw", "2\t\t\t", "3\tC"])
    valid, rejects = strict_scan_once(spark, p, SCHEMA, stage=str(tmp_path / "stage"))
    a, b = strict_scan(spark, p, SCHEMA)
    assert valid.columns == a.columns and sorted(valid.collect()) == sorted(a.collect())
    assert rejects.columns == b.columns and sorted(rejects.collect()) == sorted(b.collect())
    seen = Observation()  # lines that the parse reads, for both outputs
    lines = read_lines(spark, p).observe(seen, F.count(F.lit(1)).alias("n"))
    valid, rejects = valid_and_rejected(parse_delimited(lines, SCHEMA), SCHEMA, str(tmp_path / "stage2"))
    assert (valid.count(), rejects.count(), seen.get["n"]) == (2, 2, 4)
    assert not any("FileScan text" in df._jdf.queryExecution().executedPlan().toString() for df in (valid, rejects))
