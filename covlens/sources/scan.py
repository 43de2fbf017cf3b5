"""Scans: S1-S10 and the line/row check V1.

``typed_scan`` is Spark's CSV reader with an explicit schema. Spark prunes
columns before parsing, so FAILFAST only fails on the columns a query reads,
and a required (non-nullable) field may still come back NULL. ``strict_scan``
therefore parses the text itself: one expression per column, every column
checked, and each bad record kept with its reasons instead of failing the job.
``strict_scan_once`` gives rows and rejects from a single parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.session import shared_dir
from covlens.sources.publish import is_published, read_published
from covlens.sources.sinks import fan_out

Paths = str | Sequence[str]

# Accepted text forms per type. Whitespace, type suffixes
# ("1d"), hex and NaN/Infinity are rejected; a bare cast would accept some.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?$"
BOOLEAN_PATTERN = r"^(true|false)$"


def literal_path(path: str) -> str:
    """Escape glob characters so a listed file path is read as itself."""
    for ch in "\\*?[]{}":
        path = path.replace(ch, "\\" + ch)
    return path


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def typed_scan(spark: SparkSession, paths: Paths, schema: T.StructType, sep: str = "\t",
               mode: str = "FAILFAST", header: bool = False) -> DataFrame:
    """Delimited files with an explicit schema; quoting off.

    A list of paths is one table; paths may be glob patterns.
    """
    return (spark.read.schema(schema)
            .option("sep", sep).option("quote", "").option("header", str(header).lower())
            .option("mode", mode)
            .csv(_paths(paths)))


def _guard(data_type: T.DataType) -> str | None:
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return INTEGER_PATTERN
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return DECIMAL_PATTERN
    if isinstance(data_type, T.DateType):
        return DATE_PATTERN
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP_PATTERN
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN_PATTERN
    if isinstance(data_type, T.StringType):
        return None
    raise TypeError(f"strict_scan does not handle {data_type.simpleString()}")


# Characters that would make a one-character separator a regex: only a plain
# single character takes Java's split fast path (no pattern compile per row).
_REGEX_META = ".$|()[{^?*+\\"


def _split_pattern(sep: str) -> str:
    if len(sep) == 1 and sep not in _REGEX_META:
        return sep
    return "\\Q" + sep + "\\E"


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_INTEGERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)

#: The CSV parser's quote and comment sign: a character that no line holds, so there are none.
_NO_LINE_HOLDS = "\r"
_LINE_ENDS = r"(instr({0}, '\r') > 0 OR instr({0}, '\n') > 0)"


def _wrong(cell: str, value: str, data_type: T.DataType) -> str:
    """SQL: the text ``cell``, not NULL, has not the form of its type, or no ``value`` in it."""
    wrong = f"NOT {cell} RLIKE {_sql_str(_guard(data_type))} OR {value} IS NULL"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        wrong += f" OR abs({value}) >= double('Infinity')"  # beyond the type's range a cast gives an infinity
    return f"({wrong})"


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = "\t",
                    line_col: str = "_raw") -> DataFrame:
    """Typed columns and a plain boolean ``_ok`` for each text line.

    An empty field is NULL; a non-empty field must have its type's text form; a declared
    non-nullable field must be present; the line must have exactly as many fields as the schema,
    be valid UTF-8 and hold no line end. There are no quotes, escapes or
    comments: fields are what lies between separators, byte for byte.

    Spark's CSV parser splits the line, converts integers and reports a wrong
    number of fields; its quote and comment sign are set to a character that no accepted line holds.
    It takes decimal digits of any script, which a line of ASCII alone cannot
    have, so only the integers of other lines are looked at again. What it would accept too
    freely otherwise (``1d``, ``NaN``, ``1e400``, padded decimals) is read as text, checked by pattern
    and cast here. All of it is unpacked by one generator, so a filter on ``_ok`` is not pushed
    below it and no line is parsed twice. Reasons are made from the line itself, for rejected
    rows alone (``violations``).
    """
    for field in schema.fields:
        _guard(field.dataType)
    by_parser = (*_INTEGERS, T.StringType)
    fields = [T.StructField(f"c{i}", f.dataType if isinstance(f.dataType, by_parser) else T.StringType())
              for i, f in enumerate(schema.fields)] + [T.StructField("bad", T.StringType())]
    options = {"sep": sep, "quote": _NO_LINE_HOLDS, "comment": _NO_LINE_HOLDS, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "bad", "maxColumns": str(max(20480, 2 * len(fields)))}
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    staged = lines.select("*", F.from_csv(F.col(line_col), ddl, options).alias("_p"))
    raw = _ident(line_col)
    members, failed = [], ["_p IS NULL", f"{raw} = ''", "_p.bad IS NOT NULL", f"NOT is_valid_utf8({raw})", _LINE_ENDS.format(raw)]
    for i, field in enumerate(schema.fields):
        value = cell = f"_p.c{i}"
        if not isinstance(field.dataType, by_parser):
            value = f"try_cast({cell} AS {field.dataType.simpleString()})"
            failed.append(f"({cell} IS NOT NULL AND {_wrong(cell, value, field.dataType)})")
        if not field.nullable:
            failed.append(f"{cell} IS NULL")
        members.append(f"{_sql_str(field.name)}, {value}")
    other_digits = " OR ".join(f"get(f, {i}) RLIKE '[^0-9+-]'" for i, f in enumerate(schema.fields) if isinstance(f.dataType, _INTEGERS))
    if other_digits:
        cells = f"array(split({raw}, {_sql_str(_split_pattern(sep))}, -1))"
        failed.append(f"CASE WHEN octet_length({raw}) > length({raw}) THEN exists({cells}, f -> {other_digits}) ELSE false END")
    members.append(f"'_ok', NOT coalesce({' OR '.join(failed)}, true)")
    keep = [_ident(c) for c in lines.columns]
    return staged.selectExpr(*keep, f"inline(array(named_struct({', '.join(members)})))")


def violations(schema: T.StructType, sep: str = "\t", line_col: str = "_raw") -> Column:
    """``array<string>`` of reasons of a rejected line, from the line itself."""
    n = len(schema.fields)
    raw = _ident(line_col)
    reasons = [f"CASE WHEN {raw} IS NULL THEN 'no line' END",
               f"CASE WHEN NOT is_valid_utf8({raw}) THEN 'not valid UTF-8' END",
               f"CASE WHEN {_LINE_ENDS.format(raw)} THEN 'holds a line end' END",
               f"CASE WHEN size(f) <> {n} THEN concat('expected {n} fields, found ', CAST(size(f) AS STRING)) END"]
    for i, field in enumerate(schema.fields):
        cell = f"nullif(get(f, {i}), '')"
        if not isinstance(field.dataType, T.StringType):
            kind = field.dataType.simpleString()
            wrong = _wrong(cell, f"try_cast({cell} AS {kind})", field.dataType)
            reasons.append(f"CASE WHEN {cell} IS NOT NULL AND {wrong} THEN {_sql_str(f'{field.name}: not a {kind}')} END")
        if not field.nullable:
            reasons.append(f"CASE WHEN {cell} IS NULL THEN {_sql_str(field.name + ': required')} END")
    cells = f"array(split({raw}, {_sql_str(_split_pattern(sep))}, -1))"
    return F.expr(f"element_at(transform({cells}, f -> array_compact(array({', '.join(reasons)}))), 1)")


def read_lines(spark: SparkSession, paths: Paths, source: bool = True) -> DataFrame:
    """Text lines as ``_raw`` (renamed so a data column ``value`` cannot clash),
    with the source file name and path when ``source`` (about 20% of a
    validating scan's cost, so valid rows skip it unless asked)."""
    lines = spark.read.text(_paths(paths))
    cols = [F.col("value").alias("_raw")]
    if source:
        cols += [F.col("_metadata.file_name").alias("file_name"),
                 F.col("_metadata.file_path").alias("file_path")]
    return lines.select(*cols)


def strict_scan(spark: SparkSession, paths: Paths, schema: T.StructType,
                sep: str = "\t", keep_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects) — real validation of every record.

    ``rejects`` has ``file_name, _raw, violations``. ``keep_source=True`` also
    keeps ``file_name, file_path`` on valid rows (S10: the slice a row came
    from). Both outputs are lazy and read the text themselves; for both from one
    parse see ``strict_scan_once``.
    """
    source = ["file_name", "file_path"] if keep_source else []
    parsed = parse_delimited(read_lines(spark, paths, source=keep_source), schema, sep)
    valid = parsed.where("_ok").select(*[_column(f.name) for f in schema.fields], *source)
    rejects = (parse_delimited(read_lines(spark, paths), schema, sep).where(~F.col("_ok"))
               .select("file_name", "_raw", violations(schema, sep).alias("violations")))
    return valid, rejects


def _column(name: str) -> Column:
    return F.col(_ident(name))


def valid_and_rejected(parsed: DataFrame, schema: T.StructType, stage: str, sep: str = "\t",
                       columns: Sequence[Column] | None = None, keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects) of ``parse_delimited``'s rows, by one pass that stages both in the folder ``stage``.

    ``columns`` are the valid rows' columns (the schema's by default); ``keep`` may leave some of them out.
    """
    ok = F.col("_ok")
    out = fan_out(parsed, stage, {
        "valid": (ok if keep is None else ok & keep, columns or [_column(f.name) for f in schema.fields]),
        "rejects": (~ok, [F.col("file_name"), F.col("_raw"), violations(schema, sep).alias("violations")])})
    return out["valid"], out["rejects"]


def strict_scan_once(spark: SparkSession, paths: Paths, schema: T.StructType, sep: str = "\t",
                     stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``strict_scan`` by a single parse: one job reads the text and stages both outputs.

    The stage is a new folder below the shared checkpoint folder unless one is
    given; the caller deletes it when both tables are no longer read.
    """
    parsed = parse_delimited(read_lines(spark, paths), schema, sep)
    return valid_and_rejected(parsed, schema, stage or shared_dir(spark, "scan-stage"), sep)


def line_row_check(spark: SparkSession, paths: Paths, schema: T.StructType,
                   sep: str = "\t") -> DataFrame:
    """One row: text lines vs valid and rejected records, in one pass (V1)."""
    parsed = parse_delimited(read_lines(spark, paths, source=False), schema, sep)
    return (parsed.agg(F.count(F.lit(1)).alias("n_lines"),
                       F.count_if(F.col("_ok")).alias("n_valid"),
                       F.count_if(~F.col("_ok")).alias("n_rejected"))
            .withColumn("all_valid", F.col("n_rejected") == F.lit(0)))


def lookup_scan(spark: SparkSession, path: Paths, names: Sequence[str] = ("code", "label"),
                header: bool = False, sep: str = "\t") -> DataFrame:
    """Small delimited lookup, all columns string, renamed.

    CRLF line ends are fine: the line reader drops the ``\\r``.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (spark.read.schema(schema).option("sep", sep).option("quote", "")
            .option("header", str(header).lower()).csv(_paths(path)))


def dimension(spark: SparkSession, rows, schema: T.StructType | str | None = None) -> DataFrame:
    """A dimension from in-memory rows, or from a lookup file path."""
    if isinstance(rows, str):
        names = [f.name for f in schema.fields] if isinstance(schema, T.StructType) else ("code", "label")
        return lookup_scan(spark, rows, names)
    return spark.createDataFrame(list(rows), schema)


def read_events(spark: SparkSession, path: Paths, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (S7, S8). Pass ``schema`` to keep partition-column types and
    positions: an inferred ``bigint`` partition column would come back as
    ``int``, and a partition column is otherwise moved to the end. A table of
    published days is read in its newest state."""
    if isinstance(path, str) and is_published(spark, path):
        return read_published(spark, path, schema)
    if schema is None:
        return spark.read.parquet(*_paths(path))
    return (spark.read.schema(schema).parquet(*_paths(path))
            .select(*[F.col(f"`{n}`") for n in schema.fieldNames()]))


def with_source_file(df: DataFrame, name_col: str = "source_file",
                     size_col: str = "source_bytes") -> DataFrame:
    """Add each row's file name and file size from the scan metadata."""
    return df.select("*", F.col("_metadata.file_name").alias(name_col),
                     F.col("_metadata.file_size").alias(size_col))
