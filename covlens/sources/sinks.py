"""Sinks K1-K4 and the delimited writer used for text layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str],
                      sort: Sequence[str] = (), overwrite: str = "static",
                      n_partitions: int | None = None, shuffle: str = "range") -> None:
    """Overwrite Parquet partitioned by ``by`` (K1, K2).

    Rows are range-partitioned on (by, sort) — not hash-partitioned on the day
    alone, which would push a whole (possibly hot) day through one task — so a
    large day spreads over several tasks and each task writes few folders.
    ``overwrite="dynamic"`` replaces only the partitions present in ``df``.

    ``shuffle="rebalance"`` deals rows by ``by`` and leaves it to AQE to split large
    keys and to put small ones together: unlike a range shuffle it computes ``df`` once.
    ``shuffle="none"`` writes map-side with no exchange: right only when each
    task's rows are of a few days already. Spark packs files into tasks by size,
    so time-ordered files alone don't make it so.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    by = [by] if isinstance(by, str) else list(by)
    keys = [*by, *sort]
    if shuffle not in ("range", "rebalance", "none"):
        raise ValueError("shuffle must be 'range', 'rebalance' or 'none'")
    if shuffle == "range":
        parts = [n_partitions] if n_partitions else []
        df = df.repartitionByRange(*parts, *keys)
    elif shuffle == "rebalance":
        df = df.hint("rebalance", *by)
    (df.sortWithinPartitions(*keys)
     .write.mode("overwrite").option("partitionOverwriteMode", overwrite)
     .partitionBy(*by).parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unpartitioned Parquet (K3)."""
    df.write.mode(mode).parquet(path)


def fan_out(df: DataFrame, path: str, outputs: Mapping[str, tuple[Column, Sequence[Column]]]) -> dict[str, DataFrame]:
    """Several tables from one pass over ``df``, staged in ``path``.

    ``outputs`` maps a name to the condition of its rows and to its columns; a row goes to
    the first output whose condition holds, or to none. One job writes them all, so ``df``
    is computed once whatever is read later; each returned table reads its own folder and columns.
    Names are used as folder names.
    """
    names = list(outputs)
    kind = F.when(outputs[names[0]][0], names[0])
    for name in names[1:]:
        kind = kind.when(outputs[name][0], name)
    rows = [F.when(kind == name, F.struct(*cols)).alias(f"o{i}") for i, (name, (_, cols)) in enumerate(outputs.items())]
    staged = df.select(*rows, kind.alias("output")).where("output is not null")
    schema = staged.schema
    staged.write.partitionBy("output").parquet(path)
    written = df.sparkSession.read.schema(schema).parquet(path)
    return {name: written.where(F.col("output") == name).select(f"o{i}.*") for i, name in enumerate(names)}


def roundtrip_check(df: DataFrame, path: str) -> DataFrame:
    """Write, read back, compare row counts (K4). Returns one row; ``df`` is computed once."""
    seen = Observation("roundtrip")
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
    back = df.sparkSession.read.parquet(path)
    return (back.agg(F.count(F.lit(1)).alias("n_read"))
            .withColumn("n_written", F.lit(int(seen.get["n"])).cast("long"))
            .withColumn("equal", F.col("n_read") == F.col("n_written")))


def to_delimited_line(df: DataFrame, sep: str = "\t", exclude: Sequence[str] = ()) -> "F.Column":
    """One text line per row; NULL becomes an empty field (fields never shift)."""
    cols = [c for c in df.columns if c not in exclude]
    return F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols])


def write_delimited(df: DataFrame, path: str, sep: str = "\t",
                    partition_by: Sequence[str] = (), mode: str = "overwrite",
                    one_file: bool = False) -> None:
    """Write rows as unquoted delimited text, optionally one folder per key.

    ``one_file`` gives each key exactly one file, written by one task: for slices that are files by definition.
    """
    line = to_delimited_line(df, sep, exclude=partition_by)
    out = df.select(line.alias("value"), *partition_by)
    if one_file:
        out = out.repartition(*partition_by)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)
