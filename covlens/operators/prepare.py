"""Projection, time window, removal accounting, code aliases, prefix subsets.

Operators P1-P3, P6, P7 and S9.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.functions.exprs import as_col, pct
from covlens.operators.joins import DEFAULT_BROADCAST_BYTES, place_small_side, unique_by
from covlens.session import delete_path, shared_dir


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep only ``columns`` (P1): reaches the scan as ``ReadSchema``."""
    return df.select(*columns)


def time_window(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows with ``start <= col <= end`` (P2); NULL keys are dropped.

    A literal range on a partition column becomes a ``PartitionFilter``.
    """
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))


def window_report(df: DataFrame, col: str, start, end) -> DataFrame:
    """One row: rows read, kept, removed and % removed by ``time_window``.

    A single conditional aggregate; NULL keys count as removed.
    """
    inside = F.col(col).between(F.lit(start), F.lit(end))
    return (df.agg(F.count(F.lit(1)).alias("n_read"), F.count_if(inside).alias("n_kept"))
            .withColumn("n_removed", F.col("n_read") - F.col("n_kept"))
            .withColumn("pct_removed", pct("n_removed", "n_read"))
            .select("n_read", "n_kept", "n_removed", "pct_removed"))


def window_period(col: str | Column, start, end, labels=("before", "within", "after")) -> Column:
    """Label a key as before / within / after an inclusive window."""
    c = as_col(col)
    return (F.when(c < F.lit(start), F.lit(labels[0]))
            .when(c > F.lit(end), F.lit(labels[2]))
            .when(c.isNotNull(), F.lit(labels[1])))


# ---------------------------------------------------------------- aliases

def check_aliases(aliases: Mapping) -> None:
    """Aliases are one level, and neither an alias nor a canonical code is None."""
    if any(a is None or c is None for a, c in aliases.items()):
        raise ValueError("an alias or canonical code is None")
    chained = sorted({str(c) for c in aliases.values() if c in aliases})
    if chained:
        raise ValueError(f"alias chain: canonical codes {chained} are also aliases")


def assert_one_level(aliases: DataFrame, alias_col: str = "alias", canonical_col: str = "canonical") -> None:
    """Raise when a canonical code of an alias table is itself an alias. Runs a job."""
    chained = (aliases.select(F.col(canonical_col).alias("_c"))
               .join(aliases.select(F.col(alias_col).alias("_c")), "_c", "left_semi")
               .limit(1).collect())
    if chained:
        raise ValueError(f"alias chain: canonical code {chained[0][0]!r} is also an alias")


def _alias_frame(df: DataFrame, col: str, aliases: Mapping | DataFrame, alias_col: str,
                 canonical_col: str) -> DataFrame:
    """(_alias, _canon) rows without NULLs; a repeated alias fails the job that reads them."""
    if isinstance(aliases, Mapping):
        check_aliases(aliases)
        kind = df.schema[col].dataType
        fields = T.StructType([T.StructField("_alias", kind), T.StructField("_canon", kind)])
        return df.sparkSession.createDataFrame(list(aliases.items()), fields)
    rows = aliases.select(F.col(alias_col).alias("_alias"), F.col(canonical_col).alias("_canon"))
    return unique_by(rows.where("_alias is not null and _canon is not null"), "_alias")


def normalize_codes(df: DataFrame, col: str, aliases: Mapping | DataFrame, out: str | None = None,
                    alias_col: str = "alias", canonical_col: str = "canonical",
                    strategy: str = "auto", max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Replace alias codes by their canonical code, once.

    Other codes are unchanged and NULL stays NULL. A dict of any size is a map
    literal (no join); a table is joined, and a repeated alias in it fails the
    job instead of multiplying rows. ``assert_one_level`` checks a table for chains.
    """
    out = out or col
    if isinstance(aliases, Mapping):
        check_aliases(aliases)
        if not aliases:
            return df.withColumn(out, F.col(col))
        lookup = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        return df.withColumn(out, F.coalesce(F.try_element_at(lookup, F.col(col)), F.col(col)))
    amap = place_small_side(_alias_frame(df, col, aliases, alias_col, canonical_col), strategy, max_bytes)
    joined = df.join(amap, df[col] == amap["_alias"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_canon"), F.col(col)))
            .drop("_alias", "_canon"))


def alias_impact(df: DataFrame, col: str, aliases: Mapping | DataFrame, weight: str | None = None,
                 alias_col: str = "alias", canonical_col: str = "canonical") -> DataFrame:
    """Per canonical code: rows before / after normalisation and rows recovered.

    One count per code of the fact table, joined to the aliases; a canonical code
    without rows has zeros. ``weight``: the count column of rows that are counts already.
    """
    rows = _alias_frame(df, col, aliases, alias_col, canonical_col)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_code")).agg(n.alias("_n"))
    members = (rows.select("_canon", F.col("_alias").alias("_code"), F.lit(0).alias("_own"))
               .unionByName(rows.select("_canon").distinct()
                            .select("_canon", F.col("_canon").alias("_code"), F.lit(1).alias("_own"))))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return (members.join(counts, "_code", "left").groupBy(F.col("_canon").alias("canonical"))
            .agg(total(F.col("_n") * F.col("_own")).alias("n_before"), total(F.col("_n")).alias("n_after"))
            .withColumn("n_recovered", F.col("n_after") - F.col("n_before")))


# ---------------------------------------------------------------- prefix subsets

def prefix_cutoff(df: DataFrame, unit_col: str, fraction: float):
    """The last of the first ``max(1, round(N * fraction))`` units in their order; None without units.

    Rounding is half to even. Range partitions of the units are counted, and one of them is
    searched: two small jobs, of which only the counts and the cutoff come to the driver.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "units")
    units = df.select(F.col(unit_col).alias("unit")).where("unit is not null").distinct()
    kind = units.schema["unit"].dataType
    units.repartitionByRange("unit").sortWithinPartitions("unit").withColumn("part", F.spark_partition_id()).write.parquet(path)
    written = spark.read.schema(T.StructType([T.StructField("unit", kind), T.StructField("part", T.IntegerType())])).parquet(path)
    sizes = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    keep, top = max(1, round(sum(n for _, n in sizes) * fraction)), None
    for part, n in sizes:
        if keep <= n:
            # the largest of the smallest ``keep`` units of this part
            top = written.where(F.col("part") == part).orderBy("unit").limit(keep).agg(F.max("unit")).first()[0]
            break
        keep -= n
    delete_path(spark, path)
    return top


def prefix_slices(df: DataFrame, unit_col: str, fraction: float) -> DataFrame:
    """Rows of the first ``max(1, round(N * fraction))`` units in name order.

    Units are whole files/slices/days, not random rows. The kept units form a prefix,
    so the result is a plain filter ``unit <= cutoff`` (see ``prefix_cutoff``).
    """
    top = prefix_cutoff(df, unit_col, fraction)
    return df.filter(F.lit(False)) if top is None else df.filter(F.col(unit_col) <= F.lit(top))
