"""Data-quality reports: A8, Q1, Q2, V4-V6, A15-A16, A19.

Each report is one job where the reference ran several counts, and nothing is
collected to the driver: every result is a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covlens.functions.exprs import (
    as_col, is_weekend, pct, ratio, slice_floor, slice_from_file_name,
)
from covlens.operators.coverage import count_by, with_share
from covlens.operators.joins import place_small_side


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and % of rows, most empty first.

    One aggregate over all columns (every column is read, unlike a bare
    ``count()``), then the single result row is unpivoted.
    """
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_quoted(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n_null"))
                              for i, c in enumerate(cols)]))
    return (agg.select("_rows", rows)
            .select("column", "n_null", pct("n_null", "_rows").alias("pct_null"))
            .orderBy(F.col("n_null").desc(), "column"))


def _code_counts(df: DataFrame, code: str, weight: str | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    return df.where(F.col(code).isNotNull()).groupBy(code).agg(n.alias("_n"))


def _dim_keys(dim: DataFrame, dim_key: str, strategy: str) -> DataFrame:
    return place_small_side(dim.select(F.col(dim_key).alias("_k")).distinct(), strategy)


def match_rate(df: DataFrame, code: str, dim: DataFrame, dim_key: str,
               strategy: str = "auto", weight: str | None = None) -> DataFrame:
    """One row: non-NULL codes, matched / unmatched rows and %.

    NULL codes are outside the base (source incompleteness, not a dimension
    gap). Duplicate dimension keys cannot inflate the count: keys are made
    distinct first. ``weight``: the count column of rows that are counts already.
    """
    counts = _code_counts(df, code, weight)
    keys = _dim_keys(dim, dim_key, strategy)
    j = counts.join(keys, counts[code] == keys["_k"], "left")
    return (j.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_coded"),
                  F.coalesce(F.sum(F.when(F.col("_k").isNotNull(), F.col("_n"))), F.lit(0))
                  .cast("long").alias("n_matched"))
            .withColumn("n_unmatched", F.col("n_coded") - F.col("n_matched"))
            .withColumn("pct_matched", pct("n_matched", "n_coded"))
            .withColumn("pct_unmatched", pct("n_unmatched", "n_coded")))


def unmatched_codes(df: DataFrame, code: str, dim: DataFrame, dim_key: str,
                    strategy: str = "auto", ordered: bool = True,
                    weight: str | None = None) -> DataFrame:
    """Codes absent from the dimension, with their row counts."""
    counts = _code_counts(df, code, weight)
    keys = _dim_keys(dim, dim_key, strategy)
    out = (counts.join(keys, counts[code] == keys["_k"], "left_anti")
           .select(code, F.col("_n").alias("n_events")))
    return out.orderBy(F.col("n_events").desc(), code) if ordered else out


# ---------------------------------------------------------------- slices (V4)

def ntz_literal(value) -> Column:
    """A time-zone-free timestamp literal from a string or naive datetime."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(str(value)))


def slice_grid(spark: SparkSession, start, end, step_minutes: int = 15,
               out: str = "slot") -> DataFrame:
    """Every expected slot from ``start`` to ``end`` inclusive, built by ``range``.

    The grid is generated in parallel; it is never a driver-side list.
    """
    s = dt.datetime.fromisoformat(str(start))
    e = dt.datetime.fromisoformat(str(end))
    n = int((e - s).total_seconds() // (step_minutes * 60)) + 1
    minutes = F.col("id") * F.lit(step_minutes)
    offset = F.make_dt_interval(F.floor(minutes / 1440).cast("int"), F.lit(0),
                                (minutes % 1440).cast("int"), F.lit(0))
    return spark.range(max(n, 0)).select((ntz_literal(s) + offset).alias(out))


def _present_slots(df: DataFrame, ts: str, start, step_minutes: int, out: str) -> DataFrame:
    begin = ntz_literal(dt.datetime.fromisoformat(str(start)))
    return (df.select(slice_floor(ts, step_minutes, begin).alias(out)).where(F.col(out).isNotNull())
            .distinct().withColumn("_present", F.lit(True)))


def slice_completeness(df: DataFrame, ts: str, start, end, step_minutes: int = 15) -> DataFrame:
    """One row: expected slots, slots with data, missing slots (V4)."""
    grid = slice_grid(df.sparkSession, start, end, step_minutes, "slot")
    present = _present_slots(df, ts, start, step_minutes, "slot")
    return (grid.join(present, "slot", "left")
            .agg(F.count(F.lit(1)).alias("n_expected"), F.count("_present").alias("n_present"))
            .withColumn("n_missing", F.col("n_expected") - F.col("n_present")))


def missing_slices(df: DataFrame, ts: str, start, end, step_minutes: int = 15) -> DataFrame:
    """The expected slots that hold no row (V4)."""
    grid = slice_grid(df.sparkSession, start, end, step_minutes, "slot")
    present = _present_slots(df, ts, start, step_minutes, "slot")
    return grid.join(present, "slot", "left_anti")


#: Slots of one group of ``gap_runs``: what is sorted together.
GAP_BLOCK = 4096


def gap_runs(df: DataFrame, ts: str, start, end, step_minutes: int = 15) -> DataFrame:
    """Each run of expected slots without a row, as its first and last slot and its length (V4).

    Gaps and islands instead of a grid: the slots that are there, once each, are compared
    with the one before them. They are sorted in groups of ``GAP_BLOCK`` neighbouring slots, and
    then the ends of the groups, so that no task sorts them all; nothing is made
    for slots that are missing, however many there are. Slots outside ``start`` to
    ``end`` don't count.
    """
    first, last = (ntz_literal(dt.datetime.fromisoformat(str(x))) for x in (start, end))
    begin, stop = (dt.datetime.fromisoformat(str(x)) for x in (start, end))
    n = int((stop - begin).total_seconds() // (step_minutes * 60)) + 1
    floor = slice_floor(ts, step_minutes, first)
    minutes = F.datediff(F.to_date(floor), F.to_date(first)).cast("long") * 1440 + (
        F.hour(floor) * 60 + F.minute(floor) - F.hour(first) * 60 - F.minute(first))
    place = F.floor(minutes / F.lit(step_minutes)).cast("long")
    there = df.select(place.alias("k")).where((F.col("k") >= 0) & (F.col("k") < n)).distinct()
    there = there.withColumn("block", F.floor(F.col("k") / GAP_BLOCK))
    before = F.lag("k").over(Window.partitionBy("block").orderBy("k"))
    within = there.withColumn("before", before).where("k - before > 1").select("before", "k")
    ends = there.groupBy("block").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    # one row a block that holds a slot, and the two ends of the whole
    edges = ends.select("lo", "hi").unionByName(
        df.sparkSession.range(1).select(F.explode(F.array(F.lit(-1).cast("long"), F.lit(n).cast("long"))).alias("lo")).withColumn("hi", F.col("lo")))
    between = edges.withColumn("before", F.lag("hi").over(Window.orderBy("lo"))).where("lo - before > 1").select("before", F.col("lo").alias("k"))
    slot = lambda k: first + F.make_dt_interval(F.floor(k * step_minutes / 1440).cast("int"), F.lit(0), F.pmod(k * step_minutes, F.lit(1440)).cast("int"), F.lit(0))
    return within.unionByName(between).select(slot(F.col("before") + 1).alias("first_missing"), slot(F.col("k") - 1).alias("last_missing"),
                                              (F.col("k") - F.col("before") - 1).alias("n_missing"))


# ---------------------------------------------------------------- layouts

def file_listing(spark: SparkSession, path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of every data file under ``path``.

    The ``binaryFile`` source reads file bodies only when ``content`` is
    selected, so this is a pure listing. Hidden and ``_``-prefixed files
    (``_SUCCESS``, checksums) are skipped by the file index.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths).select("path", "length", "modificationTime")


def prefix_files(listing: DataFrame, fraction: float, path_col: str = "path") -> list[str]:
    """Paths of the first ``max(1, round(N * fraction))`` listed files, by name.

    The reference's volume subsets: whole slice files in chronological (name)
    order, chosen before anything is read. Selection runs on the listing with
    ``prefix_slices``; only the chosen paths come back to the driver, a subset
    of the file list it already holds for any scan. Paths are glob-escaped,
    ready to pass to a reader.
    """
    from covlens.operators.prepare import prefix_slices
    from covlens.sources.scan import literal_path

    chosen = prefix_slices(listing.select(path_col), path_col, fraction)
    return [literal_path(p) for p in sorted(r[0] for r in chosen.collect())]


def prefix_scan(rows: DataFrame, listing: DataFrame, fraction: float, path_col: str = "path") -> DataFrame:
    """Rows of the first ``max(1, round(N * fraction))`` listed files, by file name.

    ``rows`` is a file scan, ``listing`` its ``file_listing``. The cutoff is found on the
    listing; the scan then filters on ``_metadata.file_name``, by which Spark leaves out
    the files beyond it before it plans a task. No list of paths is made.
    """
    from covlens.operators.prepare import prefix_cutoff

    top = prefix_cutoff(listing.select(F.regexp_extract(path_col, "([^/]*)$", 1).alias("name")), "name", fraction)
    # a scan has names escaped as in a URI, a listing as they are
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return rows.where(F.lit(False)) if top is None else rows.where(name <= F.lit(top))


def listed_slices(listing: DataFrame, out: str = "slot",
                  pattern: str = r"/([0-9]{14})[^/]*$") -> DataFrame:
    """Slice start of every listed file, parsed from its path.

    By default the stamp is the start of the file name
    (``…/YYYYMMDDHHMMSS.export.CSV``); pass another ``pattern`` (first group =
    14 digits) for e.g. one folder per slice. Feeds ``slice_completeness``
    from a file listing alone: the download check reads no file.
    """
    return listing.select(slice_from_file_name("path", pattern).alias(out), "length")


def layout_sizes(spark: SparkSession, layouts: Mapping[str, str]) -> DataFrame:
    """Files and bytes of several layouts of the same data, and their size ratio (V5)."""
    parts = [file_listing(spark, p).agg(F.count(F.lit(1)).alias("n_files"),
                                        F.coalesce(F.sum("length"), F.lit(0)).cast("long")
                                        .alias("n_bytes"))
             .select(F.lit(name).alias("layout"), "n_files", "n_bytes")
             for name, p in layouts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("size_ratio", ratio("n_bytes", out.agg(F.min("n_bytes")).scalar()))


def slice_sizes(listing: DataFrame) -> DataFrame:
    """One row: files, total and mean bytes per file of a listing."""
    return (listing.agg(F.count(F.lit(1)).alias("n_files"),
                        F.sum("length").cast("long").alias("n_bytes"))
            .withColumn("avg_bytes_per_file", ratio("n_bytes", "n_files")))


def size_per_day(listing: DataFrame, day_pattern: str) -> DataFrame:
    """Files and bytes per day, the day taken from the path by ``day_pattern``.

    ``day_pattern`` is a regex whose first group is the day.
    """
    day = F.regexp_extract("path", day_pattern, 1)
    return (listing.groupBy(day.alias("day"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").cast("long").alias("n_bytes")))


def size_by_weekpart(listing: DataFrame, day_pattern: str) -> DataFrame:
    """Bytes per day on weekdays vs weekend days, from a listing.

    Each part's total is divided by its number of distinct days, so a
    two-day weekend is compared per day with a single weekday (the 48 h → 24 h
    normalisation). ``day_pattern``'s first group is the day as ``yyyyMMdd``.
    """
    day = F.to_date(F.regexp_extract("path", day_pattern, 1), "yyyyMMdd")
    return (listing.select(day.alias("_day"), "length").where(F.col("_day").isNotNull())
            .groupBy(is_weekend("_day").alias("weekend"))
            .agg(F.count_distinct("_day").alias("n_days"), F.count(F.lit(1)).alias("n_files"),
                 F.sum("length").cast("long").alias("n_bytes"))
            .withColumn("bytes_per_day", ratio("n_bytes", "n_days")))


def layouts_agree(left: DataFrame, right: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """One row: do two layouts give the same groups and counts (V6)?

    Both sides are aggregated with ``count_by`` and compared with a
    NULL-safe full outer join (NULL is a group too).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    lc = count_by(left, cols, "_nl").select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(cols)], "_nl")
    rc = count_by(right, cols, "_nr").select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(cols)], "_nr")
    cond = None
    for i in range(len(cols)):
        c = F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}"))
        cond = c if cond is None else cond & c
    j = lc.join(rc, cond, "full_outer")
    return (j.agg(F.count("_nl").alias("n_groups_left"), F.count("_nr").alias("n_groups_right"),
                  F.count_if(~F.col("_nl").eqNullSafe(F.col("_nr"))).alias("n_differing"))
            .withColumn("agree", F.col("n_differing") == F.lit(0)))


# ---------------------------------------------------------------- periods

def period_distribution(df: DataFrame, period: str | Column, out: str = "period") -> DataFrame:
    """Rows per period with % of all rows.

    ``period`` is a column or expression (``functions.period``,
    ``operators.prepare.window_period``).
    """
    grouped = df.groupBy(as_col(period).alias(out)).agg(F.count(F.lit(1)).alias("n_events"))
    return with_share(grouped, "n_events", "pct")


def retrospective_by_slice(df: DataFrame, event_day: str | Column, ingest_day: str | Column,
                           before, out: str = "ingest_day") -> DataFrame:
    """Rows whose event day precedes ``before``, counted per ingest day.

    Tells whether late-arriving old events are spread evenly or come in spikes.
    """
    return (df.where(as_col(event_day) < F.lit(before))
            .groupBy(as_col(ingest_day).alias(out)).agg(F.count(F.lit(1)).alias("n_events")))
