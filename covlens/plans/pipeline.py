"""The batch pipeline as functions: clean (E1) and the two aggregation axes.

Parameters replace the reference's command-line flags. Reports come back as
DataFrames; nothing is printed.

``clean`` parses the raw text once: the one pass that writes the days also counts lines,
valid and kept rows and notes the days (a DataFrame ``Observation``). Only where
rejects go to a table of their own are rows staged in the shared folder first. Each axis aggregates its
events once; with ``reuse`` its tables and reports all read that aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.operators.coverage import coverage_from_partials, coverage_partials
from covlens.operators.joins import unique_by
from covlens.operators.pairs import pair_filter_report, pair_partials, pairs_from_partials
from covlens.operators.prepare import alias_impact, normalize_codes, project
from covlens.operators.quality import match_rate, unmatched_codes
from covlens.profiles import KEPT_COLUMNS, QUAD_CLASSES, raw_event_schema
from covlens.session import delete_path, folder_names, shared_dir
from covlens.sources.publish import inside, new_version, publish, published, vacuum
from covlens.sources.scan import parse_delimited, read_events, violations
from covlens.sources.sinks import fan_out, write_partitioned, write_table

CLEAN_REPORT_SCHEMA = T.StructType([
    T.StructField("n_lines", T.LongType()), T.StructField("n_valid", T.LongType()),
    T.StructField("n_rejected", T.LongType()), T.StructField("n_kept", T.LongType()),
    T.StructField("n_removed", T.LongType()), T.StructField("pct_removed", T.DoubleType()),
])


def clean(spark: SparkSession, raw_paths: str | Sequence[str], out_path: str, start, end, *,
          schema: T.StructType | None = None, kept: Sequence[str] = KEPT_COLUMNS,
          day_col: str = "SQLDATE", derived: Mapping[str, Column] | None = None,
          sep: str = "\t", overwrite: str = "dynamic",
          rejects_path: str | None = None) -> DataFrame:
    """Raw delimited slices → validated, projected, windowed, day-partitioned Parquet.

    ``derived`` adds computed columns (e.g. a day from a timestamp) before the
    projection. ``rejects_path`` is always overwritten, with no rows if every
    record is valid. ``overwrite="dynamic"`` keeps days outside the window; days
    inside it are this run's, so one whose rows are gone is removed.
    ``overwrite="publish"`` does the same as a unit: readers (``read_events``) see
    all days as they were or all as they are now, wherever the run stops. Files are
    clustered by day, and a large day is split. Returns the one-row removal report.
    """
    if overwrite not in ("dynamic", "static", "publish"):
        raise ValueError("overwrite must be 'dynamic', 'static' or 'publish'")
    schema = schema or raw_event_schema()
    lines = spark.read.text(raw_paths if isinstance(raw_paths, str) else list(raw_paths))
    lines = lines.select(F.col("value").alias("_raw"),
                         *([F.col("_metadata.file_name").alias("_file")] if rejects_path else []))
    parsed = parse_delimited(lines, schema, sep)
    for name, expr in (derived or {}).items():
        parsed = parsed.withColumn(name, expr)
    ok = F.col("_ok")
    inside_window = ok & F.col(day_col).between(F.lit(start), F.lit(end))
    obs = Observation("clean")
    counts = [F.count(F.lit(1)).alias("n_lines"), F.count_if(ok).alias("n_valid"), F.count_if(inside_window).alias("n_kept"),
              F.collect_set(F.when(inside_window, F.col(day_col))).alias("days")]  # days of one window
    observed = parsed.observe(obs, *counts)
    columns = [F.col(f"`{c}`") for c in kept]
    reject = [F.col("_file").alias("file_name"), F.col("_raw"), violations(schema, sep).alias("violations")] if rejects_path else []
    sort = [c for c in kept if c != day_col][:1]
    day_type = parsed.schema[day_col].dataType
    if overwrite == "publish":
        _clean_published(observed, out_path, inside_window, columns, ~ok, reject, rejects_path, day_col, day_type, start, end, sort)
    elif rejects_path:
        stage = shared_dir(spark, "clean-stage")
        out = fan_out(observed, stage, {"kept": (inside_window, columns), "rejects": (~ok, reject)})
        write_partitioned(out["kept"], out_path, day_col, sort=sort, overwrite=overwrite, shuffle="rebalance")
        write_table(out["rejects"], rejects_path)
        delete_path(spark, stage)
    else:
        write_partitioned(observed.where(inside_window).select(*columns), out_path, day_col, sort=sort,
                          overwrite=overwrite, shuffle="rebalance")
    try:
        m = obs.get
    except Py4JJavaError:  # where nothing was to be written, AQE has left the observed part out
        m = parsed.agg(*counts).first().asDict()
    if overwrite == "dynamic":
        drop_days(spark, out_path, day_col, day_type, start, end, keep=list(m["days"]))
    n_lines, n_valid, n_kept = int(m["n_lines"]), int(m["n_valid"]), int(m["n_kept"])
    removed = n_valid - n_kept
    return spark.createDataFrame(
        [(n_lines, n_valid, n_lines - n_valid, n_kept, removed,
          (100.0 * removed / n_valid) if n_valid else None)], CLEAN_REPORT_SCHEMA)


def _clean_published(observed: DataFrame, out_path: str, is_kept: Column, columns: Sequence[Column], is_reject: Column,
                     reject: Sequence[Column], rejects_path: str | None, day_col: str, day_type: T.DataType, start, end,
                     sort: Sequence[str]) -> None:
    """One write of kept rows and rejects into a new version of the table, then its days are published."""
    spark, base, version = observed.sparkSession, published(observed.sparkSession, out_path), new_version(out_path)
    kind = F.when(is_kept, 1).when(is_reject, 0) if reject else F.when(is_kept, 1)
    bad = [F.when(is_reject, c).alias(n) for c, n in zip(reject, ("_file", "_raw", "_violations"), strict=False)]
    staged = observed.select(kind.alias("_kind"), *columns, *bad).where("_kind is not null")
    root = f"{out_path.rstrip('/')}/{version}"
    (staged.hint("rebalance", "_kind", day_col).sortWithinPartitions("_kind", day_col, *sort)
     .write.partitionBy("_kind", day_col).parquet(root))
    new = {n: f"{version}/_kind=1/{n}" for n in folder_names(spark, f"{root}/_kind=1")}
    gone = inside(spark, base.folders, day_type, start, end)
    publish(spark, out_path, base, {d: f for d, f in base.folders.items() if d not in gone} | new, base.notes)
    vacuum(spark, out_path)
    if rejects_path:
        rows = spark.read.schema(staged.drop(*[c for c in staged.columns if c not in ("_kind", "_file", "_raw", "_violations")]).schema)
        write_table(rows.parquet(root).where("_kind = 0")
                    .select(F.col("_file").alias("file_name"), "_raw", F.col("_violations").alias("violations")), rejects_path)


def drop_days(spark: SparkSession, path: str, day_col: str, kind: T.DataType, start, end, keep) -> None:
    """Deletes the day folders of ``path`` between ``start`` and ``end`` that are not in ``keep``."""
    there = [n.partition("=")[2] for n in folder_names(spark, path) if n.startswith(f"{day_col}=")]
    if not there:
        return
    days = spark.createDataFrame([(v,) for v in there], "name string").withColumn("day", F.col("name").try_cast(kind))
    days = days.where(F.col("day").between(F.lit(start), F.lit(end)))
    for row in days.collect():
        if row["day"] not in keep:
            delete_path(spark, f"{path.rstrip('/')}/{day_col}={row['name']}")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: what an axis' tables and reports read."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def aggregate_places(events: DataFrame, geo: DataFrame, out_path: str | None = None, *,
                     code: str = "ActionGeo_CountryCode", day: str = "SQLDATE",
                     geo_key: str = "code", geo_label: str = "label",
                     aliases: Mapping | DataFrame | None = None, measure: str = "AvgTone",
                     category: str = "QuadClass", categories: Mapping = QUAD_CLASSES,
                     scale: int | None = None, check_unique: bool = True,
                     reuse: bool | None = None) -> dict[str, DataFrame]:
    """Axis 1 (E2): alias impact, match report, daily coverage per place.

    The events are read once, into counts and sums per (raw code, day); alias
    mapping, reports and coverage work on those. Writes the coverage partitioned
    by day when ``out_path`` is given and returns the written table. With
    ``check_unique`` a repeated dimension key fails the job that reads it.
    ``reuse`` writes the counts and sums before any report is made, for callers of more than one
    (by default when a table is written); else each report that is read aggregates the events.
    """
    partials = coverage_partials(events, code, day, measure=measure, category=category,
                                 categories=categories, scale=scale)
    if reuse if reuse is not None else out_path is not None:
        partials = _written(partials, "places")
    normalized = normalize_codes(partials, code, aliases) if aliases is not None else partials
    coverage = coverage_from_partials(normalized, geo, code, day, dim_key=geo_key, label=geo_label,
                                      categories=categories, mean_name="avg_tone", scale=scale,
                                      check_unique=check_unique)
    if out_path:
        write_partitioned(coverage, out_path, day, sort=[code])
        coverage = read_events(events.sparkSession, out_path, schema=coverage.schema)
    return {
        "alias_impact": alias_impact(partials, code, aliases, weight="n_events") if aliases is not None else None,
        "match_rate": match_rate(normalized, code, geo, geo_key, weight="n_events"),
        "unmatched_codes": unmatched_codes(normalized, code, geo, geo_key, weight="n_events"),
        "coverage": coverage,
    }


def aggregate_pairs(events: DataFrame, types: DataFrame, out_path: str | None = None, *,
                    a: str = "Actor1CountryCode", b: str = "Actor2CountryCode",
                    type_key: str = "code", type_col: str = "entity_type",
                    entity_type: str = "country", measure: str = "AvgTone",
                    scale: int | None = None, check_unique: bool = True,
                    reuse: bool | None = None) -> dict[str, DataFrame]:
    """Axis 2 (E3): match report per role, pair filter accounting, directed pairs.

    The events are read once, into counts and sums per (A, B). With
    ``check_unique`` a repeated code in the classification fails the job. ``reuse`` as in ``aggregate_places``.
    """
    if check_unique:
        types = unique_by(types.select(type_key, type_col), type_key)
    partials = pair_partials(events, a, b, measure=measure, scale=scale)
    if reuse if reuse is not None else out_path is not None:
        partials = _written(partials, "pairs")
    pairs = pairs_from_partials(partials, types, a, b, type_key=type_key, type_col=type_col,
                                entity_type=entity_type, mean_name="avg_tone", scale=scale)
    if out_path:
        write_table(pairs, out_path)
        pairs = read_events(events.sparkSession, out_path, schema=pairs.schema)
    return {
        "match_rate_a": match_rate(partials, a, types, type_key, weight="n_events"),
        "match_rate_b": match_rate(partials, b, types, type_key, weight="n_events"),
        "pair_filter": pair_filter_report(partials, types, a, b, type_key=type_key,
                                          type_col=type_col, entity_type=entity_type, weight="n_events"),
        "pairs": pairs,
    }
