"""Query catalogue: one Spark DataFrame query per operator, plus its SQL oracle.

Each query is the library operator applied to a binding (see ``bindings``).
The oracle is an independent SQL text of the same computation for DuckDB over
the same Parquet tables. Column names match one to one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.functions.exprs import day_from_int, period, starts_with
from covlens.operators.coverage import (
    category_ratio, code_drilldown, count_by, coverage_daily, daily_volume, events_per_day,
    n_groups, top_codes, totals_by_code, volume_vs_base, weekend_drop,
)
from covlens.operators.joins import (
    dimension_diff, duplicate_labels, join_dimension, label_codes, validate_dimension,
)
from covlens.operators.pairs import (
    domestic_share, entity_distribution, exclusion_breakdown, exclusion_causes,
    pair_filter_report, pair_interactions, pairs_from_partials, tone_summary, top_pairs,
)
from covlens.operators.prepare import (
    alias_impact, normalize_codes, prefix_slices, time_window, window_period, window_report,
)
from covlens.operators.quality import (
    file_listing, gap_runs, layout_sizes, layouts_agree, listed_slices, match_rate, missing_slices,
    null_profile, period_distribution, prefix_scan, retrospective_by_slice, size_by_weekpart,
    size_per_day, slice_completeness, slice_sizes, unmatched_codes,
)
from covlens.plans import bindings as B
from covlens.plans.pipeline import aggregate_pairs, aggregate_places, clean
from covlens.plans.refresh import merge_coverage, merge_pairs, refresh_coverage, stored
from covlens.profiles import KEPT_COLUMNS, QUAD_CLASSES, RAW_EVENT_FIELDS, raw_event_schema
from covlens.session import session_key, shared_dir
from covlens.sources.scan import line_row_check, read_events, strict_scan, strict_scan_once, typed_scan, with_source_file
from covlens.sources.sinks import roundtrip_check, write_partitioned
from covlens.streaming.ingest import clean_incremental

Query = Callable[[SparkSession, str], DataFrame]

_D = dt.date.fromisoformat
CATEGORY_COLS = list(B.CATEGORIES.values())


# ---------------------------------------------------------------- B1 queries

def _coverage(spark, d):
    return coverage_daily(B.normalized_events(spark, d), B.nation_dim(spark, d), "code", "day",
                          dim_key="n_nationkey", label="n_name", measure="value",
                          category="event_type", categories=B.CATEGORIES, mean_name="avg_value",
                          scale=B.DECIMALS)


def _coverage_as_is(spark, d):
    """The mean of unrounded values with many decimals, some NULL, codes mapped by a table."""
    ev = B.coded_events(spark, d).withColumn("measure", B.fine_measure())
    aliases = spark.createDataFrame(list(B.ALIASES.items()), "alias int, canonical int")
    ev = normalize_codes(ev, "raw_code", aliases, out="code")
    return coverage_daily(ev, B.nation_dim(spark, d), "code", "day", dim_key="n_nationkey",
                          label="n_name", measure="measure", category="event_type",
                          categories=B.CATEGORIES, mean_name="avg_value", ordered=True,
                          check_unique=True)


def _alias_table(spark, n):
    """``n`` aliases as a dict: codes from 28 up, each to a code below 25."""
    return {28 + i: (3 + i) % 25 for i in range(n)}


def _pairs(spark, d):
    return pair_interactions(B.pair_events(spark, d), B.entity_types(spark, d), "a", "b",
                             type_key="code", type_col="entity_type",
                             entity_type=B.ENTITY_TYPE, measure="tone", mean_name="avg_tone",
                             scale=B.DECIMALS)


def _pair_kw():
    return dict(type_key="code", type_col="entity_type", entity_type=B.ENTITY_TYPE)


def _top_pairs(spark, d):
    return top_pairs(_pairs(spark, d), "a", "b", 15, dim=B.nation_dim(spark, d),
                     dim_key="n_nationkey", label="n_name")


def _dup_label_dim(spark, d):
    n = B.nation_dim(spark, d)
    return n.unionByName(n.where(F.col("n_nationkey") == 0)
                         .select((F.col("n_nationkey") + 25).alias("n_nationkey"), "n_name"))


def _dup_key_dim(spark, d):
    n = B.table(spark, d, "nation")
    return n.unionByName(n.where(F.col("n_nationkey") == 5))


def _row_join(strategy, salt_buckets=1):
    def q(spark, d):
        ev = B.normalized_events(spark, d).select("event_id", "code")
        return join_dimension(ev, B.nation_dim(spark, d), "code", "n_nationkey", "inner", strategy,
                              salt_buckets=salt_buckets)
    return q


def _partitioned_roundtrip(spark, d):
    df = B.coded_events(spark, d)
    path = shared_dir(spark, "coded-by-day")
    write_partitioned(df, path, "day", sort=["event_id"], overwrite="dynamic")
    return read_events(spark, path, schema=df.schema).select(*df.columns)


def _retro(spark, d):
    ev = B.table(spark, d, "events")
    ingest = F.to_date("ts")
    shaped = ev.select(ingest.alias("ingest_day"),
                       F.date_sub(ingest, (F.col("user_id") % B.RETRO_MODULUS).cast("int"))
                       .alias("event_day"))
    return retrospective_by_slice(shaped, "event_day", "ingest_day", _D(B.RETRO_BEFORE))


def _clean(spark, d):
    """E1 on the text layout of ``events``: validate, derive day, window, write."""
    text = B.events_text_layout(spark, d)
    out = shared_dir(spark, "clean")
    report = clean(spark, text, out, _D(B.WINDOW_START), _D(B.WINDOW_END),
                   schema=B.EVENTS_SCHEMA, kept=CLEAN_KEPT, day_col="day",
                   derived={"day": F.to_date("ts")})
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType()),
                           T.StructField("day", T.DateType())])
    return report, read_events(spark, out, schema=schema).select(*CLEAN_KEPT)


CLEAN_KEPT = ["event_id", "day", "user_id", "event_type", "value"]

_RAW_CONSOLIDATED: dict[tuple[str, str], str] = {}


def _raw_kept_schema():
    schema = raw_event_schema()
    return T.StructType([schema[c] for c in KEPT_COLUMNS])


def _raw_clean(spark, d):
    """E1 on the 61-column raw feed: validate every field, window, consolidate."""
    out = shared_dir(spark, "raw-clean")
    report = clean(spark, B.raw_feed_layout(spark, d), out, *B.RAW_WINDOW)
    return report, out


def _raw_clean_incremental(spark, d):
    """E1 on the raw feed as a file stream over its day folders (availableNow)."""
    out = shared_dir(spark, "raw-clean-stream")
    clean_incremental(spark, f"{B.raw_feed_layout(spark, d)}/ingest_day=*/", out, *B.RAW_WINDOW)
    return read_events(spark, out, schema=_raw_kept_schema())


def _dirty_clean(spark, d):
    """E1 on the dirty feed, rejects written (second pass over the bad files only)."""
    out, rej = shared_dir(spark, "dirty-clean"), shared_dir(spark, "dirty-rejects")
    report = clean(spark, B.dirty_feed_layout(spark, d), out, *B.RAW_WINDOW, rejects_path=rej)
    return report, rej


def _reasons(rejects):
    return count_by(rejects.select(F.explode("violations").alias("violation")), "violation")


def _raw_consolidated(spark, d):
    """The consolidated raw feed, cleaned once per session and shared by axes 1 and 2."""
    key = (session_key(spark), d)
    path = _RAW_CONSOLIDATED.get(key)
    if path is None:
        path = _RAW_CONSOLIDATED[key] = _raw_clean(spark, d)[1]
    return read_events(spark, path, schema=_raw_kept_schema())


def _raw_places(spark, d):
    return aggregate_places(_raw_consolidated(spark, d), B.geo_dim(spark, d),
                            aliases=B.RAW_ALIASES, scale=B.DECIMALS)


def _raw_axis2(spark, d):
    return aggregate_pairs(_raw_consolidated(spark, d), B.actor_types(spark, d), scale=B.DECIMALS)


def _raw_places_written(spark, d):
    """E2's product: the coverage as written, partitioned by day, and read back."""
    return aggregate_places(_raw_consolidated(spark, d), B.lookup_dim(spark, d), shared_dir(spark, "geo-daily"),
                            geo_key="code", geo_label="label", aliases=B.RAW_ALIASES, scale=B.DECIMALS)["coverage"]


def _raw_pairs_written(spark, d):
    """E3's product, as written and read back."""
    return aggregate_pairs(_raw_consolidated(spark, d), B.actor_types(spark, d), shared_dir(spark, "pairs"),
                           scale=B.DECIMALS)["pairs"]


def _two_batches(spark, d):
    """The consolidated raw feed in two batches of the same days."""
    events = _raw_consolidated(spark, d)
    odd = F.col("GlobalEventID") % 3 == 0
    return [("even", events.where(~odd)), ("odd", events.where(odd)), ("odd", events.where(odd))]


def _raw_coverage_refreshed(spark, d):
    """E2 batch by batch: the product is refreshed after each, and the second batch comes twice."""
    store, out = shared_dir(spark, "coverage-store"), shared_dir(spark, "coverage-fresh")
    geo = normalize_codes_dim(B.geo_dim(spark, d), B.RAW_ALIASES)
    for batch_id, events in _two_batches(spark, d):
        merge_coverage(normalize_codes(events, "ActionGeo_CountryCode", B.RAW_ALIASES), store, batch_id, scale=B.DECIMALS)
        refresh_coverage(spark, store, geo, out, scale=B.DECIMALS)
    return read_events(spark, out, schema=ORDERED_COVERAGE)


def normalize_codes_dim(dim, aliases):
    """Dimension rows of codes that are no aliases."""
    return dim.where(~F.col("code").isin(*aliases))


ORDERED_COVERAGE = T.StructType([T.StructField("ActionGeo_CountryCode", T.StringType()), T.StructField("label", T.StringType()),
                                 T.StructField("SQLDATE", T.LongType()), T.StructField("n_events", T.LongType()), T.StructField("avg_tone", T.DoubleType()),
                                 *[T.StructField(c, T.LongType()) for c in QUAD_CLASSES.values()]])


def _raw_pairs_refreshed(spark, d):
    """E3 batch by batch, the second batch twice."""
    store = shared_dir(spark, "pairs-store")
    for batch_id, events in _two_batches(spark, d):
        merge_pairs(events, store, batch_id, scale=B.DECIMALS)
    return pairs_from_partials(stored(spark, store), B.actor_types(spark, d), "Actor1CountryCode", "Actor2CountryCode",
                               type_key="code", type_col="entity_type", entity_type="country", mean_name="avg_tone", scale=B.DECIMALS)


def _raw_clean_published(spark, d):
    """E1 with days published as a unit: first a wider window, then the window's days again."""
    out = shared_dir(spark, "raw-clean-published")
    for window in ((20240101, 20240115), B.RAW_WINDOW):
        clean(spark, B.raw_feed_layout(spark, d), out, *window, overwrite="publish")
    return read_events(spark, out, schema=_raw_kept_schema())


def _dirty_once(spark, d):
    """Valid rows by place and rejects by reason, both from one parse of the dirty feed."""
    valid, rejects = strict_scan_once(spark, B.dirty_feed_layout(spark, d), raw_event_schema())
    places = count_by(valid, "ActionGeo_CountryCode").select(F.lit("valid").alias("output"), F.col("ActionGeo_CountryCode").alias("key"), "n")
    return places.unionByName(_reasons(rejects).select(F.lit("rejects").alias("output"), F.col("violation").alias("key"), "n"))


def _dirty_stream(spark, d):
    """E1 on the dirty feed as a stream whose batches are parsed once for both tables."""
    out, rej = shared_dir(spark, "dirty-stream"), shared_dir(spark, "dirty-stream-rejects")
    clean_incremental(spark, f"{B.dirty_feed_layout(spark, d)}/ingest_day=*/", out, *B.RAW_WINDOW, rejects_path=rej)
    rows = count_by(spark.read.parquet(out), "SQLDATE").select(F.lit("kept").alias("output"), F.col("SQLDATE").cast("string").alias("key"), "n")
    return rows.unionByName(_reasons(spark.read.parquet(rej)).select(F.lit("rejects").alias("output"), F.col("violation").alias("key"), "n"))


def _raw_day(spark, d):
    return _raw_consolidated(spark, d).withColumn("day", day_from_int("SQLDATE"))


def _raw_category_ratio(spark, d):
    """Conflict against cooperation per place, over QuadClass; every code, NULL-label ones included."""
    cov = _raw_places(spark, d)["coverage"]
    cov = cov.withColumn("label", F.when(F.col("ActionGeo_CountryCode") != "G3", F.col("label")))
    return category_ratio(cov, ["ActionGeo_CountryCode", "label"], ["n_verbal_conflict", "n_material_conflict"],
                          ["n_verbal_cooperation", "n_material_cooperation"], top_n=10)


def _raw_whole(spark, d):
    """The consolidated raw feed without a window: the same rows as the text."""
    key = (session_key(spark), d, "whole")
    path = _RAW_CONSOLIDATED.get(key)
    if path is None:
        path = _RAW_CONSOLIDATED[key] = shared_dir(spark, "raw-whole")
        clean(spark, B.raw_feed_layout(spark, d), path, 0, 99_999_999)
    return read_events(spark, path, schema=_raw_kept_schema())


def _two_runs(spark, d):
    """Two incremental cleans of a growing folder, with default arguments: the days to the 15th, then all."""
    text, out = B.events_text_layout(spark, d), shared_dir(spark, "clean-twice")
    for glob in ("ingest_day=2024010*/", "ingest_day=*/"):
        clean_incremental(spark, f"{text}/{glob}", out, _D(B.WINDOW_START), _D(B.WINDOW_END),
                          schema=B.EVENTS_SCHEMA, kept=CLEAN_KEPT, day_col="day",
                          derived={"day": F.to_date("ts")})
    return spark.read.parquet(out).select(*CLEAN_KEPT)


def _rows_by_source(spark, d):
    """Rows of the text layout by the day folder and by whether the file's size is known."""
    rows = with_source_file(spark.read.text(B.events_text_layout(spark, d)))
    return rows.groupBy(F.col("ingest_day").cast("string").alias("ingest_day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("source_bytes") > 0) & F.col("source_file").isNotNull()).alias("n_known"))


def _completeness(minutes):
    return lambda s, d: slice_completeness(B.table(s, d, "events"), "ts", B.SLICE_START, B.SLICE_END, minutes)


def _clean_incremental(spark, d):
    """E1 as a file stream over the text layout, drained with availableNow."""
    text = B.events_text_layout(spark, d)
    out = shared_dir(spark, "clean-stream")
    clean_incremental(spark, f"{text}/ingest_day=*/", out, _D(B.WINDOW_START), _D(B.WINDOW_END),
                      schema=B.EVENTS_SCHEMA, kept=CLEAN_KEPT, day_col="day",
                      derived={"day": F.to_date("ts")})
    return spark.read.parquet(out).select(*CLEAN_KEPT)

def _retro_by_file(spark, d):
    """A16 as in the reference: the ingest day comes from the slice file's path."""
    valid, _ = B.events_from_text(spark, d, keep_source=True)
    ingest = F.to_date(F.regexp_extract("file_path", r"ingest_day=([0-9]{8})", 1), "yyyyMMdd")
    shaped = valid.select(
        ingest.alias("ingest_day"),
        F.date_sub(F.to_date("ts"), (F.col("user_id") % B.RETRO_MODULUS).cast("int"))
        .alias("event_day"))
    return retrospective_by_slice(shaped, "event_day", "ingest_day", _D(B.RETRO_BEFORE))


QUERIES: dict[str, Query] = {
    # axis 1 and its reports (B1)
    "coverage_daily": _coverage,
    "coverage_daily_as_is": _coverage_as_is,
    "alias_impact_of_20": lambda s, d: alias_impact(B.coded_events(s, d), "raw_code", _alias_table(s, 20)),
    "normalize_codes_of_20": lambda s, d: count_by(normalize_codes(
        B.coded_events(s, d), "raw_code", _alias_table(s, 20), out="code"), "code"),
    "match_rate": lambda s, d: match_rate(B.normalized_events(s, d), "code",
                                          B.nation_dim(s, d), "n_nationkey"),
    "unmatched_codes": lambda s, d: unmatched_codes(B.normalized_events(s, d), "code",
                                                    B.nation_dim(s, d), "n_nationkey"),
    "alias_impact": lambda s, d: alias_impact(B.coded_events(s, d), "raw_code", B.ALIASES),
    "top_codes": lambda s, d: top_codes(B.normalized_events(s, d), "code", 15),
    "totals_by_code": lambda s, d: totals_by_code(_coverage(s, d), ["code", "n_name"],
                                                  ["n_events", *CATEGORY_COLS]),
    "category_ratio": lambda s, d: category_ratio(_coverage(s, d), ["code", "n_name"],
                                                  ["n_error", "n_purchase"], ["n_click", "n_view"],
                                                  top_n=15),
    "weekend_drop": lambda s, d: weekend_drop(B.coded_events(s, d), "day"),
    "daily_volume": lambda s, d: daily_volume(B.coded_events(s, d), "day"),
    "volume_vs_base": lambda s, d: volume_vs_base(daily_volume(B.coded_events(s, d), "day"),
                                                  "day", _D(B.BASE_DAY)),
    "events_per_day": lambda s, d: events_per_day(B.coded_events(s, d), "day"),
    "window_report": lambda s, d: window_report(B.coded_events(s, d), "day",
                                                _D(B.WINDOW_START), _D(B.WINDOW_END)),
    "time_window": lambda s, d: time_window(B.coded_events(s, d), "day",
                                            _D(B.WINDOW_START), _D(B.WINDOW_END)),
    "period_distribution": lambda s, d: period_distribution(
        B.coded_events(s, d), window_period("day", _D(B.WINDOW_START), _D(B.WINDOW_END))),
    "retrospective_by_slice": _retro,
    "retrospective_by_file": _retro_by_file,
    "null_profile": lambda s, d: null_profile(B.normalized_events(s, d)),
    "n_groups": lambda s, d: n_groups(B.normalized_events(s, d), "code"),
    "count_by": lambda s, d: count_by(B.normalized_events(s, d), "code"),
    "code_drilldown": lambda s, d: code_drilldown(B.normalized_events(s, d), "code", 3,
                                                  ["event_type"]),
    "label_codes": lambda s, d: label_codes(count_by(B.normalized_events(s, d), "code"), "code",
                                            B.nation_dim(s, d), "n_nationkey", "n_name"),
    "join_broadcast": _row_join("broadcast"),
    "join_merge": _row_join("merge"),
    "join_salted": _row_join("merge", salt_buckets="hot"),
    "prefix_slices": lambda s, d: prefix_slices(B.coded_events(s, d), "day", 0.3),
    # dimensions
    "dimension_diff": lambda s, d: dimension_diff(B.table(s, d, "nation"), B.entity_types(s, d),
                                                  "n_nationkey", "code"),
    "duplicate_labels": lambda s, d: duplicate_labels(_dup_label_dim(s, d), "n_nationkey", "n_name"),
    "validate_dimension": lambda s, d: validate_dimension(_dup_key_dim(s, d), "n_nationkey"),
    "match_rate_labels": lambda s, d: match_rate(B.table(s, d, "documents"), "doc_id",
                                                 B.table(s, d, "labels"), "doc_id"),
    # axis 2 and its reports (B2)
    "pair_interactions": _pairs,
    "pair_filter_report": lambda s, d: pair_filter_report(B.pair_events(s, d), B.entity_types(s, d),
                                                          "a", "b", **_pair_kw()),
    "exclusion_breakdown": lambda s, d: exclusion_breakdown(B.pair_events(s, d),
                                                            B.entity_types(s, d), "a", "b",
                                                            **_pair_kw()),
    "entity_distribution": lambda s, d: entity_distribution(B.pair_events(s, d), "a",
                                                            B.entity_types(s, d), type_key="code",
                                                            type_col="entity_type"),
    "exclusion_causes": lambda s, d: exclusion_causes(B.pair_events(s, d), B.entity_types(s, d),
                                                      "a", "b", "b", **_pair_kw()),
    "domestic_share": lambda s, d: domestic_share(_pairs(s, d), "a", "b"),
    "top_pairs": _top_pairs,
    "tone_summary": lambda s, d: tone_summary(_top_pairs(s, d), "avg_tone", 50000.0),
    # slices (B4)
    "slice_completeness": lambda s, d: slice_completeness(B.table(s, d, "events"), "ts",
                                                          B.SLICE_START, B.SLICE_END,
                                                          B.SLICE_MINUTES),
    "missing_slices": lambda s, d: missing_slices(B.table(s, d, "events"), "ts", B.SLICE_START,
                                                  B.SLICE_END, B.SLICE_MINUTES),
    "slice_gaps": lambda s, d: gap_runs(B.table(s, d, "events"), "ts", B.SLICE_START, B.SLICE_END, B.SLICE_MINUTES),
    "listed_slice_gaps": lambda s, d: gap_runs(listed_slices(file_listing(s, B.slice_files(s, d))), "slot",
                                               B.FILE_START, B.FILE_END, B.FILE_MINUTES),
    "listed_slice_completeness": lambda s, d: slice_completeness(
        listed_slices(file_listing(s, B.slice_files(s, d))), "slot", B.FILE_START, B.FILE_END, B.FILE_MINUTES),
    "slice_completeness_45": _completeness(45),
    "slice_completeness_120": _completeness(120),
    "lookup_scan": lambda s, d: B.lookup_dim(s, d),
    "rows_by_source": _rows_by_source,
    "clean_incremental_twice": _two_runs,
    # text layout, strict scan and sinks
    "strict_scan_roundtrip": lambda s, d: B.events_from_text(s, d)[0],
    "line_row_check": lambda s, d: line_row_check(
        s, B.events_text_layout(s, d), B.EVENTS_SCHEMA),
    "group_count_text": lambda s, d: count_by(B.events_from_text(s, d)[0], "event_type"),
    "layouts_agree": lambda s, d: layouts_agree(B.events_from_text(s, d)[0],
                                                B.table(s, d, "events"), "user_id"),
    "partitioned_roundtrip": _partitioned_roundtrip,
    "clean_consolidated": lambda s, d: _clean(s, d)[1],
    "clean_report": lambda s, d: _clean(s, d)[0],
    "clean_incremental": _clean_incremental,
    # the 61-column raw feed through the pipeline
    "raw_group_count": lambda s, d: count_by(
        strict_scan(s, B.raw_feed_layout(s, d), raw_event_schema())[0], "ActionGeo_CountryCode"),
    "raw_group_count_typed": lambda s, d: count_by(
        typed_scan(s, B.raw_feed_layout(s, d), raw_event_schema()), "ActionGeo_CountryCode"),
    "raw_group_count_prefix": lambda s, d: count_by(prefix_scan(
        typed_scan(s, B.slice_files(s, d), raw_event_schema()), file_listing(s, B.slice_files(s, d)), 0.3), "ActionGeo_CountryCode"),
    "raw_null_profile": lambda s, d: null_profile(
        strict_scan(s, B.raw_feed_layout(s, d), raw_event_schema())[0]),
    "raw_clean": lambda s, d: read_events(s, _raw_clean(s, d)[1], schema=_raw_kept_schema()),
    "raw_clean_report": lambda s, d: _raw_clean(s, d)[0],
    "raw_clean_published": _raw_clean_published,
    "raw_coverage_refreshed": _raw_coverage_refreshed,
    "raw_pairs_refreshed": _raw_pairs_refreshed,
    "dirty_scan_once": _dirty_once,
    "dirty_stream": _dirty_stream,
    "raw_clean_incremental": _raw_clean_incremental,
    "raw_group_count_parquet": lambda s, d: count_by(_raw_whole(s, d), "ActionGeo_CountryCode"),
    "raw_coverage_written": _raw_places_written,
    "raw_pairs_written": _raw_pairs_written,
    "raw_weekend_drop": lambda s, d: weekend_drop(_raw_day(s, d), "day"),
    "raw_category_ratio": _raw_category_ratio,
    "raw_top_pairs": lambda s, d: top_pairs(_raw_axis2(s, d)["pairs"], "Actor1CountryCode", "Actor2CountryCode", 15),
    "raw_period_by_month": lambda s, d: period_distribution(_raw_whole(s, d), period("SQLDATE", "month", 8)),
    "raw_prefix_match": lambda s, d: count_by(
        _raw_whole(s, d).where(starts_with("SQLDATE", "2024011")), "SQLDATE"),
    "raw_daily_volume_matched": lambda s, d: daily_volume(join_dimension(
        _raw_whole(s, d), B.dimension_rows(s, d), "ActionGeo_CountryCode", "code", "left_semi"), "SQLDATE"),
    "raw_coverage": lambda s, d: _raw_places(s, d)["coverage"],
    "raw_match_rate": lambda s, d: _raw_places(s, d)["match_rate"],
    "raw_alias_impact": lambda s, d: _raw_places(s, d)["alias_impact"],
    "raw_join_broadcast": lambda s, d: join_dimension(
        _raw_whole(s, d).select("GlobalEventID", "Actor1CountryCode"), B.actor_types(s, d),
        "Actor1CountryCode", "code", "inner", "broadcast"),
    "raw_join_merge": lambda s, d: join_dimension(
        _raw_whole(s, d).select("GlobalEventID", "Actor1CountryCode"), B.actor_types(s, d),
        "Actor1CountryCode", "code", "inner", "merge"),
    "raw_pairs": lambda s, d: _raw_axis2(s, d)["pairs"],
    # the dirty raw feed: every bad line rejected with its reason
    "dirty_line_row_check": lambda s, d: line_row_check(s, B.dirty_feed_layout(s, d),
                                                        raw_event_schema()),
    "dirty_reject_reasons": lambda s, d: _reasons(
        strict_scan(s, B.dirty_feed_layout(s, d), raw_event_schema())[1]),
    "dirty_clean_report": lambda s, d: _dirty_clean(s, d)[0],
    "dirty_rejects_written": lambda s, d: _reasons(s.read.parquet(_dirty_clean(s, d)[1])),
    "raw_pair_filter": lambda s, d: _raw_axis2(s, d)["pair_filter"],
    "roundtrip_check": lambda s, d: roundtrip_check(B.table(s, d, "events"),
                                                    shared_dir(s, "roundtrip")),
    "null_share_roles": lambda s, d: null_profile(B.pair_events(s, d), ["a", "b"]),
    "distinct_ids": lambda s, d: (B.coded_events(s, d).where(F.col("raw_code").isNull())
                                  .select("user_id").distinct()),
    "period_by_month": lambda s, d: period_distribution(B.table(s, d, "events"),
                                                        period("ts", "month")),
    "layout_sizes": lambda s, d: layout_sizes(s, {"all columns": B.events_text_layout(s, d),
                                                  "kept columns": B.kept_text_layout(s, d)}),
    "slice_sizes": lambda s, d: slice_sizes(file_listing(s, B.events_text_layout(s, d))),
    "size_by_weekpart": lambda s, d: size_by_weekpart(file_listing(s, B.events_text_layout(s, d)),
                                                      r"ingest_day=([0-9]{8})"),
    "size_per_day": lambda s, d: size_per_day(file_listing(s, B.events_text_layout(s, d)),
                                              r"ingest_day=([0-9]{8})"),
}


# ---------------------------------------------------------------- SQL oracle

def _mean(v: str) -> str:
    return (f"CAST(SUM(CAST(ROUND({v} * 10000) AS BIGINT)) AS DOUBLE) / CAST(10000 AS DOUBLE)"
            f" / CAST(NULLIF(COUNT({v}), 0) AS DOUBLE)")


def _pct(a: str, b: str) -> str:
    return f"CAST(100 AS DOUBLE) * CAST({a} AS DOUBLE) / CAST(NULLIF({b}, 0) AS DOUBLE)"


B1 = ("SELECT event_id, CAST(ts AS DATE) AS day, ts, user_id, event_type, value, "
      "CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id % 30 AS INTEGER) END AS raw_code "
      "FROM events")
B1N = (f"SELECT *, CASE WHEN raw_code = 28 THEN 3 WHEN raw_code = 29 THEN 3 ELSE raw_code END "
       f"AS code FROM ({B1}) b1")
COV = (f"SELECT e.code, n.n_name, e.day, COUNT(*) AS n_events, {_mean('e.value')} AS avg_value, "
       "COUNT(CASE WHEN e.event_type = 'click' THEN 1 END) AS n_click, "
       "COUNT(CASE WHEN e.event_type = 'view' THEN 1 END) AS n_view, "
       "COUNT(CASE WHEN e.event_type = 'purchase' THEN 1 END) AS n_purchase, "
       "COUNT(CASE WHEN e.event_type = 'error' THEN 1 END) AS n_error "
       f"FROM ({B1N}) e JOIN nation n ON e.code = n.n_nationkey GROUP BY e.code, n.n_name, e.day")
B2 = ("SELECT l.l_orderkey, "
      "CASE WHEN l.l_orderkey % 7 = 0 THEN NULL ELSE c.c_nationkey END AS a, "
      "CASE WHEN l.l_orderkey % 5 = 0 THEN NULL ELSE s.s_nationkey END AS b, "
      "l.l_extendedprice AS tone FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
      "JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey")
TYPES = ("SELECT n_nationkey AS code, CASE WHEN n_regionkey < 3 THEN 'country' "
         "WHEN n_regionkey = 3 THEN 'region' ELSE 'territory' END AS entity_type "
         "FROM nation WHERE n_nationkey <> 7")
PAIRS = (f"SELECT p.a, p.b, COUNT(*) AS n_events, {_mean('p.tone')} AS avg_tone "
         f"FROM ({B2}) p JOIN ({TYPES}) ta ON p.a = ta.code JOIN ({TYPES}) tb ON p.b = tb.code "
         "WHERE ta.entity_type = 'country' AND tb.entity_type = 'country' GROUP BY p.a, p.b")
TYPED = (f"SELECT p.*, ta.entity_type AS ta, tb.entity_type AS tb FROM ({B2}) p "
         f"LEFT JOIN ({TYPES}) ta ON p.a = ta.code LEFT JOIN ({TYPES}) tb ON p.b = tb.code")
TOP_PAIRS = (f"WITH t AS (SELECT * FROM ({PAIRS}) x WHERE a <> b "
             "ORDER BY n_events DESC, a, b LIMIT 15) "
             "SELECT t.a, t.b, t.n_events, t.avg_tone, "
             "COALESCE(na.n_name, CAST(t.a AS VARCHAR)) AS label_a, "
             "COALESCE(nb.n_name, CAST(t.b AS VARCHAR)) AS label_b, "
             "COALESCE(na.n_name, CAST(t.a AS VARCHAR)) || ' → ' || "
             "COALESCE(nb.n_name, CAST(t.b AS VARCHAR)) AS pair "
             "FROM t LEFT JOIN nation na ON t.a = na.n_nationkey "
             "LEFT JOIN nation nb ON t.b = nb.n_nationkey")
GRID = ("SELECT slot FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', "
        "TIMESTAMP '2024-01-30 23:45:00', INTERVAL 15 MINUTE) t(slot)")
PRESENT = "SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS slot FROM events"
IN_WINDOW = "day BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"
A_OK = "COALESCE(ta = 'country', false)"
B_OK = "COALESCE(tb = 'country', false)"
WEEKEND = "isodow(day) >= 6"

_RAW_SQL_EXPR = {
    "GlobalEventID": "event_id",
    "SQLDATE": "CAST(strftime(ts, '%Y%m%d') AS BIGINT)",
    "MonthYear": "CAST(strftime(ts, '%Y%m') AS BIGINT)",
    "Year": "CAST(year(ts) AS BIGINT)",
    "FractionDate": "CAST(year(ts) AS DOUBLE) + CAST(month(ts) * 30 + day(ts) AS DOUBLE) / 365.0",
    "Actor1Code": "'A' || CAST(user_id AS VARCHAR)",
    "Actor1Name": "'ACTOR ' || CAST(user_id AS VARCHAR)",
    "Actor1CountryCode": "CASE WHEN user_id % 4 <> 0 THEN 'N' || CAST(user_id % 27 AS VARCHAR) END",
    "Actor2CountryCode": "CASE WHEN event_id % 3 <> 0 THEN 'N' || CAST(event_id % 27 AS VARCHAR) END",
    "IsRootEvent": "CAST(event_id % 2 AS BIGINT)",
    "EventCode": "lpad(CAST(event_id % 200 AS VARCHAR), 3, '0')",
    "EventBaseCode": "substr(lpad(CAST(event_id % 200 AS VARCHAR), 3, '0'), 1, 3)",
    "EventRootCode": "substr(lpad(CAST(event_id % 200 AS VARCHAR), 3, '0'), 1, 2)",
    "QuadClass": "CAST(event_id % 5 AS BIGINT)",
    "GoldsteinScale": "CAST(user_id % 21 AS DOUBLE) - CAST(10 AS DOUBLE)",
    "NumMentions": "CAST(user_id % 7 + 1 AS BIGINT)",
    "NumSources": "CAST(user_id % 3 + 1 AS BIGINT)",
    "NumArticles": "CAST(user_id % 5 + 1 AS BIGINT)",
    "AvgTone": "value",
    "ActionGeo_Type": "CAST(user_id % 5 + 1 AS BIGINT)",
    "ActionGeo_Fullname": "'Place ' || CAST(user_id AS VARCHAR)",
    "ActionGeo_CountryCode": "CASE WHEN user_id % 10 <> 0 THEN 'G' || CAST(user_id % 30 AS VARCHAR) END",
    "ActionGeo_Lat": "CAST(user_id % 180 AS DOUBLE) - CAST(90 AS DOUBLE)",
    "ActionGeo_Long": "CAST(user_id % 360 AS DOUBLE) - CAST(180 AS DOUBLE)",
    "ActionGeo_FeatureID": "CAST(user_id AS VARCHAR)",
    "DATEADDED": "CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT)",
    "SOURCEURL": "props",
}
_SQL_TYPES = {"L": "BIGINT", "D": "DOUBLE", "S": "VARCHAR"}
RAW = "SELECT " + ", ".join(
    f"{_RAW_SQL_EXPR.get(n, 'NULL')}::{_SQL_TYPES[t[0]]} AS {n}" for n, t in RAW_EVENT_FIELDS
) + " FROM events"
RAW_KEPT = (f"SELECT {', '.join(KEPT_COLUMNS)} FROM ({RAW}) r "
            "WHERE SQLDATE BETWEEN 20240105 AND 20240125")
RAW_NORM = ("SELECT * REPLACE (CASE WHEN ActionGeo_CountryCode = 'G28' THEN 'G3' "
            "WHEN ActionGeo_CountryCode = 'G29' THEN 'G3' ELSE ActionGeo_CountryCode END "
            f"AS ActionGeo_CountryCode) FROM ({RAW_KEPT}) k")
GEO = "SELECT 'G' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation"
ATYPES = (f"SELECT 'N' || CAST(code AS VARCHAR) AS code, entity_type FROM ({TYPES}) t")
RAW_TYPED = (f"SELECT k.*, ta.entity_type AS ta, tb.entity_type AS tb FROM ({RAW_KEPT}) k "
             f"LEFT JOIN ({ATYPES}) ta ON k.Actor1CountryCode = ta.code "
             f"LEFT JOIN ({ATYPES}) tb ON k.Actor2CountryCode = tb.code")

DIRTY = ("SELECT GlobalEventID, SQLDATE, CASE WHEN GlobalEventID % 97 = 0 THEN 'GlobalEventID: not a bigint' "
         "WHEN GlobalEventID % 89 = 0 THEN 'expected 61 fields, found 60' "
         "WHEN GlobalEventID % 83 = 0 THEN 'AvgTone: not a double' "
         "WHEN GlobalEventID % 79 = 0 THEN 'NumMentions: not a bigint' "
         "WHEN GlobalEventID % 73 = 0 THEN 'AvgTone: not a double' END AS rule "
         f"FROM ({RAW}) r")

ORACLE: dict[str, str] = {
    "coverage_daily": COV,
    "match_rate": (
        f"SELECT n_coded, n_matched, n_coded - n_matched AS n_unmatched, "
        f"{_pct('n_matched', 'n_coded')} AS pct_matched, "
        f"{_pct('n_coded - n_matched', 'n_coded')} AS pct_unmatched FROM ("
        f"SELECT COUNT(*) AS n_coded, COUNT(k.n_nationkey) AS n_matched FROM ({B1N}) e "
        "LEFT JOIN (SELECT DISTINCT n_nationkey FROM nation) k ON e.code = k.n_nationkey "
        "WHERE e.code IS NOT NULL) t"),
    "unmatched_codes": (
        f"SELECT code, COUNT(*) AS n_events FROM ({B1N}) e WHERE code IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM nation n WHERE n.n_nationkey = e.code) GROUP BY code"),
    "alias_impact": (
        "SELECT code AS canonical, COUNT(CASE WHEN raw_code = code THEN 1 END) AS n_before, "
        "COUNT(*) AS n_after, COUNT(*) - COUNT(CASE WHEN raw_code = code THEN 1 END) AS n_recovered "
        f"FROM ({B1N}) e WHERE code IN (3) GROUP BY code"),
    "top_codes": (f"SELECT code, COUNT(*) AS n_events FROM ({B1N}) e GROUP BY code "
                  "ORDER BY n_events DESC, code ASC NULLS FIRST LIMIT 15"),
    "totals_by_code": (
        "SELECT code, n_name, CAST(SUM(n_events) AS BIGINT) AS n_events, "
        "CAST(SUM(n_click) AS BIGINT) AS n_click, CAST(SUM(n_view) AS BIGINT) AS n_view, "
        "CAST(SUM(n_purchase) AS BIGINT) AS n_purchase, CAST(SUM(n_error) AS BIGINT) AS n_error "
        f"FROM ({COV}) c GROUP BY code, n_name"),
    "category_ratio": (
        f"WITH s AS (SELECT code, n_name, CAST(SUM(n_events) AS BIGINT) AS n_events, "
        "CAST(SUM(n_error + n_purchase) AS BIGINT) AS numerator, "
        f"CAST(SUM(n_click + n_view) AS BIGINT) AS denominator FROM ({COV}) c GROUP BY code, n_name), "
        "t AS (SELECT code, n_name FROM s "
        "ORDER BY n_events DESC, code ASC NULLS FIRST, n_name ASC NULLS FIRST LIMIT 15) "
        "SELECT s.code, s.n_name, s.n_events, s.numerator, s.denominator, "
        "CAST(s.numerator AS DOUBLE) / CAST(NULLIF(s.denominator, 0) AS DOUBLE) AS ratio "
        "FROM s WHERE EXISTS (SELECT 1 FROM t WHERE t.code = s.code AND t.n_name = s.n_name)"),
    "weekend_drop": (
        f"WITH d AS (SELECT day, COUNT(*) AS n_events FROM ({B1}) b GROUP BY day), "
        f"a AS (SELECT COUNT(CASE WHEN NOT {WEEKEND} THEN 1 END) AS n_weekdays, "
        f"COUNT(CASE WHEN {WEEKEND} THEN 1 END) AS n_weekend_days, "
        f"CAST(SUM(CASE WHEN NOT {WEEKEND} THEN n_events END) AS DOUBLE) AS wd, "
        f"CAST(SUM(CASE WHEN {WEEKEND} THEN n_events END) AS DOUBLE) AS we FROM d) "
        "SELECT n_weekdays, n_weekend_days, "
        "wd / CAST(NULLIF(n_weekdays, 0) AS DOUBLE) AS avg_weekday, "
        "we / CAST(NULLIF(n_weekend_days, 0) AS DOUBLE) AS avg_weekend, "
        "CAST(1 AS DOUBLE) - (we / CAST(NULLIF(n_weekend_days, 0) AS DOUBLE)) / "
        "NULLIF(wd / CAST(NULLIF(n_weekdays, 0) AS DOUBLE), 0) AS weekend_drop FROM a"),
    "daily_volume": f"SELECT day, COUNT(*) AS n_events FROM ({B1}) b GROUP BY day",
    "volume_vs_base": (
        f"WITH d AS (SELECT day, COUNT(*) AS n_events FROM ({B1}) b GROUP BY day) "
        f"SELECT day, n_events, "
        f"{_pct('n_events', '(SELECT SUM(n_events) FROM d WHERE day = DATE ' + repr('2024-01-01') + ')')}"
        " AS pct_of_base FROM d"),
    "events_per_day": (
        f"SELECT CAST(SUM(n) AS BIGINT) AS n_events, COUNT(*) AS n_days, "
        "CAST(SUM(n) AS DOUBLE) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) AS events_per_day "
        f"FROM (SELECT day, COUNT(*) AS n FROM ({B1}) b GROUP BY day) d"),
    "window_report": (
        f"SELECT n_read, n_kept, n_read - n_kept AS n_removed, "
        f"{_pct('n_read - n_kept', 'n_read')} AS pct_removed FROM ("
        f"SELECT COUNT(*) AS n_read, COUNT(CASE WHEN {IN_WINDOW} THEN 1 END) AS n_kept "
        f"FROM ({B1}) b) t"),
    "time_window": f"SELECT * FROM ({B1}) b WHERE {IN_WINDOW}",
    "period_distribution": (
        "WITH g AS (SELECT CASE WHEN day < DATE '2024-01-05' THEN 'before' "
        "WHEN day > DATE '2024-01-25' THEN 'after' WHEN day IS NOT NULL THEN 'within' END "
        f"AS period, COUNT(*) AS n_events FROM ({B1}) b GROUP BY 1) "
        f"SELECT period, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct FROM g"),
    "retrospective_by_slice": (
        "SELECT ingest_day, COUNT(*) AS n_events FROM (SELECT CAST(ts AS DATE) AS ingest_day, "
        "CAST(ts AS DATE) - CAST(user_id % 40 AS INTEGER) AS event_day FROM events) e "
        "WHERE event_day < DATE '2024-01-01' GROUP BY ingest_day"),
    "retrospective_by_file": (
        "SELECT ingest_day, COUNT(*) AS n_events FROM (SELECT CAST(ts AS DATE) AS ingest_day, "
        "CAST(ts AS DATE) - CAST(user_id % 40 AS INTEGER) AS event_day FROM events) e "
        "WHERE event_day < DATE '2024-01-01' GROUP BY ingest_day"),
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) - COUNT({c}) AS n_null, "
        f"{_pct('COUNT(*) - COUNT(' + c + ')', 'COUNT(*)')} AS pct_null FROM ({B1N}) e"
        for c in ["event_id", "day", "ts", "user_id", "event_type", "value", "raw_code", "code"]),
    "n_groups": f"SELECT COUNT(*) AS n_groups FROM (SELECT code FROM ({B1N}) e GROUP BY code) g",
    "count_by": f"SELECT code, COUNT(*) AS n FROM ({B1N}) e GROUP BY code",
    "code_drilldown": (f"SELECT event_type, COUNT(*) AS n FROM ({B1N}) e WHERE code = 3 "
                       "GROUP BY event_type"),
    "label_codes": (
        f"SELECT g.code, g.n, COALESCE(n.n_name, CAST(g.code AS VARCHAR)) AS label FROM "
        f"(SELECT code, COUNT(*) AS n FROM ({B1N}) e GROUP BY code) g "
        "LEFT JOIN nation n ON g.code = n.n_nationkey"),
    "join_broadcast": (f"SELECT e.event_id, e.code, n.n_name FROM ({B1N}) e "
                       "JOIN nation n ON e.code = n.n_nationkey"),
    "join_merge": (f"SELECT e.event_id, e.code, n.n_name FROM ({B1N}) e "
                   "JOIN nation n ON e.code = n.n_nationkey"),
    "join_salted": (f"SELECT e.event_id, e.code, n.n_name FROM ({B1N}) e "
                    "JOIN nation n ON e.code = n.n_nationkey"),
    "prefix_slices": (
        f"WITH b AS ({B1}), u AS (SELECT day, ROW_NUMBER() OVER (ORDER BY day) AS rn "
        "FROM (SELECT DISTINCT day FROM b WHERE day IS NOT NULL) x), "
        "k AS (SELECT GREATEST(1, CAST(ROUND_EVEN(COUNT(*) * 0.3, 0) AS BIGINT)) AS k FROM u) "
        "SELECT * FROM b WHERE day <= (SELECT MAX(day) FROM u, k WHERE u.rn <= k.k)"),
    "dimension_diff": (
        f"SELECT n_nationkey AS code, 'left_only' AS side FROM nation "
        f"WHERE n_nationkey NOT IN (SELECT code FROM ({TYPES}) t) "
        f"UNION ALL SELECT code, 'right_only' AS side FROM ({TYPES}) t "
        "WHERE code NOT IN (SELECT n_nationkey FROM nation)"),
    "duplicate_labels": (
        "WITH d AS (SELECT n_nationkey, n_name FROM nation UNION ALL "
        "SELECT n_nationkey + 25 AS n_nationkey, n_name FROM nation WHERE n_nationkey = 0), "
        "g AS (SELECT n_name, COUNT(DISTINCT n_nationkey) AS n_codes FROM d GROUP BY n_name "
        "HAVING COUNT(DISTINCT n_nationkey) > 1) "
        "SELECT DISTINCT d.n_name, d.n_nationkey, g.n_codes FROM d JOIN g USING (n_name)"),
    "validate_dimension": (
        "SELECT n_nationkey, COUNT(*) AS n_rows FROM (SELECT * FROM nation UNION ALL "
        "SELECT * FROM nation WHERE n_nationkey = 5) d GROUP BY n_nationkey HAVING COUNT(*) > 1"),
    "match_rate_labels": (
        f"SELECT n_coded, n_matched, n_coded - n_matched AS n_unmatched, "
        f"{_pct('n_matched', 'n_coded')} AS pct_matched, "
        f"{_pct('n_coded - n_matched', 'n_coded')} AS pct_unmatched FROM ("
        "SELECT COUNT(*) AS n_coded, COUNT(k.doc_id) AS n_matched FROM documents d "
        "LEFT JOIN (SELECT DISTINCT doc_id FROM labels) k ON d.doc_id = k.doc_id "
        "WHERE d.doc_id IS NOT NULL) t"),
    "pair_interactions": PAIRS,
    "pair_filter_report": (
        f"SELECT n_total, n_kept, n_total - n_kept AS n_excluded, "
        f"{_pct('n_kept', 'n_total')} AS pct_kept, "
        f"{_pct('n_total - n_kept', 'n_total')} AS pct_excluded FROM ("
        f"SELECT COUNT(*) AS n_total, COUNT(CASE WHEN {A_OK} AND {B_OK} THEN 1 END) AS n_kept "
        f"FROM ({TYPED}) x) t"),
    "exclusion_breakdown": (
        f"WITH g AS (SELECT CASE WHEN {A_OK} AND {B_OK} THEN 'kept' WHEN {B_OK} THEN 'a_only' "
        f"WHEN {A_OK} THEN 'b_only' ELSE 'both' END AS outcome, COUNT(*) AS n_events "
        f"FROM ({TYPED}) x GROUP BY 1) "
        f"SELECT outcome, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct_of_total, "
        "CASE WHEN outcome <> 'kept' THEN "
        f"{_pct('n_events', 'SUM(CASE WHEN outcome <> ' + repr('kept') + ' THEN n_events END) OVER ()')}"
        " END AS pct_of_excluded FROM g"),
    "entity_distribution": (
        "WITH g AS (SELECT CASE WHEN a IS NULL THEN 'null' WHEN ta IS NULL THEN 'unknown_code' "
        f"ELSE ta END AS bucket, COUNT(*) AS n_events FROM ({TYPED}) x GROUP BY 1) "
        f"SELECT bucket, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct FROM g"),
    "exclusion_causes": (
        "WITH g AS (SELECT CASE WHEN b IS NULL THEN 'null' WHEN tb IS NULL THEN 'unknown_code' "
        f"ELSE tb END AS cause, COUNT(*) AS n_events FROM ({TYPED}) x WHERE NOT {B_OK} GROUP BY 1) "
        f"SELECT cause, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct FROM g"),
    "domestic_share": (
        "SELECT COUNT(*) AS n_pairs, COUNT(CASE WHEN a = b THEN 1 END) AS n_domestic_pairs, "
        "CAST(SUM(n_events) AS BIGINT) AS n_events, "
        "CAST(COALESCE(SUM(CASE WHEN a = b THEN n_events END), 0) AS BIGINT) AS n_domestic_events, "
        f"{_pct('COALESCE(SUM(CASE WHEN a = b THEN n_events END), 0)', 'SUM(n_events)')} "
        f"AS pct_domestic_events FROM ({PAIRS}) p"),
    "top_pairs": TOP_PAIRS,
    "tone_summary": (
        "SELECT COUNT(*) AS n_pairs, COUNT(CASE WHEN avg_tone > 50000 THEN 1 END) AS n_positive, "
        f"MIN(avg_tone) AS min_avg_tone, MAX(avg_tone) AS max_avg_tone FROM ({TOP_PAIRS}) t"),
    "slice_completeness": (
        "SELECT COUNT(*) AS n_expected, COUNT(p.slot) AS n_present, "
        f"COUNT(*) - COUNT(p.slot) AS n_missing FROM ({GRID}) g LEFT JOIN ({PRESENT}) p "
        "ON g.slot = p.slot"),
    "missing_slices": (f"SELECT g.slot FROM ({GRID}) g WHERE NOT EXISTS "
                       f"(SELECT 1 FROM ({PRESENT}) p WHERE p.slot = g.slot)"),
    "strict_scan_roundtrip": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "line_row_check": ("SELECT COUNT(*) AS n_lines, COUNT(*) AS n_valid, "
                       "CAST(0 AS BIGINT) AS n_rejected, true AS all_valid FROM events"),
    "group_count_text": "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type",
    "layouts_agree": ("SELECT COUNT(*) AS n_groups_left, COUNT(*) AS n_groups_right, "
                      "CAST(0 AS BIGINT) AS n_differing, true AS agree "
                      "FROM (SELECT user_id FROM events GROUP BY user_id) g"),
    "partitioned_roundtrip": B1,
    "clean_consolidated": (f"SELECT event_id, day, user_id, event_type, value FROM ({B1}) b "
                           f"WHERE {IN_WINDOW}"),
    "clean_incremental": (f"SELECT event_id, day, user_id, event_type, value FROM ({B1}) b "
                          f"WHERE {IN_WINDOW}"),
    "raw_group_count": (f"SELECT ActionGeo_CountryCode, COUNT(*) AS n FROM ({RAW}) r "
                        "GROUP BY ActionGeo_CountryCode"),
    "raw_group_count_typed": (f"SELECT ActionGeo_CountryCode, COUNT(*) AS n FROM ({RAW}) r "
                              "GROUP BY ActionGeo_CountryCode"),
    "raw_null_profile": " UNION ALL ".join(
        f"SELECT '{n}' AS column, COUNT(*) - COUNT({n}) AS n_null, "
        f"{_pct('COUNT(*) - COUNT(' + n + ')', 'COUNT(*)')} AS pct_null FROM ({RAW}) r"
        for n, _ in RAW_EVENT_FIELDS),
    "raw_clean": RAW_KEPT,
    "raw_clean_incremental": RAW_KEPT,
    "raw_clean_report": (
        f"SELECT n_lines, n_valid, n_lines - n_valid AS n_rejected, n_kept, "
        f"n_valid - n_kept AS n_removed, {_pct('n_valid - n_kept', 'n_valid')} AS pct_removed "
        "FROM (SELECT COUNT(*) AS n_lines, COUNT(*) AS n_valid, "
        "COUNT(CASE WHEN SQLDATE BETWEEN 20240105 AND 20240125 THEN 1 END) AS n_kept "
        f"FROM ({RAW}) r) t"),
    "raw_group_count_parquet": (f"SELECT ActionGeo_CountryCode, COUNT(*) AS n FROM ({RAW}) k "
                                "GROUP BY ActionGeo_CountryCode"),
    "raw_weekend_drop": (
        "WITH d AS (SELECT CAST(strptime(CAST(SQLDATE AS VARCHAR), '%Y%m%d') AS DATE) AS day, COUNT(*) AS n_events "
        f"FROM ({RAW_KEPT}) k GROUP BY 1), "
        f"a AS (SELECT COUNT(CASE WHEN NOT {WEEKEND} THEN 1 END) AS n_weekdays, "
        f"COUNT(CASE WHEN {WEEKEND} THEN 1 END) AS n_weekend_days, "
        f"CAST(SUM(CASE WHEN NOT {WEEKEND} THEN n_events END) AS DOUBLE) AS wd, "
        f"CAST(SUM(CASE WHEN {WEEKEND} THEN n_events END) AS DOUBLE) AS we FROM d) "
        "SELECT n_weekdays, n_weekend_days, "
        "wd / CAST(NULLIF(n_weekdays, 0) AS DOUBLE) AS avg_weekday, "
        "we / CAST(NULLIF(n_weekend_days, 0) AS DOUBLE) AS avg_weekend, "
        "CAST(1 AS DOUBLE) - (we / CAST(NULLIF(n_weekend_days, 0) AS DOUBLE)) / "
        "NULLIF(wd / CAST(NULLIF(n_weekdays, 0) AS DOUBLE), 0) AS weekend_drop FROM a"),
    "raw_category_ratio": (
        "SELECT e.ActionGeo_CountryCode, CASE WHEN e.ActionGeo_CountryCode <> 'G3' THEN g.label END AS label, "
        "COUNT(*) AS n_events, COUNT(CASE WHEN e.QuadClass IN (3, 4) THEN 1 END) AS numerator, "
        "COUNT(CASE WHEN e.QuadClass IN (1, 2) THEN 1 END) AS denominator, "
        "CAST(COUNT(CASE WHEN e.QuadClass IN (3, 4) THEN 1 END) AS DOUBLE) / "
        "CAST(NULLIF(COUNT(CASE WHEN e.QuadClass IN (1, 2) THEN 1 END), 0) AS DOUBLE) AS ratio "
        f"FROM ({RAW_NORM}) e JOIN ({GEO}) g ON e.ActionGeo_CountryCode = g.code "
        "GROUP BY 1, 2 ORDER BY n_events DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10"),
    "raw_period_by_month": (
        "WITH g AS (SELECT CAST(SQLDATE // 100 AS BIGINT) AS period, COUNT(*) AS n_events "
        f"FROM ({RAW}) r GROUP BY 1) "
        f"SELECT period, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct FROM g"),
    "raw_prefix_match": (f"SELECT SQLDATE, COUNT(*) AS n FROM ({RAW}) r "
                         "WHERE CAST(SQLDATE AS VARCHAR) LIKE '2024011%' GROUP BY SQLDATE"),
    "raw_daily_volume_matched": (
        f"SELECT SQLDATE, COUNT(*) AS n_events FROM ({RAW}) r WHERE ActionGeo_CountryCode IN "
        "('G0', 'G1', 'G2', 'G3', 'G4') GROUP BY SQLDATE"),
    "coverage_daily_as_is": (
        "SELECT e.code, n.n_name, e.day, COUNT(*) AS n_events, "
        "AVG(CASE WHEN e.user_id % 3 <> 0 THEN floor(e.value * 1000) / 1048576 END) AS avg_value, "
        "COUNT(CASE WHEN e.event_type = 'click' THEN 1 END) AS n_click, "
        "COUNT(CASE WHEN e.event_type = 'view' THEN 1 END) AS n_view, "
        "COUNT(CASE WHEN e.event_type = 'purchase' THEN 1 END) AS n_purchase, "
        "COUNT(CASE WHEN e.event_type = 'error' THEN 1 END) AS n_error "
        f"FROM ({B1N}) e JOIN nation n ON e.code = n.n_nationkey GROUP BY e.code, n.n_name, e.day"),
    "alias_impact_of_20": (
        f"WITH b AS ({B1}), a AS (SELECT 28 + i AS alias, (3 + i) % 25 AS canonical FROM range(20) t(i)) "
        "SELECT CAST(c.canonical AS INTEGER) AS canonical, "
        "(SELECT COUNT(*) FROM b WHERE raw_code = c.canonical) AS n_before, "
        "(SELECT COUNT(*) FROM b WHERE raw_code = c.canonical OR raw_code IN "
        "(SELECT alias FROM a WHERE a.canonical = c.canonical)) AS n_after, "
        "(SELECT COUNT(*) FROM b WHERE raw_code IN (SELECT alias FROM a WHERE a.canonical = c.canonical)) "
        "AS n_recovered FROM (SELECT DISTINCT canonical FROM a) c"),
    "normalize_codes_of_20": (
        "SELECT CASE WHEN raw_code BETWEEN 28 AND 47 THEN CAST((raw_code - 25) % 25 AS INTEGER) ELSE raw_code END "
        f"AS code, COUNT(*) AS n FROM ({B1}) b GROUP BY 1"),
    **{f"slice_completeness_{m}": (
        "SELECT COUNT(*) AS n_expected, COUNT(p.slot) AS n_present, COUNT(*) - COUNT(p.slot) AS n_missing FROM "
        f"generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-30 23:45:00', INTERVAL {m} MINUTE) g(slot) "
        f"LEFT JOIN (SELECT DISTINCT time_bucket(INTERVAL {m} MINUTE, ts, TIMESTAMP '2024-01-01 00:00:00') AS slot "
        "FROM events) p ON g.slot = p.slot") for m in (45, 120)},
    "lookup_scan": GEO,
    "rows_by_source": ("SELECT strftime(ts, '%Y%m%d') AS ingest_day, COUNT(*) AS n, COUNT(*) AS n_known "
                       "FROM events GROUP BY 1"),
    "clean_incremental_twice": (f"SELECT event_id, day, user_id, event_type, value FROM ({B1}) b "
                                f"WHERE {IN_WINDOW}"),
    "raw_coverage": (
        f"SELECT e.ActionGeo_CountryCode, g.label, e.SQLDATE, COUNT(*) AS n_events, "
        f"{_mean('e.AvgTone')} AS avg_tone, "
        "COUNT(CASE WHEN e.QuadClass = 1 THEN 1 END) AS n_verbal_cooperation, "
        "COUNT(CASE WHEN e.QuadClass = 2 THEN 1 END) AS n_material_cooperation, "
        "COUNT(CASE WHEN e.QuadClass = 3 THEN 1 END) AS n_verbal_conflict, "
        "COUNT(CASE WHEN e.QuadClass = 4 THEN 1 END) AS n_material_conflict "
        f"FROM ({RAW_NORM}) e JOIN ({GEO}) g ON e.ActionGeo_CountryCode = g.code "
        "GROUP BY e.ActionGeo_CountryCode, g.label, e.SQLDATE"),
    "raw_match_rate": (
        f"SELECT n_coded, n_matched, n_coded - n_matched AS n_unmatched, "
        f"{_pct('n_matched', 'n_coded')} AS pct_matched, "
        f"{_pct('n_coded - n_matched', 'n_coded')} AS pct_unmatched FROM ("
        f"SELECT COUNT(*) AS n_coded, COUNT(g.code) AS n_matched FROM ({RAW_NORM}) e "
        f"LEFT JOIN ({GEO}) g ON e.ActionGeo_CountryCode = g.code "
        "WHERE e.ActionGeo_CountryCode IS NOT NULL) t"),
    "raw_alias_impact": (
        "SELECT n.ActionGeo_CountryCode AS canonical, "
        "COUNT(CASE WHEN k.ActionGeo_CountryCode = n.ActionGeo_CountryCode THEN 1 END) AS n_before, "
        "COUNT(*) AS n_after, COUNT(*) - COUNT(CASE WHEN k.ActionGeo_CountryCode = "
        "n.ActionGeo_CountryCode THEN 1 END) AS n_recovered "
        f"FROM ({RAW_KEPT}) k JOIN ({RAW_NORM}) n ON k.GlobalEventID = n.GlobalEventID "
        "WHERE n.ActionGeo_CountryCode IN ('G3') GROUP BY n.ActionGeo_CountryCode"),
    "raw_join_broadcast": (f"SELECT k.GlobalEventID, k.Actor1CountryCode, t.entity_type "
                           f"FROM ({RAW}) k JOIN ({ATYPES}) t ON k.Actor1CountryCode = t.code"),
    "raw_join_merge": (f"SELECT k.GlobalEventID, k.Actor1CountryCode, t.entity_type "
                       f"FROM ({RAW}) k JOIN ({ATYPES}) t ON k.Actor1CountryCode = t.code"),
    "dirty_line_row_check": (
        f"SELECT COUNT(*) AS n_lines, COUNT(*) - COUNT(rule) AS n_valid, COUNT(rule) AS n_rejected, "
        f"COUNT(rule) = 0 AS all_valid FROM ({DIRTY}) x"),
    "dirty_reject_reasons": (f"SELECT rule AS violation, COUNT(*) AS n FROM ({DIRTY}) x "
                             "WHERE rule IS NOT NULL GROUP BY rule"),
    "dirty_clean_report": (
        "SELECT n_lines, n_valid, n_lines - n_valid AS n_rejected, n_kept, "
        f"n_valid - n_kept AS n_removed, {_pct('n_valid - n_kept', 'n_valid')} AS pct_removed "
        "FROM (SELECT COUNT(*) AS n_lines, COUNT(*) - COUNT(rule) AS n_valid, "
        "COUNT(CASE WHEN rule IS NULL AND SQLDATE BETWEEN 20240105 AND 20240125 THEN 1 END) "
        f"AS n_kept FROM ({DIRTY}) x) t"),
    "dirty_rejects_written": (f"SELECT rule AS violation, COUNT(*) AS n FROM ({DIRTY}) x "
                              "WHERE rule IS NOT NULL GROUP BY rule"),
    "raw_pairs": (
        f"SELECT p.Actor1CountryCode, p.Actor2CountryCode, COUNT(*) AS n_events, "
        f"{_mean('p.AvgTone')} AS avg_tone FROM ({RAW_TYPED}) p "
        "WHERE p.ta = 'country' AND p.tb = 'country' "
        "GROUP BY p.Actor1CountryCode, p.Actor2CountryCode"),
    "raw_pair_filter": (
        f"SELECT n_total, n_kept, n_total - n_kept AS n_excluded, "
        f"{_pct('n_kept', 'n_total')} AS pct_kept, "
        f"{_pct('n_total - n_kept', 'n_total')} AS pct_excluded FROM ("
        f"SELECT COUNT(*) AS n_total, COUNT(CASE WHEN {A_OK} AND {B_OK} THEN 1 END) AS n_kept "
        f"FROM ({RAW_TYPED}) x) t"),
    "roundtrip_check": ("SELECT COUNT(*) AS n_read, COUNT(*) AS n_written, true AS equal "
                        "FROM events"),
    "null_share_roles": " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(*) - COUNT({c}) AS n_null, "
        f"{_pct('COUNT(*) - COUNT(' + c + ')', 'COUNT(*)')} AS pct_null FROM ({B2}) p"
        for c in ["a", "b"]),
    "distinct_ids": f"SELECT DISTINCT user_id FROM ({B1}) b WHERE raw_code IS NULL",
    "period_by_month": (
        "WITH g AS (SELECT CAST(year(ts) * 100 + month(ts) AS BIGINT) AS period, "
        "COUNT(*) AS n_events FROM events GROUP BY 1) "
        f"SELECT period, n_events, {_pct('n_events', 'SUM(n_events) OVER ()')} AS pct FROM g"),
    "clean_report": (
        f"SELECT n_lines, n_valid, n_lines - n_valid AS n_rejected, n_kept, "
        f"n_valid - n_kept AS n_removed, {_pct('n_valid - n_kept', 'n_valid')} AS pct_removed "
        f"FROM (SELECT COUNT(*) AS n_lines, COUNT(*) AS n_valid, "
        f"COUNT(CASE WHEN {IN_WINDOW} THEN 1 END) AS n_kept FROM ({B1}) b) t"),
}

#: What the text layouts hold, line by line: fields as text, a tab between them, a line feed behind.
_LINES = ("SELECT strftime(ts, '%Y%m%d') AS day, CAST(event_id AS VARCHAR) || chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S') || "
          "CASE WHEN ts <> date_trunc('second', ts) THEN rtrim(strftime(ts, '.%f'), '0') ELSE '' END || chr(9) || "
          "coalesce(CAST(user_id AS VARCHAR), '') || chr(9) || coalesce(event_type, '') || chr(9) || coalesce(CAST(value AS VARCHAR), '') "
          "|| chr(9) || coalesce(props, '') AS line, CAST(event_id AS VARCHAR) || chr(9) || coalesce(CAST(user_id AS VARCHAR), '') || chr(9) "
          "|| coalesce(event_type, '') AS short, ts FROM events")
_BYTES = "CAST(SUM(octet_length(encode({})) + 1) AS BIGINT) AS n_bytes"
_DAY_BYTES = f"SELECT day, CAST(1 AS BIGINT) AS n_files, {_BYTES.format('line')} FROM ({_LINES}) x GROUP BY day"
ORACLE["size_per_day"] = _DAY_BYTES
ORACLE["slice_sizes"] = ("SELECT COUNT(*) AS n_files, CAST(SUM(n_bytes) AS BIGINT) AS n_bytes, "
                         f"CAST(SUM(n_bytes) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_bytes_per_file FROM ({_DAY_BYTES}) d")
ORACLE["size_by_weekpart"] = (
    "SELECT isodow(strptime(day, '%Y%m%d')) >= 6 AS weekend, COUNT(*) AS n_days, COUNT(*) AS n_files, CAST(SUM(n_bytes) AS BIGINT) AS n_bytes, "
    f"CAST(SUM(n_bytes) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS bytes_per_day FROM ({_DAY_BYTES}) d GROUP BY 1")
ORACLE["layout_sizes"] = (
    f"WITH s AS (SELECT 'all columns' AS layout, COUNT(DISTINCT day) AS n_files, {_BYTES.format('line')} FROM ({_LINES}) x UNION ALL "
    f"SELECT 'kept columns', COUNT(DISTINCT day), {_BYTES.format('short')} FROM ({_LINES}) x) "
    "SELECT layout, n_files, n_bytes, CAST(n_bytes AS DOUBLE) / CAST((SELECT MIN(n_bytes) FROM s) AS DOUBLE) AS size_ratio FROM s")
_SIX_HOURS = "time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2023-12-31 00:00:00')"
ORACLE["raw_group_count_prefix"] = (
    f"WITH f AS (SELECT DISTINCT {_SIX_HOURS} AS slot FROM events), r AS (SELECT slot, row_number() OVER (ORDER BY slot) AS i, "
    "GREATEST(1, CAST(round_even(COUNT(*) OVER () * 0.3, 0) AS BIGINT)) AS k FROM f) "
    f"SELECT x.ActionGeo_CountryCode, COUNT(*) AS n FROM ({RAW}) x JOIN events ON event_id = GlobalEventID "
    f"WHERE {_SIX_HOURS} IN (SELECT slot FROM r WHERE i <= k) GROUP BY x.ActionGeo_CountryCode")


def _gaps_sql(start: str, end: str, minutes: int) -> str:
    grid = f"SELECT slot FROM generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL {minutes} MINUTE) t(slot)"
    present = f"SELECT DISTINCT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '{start}') FROM events"
    return (f"WITH g AS (SELECT slot, row_number() OVER (ORDER BY slot) AS i FROM ({grid}) x), "
            f"m AS (SELECT slot, i - row_number() OVER (ORDER BY slot) AS run FROM g WHERE slot NOT IN ({present})) "
            "SELECT MIN(slot) AS first_missing, MAX(slot) AS last_missing, COUNT(*) AS n_missing FROM m GROUP BY run")


ORACLE["slice_gaps"] = _gaps_sql(B.SLICE_START, B.SLICE_END, B.SLICE_MINUTES)
ORACLE["listed_slice_gaps"] = _gaps_sql(B.FILE_START, B.FILE_END, B.FILE_MINUTES)
ORACLE["listed_slice_completeness"] = (
    "SELECT COUNT(*) AS n_expected, COUNT(p.slot) AS n_present, COUNT(*) - COUNT(p.slot) AS n_missing FROM "
    f"generate_series(TIMESTAMP '{B.FILE_START}', TIMESTAMP '{B.FILE_END}', INTERVAL 6 HOUR) g(slot) "
    f"LEFT JOIN (SELECT DISTINCT {_SIX_HOURS} AS slot FROM events) p ON g.slot = p.slot")
ORACLE["raw_clean_published"] = (f"SELECT {', '.join(KEPT_COLUMNS)} FROM ({RAW}) r WHERE SQLDATE BETWEEN 20240101 AND 20240125")
ORACLE["raw_coverage_refreshed"] = ORACLE["raw_coverage"]
ORACLE["raw_pairs_refreshed"] = ORACLE["raw_pairs"]
ORACLE["dirty_scan_once"] = (
    "SELECT 'valid' AS output, ActionGeo_CountryCode AS key, COUNT(*) AS n FROM "
    f"(SELECT r.ActionGeo_CountryCode, x.rule FROM ({RAW}) r JOIN ({DIRTY}) x USING (GlobalEventID)) v WHERE rule IS NULL GROUP BY 2 UNION ALL "
    f"SELECT 'rejects', rule, COUNT(*) FROM ({DIRTY}) x WHERE rule IS NOT NULL GROUP BY rule")
ORACLE["dirty_stream"] = (
    f"SELECT 'kept' AS output, CAST(SQLDATE AS VARCHAR) AS key, COUNT(*) AS n FROM ({DIRTY}) x "
    "WHERE rule IS NULL AND SQLDATE BETWEEN 20240105 AND 20240125 GROUP BY 2 UNION ALL "
    f"SELECT 'rejects', rule, COUNT(*) FROM ({DIRTY}) x WHERE rule IS NOT NULL GROUP BY rule")
ORACLE["raw_coverage_written"] = ORACLE["raw_coverage"]
ORACLE["raw_pairs_written"] = ORACLE["raw_pairs"]
ORACLE["raw_top_pairs"] = (
    "SELECT *, Actor1CountryCode || ' → ' || Actor2CountryCode AS pair FROM "
    f"({ORACLE['raw_pairs']}) x WHERE Actor1CountryCode <> Actor2CountryCode "
    "ORDER BY n_events DESC, Actor1CountryCode, Actor2CountryCode LIMIT 15")
