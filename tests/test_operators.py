"""Operator edge cases (FIXTURES §5), invariants and plan shapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from covlens.functions.exprs import day_from_int, exact_mean, is_weekend, pair_label, period
from covlens.operators.coverage import (
    category_ratio, count_by, coverage_daily, n_groups, top_codes, weekend_drop,
)
from covlens.operators.joins import (
    assert_unique_keys, dimension_diff, duplicate_labels, join_dimension, join_roles,
    label_codes, validate_dimension,
)
from covlens.operators.pairs import (
    domestic_share, entity_distribution, exclusion_breakdown, exclusion_causes,
    pair_filter_report, pair_interactions, top_pairs,
)
from covlens.operators.prepare import (
    alias_impact, assert_one_level, normalize_codes, prefix_slices, window_report,
)
from covlens.operators.quality import (
    layouts_agree, match_rate, missing_slices, null_profile, slice_completeness, unmatched_codes,
)
from covlens.session import shared_dir
from covlens.sources.scan import read_events
from covlens.sources.sinks import write_partitioned
from tests.conftest import write_lines

GEO = [("US", "United States"), ("RI", "Serbia"), ("FR", "France")]
TYPES = [("USA", "country"), ("FRA", "country"), ("EUR", "region"), ("PRI", "territory")]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def geo(spark):
    return spark.createDataFrame(GEO, "code string, label string")


@pytest.fixture()
def types(spark):
    return spark.createDataFrame(TYPES, "code string, entity_type string")


@pytest.fixture()
def events(spark):
    rows = [
        (1, 20240105, "US", 1, 2.0), (2, 20240105, "US", 3, -1.0), (3, 20240105, "RB", 4, None),
        (4, 20240106, "YI", 2, 0.5), (5, 20240106, None, 1, 1.0), (6, 20240106, "OC", 5, 3.0),
        (7, 20240106, "US", None, 1.25), (8, 20240107, "FR", 3, -2.5),
    ]
    return spark.createDataFrame(rows, "id long, day long, code string, quad long, tone double")


# ---------------------------------------------------------------- functions

def test_scalar_functions(spark):
    r = spark.createDataFrame([(20240106, 20241301)], "d long, bad long").select(
        day_from_int("d").alias("d"), day_from_int("bad").alias("bad"),
        is_weekend(day_from_int("d")).alias("we"), period("d", "month", 8).alias("m"),
        period("d", "year", 8).alias("y"), pair_label(F.lit("A"), F.lit(None)).alias("p"),
    ).collect()[0]
    assert r.d == dt.date(2024, 1, 6) and r.bad is None and r.we is True
    assert (r.m, r.y, r.p) == (202401, 2024, "A → ")


def test_exact_mean_ignores_nulls_and_is_order_free(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "v double")
    got = df.agg(exact_mean("v").alias("m")).collect()[0].m
    assert got == pytest.approx(0.2, abs=1e-15)
    assert df.repartition(3).agg(exact_mean("v").alias("m")).collect()[0].m == got


# ---------------------------------------------------------------- aliases

def test_normalize_codes_dict_and_frame_agree(spark, events):
    aliases = {"RB": "RI", "YI": "RI"}
    a = normalize_codes(events, "code", aliases).orderBy("id").collect()
    amap = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    b = normalize_codes(events, "code", amap).orderBy("id").collect()
    assert [r.code for r in a] == [r.code for r in b] == ["US", "US", "RI", "RI", None, "OC", "US", "FR"]


def test_alias_chain_rejected(spark, events):
    with pytest.raises(ValueError):
        normalize_codes(events, "code", {"A": "B", "B": "C"})
    amap = spark.createDataFrame([("A", "B"), ("B", "C")], "alias string, canonical string")
    with pytest.raises(ValueError):
        assert_one_level(amap)
    with pytest.raises(ValueError):
        normalize_codes(events, "code", {"A": None})


def test_repeated_alias_fails_instead_of_multiplying_rows(spark, events):
    amap = spark.createDataFrame([("RB", "RI"), ("RB", "US"), (None, "x"), ("y", None)], "alias string, canonical string")
    with pytest.raises(Exception, match="not unique"):
        normalize_codes(events, "code", amap).collect()


@pytest.mark.parametrize("n", [1, 2, 20])
def test_alias_tables_and_dicts_agree_at_every_size(spark, events, n):
    aliases = {"RB": "RI", **{f"Q{i}": f"Z{i}" for i in range(n - 1)}}
    amap = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    for f in (lambda a: normalize_codes(events, "code", a), lambda a: alias_impact(events, "code", a)):
        assert sorted(map(str, f(aliases).collect())) == sorted(map(str, f(amap).collect()))
    impact = {r.canonical: (r.n_before, r.n_after) for r in alias_impact(events, "code", aliases).collect()}
    assert len(impact) == n and all(v == (0, 0) for k, v in impact.items() if k != "RI")


def test_alias_impact_recovered_equals_alias_rows(events):
    r = alias_impact(events, "code", {"RB": "RI", "YI": "RI"}).collect()
    assert [(x.canonical, x.n_before, x.n_after, x.n_recovered) for x in r] == [("RI", 0, 2, 2)]


# ---------------------------------------------------------------- dimensions

def test_dimension_checks(spark):
    dim = spark.createDataFrame([("GV", "Equatorial Guinea"), ("EK", "Equatorial Guinea"),
                                 ("US", "United States"), ("US", "USA")], "code string, label string")
    assert [(r.code, r.n_rows) for r in validate_dimension(dim, "code").collect()] == [("US", 2)]
    with pytest.raises(ValueError):
        assert_unique_keys(dim, "code")
    d = duplicate_labels(dim, "code", "label").collect()
    assert sorted((r.label, r.code, r.n_codes) for r in d) == [("Equatorial Guinea", "EK", 2), ("Equatorial Guinea", "GV", 2)]
    other = spark.createDataFrame([("US",), ("SSD",)], "code string")
    diff = {(r.code, r.side) for r in dimension_diff(dim, other, "code").collect()}
    assert diff == {("GV", "left_only"), ("EK", "left_only"), ("SSD", "right_only")}


def test_join_strategies_in_plan(spark, events, geo):
    b = join_dimension(events, geo, "code", how="inner", strategy="broadcast", max_bytes=None)
    m = join_dimension(events, geo, "code", how="inner", strategy="merge")
    assert "BroadcastHashJoin" in plan_text(b)
    assert "SortMergeJoin" in plan_text(m)
    assert sorted(r.id for r in b.collect()) == sorted(r.id for r in m.collect()) == [1, 2, 7, 8]
    # the size check refuses to broadcast past its bound
    with pytest.raises(ValueError):
        join_dimension(events, spark.range(100).select(F.col("id").cast("string").alias("code")), "code",
                       strategy="broadcast", max_bytes=100)
    assert "BroadcastHashJoin" not in plan_text(join_dimension(events, geo.hint("merge"), "code", strategy="auto"))


def test_building_plans_runs_no_job(spark, events, geo):
    from covlens.operators.quality import match_rate

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "plans only")
    try:
        joined = join_dimension(normalize_codes(events, "code", {"RB": "RI"}), geo, "code", check_unique=True)
        plan_text(joined), plan_text(match_rate(events, "code", geo, "code"))
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_salt_splits_equal_rows(spark, geo):
    fact = spark.createDataFrame([("US",)] * 800, "code string").coalesce(1)
    j = join_dimension(fact, geo, "code", strategy="merge", salt_buckets=8)
    assert j.count() == 800
    salted = fact.withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(8)))
    assert salted.groupBy("s").count().count() == 8 and "monotonically_increasing_id" in plan_text(j)


def test_label_codes_falls_back_to_code(events, geo):
    r = {x.code: x.label for x in label_codes(count_by(events, "code"), "code", geo, "code", "label")
         .collect()}
    assert r["US"] == "United States" and r["OC"] == "OC" and r[None] is None


def test_join_roles(spark, types):
    fact = spark.createDataFrame([("USA", "EUR"), ("XXX", None)], "a string, b string")
    r = join_roles(fact, types, "code", {"ra": "a", "rb": "b"}).orderBy("a").collect()
    assert [(x.ra_entity_type, x.rb_entity_type) for x in r] == [("country", "region"), (None, None)]


# ---------------------------------------------------------------- coverage

def test_coverage_daily_categories_nulls_and_unmatched(events, geo):
    out = coverage_daily(normalize_codes(events, "code", {"RB": "RI", "YI": "RI"}), geo, "code",
                         "day", dim_key="code", label="label", measure="tone", category="quad",
                         categories={1: "n_vc", 2: "n_mc", 3: "n_vk", 4: "n_mk"})
    rows = {(r.code, r.day): r for r in out.collect()}
    assert set(rows) == {("US", 20240105), ("RI", 20240105), ("RI", 20240106), ("US", 20240106),
                         ("FR", 20240107)}
    us6 = rows[("US", 20240106)]
    assert us6.n_events == 1 and us6.n_vc + us6.n_mc + us6.n_vk + us6.n_mk == 0  # NULL category
    ri5 = rows[("RI", 20240105)]
    assert ri5.avg_tone is None and ri5.n_mk == 1                                  # NULL measure
    assert rows[("US", 20240105)].avg_tone == pytest.approx(0.5)
    for r in rows.values():
        assert r.n_vc + r.n_mc + r.n_vk + r.n_mk <= r.n_events


def test_match_rate_and_unmatched_add_up(events, geo):
    r = match_rate(events, "code", geo, "code").collect()[0]
    assert (r.n_coded, r.n_matched, r.n_unmatched) == (7, 4, 3)
    assert r.n_matched + r.n_unmatched == r.n_coded
    un = [(x.code, x.n_events) for x in unmatched_codes(events, "code", geo, "code").collect()]
    assert un == [("OC", 1), ("RB", 1), ("YI", 1)]   # ties ordered by code


def test_empty_table_gives_null_percentages(spark, geo):
    empty = spark.createDataFrame([], "id long, day long, code string")
    r = match_rate(empty, "code", geo, "code").collect()[0]
    assert (r.n_coded, r.pct_matched) == (0, None)
    w = window_report(empty, "day", 1, 2).collect()[0]
    assert (w.n_read, w.pct_removed) == (0, None)


def test_window_report_nulls_count_as_removed(spark):
    df = spark.createDataFrame([(20240101,), (20240102,), (None,), (20231231,)], "d long")
    r = window_report(df, "d", 20240101, 20240131).collect()[0]
    assert (r.n_read, r.n_kept, r.n_removed, r.pct_removed) == (4, 2, 2, 50.0)


def test_category_ratio_zero_denominator_is_null(spark):
    cov = spark.createDataFrame([("A", 5, 0, 5), ("B", 4, 2, 2), ("C", 1, 1, 0)],
                                "code string, n_events long, coop long, conf long")
    r = {x.code: x.ratio for x in category_ratio(cov, ["code"], ["conf"], ["coop"], top_n=2)
         .collect()}
    assert r == {"A": None, "B": 1.0}


def test_top_codes_ties_break_on_code(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", "c", "c", None, None]], "code string")
    r = [(x.code, x.n_events) for x in top_codes(df, "code", 3).collect()]
    assert r == [(None, 2), ("c", 2), ("a", 1)]


def test_groups_include_null(events):
    assert n_groups(events, "code").collect()[0].n_groups == 6


def test_weekend_drop(spark):
    days = [dt.date(2024, 1, d) for d in (5, 5, 5, 5, 6, 6, 8, 8)]   # Fri x4, Sat x2, Mon x2
    r = weekend_drop(spark.createDataFrame([(d,) for d in days], "day date"), "day").collect()[0]
    assert (r.n_weekdays, r.n_weekend_days, r.avg_weekday, r.avg_weekend) == (2, 1, 3.0, 2.0)
    assert r.weekend_drop == pytest.approx(1 / 3)


# ---------------------------------------------------------------- pairs

@pytest.fixture()
def pair_fact(spark):
    rows = [("USA", "FRA", 1.0), ("USA", "FRA", 3.0), ("FRA", "USA", -1.0), ("USA", "USA", 2.0),
            ("USA", "EUR", 0.0), (None, "FRA", 0.0), ("PRI", None, 0.0), (None, None, 0.0),
            ("XXX", "USA", 0.0)]
    return spark.createDataFrame(rows, "a string, b string, tone double")


KW = dict(type_key="code", type_col="entity_type", entity_type="country")


def test_pairs_are_directed(pair_fact, types):
    r = {(x.a, x.b): (x.n_events, x.avg_tone) for x in
         pair_interactions(pair_fact, types, "a", "b", measure="tone", **KW).collect()}
    assert r == {("USA", "FRA"): (2, 2.0), ("FRA", "USA"): (1, -1.0), ("USA", "USA"): (1, 2.0)}


def test_exclusion_buckets_add_up(pair_fact, types):
    rep = pair_filter_report(pair_fact, types, "a", "b", **KW).collect()[0]
    br = {x.outcome: x.n_events for x in exclusion_breakdown(pair_fact, types, "a", "b", **KW)
          .collect()}
    assert rep.n_total == 9 and rep.n_kept == 4 and rep.n_excluded == 5
    assert br == {"kept": 4, "b_only": 1, "a_only": 2, "both": 2}
    assert sum(br.values()) == rep.n_total
    causes = {x.cause: x.n_events for x in
              exclusion_causes(pair_fact, types, "a", "b", "b", **KW).collect()}
    assert causes == {"region": 1, "null": 2}
    dist = {x.bucket: x.n_events for x in
            entity_distribution(pair_fact, "a", types, type_key="code", type_col="entity_type")
            .collect()}
    assert dist == {"country": 5, "null": 2, "territory": 1, "unknown_code": 1}


def test_domestic_share_and_top_pairs(pair_fact, types, spark):
    pairs = pair_interactions(pair_fact, types, "a", "b", measure="tone", **KW)
    d = domestic_share(pairs, "a", "b").collect()[0]
    assert (d.n_pairs, d.n_domestic_pairs, d.n_events, d.n_domestic_events) == (3, 1, 4, 1)
    names = spark.createDataFrame([("USA", "United States")], "code string, name string")
    top = top_pairs(pairs, "a", "b", 5, dim=names, dim_key="code", label="name").collect()
    assert [x.pair for x in top] == ["United States → FRA", "FRA → United States"]


# ---------------------------------------------------------------- quality

def test_null_profile_most_empty_first(events):
    r = [(x.column, x.n_null) for x in null_profile(events).collect()]
    assert r[:2] == [("code", 1), ("quad", 1)] and r[-1][1] == 0
    assert len(r) == 5


def test_missing_slice_reported(spark):
    ts = ["2024-01-01 00:00:00", "2024-01-01 00:14:59", "2024-01-01 00:31:00"]
    df = spark.createDataFrame([(t,) for t in ts], "t string").select(
        F.to_timestamp_ntz("t").alias("ts"))
    r = slice_completeness(df, "ts", "2024-01-01 00:00:00", "2024-01-01 00:45:00").collect()[0]
    assert (r.n_expected, r.n_present, r.n_missing) == (4, 2, 2)
    miss = sorted(str(x.slot) for x in missing_slices(df, "ts", "2024-01-01 00:00:00",
                                                      "2024-01-01 00:45:00").collect())
    assert miss == ["2024-01-01 00:15:00", "2024-01-01 00:45:00"]


def test_layouts_agree_detects_difference(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "c string")
    b = spark.createDataFrame([("x",), (None,), (None,)], "c string")
    r = layouts_agree(a, b, "c").collect()[0]
    assert (r.n_groups_left, r.n_groups_right, r.n_differing, r.agree) == (2, 2, 2, False)
    assert layouts_agree(a, a, "c").collect()[0].agree is True


# ---------------------------------------------------------------- subsets and sinks

def test_prefix_slices_spans_partitions(spark):
    units = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("u"))
    assert sorted(r.u for r in prefix_slices(units, "u", 0.407).collect()) == [3 * i for i in range(407)]


def test_prefix_slices_rounds_half_to_even(spark):
    df = spark.createDataFrame([(d,) for d in [1, 1, 2, 3, 4, 5]], "unit long")
    assert sorted(r.unit for r in prefix_slices(df, "unit", 0.5).collect()) == [1, 1, 2]  # 2.5 → 2
    assert sorted(r.unit for r in prefix_slices(df, "unit", 0.01).collect()) == [1, 1]   # at least 1


def test_dynamic_overwrite_keeps_other_days_and_types(spark):
    path = shared_dir(spark, "test-overwrite")
    schema = "id long, SQLDATE long"
    first = spark.createDataFrame([(1, 20240101), (2, 20240102), (3, 20240103)], schema)
    write_partitioned(first, path, "SQLDATE", overwrite="dynamic")
    second = spark.createDataFrame([(9, 20240102)], schema)
    write_partitioned(second, path, "SQLDATE", overwrite="dynamic")
    back = read_events(spark, path, schema=first.schema)
    assert dict(back.dtypes)["SQLDATE"] == "bigint"        # explicit schema keeps bigint (T3)
    assert sorted((r.id, r.SQLDATE) for r in back.collect()) == [
        (1, 20240101), (3, 20240103), (9, 20240102)]
    pruned = back.where(F.col("SQLDATE") == 20240103)
    scan = [line for line in plan_text(pruned).splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(SQLDATE" in scan and "20240103" in scan
    write_partitioned(second, path, "SQLDATE", overwrite="static")
    assert read_events(spark, path, schema=first.schema).count() == 1


def test_dimension_rows_prefix_and_null_flag(spark):
    from pyspark.sql import types as T

    from covlens.functions.exprs import null_flag, starts_with
    from covlens.sources.scan import dimension

    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("label", T.StringType())])
    dim = dimension(spark, [("USA", "United States"), ("SSD", "South Sudan")], schema)
    assert dim.count() == 2 and dim.columns == ["code", "label"]
    df = spark.createDataFrame([(20160101,), (20250801,), (None,)], "d long")
    r = df.select(starts_with("d", "2016").alias("p"), null_flag("d").alias("n")).collect()
    assert [(x.p, x.n) for x in r] == [(True, 0), (False, 0), (None, 1)]


def test_join_dimension_unique_check(spark, events):
    dup = spark.createDataFrame([("US", "a"), ("US", "b")], "code string, label string")
    with pytest.raises(Exception, match="not unique"):
        join_dimension(events, dup, "code", check_unique=True).collect()
    assert join_dimension(events, dup, "code").count() == 6      # inflated: 3 US rows x 2


def test_hot_key_holding_a_third_of_rows(spark, geo):
    n = 300_000
    fact = spark.range(0, n, 1, 12).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("US"))
        .otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("code"),
        (F.col("id") % 5).alias("quad"), (F.col("id") % 7 / 4).alias("tone"),
        F.lit(20240105).alias("day"))
    cov_df = coverage_daily(fact, geo, "code", "day", dim_key="code", label="label",
                            measure="tone", category="quad", categories={1: "n1"})
    assert "partial_count" in plan_text(cov_df)      # hot key shrinks map-side
    assert [(r.code, r.n_events) for r in cov_df.collect()] == [("US", n // 3)]
    m = match_rate(fact, "code", geo, "code").collect()[0]
    assert (m.n_coded, m.n_matched) == (n, n // 3)
    merged = join_dimension(fact.select("id", "code"), geo, "code", strategy="merge")
    assert merged.count() == n // 3


def test_salted_join_equals_plain_join(spark, geo):
    fact = spark.range(0, 30_000, 1, 6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("US")).otherwise(F.lit("FR")).alias("code"))
    plain = join_dimension(fact, geo, "code", strategy="merge")
    salted = join_dimension(fact, geo, "code", strategy="merge", salt_buckets=8)
    assert "_salt" in plan_text(salted) and salted.columns == plain.columns
    assert sorted(salted.collect()) == sorted(plain.collect())
    left = join_dimension(fact.union(spark.createDataFrame([(-1, "ZZ")], "id long, code string")),
                          geo, "code", how="left", strategy="merge", salt_buckets=4)
    assert left.where(F.col("label").isNull()).count() == 1 and left.count() == 30_001


def test_salting_skipped_when_broadcast(spark, geo):
    fact = spark.createDataFrame([(1, "US")], "id long, code string")
    j = join_dimension(fact, geo, "code", strategy="broadcast", salt_buckets=8, max_bytes=None)
    assert "_salt" not in plan_text(j) and "BroadcastHashJoin" in plan_text(j)
    h = join_dimension(fact, geo, "code", strategy="shuffle_hash", salt_buckets=4)
    assert "_salt" in plan_text(h) and h.count() == 1


def test_slice_completeness_from_file_listing(spark, tmp_path):
    from covlens.operators.quality import file_listing, listed_slices

    folder = tmp_path / "raw"
    folder.mkdir()
    for stamp in ["20260801000000", "20260801001500", "20260801004500"]:   # 00:30 missing
        (folder / f"{stamp}.export.CSV").write_text("x\n")
    (folder / "notes.txt").write_text("not a slice\n")
    slots = listed_slices(file_listing(spark, str(folder)))
    assert slots.where(F.col("slot").isNull()).count() == 1
    r = slice_completeness(slots, "slot", "2026-08-01 00:00:00", "2026-08-01 00:45:00").collect()[0]
    assert (r.n_expected, r.n_present, r.n_missing) == (4, 3, 1)
    miss = [str(x.slot) for x in missing_slices(slots, "slot", "2026-08-01 00:00:00",
                                                "2026-08-01 00:45:00").collect()]
    assert miss == ["2026-08-01 00:30:00"]


def test_file_size_reports(spark, tmp_path):
    from covlens.operators.quality import file_listing, layout_sizes, size_per_day, slice_sizes

    raw = tmp_path / "raw"
    raw.mkdir()
    sizes = {"20260801000000.export.CSV": 100, "20260801001500.export.CSV": 300,
             "20260802000000.export.CSV": 50}
    for name, n in sizes.items():
        (raw / name).write_bytes(b"x" * n)
    (raw / "_SUCCESS").write_bytes(b"")                      # hidden from the listing
    small = tmp_path / "small"
    small.mkdir()
    (small / "part-0.parquet").write_bytes(b"y" * 45)
    listing = file_listing(spark, str(raw))
    s = slice_sizes(listing).collect()[0]
    assert (s.n_files, s.n_bytes, s.avg_bytes_per_file) == (3, 450, 150.0)
    per_day = {r.day: (r.n_files, r.n_bytes) for r in
               size_per_day(listing, r"/([0-9]{8})[0-9]{6}\.export\.CSV$").collect()}
    assert per_day == {"20260801": (2, 400), "20260802": (1, 50)}
    lay = {r.layout: (r.n_files, r.n_bytes, r.size_ratio) for r in
           layout_sizes(spark, {"raw": str(raw), "parquet": str(small)}).collect()}
    assert lay == {"raw": (3, 450, 10.0), "parquet": (1, 45, 1.0)}


def test_prefix_and_index_on_empty_input(spark):
    empty = spark.createDataFrame([], "unit long")
    assert prefix_slices(empty, "unit", 0.5).count() == 0


def test_large_alias_dict_uses_map_and_matches_join(spark):
    aliases = {f"A{i}": f"C{i % 7}" for i in range(50)}
    df = spark.createDataFrame([(f"A{i}",) for i in range(60)] + [(None,), ("C3",)], "code string")
    by_dict = normalize_codes(df, "code", aliases, out="n")
    assert "CASE WHEN" not in plan_text(by_dict)
    amap = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    by_join = normalize_codes(df, "code", amap, out="n")
    assert sorted(map(tuple, by_dict.collect()), key=str) == sorted(map(tuple, by_join.collect()), key=str)
    got = dict((r.code, r.n) for r in by_dict.collect())
    assert got["A10"] == "C3" and got["A55"] == "A55" and got[None] is None and got["C3"] == "C3"


def test_mean_of_values_as_they_are(spark, geo):
    from covlens.operators.coverage import coverage_daily

    kw = dict(dim_key="code", label="label", measure="m", category="c", categories={1: "n_one"}, mean_name="mean")
    rows = [("US", 1, 0.00004, 1), ("US", 1, 0.00004, 2), ("US", 1, -2.82485875706215, 1), ("US", 1, None, 1), ("US", 2, float("nan"), 1), ("US", 2, 1e300, 1)]
    got = {r.d: r for r in coverage_daily(spark.createDataFrame(rows, "code string, d int, m double, c int"), geo, "code", "d", **kw).collect()}
    assert got[1]["mean"] == pytest.approx(-0.94159291902, abs=1e-11) and (got[1].n_events, got[1].n_one) == (4, 3)
    assert got[2]["mean"] != got[2]["mean"]  # NaN, as avg gives


@pytest.mark.parametrize("step, present", [(15, 2), (45, 2), (120, 2), (240, 1)])
def test_slices_of_any_width_count_from_the_grids_start(spark, step, present):
    from covlens.operators.quality import slice_completeness

    ts = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 01:30:00'), (TIMESTAMP_NTZ'2024-01-01 03:30:00') AS t(ts)")
    r = slice_completeness(ts, "ts", "2024-01-01 00:00:00", "2024-01-01 23:59:00", step).first()
    assert (r.n_expected, r.n_present) == (1439 // step + 1, present)


def test_map_side_partitioned_write(spark):
    path = shared_dir(spark, "test-mapside")
    df = spark.createDataFrame([(i, 20240101 + i % 3) for i in range(30)], "id long, day long")
    write_partitioned(df, path, "day", shuffle="none")
    assert sorted(r.day for r in spark.read.parquet(path).select("day").distinct().collect()) == [
        20240101, 20240102, 20240103]
    assert spark.read.parquet(path).count() == 30
    with pytest.raises(ValueError):
        write_partitioned(df, path, "day", shuffle="hash")


def test_size_by_weekpart_normalises_per_day(spark, tmp_path):
    from covlens.operators.quality import file_listing, size_by_weekpart

    raw = tmp_path / "wk"
    raw.mkdir()
    # Tue 2026-08-04: 420 bytes; Sat 08 + Sun 09: 240 + 260 bytes
    for name, n in {"20260804000000.export.CSV": 420, "20260808000000.export.CSV": 240,
                    "20260809000000.export.CSV": 200, "20260809001500.export.CSV": 60}.items():
        (raw / name).write_bytes(b"z" * n)
    r = {x.weekend: (x.n_days, x.n_files, x.n_bytes, x.bytes_per_day) for x in
         size_by_weekpart(file_listing(spark, str(raw)), r"/([0-9]{8})[0-9]{6}").collect()}
    assert r == {False: (1, 1, 420, 420.0), True: (2, 3, 500, 250.0)}


def test_prefix_files_picks_first_files_by_name(spark, tmp_path):
    from covlens.operators.quality import file_listing, prefix_files

    raw = tmp_path / "slices"
    raw.mkdir()
    stamps = ["20260801000000", "20260801001500", "20260801003000", "20260801004500",
              "20260801010000"]
    for st in reversed(stamps):
        (raw / f"{st}.export.CSV").write_text("x\n")
    listing = file_listing(spark, str(raw))
    picked = [p.rsplit("/", 1)[1][:14] for p in prefix_files(listing, 0.5)]
    assert picked == stamps[:2]                      # round(2.5) = 2, half to even
    assert len(prefix_files(listing, 0.01)) == 1     # at least one file
    assert len(prefix_files(listing, 1.0)) == 5


def test_hot_keys_are_salted_alone(spark, geo):
    """A key with a third of the rows is spread over the tasks; the dimension's other rows stay single."""
    from covlens.operators.joins import hot_keys

    codes = [r.code for r in geo.collect()]
    fact = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit(codes[0])).when(F.col("id") % 97 == 0, F.lit(None).cast("string"))
                                    .otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("code"))
    dim = geo.unionByName(spark.range(500).select(F.concat(F.lit("c"), F.col("id")).alias("code"), *[F.lit("x").alias(c) for c in geo.columns if c != "code"]))
    assert [(r.code, r._salts) for r in hot_keys(fact, "code", 8).collect()] == [(codes[0], 3)]
    hot = join_dimension(fact, dim, "code", strategy="merge", salt_buckets="hot")
    plain = join_dimension(fact, dim, "code", strategy="merge")
    assert hot.columns == plain.columns and sorted(hot.collect()) == sorted(plain.collect())
    left = join_dimension(fact, dim, "code", how="left", strategy="merge", salt_buckets="hot")
    assert left.count() == 9000 + plain.count() - fact.join(dim, "code", "left_semi").count()
    text = plan_text(hot)
    assert "_salt" in text and "SortMergeJoin" in text
    spread = fact.join(F.broadcast(hot_keys(fact, "code", 8)), "code", "left").withColumn("s", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("_salts", F.lit(1))))
    most = spread.groupBy("code", "s").count().agg(F.max("count")).first()[0]
    assert most <= 1.2 * 9000 / 8


def test_no_key_is_hot_among_equals(spark):
    from covlens.operators.joins import hot_keys

    assert hot_keys(spark.range(1000).select((F.col("id") % 50).alias("k")), "k", 8).count() == 0
    assert hot_keys(spark.range(0).select(F.col("id").alias("k")), "k", 8).count() == 0


def test_names_with_dots(spark):
    from covlens.operators.joins import unique_by

    dim = spark.createDataFrame([("a", 1), ("b", 2)], "`co.de` string, `lab.el` int")
    assert sorted(map(tuple, unique_by(dim, "co.de").collect())) == [("a", 1), ("b", 2)]
    assert unique_by(dim, "lab.el").columns == ["co.de", "lab.el"]


def gaps(spark, stamps, start, end, minutes):
    from covlens.operators.quality import gap_runs

    df = spark.createDataFrame([(s,) for s in stamps], "ts string").select(F.to_timestamp_ntz("ts").alias("ts"))
    return sorted((str(r.first_missing), str(r.last_missing), r.n_missing) for r in gap_runs(df, "ts", start, end, minutes).collect())


def test_gap_runs(spark, monkeypatch):
    from covlens.operators import quality

    day = "2024-01-01 "
    assert gaps(spark, [], day + "00:00:00", day + "01:00:00", 15) == [(day + "00:00:00", day + "01:00:00", 5)]
    stamps = [day + "00:15:00", day + "00:20:00", day + "01:00:00", "2023-12-31 00:00:00", "2024-02-01 00:00:00"]
    want = [(day + "00:00:00", day + "00:00:00", 1), (day + "00:30:00", day + "00:45:00", 2), (day + "01:15:00", day + "01:30:00", 2)]
    for block in (4096, 2, 1):
        monkeypatch.setattr(quality, "GAP_BLOCK", block)
        assert gaps(spark, stamps, day + "00:00:00", day + "01:30:00", 15) == want
    assert gaps(spark, [day + "00:00:00"], day + "00:00:00", day + "00:44:00", 45) == []


def test_prefix_scan_reads_the_first_files_only(spark, tmp_path):
    from covlens.operators.quality import file_listing, prefix_scan

    for i in range(10):
        write_lines(tmp_path / "f" / f"2024010{i}000000 a+b%41.CSV", [f"{i}"])
    path = str(tmp_path / "f")
    df = prefix_scan(spark.read.text(path), file_listing(spark, path), 0.3)
    assert sorted(r.value for r in df.collect()) == ["0", "1", "2"]
    assert df._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles() == 3
    assert prefix_scan(spark.read.text(path), file_listing(spark, path, glob="*.none"), 0.3).count() == 0


def test_a_pipeline_scan_reads_only_kept_columns(spark, tmp_path):
    """Reports read their columns off the consolidated table, not the kept twelve."""
    from covlens.plans.catalog import QUERIES

    df = QUERIES["raw_match_rate"](spark, "/root/testdata/sf0.001")
    scans = [line for line in plan_text(df).splitlines() if "ReadSchema" in line and "ActionGeo" in line]
    assert scans and all("SOURCEURL" not in s and "Actor1" not in s for s in scans)
