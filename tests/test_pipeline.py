"""End-to-end batch pipeline on hand-made 61-column raw slices."""

from pyspark.sql import functions as F

from covlens.plans.pipeline import aggregate_pairs, aggregate_places, clean
from covlens.profiles import KEPT_COLUMNS, RAW_EVENT_FIELDS, raw_event_schema
from covlens.session import shared_dir
from covlens.sources.scan import read_events
from tests.conftest import write_lines

NAMES = [n for n, _ in RAW_EVENT_FIELDS]


def raw_line(gid, day, geo, a1, a2, quad, tone, **extra):
    f = dict.fromkeys(NAMES, "")
    f.update(GlobalEventID=str(gid), SQLDATE=str(day), MonthYear=str(day)[:6], Year=str(day)[:4],
             FractionDate="2024.0110", DATEADDED=f"{day}120000", ActionGeo_CountryCode=geo,
             Actor1CountryCode=a1, Actor2CountryCode=a2, QuadClass=str(quad), AvgTone=str(tone),
             ActionGeo_Type="1", GoldsteinScale="1.0", NumMentions="1", NumSources="1",
             NumArticles="1")
    f.update(extra)
    return "\t".join(f[n] for n in NAMES)


def test_clean_then_both_axes(spark, tmp_path):
    raw = tmp_path / "raw"
    write_lines(raw / "20240105000000.export.CSV", [
        raw_line(1, 20240105, "US", "USA", "FRA", 1, -2.5),
        raw_line(2, 20240105, "RB", "FRA", "USA", 4, 1.5),
        raw_line(3, 20231201, "US", "USA", "USA", 3, 0.0),          # outside the window
    ])
    write_lines(raw / "20240106000000.export.CSV", [
        raw_line(4, 20240106, "", "USA", "EUR", 2, 3.25),           # NULL place
        raw_line(5, 20240106, "OC", "", "FRA", 1, 1.0),
        raw_line("x5", 20240106, "US", "USA", "FRA", 1, 1.0),       # bad id → rejected
    ])
    out = shared_dir(spark, "test-clean")
    rej = shared_dir(spark, "test-rejects")
    report = clean(spark, str(raw / "*.export.CSV"), out, 20240101, 20240131,
                   rejects_path=rej).collect()[0]
    assert (report.n_lines, report.n_valid, report.n_rejected, report.n_kept, report.n_removed) \
        == (6, 5, 1, 4, 1)
    rejected = spark.read.parquet(rej).collect()
    assert [(r.file_name, r.violations) for r in rejected] == [
        ("20240106000000.export.CSV", ["GlobalEventID: not a bigint"])]

    schema = raw_event_schema()
    kept_schema = type(schema)([schema[c] for c in KEPT_COLUMNS])
    events = read_events(spark, out, schema=kept_schema)
    assert events.columns == KEPT_COLUMNS and dict(events.dtypes)["SQLDATE"] == "bigint"
    assert events.count() == 4

    geo = spark.createDataFrame([("US", "United States"), ("RI", "Serbia")], "code string, label string")
    cov_out = shared_dir(spark, "test-coverage-out")
    places = aggregate_places(events, geo, cov_out, aliases={"RB": "RI"})
    written = spark.read.parquet(cov_out)
    assert written.count() == 2 and "SQLDATE" in written.columns
    assert sorted(r.SQLDATE for r in written.select("SQLDATE").collect()) == [20240105, 20240105]
    cov = {(r.ActionGeo_CountryCode, r.SQLDATE): r for r in places["coverage"].collect()}
    assert set(cov) == {("US", 20240105), ("RI", 20240105)}
    assert cov[("RI", 20240105)].n_material_conflict == 1
    m = places["match_rate"].collect()[0]
    assert (m.n_coded, m.n_matched) == (3, 2)
    assert places["alias_impact"].collect()[0].n_recovered == 1

    types = spark.createDataFrame([("USA", "country"), ("FRA", "country"), ("EUR", "region")],
                                  "code string, entity_type string")
    pairs_out = shared_dir(spark, "test-pairs-out")
    ax2 = aggregate_pairs(events, types, pairs_out)
    assert spark.read.parquet(pairs_out).count() == 2
    pairs = {(r.Actor1CountryCode, r.Actor2CountryCode): r.n_events for r in ax2["pairs"].collect()}
    assert pairs == {("USA", "FRA"): 1, ("FRA", "USA"): 1}
    pf = ax2["pair_filter"].collect()[0]
    assert (pf.n_total, pf.n_kept, pf.n_excluded) == (4, 2, 2)


def test_clean_rerun_with_narrower_window_keeps_other_days(spark, tmp_path):
    raw = tmp_path / "raw2"
    write_lines(raw / "a.export.CSV", [raw_line(1, 20240105, "US", "", "", 1, 0.0),
                                       raw_line(2, 20240106, "US", "", "", 1, 0.0)])
    out = shared_dir(spark, "test-clean2")
    clean(spark, str(raw / "*.export.CSV"), out, 20240101, 20240131)
    clean(spark, str(raw / "*.export.CSV"), out, 20240106, 20240106)
    days = sorted(r.SQLDATE for r in spark.read.parquet(out).select("SQLDATE").collect())
    assert days == [20240105, 20240106]
    assert spark.read.parquet(out).where(F.col("SQLDATE") == 20240106).count() == 1


def test_axes_refuse_repeated_dimension_keys(spark):
    import pytest

    events = spark.createDataFrame(
        [(1, 20240105, "US", "USA", "FRA", 1, 1.0)],
        "GlobalEventID long, SQLDATE long, ActionGeo_CountryCode string, "
        "Actor1CountryCode string, Actor2CountryCode string, QuadClass long, AvgTone double")
    geo = spark.createDataFrame([("US", "United States"), ("US", "USA")], "code string, label string")
    with pytest.raises(Exception, match="not unique"):
        aggregate_places(events, geo)["coverage"].collect()
    types = spark.createDataFrame([("USA", "country"), ("USA", "region")],
                                  "code string, entity_type string")
    with pytest.raises(Exception, match="not unique"):
        aggregate_pairs(events, types)["pairs"].collect()


def test_rejects_on_odd_paths_and_after_a_repair(spark, tmp_path):
    raw, out, rej = tmp_path / "raw a%b" / "h=10%3A00", str(tmp_path / "out"), str(tmp_path / "rej")
    line = write_lines(raw / "20240105000000.export.CSV", [raw_line(1, 20240105, "US", "USA", "FRA", 1, 1.0), "broken"])
    report = clean(spark, str(raw.parent), out, 20240101, 20240131, rejects_path=rej).first()
    assert (report.n_lines, report.n_rejected, report.n_kept) == (2, 1, 1)
    bad = spark.read.parquet(rej).first()
    assert bad["_raw"] == "broken" and bad.violations[0].startswith("expected 61 fields")
    write_lines(raw / "20240105000000.export.CSV", [raw_line(1, 20240105, "US", "USA", "FRA", 1, 1.0)])
    assert clean(spark, str(raw.parent), out, 20240101, 20240131, rejects_path=rej).first().n_rejected == 0
    assert line and spark.read.parquet(rej).count() == 0


def test_withdrawn_day_goes_and_days_outside_stay(spark, tmp_path):
    out, old, new = str(tmp_path / "out"), tmp_path / "old", tmp_path / "new"
    write_lines(old / "a.CSV", [raw_line(i, 20240104 + i, "US", "USA", "FRA", 1, 1.0) for i in range(3)])
    write_lines(new / "a.CSV", [raw_line(9, 20240105, "US", "USA", "FRA", 1, 1.0)])
    clean(spark, str(old), out, 20240101, 20240131)
    report = clean(spark, str(new), out, 20240105, 20240131).first()
    days = sorted(r.SQLDATE for r in spark.read.parquet(out).collect())
    assert report.n_kept == 1 and days == [20240104, 20240105]


def test_files_of_a_day_are_few(spark, tmp_path):
    import glob

    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for i in range(40):
        write_lines(raw / f"{i:02}.CSV", [raw_line(i * 100 + k, 20240101 + k % 10, "US", "USA", "FRA", 1, 1.0) for k in range(30)])
    clean(spark, str(raw), out, 20240101, 20240131)
    assert len(glob.glob(f"{out}/*/*.parquet")) <= 20


def test_a_window_without_rows(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    write_lines(raw / "a.CSV", [raw_line(1, 20240105, "US", "", "", 1, 0.0), "broken"])
    clean(spark, str(raw), out, 20240101, 20240131)
    for mode in ("dynamic", "publish"):
        report = clean(spark, str(raw), out if mode == "dynamic" else out + "2", 20240201, 20240229, overwrite=mode).first()
        assert (report.n_lines, report.n_valid, report.n_rejected, report.n_kept, report.n_removed) == (2, 1, 1, 0, 1)
    assert spark.read.parquet(out).count() == 1
