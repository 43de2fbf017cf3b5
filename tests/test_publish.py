"""Days published as a unit, and the aggregates that are refreshed batch by batch."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import covlens.plans.refresh as refresh
import covlens.sources.publish as pub
from covlens.operators.pairs import pairs_from_partials
from covlens.plans.pipeline import aggregate_pairs, aggregate_places, clean
from covlens.sources.scan import read_events
from covlens.sources.sinks import fan_out
from tests.conftest import write_lines
from tests.test_pipeline import raw_line

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("day", T.LongType()), T.StructField("n", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(spark, path):
    return sorted(map(tuple, pub.read_published(spark, path, SCHEMA).collect()))


def test_days_are_replaced_and_withdrawn_as_a_unit(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows_of(spark, path) == []
    pub.publish_days(frame(spark, [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]), path, "day")
    state = pub.publish_days(frame(spark, [("B", 2, 20)]), path, "day", 2, 3, sort=["k"])
    assert rows_of(spark, path) == [("B", 2, 20), ("a", 1, 1)] and state.number == 2
    assert dict(read_events(spark, path, schema=SCHEMA).dtypes)["day"] == "bigint"
    assert sorted(read_events(spark, path).columns) == ["day", "k", "n"]


@pytest.mark.parametrize("step", ["before the marker", "within the marker", "after the marker"])
def test_a_run_that_stops_leaves_the_old_or_the_new_state(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    old, new = [("a", 1, 1), ("b", 2, 2)], [("a", 1, 10), ("c", 3, 30)]
    pub.publish_days(frame(spark, old), path, "day")

    def stop(*args):
        raise KeyboardInterrupt

    if step == "before the marker":
        monkeypatch.setattr(pub, "publish", stop)
    elif step == "within the marker":
        whole = pub.create_text
        monkeypatch.setattr(pub, "create_text", lambda s, p, text: (whole(s, p, text[: len(text) // 2]), stop()))
    else:
        monkeypatch.setattr(pub, "vacuum", stop)
    with pytest.raises(KeyboardInterrupt):
        pub.publish_days(frame(spark, new), path, "day", 1, 3)
    assert rows_of(spark, path) == (new if step == "after the marker" else old)
    monkeypatch.undo()
    pub.publish_days(frame(spark, new), path, "day", 1, 3)  # the run is repeated
    assert rows_of(spark, path) == new


def test_of_two_runs_from_one_state_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    base = pub.published(spark, path)
    folders = pub.write_days(frame(spark, [("a", 1, 1)]), path, "day")
    pub.publish_days(frame(spark, [("b", 2, 2)]), path, "day")
    with pytest.raises(RuntimeError, match="another run"):
        pub.publish(spark, path, base, folders)
    assert rows_of(spark, path) == [("b", 2, 2)]


def test_older_states_are_cleared_and_the_last_but_one_stays_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    states = [pub.publish_days(frame(spark, [("a", 1, i), ("z", 9, 0)] if i == 0 else [("a", 1, i)]), path, "day") for i in range(4)]
    assert sorted(map(tuple, pub.read_published(spark, path, SCHEMA, states[2]).collect())) == [("a", 1, 2), ("z", 9, 0)]
    assert [s.number for s in pub.history(spark, path)] == [4, 3]
    assert len(list((tmp_path / "t").glob("v=*"))) == 3  # day 9 of the first run is still named


def test_clean_publishes_rows_and_rejects_of_one_parse(spark, tmp_path):
    raw, out, rej = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "rej")
    write_lines(raw / "a.CSV", [raw_line(1, 20240104, "US", "", "", 1, 0.0), raw_line(2, 20240105, "US", "", "", 1, 0.0), "broken"])
    report = clean(spark, str(raw), out, 20240101, 20240131, overwrite="publish", rejects_path=rej).first()
    assert (report.n_lines, report.n_rejected, report.n_kept) == (3, 1, 2) and [r["_raw"] for r in spark.read.parquet(rej).collect()] == ["broken"]
    write_lines(raw / "a.CSV", [raw_line(3, 20240105, "FR", "", "", 1, 0.0)])
    clean(spark, str(raw), out, 20240105, 20240131, overwrite="publish", rejects_path=rej)
    assert sorted((r.GlobalEventID, r.SQLDATE) for r in read_events(spark, out).collect()) == [(1, 20240104), (3, 20240105)]
    assert spark.read.parquet(rej).count() == 0
    write_lines(raw / "a.CSV", ["broken"])
    clean(spark, str(raw), out, 20240101, 20240131, overwrite="publish")
    assert pub.published(spark, out).folders == {} and pub.is_published(spark, out)


EVENTS = "GlobalEventID long, SQLDATE long, ActionGeo_CountryCode string, Actor1CountryCode string, Actor2CountryCode string, QuadClass long, AvgTone double"


def events(spark, lo, hi):
    return spark.createDataFrame([(i, 20240101 + i % 4, None if i % 7 == 0 else f"G{i % 5}", f"A{i % 3}", None if i % 6 == 0 else f"A{i % 4}", 1 + i % 4, None if i % 11 == 0 else i / 8)
                                  for i in range(lo, hi)], EVENTS)


def test_batches_add_up_and_a_replay_changes_nothing(spark, tmp_path):
    store, out, pairs = (str(tmp_path / n) for n in ("store", "out", "pairs"))
    geo = spark.createDataFrame([(f"G{i}", f"place {i}") for i in range(4)], "code string, label string")
    types = spark.createDataFrame([(f"A{i}", "country") for i in range(3)], "code string, entity_type string")
    made = []
    for batch_id, lo, hi in (("b1", 0, 60), ("b2", 60, 200), ("b2", 60, 200), ("b1", 0, 60), ("b3", 200, 202)):
        refresh.merge_coverage(events(spark, lo, hi), store, batch_id)
        refresh.merge_pairs(events(spark, lo, hi), pairs, batch_id)
        made.append(len(refresh.refresh_coverage(spark, store, geo, out)))
    assert made == [4, 4, 0, 0, 2]  # days made anew: none by a replay, two by a batch of two days
    whole = events(spark, 0, 202)
    want = aggregate_places(whole, geo)["coverage"]
    got = pub.read_published(spark, out, want.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    full = aggregate_pairs(whole, types)["pairs"]
    fresh = pairs_from_partials(refresh.stored(spark, pairs), types, "Actor1CountryCode", "Actor2CountryCode", type_key="code",
                                type_col="entity_type", entity_type="country", mean_name="avg_tone")
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, full.collect()))


def test_a_refresh_that_stopped_is_caught_up(spark, tmp_path, monkeypatch):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    geo = spark.createDataFrame([(f"G{i}", f"place {i}") for i in range(4)], "code string, label string")
    refresh.merge_coverage(events(spark, 0, 50), store, "b1")
    refresh.merge_coverage(events(spark, 50, 90), store, "b2")  # no refresh in between
    assert len(refresh.refresh_coverage(spark, store, geo, out)) == 4
    want = aggregate_places(events(spark, 0, 90), geo)["coverage"]
    assert sorted(map(tuple, pub.read_published(spark, out, want.schema).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="batch id"):
        refresh.merge_coverage(events(spark, 0, 1), store, "a\tb")


def test_fan_out_is_one_pass(spark, tmp_path):
    df = spark.range(10).withColumn("s", F.concat(F.lit("x"), F.col("id")))
    out = fan_out(df, str(tmp_path / "o"), {"even": (F.col("id") % 2 == 0, [F.col("id"), F.col("s")]), "big": (F.col("id") > 5, [F.col("s").alias("id")])})
    assert sorted(map(tuple, out["even"].collect())) == [(i, f"x{i}") for i in range(0, 10, 2)]
    assert sorted(r.id for r in out["big"].collect()) == ["x7", "x9"]
