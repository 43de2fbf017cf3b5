"""Incremental clean: slices arriving between runs are appended exactly once."""

from pyspark.sql import functions as F

from covlens.session import shared_dir
from covlens.streaming.ingest import clean_incremental
from tests.test_pipeline import raw_line
from tests.conftest import write_lines


def test_new_slices_are_appended_once(spark, tmp_path):
    raw = tmp_path / "slices"
    out = shared_dir(spark, "test-stream-out")
    ckpt = shared_dir(spark, "test-stream-ckpt")
    rej = shared_dir(spark, "test-stream-rejects")
    write_lines(raw / "20240105000000.export.CSV",
                [raw_line(1, 20240105, "US", "USA", "FRA", 1, 1.0),
                 raw_line(2, 20231231, "US", "USA", "FRA", 1, 1.0)])     # outside the window
    kw = dict(checkpoint=ckpt, rejects_path=rej)
    clean_incremental(spark, str(raw), out, 20240101, 20240131, **kw)
    assert sorted(r.GlobalEventID for r in spark.read.parquet(out).collect()) == [1]

    write_lines(raw / "20240105001500.export.CSV",
                [raw_line(3, 20240106, "FR", "FRA", "USA", 4, -1.0),
                 raw_line("bad", 20240106, "FR", "FRA", "USA", 4, -1.0)])
    clean_incremental(spark, str(raw), out, 20240101, 20240131, **kw)
    clean_incremental(spark, str(raw), out, 20240101, 20240131, **kw)   # nothing new
    back = spark.read.parquet(out)
    assert sorted(r.GlobalEventID for r in back.collect()) == [1, 3]
    assert back.where(F.col("SQLDATE") == 20240106).count() == 1
    assert spark.read.parquet(rej).count() == 1


def test_continuous_trigger_returns_running_queries(spark, tmp_path):
    raw = tmp_path / "live"
    write_lines(raw / "20240105000000.export.CSV", [raw_line(7, 20240105, "US", "", "", 1, 0.0)])
    out = shared_dir(spark, "test-live-out")
    queries = clean_incremental(spark, str(raw), out, 20240101, 20240131,
                                checkpoint=shared_dir(spark, "test-live-ckpt"),
                                trigger_interval="1 second")
    try:
        assert len(queries) == 1 and queries[0].isActive
        queries[0].processAllAvailable()
        assert [r.GlobalEventID for r in spark.read.parquet(out).collect()] == [7]
    finally:
        for q in queries:
            q.stop()
