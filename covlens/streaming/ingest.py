"""Incremental clean: the batch ``clean`` run as a file stream (E1, incremental).

Slices arrive as new files every 15 minutes. The same strict parse, derived
columns, window filter and projection as ``plans.pipeline.clean`` run as a
Structured Streaming query over the slice folder, so each run processes only
files it has not seen. ``trigger(availableNow=True)`` drains what is there and
stops, which suits a scheduled job. The checkpoint lies beside the sink's own log in
the output folder, so both always belong together: each slice lands exactly once over
any number of runs, and a failed run resumes where the last one committed. Several
feeds may go to one table one after the other; they share its checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.profiles import KEPT_COLUMNS, raw_event_schema
from covlens.session import delete_path, shared_dir
from covlens.sources.scan import parse_delimited, valid_and_rejected


def clean_incremental(spark: SparkSession, raw_dir: str, out_path: str, start, end, *,
                      schema: T.StructType | None = None, kept: Sequence[str] = KEPT_COLUMNS,
                      day_col: str = "SQLDATE", derived: Mapping[str, Column] | None = None,
                      sep: str = "\t", checkpoint: str | None = None,
                      rejects_path: str | None = None,
                      max_files_per_trigger: int | None = None,
                      trigger_interval: str | None = None) -> list:
    """Append new slices of ``raw_dir`` to the day-partitioned table at ``out_path``.

    Rejected records go to ``rejects_path`` when given. Then each batch is parsed once,
    staged, and written to both tables into folders named by the batch (``_batch=<id>``), which a repeated
    batch overwrites: every slice still lands exactly once. A table is written in one of the two forms,
    with rejects or without. ``checkpoint`` is where the progress is kept, by default
    in the output folder itself; one that is given must be used in every run. By default the available files are processed and the
    call blocks until done (``availableNow``). With ``trigger_interval`` (for
    example ``"15 minutes"``, the slice cadence) the stream keeps running on a
    processing-time trigger and its handle is returned at once, in a list.
    """
    schema = schema or raw_event_schema()
    # readers skip folders that begin with an underscore
    log = f"{checkpoint}/valid" if checkpoint else f"{out_path.rstrip('/')}/_checkpoint"
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = [F.col("_metadata.file_name").alias("file_name")] if rejects_path else []
    lines = reader.load(raw_dir).select(F.col("value").alias("_raw"), *source)
    columns = [F.col(f"`{c}`") for c in kept]

    def parse(lines: DataFrame) -> DataFrame:
        parsed = parse_delimited(lines, schema, sep)
        for name, expr in (derived or {}).items():
            parsed = parsed.withColumn(name, expr)
        return parsed

    in_window = F.col(day_col).between(F.lit(start), F.lit(end))

    def write_both(batch: DataFrame, batch_id: int) -> None:
        stage = shared_dir(batch.sparkSession, "stream-stage")
        valid, rejects = valid_and_rejected(parse(batch), schema, stage, sep, columns, in_window)
        valid.write.mode("overwrite").partitionBy(day_col).parquet(f"{out_path.rstrip('/')}/_batch={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/_batch={batch_id}")
        delete_path(batch.sparkSession, stage)

    if rejects_path:
        writer = lines.writeStream.foreachBatch(write_both)
    else:
        valid = parse(lines).where(F.col("_ok") & in_window).select(*columns)
        writer = valid.writeStream.format("parquet").partitionBy(day_col).option("path", out_path)
    writer = writer.option("checkpointLocation", log)
    if trigger_interval:
        return [writer.trigger(processingTime=trigger_interval).start()]
    writer.trigger(availableNow=True).start().awaitTermination()
    return []
