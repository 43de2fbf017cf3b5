"""Incremental refresh of the aggregates: each batch of events is merged once.

A store holds the counts and sums per (code, day) or per (A, B) of all batches merged so
far, as a published table (``sources.publish``): a merge rewrites the days that the batch
touches and publishes them together with the batch's id, so a batch counts once
however often it is replayed and wherever a run stops. The cost of a merge is that of
the batch plus the stored groups of its days, not of the events before it.

The day-partitioned product of a store is refreshed the same way: its notes tell which
folder of the store each of its days was made from, and only days whose folder is another now are made again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.operators.coverage import coverage_from_partials, coverage_partials
from covlens.operators.pairs import pair_partials
from covlens.profiles import QUAD_CLASSES
from covlens.sources.publish import Published, publish, published, read_published, vacuum, write_days

#: Partition column of a store without days.
WHOLE = "_part"


def merge_partials(partials: DataFrame, store: str, batch_id: str, keys: list[str], day: str | None) -> Published:
    """Adds a batch's ``partials`` (sums by ``keys``) to the store, unless ``batch_id`` is in it already."""
    spark, state = partials.sparkSession, published(partials.sparkSession, store)
    if "\t" in batch_id or "\n" in batch_id or not batch_id:
        raise ValueError("a batch id is a text without tabs or line ends")
    if batch_id in state.notes:
        return state
    if day is None:
        day, partials = WHOLE, partials.withColumn(WHOLE, F.lit(0))
    sums = [c for c in partials.columns if c not in (*keys, day)]
    by = [*[k for k in keys if k != day], day]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in partials.schema])
    batch = write_days(partials, store, day)  # the events are read once; the merge works on groups
    added = read_published(spark, store, schema, Published(0, batch, ()))
    before = read_published(spark, store, schema, state, days=set(batch))
    merged = added.unionByName(before).groupBy(*[F.col(f"`{k}`") for k in by]).agg(*[F.sum(f"`{c}`").cast(schema[c].dataType).alias(c) for c in sums])
    folders = write_days(merged.select(*[F.col(f"`{n}`") for n in schema.fieldNames()]), store, day)
    out = publish(spark, store, state, state.folders | folders, [*state.notes, batch_id])
    vacuum(spark, store)
    return out


def merge_coverage(batch: DataFrame, store: str, batch_id: str, *, code: str = "ActionGeo_CountryCode",
                   day: str = "SQLDATE", measure: str = "AvgTone", category: str = "QuadClass",
                   categories: Mapping = QUAD_CLASSES, scale: int | None = None) -> Published:
    """Merges a batch into the per-(code, day) store behind the coverage of axis 1 (K2, A4).

    Without ``scale`` sums of doubles depend on the order of batches in their last digits.
    """
    partials = coverage_partials(batch, code, day, measure=measure, category=category, categories=categories, scale=scale)
    return merge_partials(partials, store, batch_id, [code, day], day)


def merge_pairs(batch: DataFrame, store: str, batch_id: str, *, a: str = "Actor1CountryCode",
                b: str = "Actor2CountryCode", measure: str = "AvgTone", scale: int | None = None) -> Published:
    """Merges a batch into the per-(A, B) store behind the pairs of axis 2."""
    return merge_partials(pair_partials(batch, a, b, measure=measure, scale=scale), store, batch_id, [a, b], None)


def stored(spark: SparkSession, store: str, schema: T.StructType | None = None) -> DataFrame:
    """The merged counts and sums of a store."""
    df = read_published(spark, store, schema)
    return df.drop(WHOLE)


def refresh_coverage(spark: SparkSession, store: str, geo: DataFrame, out_path: str, *, code: str = "ActionGeo_CountryCode",
                     day: str = "SQLDATE", geo_key: str = "code", geo_label: str = "label",
                     categories: Mapping = QUAD_CLASSES, scale: int | None = None, schema: T.StructType | None = None,
                     check_unique: bool = True) -> list[str]:
    """Brings the coverage table at ``out_path`` up to its store; returns the day folders made anew.

    Days are replaced as a unit. A run that stopped halfway is caught up by the next one, since what is
    out of date is read off the two tables' states.
    """
    state, product = published(spark, store), published(spark, out_path)
    made_from = dict(n.split("\t") for n in product.notes)
    changed = sorted(d for d, f in state.folders.items() if made_from.get(d) != f)
    if not changed:
        return []
    partials = read_published(spark, store, schema, state, days=set(changed))
    coverage = coverage_from_partials(partials, geo, code, day, dim_key=geo_key, label=geo_label, categories=categories,
                                      mean_name="avg_tone", scale=scale, check_unique=check_unique)
    new = write_days(coverage, out_path, day, sort=[code])
    notes = [f"{d}\t{f}" for d, f in sorted(state.folders.items())]
    publish(spark, out_path, product, {d: f for d, f in product.folders.items() if d not in changed} | new, notes)
    vacuum(spark, out_path)
    return changed
