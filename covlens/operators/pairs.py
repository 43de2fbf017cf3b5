"""Directed actor pairs: A6, A7, A13, A14, O4, and the entity reports Q3-Q5.

Every operator first aggregates the fact table on its code columns (partial
aggregation on the map side), then joins the small entity-type dimension to
those aggregates. The number of distinct (A, B) code pairs bounds every join
input, whatever the event volume or its skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.functions.exprs import entity_bucket, mean_from_scaled, pair_label, pct, ratio, scaled_sum
from covlens.operators.coverage import with_share
from covlens.operators.joins import join_roles, label_codes, place_small_side


def pair_interactions(fact: DataFrame, types: DataFrame, a: str, b: str, *, type_key: str,
                      type_col: str, entity_type: str, measure: str,
                      mean_name: str | None = None, scale: int | None = None,
                      strategy: str = "auto", ordered: bool = False) -> DataFrame:
    """Axis-2 directed pairs (A, B), both sides of ``entity_type``.

    (A, B) and (B, A) are different pairs. Returns ``n_events`` and the
    mean of ``measure`` (NULLs ignored; see ``coverage_daily`` for ``scale``).
    """
    partials = pair_partials(fact.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b,
                             measure=measure, scale=scale)
    return pairs_from_partials(partials, types, a, b, type_key=type_key, type_col=type_col,
                               entity_type=entity_type, mean_name=mean_name or f"avg_{measure}",
                               scale=scale, strategy=strategy, ordered=ordered)


def pair_partials(fact: DataFrame, a: str, b: str, *, measure: str, scale: int | None = None) -> DataFrame:
    """Counts and sums per (A, B), NULL codes included: what all reports of the axis need."""
    if scale is None:
        m = [F.sum(F.col(measure).cast("double")).alias("_m_sum")]
    else:
        m = [scaled_sum(measure, scale).alias("_m_sum")]
    return fact.groupBy(a, b).agg(F.count(F.lit(1)).alias("n_events"), *m, F.count(measure).alias("_m_n"))


def pairs_from_partials(partial: DataFrame, types: DataFrame, a: str, b: str, *, type_key: str,
                        type_col: str, entity_type: str, mean_name: str, scale: int | None = None,
                        strategy: str = "auto", ordered: bool = False) -> DataFrame:
    """``pair_interactions`` from ``pair_partials``."""
    ok = place_small_side(types.where(F.col(type_col) == F.lit(entity_type))
                          .select(F.col(type_key).alias("_ok")), strategy)
    kept = (partial.join(ok, partial[a] == ok["_ok"], "left_semi")
            .join(ok, partial[b] == ok["_ok"], "left_semi"))
    mean = ratio("_m_sum", "_m_n") if scale is None else mean_from_scaled("_m_sum", "_m_n", scale)
    out = kept.select(a, b, "n_events", mean.alias(mean_name))
    return out.orderBy(F.col("n_events").desc(), a, b) if ordered else out


def _typed_pairs(fact: DataFrame, types: DataFrame, a: str, b: str, type_key: str,
                 type_col: str, strategy: str, weight: str | None = None) -> DataFrame:
    """Row counts per (A, B) with each side's entity type (NULL = null/unknown code)."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    partial = fact.groupBy(a, b).agg(n.alias("_n"))
    return join_roles(partial, types.select(type_key, type_col), type_key,
                      {"_ta": a, "_tb": b}, how="left", strategy=strategy)


def _ok(type_c: str, entity_type: str):
    return F.coalesce(F.col(type_c) == F.lit(entity_type), F.lit(False))


def pair_filter_report(fact: DataFrame, types: DataFrame, a: str, b: str, *, type_key: str,
                       type_col: str, entity_type: str, strategy: str = "auto",
                       weight: str | None = None) -> DataFrame:
    """One row: events total / kept by the pair filter / excluded, with %.

    ``weight``: the count column of rows that are counts already.
    """
    t = _typed_pairs(fact, types, a, b, type_key, type_col, strategy, weight)
    both = _ok(f"_ta_{type_col}", entity_type) & _ok(f"_tb_{type_col}", entity_type)
    return (t.agg(F.sum("_n").cast("long").alias("n_total"),
                  F.coalesce(F.sum(F.when(both, F.col("_n"))), F.lit(0)).cast("long").alias("n_kept"))
            .withColumn("n_total", F.coalesce("n_total", F.lit(0).cast("long")))
            .withColumn("n_excluded", F.col("n_total") - F.col("n_kept"))
            .withColumn("pct_kept", pct("n_kept", "n_total"))
            .withColumn("pct_excluded", pct("n_excluded", "n_total")))


def exclusion_breakdown(fact: DataFrame, types: DataFrame, a: str, b: str, *, type_key: str,
                        type_col: str, entity_type: str, strategy: str = "auto") -> DataFrame:
    """Events per outcome: kept / excluded by A only / by B only / by both (Q4).

    A NULL or unknown code is "not of the type". The four buckets add up to
    the total; ``pct_of_excluded`` is NULL for the kept bucket.
    """
    t = _typed_pairs(fact, types, a, b, type_key, type_col, strategy)
    a_ok, b_ok = _ok(f"_ta_{type_col}", entity_type), _ok(f"_tb_{type_col}", entity_type)
    bucket = (F.when(a_ok & b_ok, F.lit("kept")).when(b_ok, F.lit("a_only"))
              .when(a_ok, F.lit("b_only")).otherwise(F.lit("both")))
    grouped = t.groupBy(bucket.alias("outcome")).agg(F.sum("_n").cast("long").alias("n_events"))
    excl = grouped.where(F.col("outcome") != F.lit("kept")).agg(F.sum("n_events")).scalar()
    return (with_share(grouped, "n_events", "pct_of_total")
            .withColumn("pct_of_excluded",
                        F.when(F.col("outcome") != F.lit("kept"), pct("n_events", excl))))


def entity_distribution(fact: DataFrame, code: str, types: DataFrame, *, type_key: str,
                        type_col: str, strategy: str = "auto") -> DataFrame:
    """Events per entity bucket of one role: null, unknown_code or the type (Q3)."""
    partial = fact.groupBy(code).agg(F.count(F.lit(1)).alias("_n"))
    t = join_roles(partial, types.select(type_key, type_col), type_key, {"_t": code},
                   how="left", strategy=strategy)
    grouped = (t.groupBy(entity_bucket(code, f"_t_{type_col}").alias("bucket"))
               .agg(F.sum("_n").cast("long").alias("n_events")))
    return with_share(grouped, "n_events", "pct")


def exclusion_causes(fact: DataFrame, types: DataFrame, a: str, b: str, side: str, *,
                     type_key: str, type_col: str, entity_type: str,
                     strategy: str = "auto") -> DataFrame:
    """Why one side (``side`` = the column ``a`` or ``b``) fails the filter (Q5).

    Among events whose ``side`` code is not of ``entity_type``: counts per
    cause (null, unknown_code, or the other entity type) and their %.
    """
    if side not in (a, b):
        raise ValueError("side must be one of the two pair columns")
    t = _typed_pairs(fact, types, a, b, type_key, type_col, strategy)
    tc = f"_ta_{type_col}" if side == a else f"_tb_{type_col}"
    grouped = (t.where(~_ok(tc, entity_type))
               .groupBy(entity_bucket(side, tc).alias("cause"))
               .agg(F.sum("_n").cast("long").alias("n_events")))
    return with_share(grouped, "n_events", "pct")


def domestic_share(pairs: DataFrame, a: str, b: str, n: str = "n_events") -> DataFrame:
    """One row: pairs with A = B and their share of events, over all pairs."""
    dom = F.col(a) == F.col(b)
    return (pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                      F.count_if(dom).alias("n_domestic_pairs"),
                      F.sum(n).cast("long").alias("n_events"),
                      F.coalesce(F.sum(F.when(dom, F.col(n))), F.lit(0)).cast("long")
                      .alias("n_domestic_events"))
            .withColumn("pct_domestic_events", pct("n_domestic_events", "n_events")))


def tone_summary(pairs: DataFrame, measure: str, threshold: float = 0.0) -> DataFrame:
    """One row: pairs, pairs with ``measure`` above ``threshold``, min, max."""
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.count_if(F.col(measure) > F.lit(threshold)).alias("n_positive"),
                     F.min(measure).alias(f"min_{measure}"),
                     F.max(measure).alias(f"max_{measure}"))


def top_pairs(pairs: DataFrame, a: str, b: str, n: int = 15, *, domestic: bool = False,
              volume: str = "n_events", dim: DataFrame | None = None,
              dim_key: str | None = None, label: str | None = None) -> DataFrame:
    """Top ``n`` pairs by volume, international only unless ``domestic``.

    Ties break on (A, B). With a dimension, both codes get a label (falling
    back to the code) and ``pair`` = ``"label A → label B"`` (P13, P14).
    """
    src = pairs if domestic else pairs.where(F.col(a) != F.col(b))
    top = src.orderBy(F.col(volume).desc(), F.col(a), F.col(b)).limit(n)
    if dim is None:
        return top.withColumn("pair", pair_label(a, b))
    top = label_codes(top, a, dim, dim_key, label, out="label_a")
    top = label_codes(top, b, dim, dim_key, label, out="label_b")
    return top.withColumn("pair", pair_label("label_a", "label_b"))
