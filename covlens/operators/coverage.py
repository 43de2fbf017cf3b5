"""Coverage aggregates: A2-A5, A9-A12, A18, A20, O1, O3.

Fact tables are aggregated on their codes *before* any dimension join. The
map-side partial aggregate shrinks a hot code (one code may hold a third of
all rows) to one row per task, and the join then runs on a table whose size
is the number of distinct (code, day) groups, not the number of events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.functions.exprs import is_weekend, mean_from_scaled, pct, ratio, scaled_sum
from covlens.operators.joins import join_dimension


def count_by(df: DataFrame, cols: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per group; NULL is a group of its own (A2)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def n_groups(df: DataFrame, col: str) -> DataFrame:
    """One row: number of groups of ``col`` including the NULL group (A3)."""
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias("n_groups"))


def coverage_daily(fact: DataFrame, dim: DataFrame, code: str, day: str, *,
                   dim_key: str, label: str, measure: str, category: str,
                   categories: Mapping, mean_name: str | None = None, scale: int | None = None,
                   strategy: str = "auto", ordered: bool = False,
                   check_unique: bool = False) -> DataFrame:
    """Axis-1 coverage per (code, label, day).

    ``n_events`` counts every row of a matched code; ``categories`` maps a
    category value to its output column, and rows of any other value (or
    NULL) are in ``n_events`` only. NULL and unmatched codes are dropped by
    the inner join. The measure mean ignores NULLs; it is the floating mean of
    the values as they are, or with ``scale`` the mean of the values at that many
    decimals, which no order of rows changes.
    """
    partials = coverage_partials(fact.where(F.col(code).isNotNull()), code, day, measure=measure,
                                 category=category, categories=categories, scale=scale)
    return coverage_from_partials(partials, dim, code, day, dim_key=dim_key, label=label,
                                  categories=categories, mean_name=mean_name or f"avg_{measure}",
                                  scale=scale, strategy=strategy, ordered=ordered,
                                  check_unique=check_unique)


def coverage_partials(fact: DataFrame, code: str, day: str, *, measure: str, category: str,
                      categories: Mapping, scale: int | None = None) -> DataFrame:
    """Counts and sums per (code, day), NULL codes included: what all reports of an axis need."""
    cat_aggs = [F.count_if(F.col(category) == F.lit(v)).alias(name)
                for v, name in categories.items()]
    if scale is None:
        m_aggs = [F.sum(F.col(measure).cast("double")).alias("_m_sum"),
                  F.count(measure).alias("_m_n")]
    else:
        m_aggs = [scaled_sum(measure, scale).alias("_m_sum"), F.count(measure).alias("_m_n")]
    return fact.groupBy(code, day).agg(F.count(F.lit(1)).alias("n_events"), *m_aggs, *cat_aggs)


def coverage_from_partials(partials: DataFrame, dim: DataFrame, code: str, day: str, *,
                           dim_key: str, label: str, categories: Mapping, mean_name: str,
                           scale: int | None = None, strategy: str = "auto", ordered: bool = False,
                           check_unique: bool = False) -> DataFrame:
    """``coverage_daily`` from ``coverage_partials``, whose codes may have been mapped since."""
    sums = ["n_events", "_m_n", *categories.values()]
    partial = partials.groupBy(code, day).agg(
        *[F.sum(c).cast("long").alias(c) for c in sums], F.sum("_m_sum").alias("_m_sum"))
    joined = join_dimension(partial, dim.select(dim_key, label), code, dim_key, "inner", strategy,
                            check_unique=check_unique)
    mean = (ratio("_m_sum", "_m_n") if scale is None
            else mean_from_scaled("_m_sum", "_m_n", scale))
    out = joined.select(code, label, day, "n_events", mean.alias(mean_name),
                        *categories.values())
    return out.orderBy(day, code) if ordered else out


def totals_by_code(coverage: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum per-day coverage over the window, per code."""
    return coverage.groupBy(*keys).agg(*[F.sum(m).cast("long").alias(m) for m in measures])


def top_codes(df: DataFrame, code: str, n: int, *, weight: str | None = None,
              keep_null: bool = True, out: str = "n_events") -> DataFrame:
    """The ``n`` codes with most rows (or largest ``weight`` sum) (O3).

    Ties are broken by the code, NULL first, so the result is a total order.
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps
    only its own top ``n``.
    """
    src = df if keep_null else df.where(F.col(code).isNotNull())
    agg = (F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")).alias(out)
    return (src.groupBy(code).agg(agg)
            .orderBy(F.col(out).desc(), F.col(code).asc_nulls_first()).limit(n))


def _row_total(cols: Sequence[str]):
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total


def category_ratio(coverage: DataFrame, keys: Sequence[str], numerator: Sequence[str],
                   denominator: Sequence[str], *, top_n: int | None = None,
                   volume: str = "n_events") -> DataFrame:
    """Per code: numerator and denominator category sums and their ratio.

    With ``top_n``, of the codes with the largest volume (the same set as
    ``top_codes``, NULL included), never a top-n by ratio. Zero denominators give NULL, not ``inf``.
    """
    keys = list(keys)
    sums = coverage.groupBy(*keys).agg(
        F.sum(volume).cast("long").alias(volume),
        F.sum(_row_total(numerator)).cast("long").alias("numerator"),
        F.sum(_row_total(denominator)).cast("long").alias("denominator"))
    if top_n is not None:
        sums = (sums.orderBy(F.col(volume).desc(), *[F.col(k).asc_nulls_first() for k in keys])
                .limit(top_n))
    return sums.withColumn("ratio", ratio("numerator", "denominator"))


def daily_volume(df: DataFrame, day: str, out: str = "n_events") -> DataFrame:
    """Events per day, from the fact table so NULL / unmatched codes count."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias(out))


def events_per_day(df: DataFrame, day: str) -> DataFrame:
    """One row: events, distinct days, mean events per day."""
    return (daily_volume(df, day)
            .agg(F.sum("n_events").cast("long").alias("n_events"),
                 F.count(F.lit(1)).alias("n_days"))
            .withColumn("events_per_day", ratio("n_events", "n_days")))


def weekend_drop(df: DataFrame, day: str) -> DataFrame:
    """One row: mean daily volume on weekdays and weekends, and the drop (A10).

    ``weekend_drop = 1 - mean(weekend) / mean(weekday)``; NULL when a side
    has no day.
    """
    daily = daily_volume(df, day).withColumn("_we", is_weekend(day))
    agg = daily.agg(
        F.sum(F.when(~F.col("_we"), F.col("n_events"))).cast("long").alias("_wd_sum"),
        F.count_if(~F.col("_we")).alias("n_weekdays"),
        F.sum(F.when(F.col("_we"), F.col("n_events"))).cast("long").alias("_we_sum"),
        F.count_if(F.col("_we")).alias("n_weekend_days"))
    return (agg.withColumn("avg_weekday", ratio("_wd_sum", "n_weekdays"))
            .withColumn("avg_weekend", ratio("_we_sum", "n_weekend_days"))
            .withColumn("weekend_drop", F.lit(1.0) - ratio("avg_weekend", "avg_weekday"))
            .select("n_weekdays", "n_weekend_days", "avg_weekday", "avg_weekend", "weekend_drop"))


def volume_vs_base(daily: DataFrame, day: str, base_day, volume: str = "n_events") -> DataFrame:
    """Each day's volume as % of one base day's volume.

    The base volume is a scalar subquery, so no join and no cross product.
    """
    base = daily.where(F.col(day) == F.lit(base_day)).agg(F.sum(volume)).scalar()
    return daily.withColumn("pct_of_base", pct(volume, base))


def code_drilldown(df: DataFrame, code: str, value, by: Sequence[str]) -> DataFrame:
    """Counts of ``by`` values among the rows of one code."""
    return count_by(df.where(F.col(code) == F.lit(value)), list(by))


def with_share(df: DataFrame, n_col: str, out: str = "pct") -> DataFrame:
    """Add each row's % of the column total.

    The total is a scalar subquery, so no task gathers the rows.
    """
    return df.withColumn(out, pct(n_col, df.agg(F.sum(n_col)).scalar()))
