"""Dimension joins and dimension checks: J1-J7, P13, V2, V3, V7.

Nothing here runs a job while a plan is built. By default Spark decides from the
sizes it measures at run time (AQE) whether a side is broadcast; a caller who asks
for a broadcast gets it only if the planned size is within a bound in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.functions.exprs import as_col

#: Largest planned size, in bytes, of a side that is broadcast on request.
DEFAULT_BROADCAST_BYTES = 64 << 20

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def planned_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def place_small_side(dim: DataFrame, strategy: str = "auto",
                     max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Apply the join-strategy choice to the dimension side.

    ``auto``: no hint; Spark broadcasts by the measured size, and AQE splits skew.
    ``broadcast``: broadcast, but fail if the planned size is above ``max_bytes``. Rows
    that came from the driver have no planned size; with ``max_bytes=None`` the caller
    vouches for the side.
    ``merge`` / ``shuffle_hash``: scoped join hint, no session change (J6).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy in ("merge", "shuffle_hash"):
        return dim.hint(strategy)
    if strategy == "broadcast":
        size = 0 if max_bytes is None else planned_bytes(dim)
        if max_bytes is not None and size > max_bytes:
            raise ValueError(f"dimension is planned at {size} bytes, above {max_bytes}; refusing to broadcast it")
        return F.broadcast(dim)
    return dim


def _q(name: str):
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unique_by(dim: DataFrame, key: str) -> DataFrame:
    """``dim``, failing at run time if a value of ``key`` occurs twice (NULL too).

    The check is part of the plan: one aggregate over the dimension, when it is read.
    """
    others = [c for c in dim.columns if c != key]
    row = F.struct(*[_q(c).alias(f"c{i}") for i, c in enumerate(others)]) if others else F.lit(0)
    rows = dim.groupBy(_q(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
    message = F.concat(F.lit(f"dimension key {key!r} is not unique, e.g. "), F.coalesce(F.col("_key").cast("string"), F.lit("NULL")))
    checked = rows.where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    place = {c: f"_row.c{i}" for i, c in enumerate(others)} | {key: "_key"}
    return checked.select(*[F.col(place[c]).alias(c) for c in dim.columns])


def join_dimension(fact: DataFrame, dim: DataFrame, on: str, dim_key: str | None = None,
                   how: str = "inner", strategy: str = "auto",
                   max_bytes: int | None = DEFAULT_BROADCAST_BYTES, check_unique: bool = False,
                   salt_buckets: int | str = 1) -> DataFrame:
    """Equi-join a fact table to a dimension.

    The dimension key is renamed to ``on`` and joined by name, so the result
    carries one key column. Dimension keys are expected unique: an inner join
    multiplies fact rows otherwise. ``check_unique=True`` makes the job fail on a
    repeated key (one aggregate over the dimension, never over the fact).

    ``salt_buckets > 1`` spreads each key of a shuffle join over that many
    tasks, whatever AQE does: fact rows are salted in turn by their place in
    their task, so equal rows are spread as well, and dimension rows are
    repeated once per salt. Ignored when the dimension is broadcast, where
    there is no shuffle to skew. ``"hot"`` salts only keys with more rows than
    two mean tasks have, each as much as it takes: they are found by one count per key of the
    fact table, the dimension's other rows are not repeated, and no number has to be guessed.
    """
    dim_key = dim_key or on
    if check_unique:
        dim = unique_by(dim, dim_key)
    if dim_key != on:
        dim = dim.withColumnRenamed(dim_key, on)
    small = place_small_side(dim, strategy, max_bytes)
    hinted = strategy in ("merge", "shuffle_hash")
    if salt_buckets == 1 or strategy == "broadcast":
        return fact.join(small, on=on, how=how)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("salting keeps every dimension row once per salt; use an inner or left join")
    if salt_buckets == "hot":
        return _join_hot(fact, dim, on, how, strategy)
    salted_fact = fact.withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets)))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                              F.lit(salt_buckets - 1).cast("long"))))
    if hinted:
        salted_dim = salted_dim.hint(strategy)
    return salted_fact.join(salted_dim, on=[on, "_salt"], how=how).drop("_salt")


def hot_keys(fact: DataFrame, key: str, tasks: int) -> DataFrame:
    """(key, _salts) of the keys with more than twice the rows that a task has on average.

    There are at most ``tasks / 2`` of them whatever the data, so they may be broadcast.
    ``_salts`` is the number of mean tasks that a key's rows fill.
    """
    counts = fact.where(_q(key).isNotNull()).groupBy(_q(key).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    mean = counts.agg((F.sum("_n") / F.lit(tasks)).alias("_mean")).scalar()
    return counts.where(F.col("_n") > 2 * mean).select(_q(key), F.ceil(F.col("_n") / mean).cast("int").alias("_salts"))


def _join_hot(fact: DataFrame, dim: DataFrame, on: str, how: str, strategy: str) -> DataFrame:
    """``join_dimension`` with the hot keys spread: their fact rows in turn, their dimension rows once per salt."""
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(fact, on, tasks))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    # hashed, since a key may come in every so many rows
    salted_fact = fact.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts).cast("int"))
    salted_dim = dim.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    salted_dim = salted_dim.drop("_salts")
    if strategy in ("merge", "shuffle_hash"):
        salted_dim = salted_dim.hint(strategy)
    return salted_fact.drop("_salts").join(salted_dim, on=[on, "_salt"], how=how).drop("_salt")


def join_roles(fact: DataFrame, dim: DataFrame, dim_key: str, roles: dict[str, str],
               how: str = "left", strategy: str = "auto",
               max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join one dimension once per role column.

    ``roles`` maps an output prefix to a fact column; the dimension's other
    columns come back as ``<prefix>_<column>``.
    """
    small = place_small_side(dim, strategy, max_bytes)
    attrs = [c for c in dim.columns if c != dim_key]
    out = fact
    for prefix, fact_col in roles.items():
        renamed = small.select(F.col(dim_key).alias(f"_{prefix}_key"),
                               *[F.col(c).alias(f"{prefix}_{c}") for c in attrs])
        out = (out.join(renamed, out[fact_col] == renamed[f"_{prefix}_key"], how)
               .drop(f"_{prefix}_key"))
    return out


def label_codes(df: DataFrame, code: str, dim: DataFrame, dim_key: str, label: str,
                out: str = "label", strategy: str = "auto") -> DataFrame:
    """Add ``out`` = the code's label, or the code itself when unknown."""
    small = dim.select(F.col(dim_key).alias("_lbl_key"), F.col(label).alias("_lbl"))
    small = place_small_side(small, strategy)
    joined = df.join(small, df[code] == small["_lbl_key"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_lbl"), as_col(code).cast("string")))
            .drop("_lbl_key", "_lbl"))


def validate_dimension(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count (V2). Empty = valid."""
    return (dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def assert_unique_keys(dim: DataFrame, key: str) -> None:
    """Raise when a dimension key is repeated (an inner join would inflate)."""
    dup = validate_dimension(dim, key).limit(1).collect()
    if dup:
        raise ValueError(f"dimension key {key!r} is not unique, e.g. {dup[0][key]!r}")


def duplicate_labels(dim: DataFrame, code: str, label: str) -> DataFrame:
    """(label, code, n_codes) of the labels that appear under more than one code (V3).

    One row per code, so no label gathers its codes in one place. NULL is not a label.
    """
    pairs = dim.where(F.col(label).isNotNull() & F.col(code).isNotNull()).select(label, code).distinct()
    shared = pairs.groupBy(label).agg(F.count(F.lit(1)).alias("n_codes")).where("n_codes > 1")
    return pairs.join(shared, label)


def dimension_diff(left: DataFrame, right: DataFrame, left_key: str,
                   right_key: str | None = None, out: str = "code") -> DataFrame:
    """Keys present in only one of two dimensions, with the side."""
    right_key = right_key or left_key
    lk = left.select(F.col(left_key).alias(out)).distinct()
    rk = right.select(F.col(right_key).alias(out)).distinct()
    only_left = lk.join(rk, out, "left_anti").withColumn("side", F.lit("left_only"))
    only_right = rk.join(lk, out, "left_anti").withColumn("side", F.lit("right_only"))
    return only_left.unionByName(only_right)
