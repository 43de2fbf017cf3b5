"""Day-partitioned tables whose days are replaced as a unit.

Each run writes its days into a folder of its own, ``<table>/v=<run>/<day column>=<day>``, which no
reader knows yet. A marker file ``<table>/_published/<number>`` then names the folder of every
day, old ones and new ones, and ends with a line that makes it complete. Readers take
the newest complete marker, so they see all of a run's days or none of them, whenever the run
stops; days that a run withdraws are simply named no more. A marker that exists is never
written again: of two runs that started from the same state one fails.

What is listed on the driver is one line a day (and what a caller notes), never files or rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.session import create_text, delete_path, file_names, folder_names, read_text

MARKERS = "_published"


class Published(NamedTuple):
    """A table's state: its number, the folder (below the table) of each day folder's name, and notes."""

    number: int
    folders: dict[str, str]
    notes: tuple[str, ...]


def _state(number: int, text: str) -> Published | None:
    """The state that a marker describes; None if the marker is not complete."""
    lines = text.splitlines()
    if not lines or lines[-1] != f"end\t{len(lines) - 1}":
        return None
    rows = [line.split("\t") for line in lines[:-1]]
    return Published(number, {r[1]: r[2] for r in rows if r[0] == "day"}, tuple("\t".join(r[1:]) for r in rows if r[0] == "note"))


def history(spark: SparkSession, path: str) -> list[Published]:
    """Complete states of a table, the newest first."""
    root = f"{path.rstrip('/')}/{MARKERS}"
    numbers = sorted((int(n) for n in file_names(spark, root) if n.isdigit()), reverse=True)
    states = (_state(n, read_text(spark, f"{root}/{n}")) for n in numbers)
    return [s for s in states if s is not None]


def published(spark: SparkSession, path: str) -> Published:
    """The newest complete state; number 0 without days if there is none."""
    root = f"{path.rstrip('/')}/{MARKERS}"
    for n in sorted((int(n) for n in file_names(spark, root) if n.isdigit()), reverse=True):
        if (state := _state(n, read_text(spark, f"{root}/{n}"))) is not None:
            return state
    return Published(0, {}, ())


def is_published(spark: SparkSession, path: str) -> bool:
    return published(spark, path).number > 0


def new_version(path: str) -> str:
    """Name, below the table, of the folder of a run that is about to be written."""
    return f"v={uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, base: Published, folders: dict[str, str], notes: Iterable[str] = ()) -> Published:
    """Makes ``folders`` and ``notes`` the table's state, if it still is as in ``base``."""
    root = f"{path.rstrip('/')}/{MARKERS}"
    if published(spark, path).number != base.number:
        raise RuntimeError(f"{path} has been published by another run meanwhile")
    number = max([base.number, *(int(n) for n in file_names(spark, root) if n.isdigit())]) + 1
    notes = tuple(notes)
    lines = [f"day\t{day}\t{folder}" for day, folder in sorted(folders.items())] + [f"note\t{n}" for n in notes]
    create_text(spark, f"{root}/{number}", "\n".join([*lines, f"end\t{len(lines)}"]))
    return Published(number, dict(folders), notes)


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None, state: Published | None = None,
                   days: Iterable[str] | None = None) -> DataFrame:
    """The table in its newest state, or in ``state``; only the day folders ``days`` if given."""
    state = state or published(spark, path)
    root = path.rstrip("/")
    folders = [f for d, f in sorted(state.folders.items()) if days is None or d in days]
    if not folders:
        if schema is None:
            raise ValueError(f"{path} holds no published day; give its schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    if schema is not None:
        df = reader.schema(schema).parquet(*[f"{root}/{f}" for f in folders])
        return df.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])
    return reader.parquet(*[f"{root}/{f}" for f in folders]).drop("v")


def inside(spark: SparkSession, names: Iterable[str], kind: T.DataType, start, end) -> set[str]:
    """Of the day folder names (``column=day``) those of days from ``start`` to ``end``."""
    names = list(names)
    if not names:
        return set()
    days = spark.createDataFrame([(n, n.partition("=")[2]) for n in names], "name string, day string")
    day = F.col("day").try_cast(kind)
    return {r["name"] for r in days.where(day.between(F.lit(start), F.lit(end))).collect()}


def write_days(df: DataFrame, path: str, day_col: str, sort: Iterable[str] = ()) -> dict[str, str]:
    """Writes ``df`` by day into a folder that is not published yet; its day folders by name.

    Rows are dealt by day, and Spark splits a day that is large and puts small ones together.
    """
    version = new_version(path)
    root = path.rstrip("/")
    (df.hint("rebalance", F.col(f"`{day_col}`")).sortWithinPartitions(*[F.col(f"`{c}`") for c in [day_col, *sort]])
     .write.partitionBy(day_col).parquet(f"{root}/{version}"))
    return {n: f"{version}/{n}" for n in folder_names(df.sparkSession, f"{root}/{version}") if n.startswith(f"{day_col}=")}


def publish_days(df: DataFrame, path: str, day_col: str, start=None, end=None, sort: Iterable[str] = (), notes: Iterable[str] | None = None) -> Published:
    """Replaces the days of ``df`` in the table, and those from ``start`` to ``end`` that it has no row of.

    ``notes`` take the place of the table's notes, which stay by default.
    """
    spark = df.sparkSession
    base = published(spark, path)
    new = write_days(df, path, day_col, sort)
    gone = inside(spark, base.folders, df.schema[day_col].dataType, start, end) if start is not None else set()
    state = publish(spark, path, base, {d: f for d, f in base.folders.items() if d not in gone} | new, base.notes if notes is None else notes)
    vacuum(spark, path)
    return state


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes folders that the newest ``keep`` states do not name and that an older one does.

    Folders that no state names may belong to a run that is still writing and stay.
    """
    states = history(spark, path)
    top = lambda s: {f.split("/")[0] for f in s.folders.values()}
    used = set().union(*map(top, states[:keep])) if states else set()
    for version in set().union(set(), *map(top, states[keep:])) - used:
        delete_path(spark, f"{path.rstrip('/')}/{version}")
    for s in states[keep:]:
        delete_path(spark, f"{path.rstrip('/')}/{MARKERS}/{s.number}")
