"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.session import checkpoint_root

# Functions of this subpackage travel to the executors with their code, so that these need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules["covlens.llm"])

#: Most bytes, as written, of a table that is sent to all executors for a join.
SIDE_BYTES = 4 << 20

#: Bytes of text that one vectorised step works on; bounds the arrays in a Python worker.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def replace_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """``df`` with ``cols``; an input column of the same name (whatever its case) gives way."""
    taken = {c.lower() for c in cols}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken], *[v.alias(k) for k, v in cols.items()])


def spare(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def doc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of doc_id written as text, modulo ``divisor`` (null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def bounded_sample(df: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """The ``max_rows`` rows with the smallest hash of ``key`` (all if there are fewer).

    Rows are first cut by hash to about twice as many, so that a task passes on few
    rows whatever its input; repeated rows count once.
    """
    share = min(1.0, 2 * max_rows / max(1, df.count()))
    h = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40))
    cut = df.withColumn("_h", h).where(F.col("_h") < int(share * (1 << 40))).distinct()
    return cut.orderBy("_h", *df.columns).limit(max_rows).drop("_h")


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads uint64 values over all 64 bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the hash base and of its inverse modulo 2**64, ``n`` at least.

    A worker keeps those of a chunk; a longer text's are made for it alone.
    """
    if len(_powers.get("up", ())) >= n:
        return _powers["up"], _powers["down"]
    out = []
    for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        steps = np.full(n + n // 8, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, out=steps))
    if n <= 2 * CHUNK_BYTES:
        _powers.update(up=out[0], down=out[1])
    return out[0], out[1]


def hash_words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and 64-bit hash of every maximal run of word bytes in ``data``.

    A word's hash is the polynomial of its bytes' random values in a fixed odd
    base, finalised; it depends on the word alone. Runs may not be cut by the caller.
    """
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    with np.errstate(over="ignore"):
        up, down = powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES):
    """(first, last+1) slices of ``texts`` of about ``limit`` bytes, one text at least."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a line feed after each, and where each text starts."""
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8), np.cumsum(lengths) - lengths


def utf8(values) -> list[bytes]:
    """Texts as UTF-8; a null (None, or NaN from pandas) is empty."""
    return [v.encode("utf-8", "surrogatepass") if isinstance(v, str) else b"" for v in values]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def is_space(data: np.ndarray) -> np.ndarray:
    """White space of the contracts: space and 0x09 to 0x0D."""
    return _SPACE[data]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within, jobs hand workers at most ``rows`` rows at a time; the session's setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes a job's shuffle files when the job has ended; the session's setting comes back after."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Scratch:
    """Tables written to the shared checkpoint folder, so that a lost executor costs one step at most."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` as a written table, without its lineage."""
        path = f"{checkpoint_root(self.spark).rstrip('/')}/covlens/cut-{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[path] = out
        return out

    def size(self, df: DataFrame) -> int:
        """Bytes of a table that ``cut`` has written."""
        path = next(p for p, written in self.paths.items() if written is df)
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()

    def side(self, df: DataFrame, max_bytes: int = SIDE_BYTES) -> DataFrame:
        """``df`` as a written table, to be broadcast in a join if it is no larger than ``max_bytes``."""
        out = self.cut(df)
        return F.broadcast(out) if self.size(out) <= max_bytes else out

    def clear(self, *keep: DataFrame) -> None:
        """Deletes what was written but for the tables that ``keep`` reads."""
        used = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for df in keep for f in df.inputFiles()}
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for path in [p for p in self.paths if p.rsplit("/", 1)[-1] not in used]:
            at = hadoop.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
            del self.paths[path]
