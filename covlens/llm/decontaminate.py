"""Benchmark decontamination with an Aho-Corasick automaton.

Test questions and answers are normalised to words (A-Z in lower case, words of
digits, letters and anything beyond ASCII) and every window of ``n`` words becomes
a pattern of the automaton; an item of fewer words is one pattern. Each document is
normalised the same way, scanned once from end to end, and the matches' places are
mapped back to characters of the original text.

The benchmark is broadcast in shards of at most ``SHARD_BYTES`` of text (a larger
item is a shard by itself): with more than one shard the documents pass through
several automata in turn, still without a shuffle. Null and empty texts have no
words and no hit; items without an id or words are ignored; repeated rows, of
documents or items, are treated alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.llm.common import replace_columns, spare, table, utf8

WINDOW_WORDS = 10
SHARD_BYTES = 1 << 17

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_SPACES = bytes(b if b in _KEPT else 0x20 for b in range(256))
_IS_WORD = np.array([b in _KEPT for b in range(256)])


def words(text: bytes) -> list[bytes]:
    """Words of UTF-8 ``text``; ``bytes.lower`` changes A-Z alone."""
    return text.lower().translate(_TO_SPACES).split()


def automaton(items: list[tuple[str, str]], n: int) -> ahocorasick.Automaton:
    """Patterns `` w1 ... wn `` (a space on either side), each with its words and items."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        w = words(utf8([text])[0])
        for i in range(max(1, len(w) - n + 1) if w else 0):
            part = w[i : i + n]
            found.setdefault(f" {b' '.join(part).decode('latin-1')} ", (len(part), set()))[1].add(item)
    a = ahocorasick.Automaton()
    for pattern, (k, ids) in found.items():
        a.add_word(pattern, (k, tuple(ids)))
    a.make_automaton()
    return a


def matches(a: ahocorasick.Automaton, text: bytes) -> tuple[int, list[list[int]], set[str]]:
    """Words of the text, the merged [first, last+1) word runs that are hit, and the items."""
    w = words(text)
    ids: set[str] = set()
    if not w or not len(a):
        return len(w), [], ids
    line = b" " + b" ".join(w) + b" "
    hits = []
    for end, (k, items) in a.iter(line.decode("latin-1")):
        hits.append((end, k))
        ids.update(items)
    if not hits:
        return len(w), [], ids
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    last = np.searchsorted(spaces, [e for e, _ in hits])
    return len(w), merge([[int(e) - k, int(e)] for e, (_, k) in zip(last, hits, strict=True)]), ids


def merge(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def char_spans(text: bytes, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Word runs as [start, end) characters of the original text."""
    if not runs:
        return []
    data = np.frombuffer(text.lower(), np.uint8)
    edges = np.diff(np.concatenate(([0], _IS_WORD[data].view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(chars[starts[f]]), int(chars[ends[e - 1]])) for f, e in runs]


_RUNS = T.ArrayType(T.ArrayType(T.IntegerType()))
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS), T.StructField("items", T.ArrayType(T.StringType()))])
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@F.pandas_udf(_SPANS)
def _char_spans(texts: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series([[{"start": s, "end": e} for s, e in char_spans(t, merge([list(r) for r in rs]))] for t, rs in zip(utf8(texts), runs, strict=True)])


@F.pandas_udf(T.LongType())
def _words_hit(runs: pd.Series) -> pd.Series:
    return pd.Series([sum(e - s for s, e in merge([list(r) for r in rs])) for rs in runs], dtype="int64")


def finder(items: Broadcast, n: int):
    """Column function: a text's words, runs and items by the automaton of ``items``."""

    @F.pandas_udf(_FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = automaton(items.value, n)
        for b in batches:
            got = [matches(a, t) for t in utf8(b)]
            yield pd.DataFrame({"n_words": [g[0] for g in got], "runs": [g[1] for g in got], "items": [sorted(g[2]) for g in got]})

    return run


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids as strings, sorted) and spans ([start, end) characters of the hits)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("body")).where("item is not null and body is not null")
    n_bytes = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    shards = max(1, -(-n_bytes // shard_bytes))
    out, names = docs, [spare(docs, f"_found{s}_") for s in range(shards)]
    for s in range(shards):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(shards)) == s)
        held = spark.sparkContext.broadcast([(r["item"], r["body"]) for r in part.collect()])
        out = out.withColumn(names[s], finder(held, n)(F.col(f"`{text}`")))
    runs = F.concat(*[F.col(f"{n}.runs") for n in names])
    out = replace_columns(out, {
        "n_words": F.col(f"{names[0]}.n_words"), "n_hit": _words_hit(runs),
        "items": F.array_sort(F.array_distinct(F.concat(*[F.col(f"{n}.items") for n in names]))),
        "spans": _char_spans(F.col(f"`{text}`"), runs)})
    return out.drop(*names)


def op1_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, CAST(len(w) AS BIGINT) AS k, array_to_string(w, ' ') AS s FROM b WHERE len(w) BETWEEN 1 AND {WINDOW_WORDS - 1}
  UNION SELECT item_id, {WINDOW_WORDS}, array_to_string(w[i:i+{WINDOW_WORDS - 1}], ' ')
  FROM (SELECT item_id, w, unnest(range(1, len(w) - {WINDOW_WORDS - 2})) AS i FROM b WHERE len(w) >= {WINDOW_WORDS})),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT rid, k, i, array_to_string(w[i:i+k-1], ' ') AS s FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN ks ON len(w) >= k)),
hit AS (SELECT DISTINCT rid, i, k, item_id FROM dw JOIN win USING (k, s)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
