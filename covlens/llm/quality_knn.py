"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its hashed words, word endings, word shapes, its size class and, in
eighths, its shares of repeats of the word before, of words that end in a symbol and of
capitals. Term weights (log term count, idf of the
labelled sample) are projected on the leading singular vectors of the labelled
documents. Every document is compared with every labelled vector by exact cosine, in
blocks; the ``NEIGHBOURS`` most similar vote with their labels, weighted by a power of
the similarity.

At most ``LABELLED`` labelled documents (those with the smallest hash) are
learned from and broadcast, with a projection of ``SLOTS`` x ``RANK`` numbers: both
bounds hold at every input size. Null texts count as empty; an empty text has its size
class as its only term. Without labelled rows every score is 0.5. Repeated rows get
equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import bounded_sample, chunks, doc_remainder, hash_words, is_space, joined, mix, table, utf8

SLOTS = 1 << 14
RANK = 64
LABELLED = 2048
NEIGHBOURS = 25
POWER = 8
#: Weight of the terms that describe a whole text.
TEXT_WEIGHT = 6.0
#: Byte classes of word shapes: other, lower case, upper case, digit, sentence mark, symbol, beyond ASCII.
_CLASS = np.zeros(256, np.uint64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[[ord(c) for c in ".,;:'\"-"]] = 4
_CLASS[[ord(c) for c in "!?#*$%&|<>=+_/\\{}[]~^@"]] = 5


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, weight) of the texts' distinct terms, by text; weight is 1 + log of the count, or TEXT_WEIGHT."""
    data, begin = joined(texts)
    starts, words = hash_words(data, ~is_space(data))
    n = len(texts)
    owner = np.searchsorted(begin, starts, side="right") - 1
    space = np.append(np.flatnonzero(is_space(data)), len(data))
    ends = space[np.searchsorted(space, starts)] if len(starts) else starts
    a, z, y = data[starts], data[np.maximum(ends - 1, 0)], data[np.maximum(ends - 2, starts)]
    shape = _CLASS[a] + 8 * _CLASS[data[np.minimum(starts + 1, np.maximum(ends - 1, 0))]] + 64 * _CLASS[y] + 512 * _CLASS[z]
    ending = 256 * y.astype(np.uint64) + z
    again = np.zeros(len(starts), bool)
    if len(starts):
        again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    counts = np.bincount(owner, minlength=n)
    size = np.log2(counts + 1).astype(np.uint64)
    share = lambda x: (8 * np.bincount(owner, x, minlength=n) / np.maximum(counts, 1) + 0.5).astype(np.uint64)  # noqa: E731  in eighths
    whole = np.arange(n)
    kinds = [(owner, words, 1), (owner, ending, 2), (owner, shape, 3), (whole, size, 4)]
    kinds += [(whole, share(x), k) for k, x in ((5, again), (6, _CLASS[z] == 5), (7, _CLASS[a] == 2))]
    keys = [o.astype(np.uint64) * np.uint64(SLOTS) + mix(v.astype(np.uint64) + np.uint64(k << 56)) % np.uint64(SLOTS) for o, v, k in kinds]
    text_level = np.concatenate([np.full(len(o), k > 4) for o, _, k in kinds])
    key, first, count = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
    weight = np.where(text_level[first], TEXT_WEIGHT, 1 + np.log(count.astype(np.float32)))
    return (key // np.uint64(SLOTS)).astype(np.int64), (key % np.uint64(SLOTS)).astype(np.int64), weight.astype(np.float32)


def project(texts: list[bytes], idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of the texts in the latent space (zero if none of a text's terms is known)."""
    out = np.zeros((len(texts), basis.shape[1]), np.float32)
    for i, j in chunks(texts):
        text, slot, weight = terms(texts[i:j])
        w = weight * idf[slot]
        norm = np.sqrt(np.bincount(text, w * w, minlength=j - i))
        first = np.flatnonzero(np.diff(text, prepend=-1))
        out[i + text[first]] = np.add.reduceat(basis[slot] * w[:, None].astype(np.float32), first, axis=0)
        out[i:j] /= np.maximum(norm, 1e-9)[:, None]
    return unit(out)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(texts: list[bytes], rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """idf by slot and the projection on the leading singular vectors of the texts' weighted terms."""
    parts = [(i, *terms(texts[i:j])) for i, j in chunks(texts)]
    text = np.concatenate([t + i for i, t, _, _ in parts])
    slot, weight = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
    df = np.bincount(slot, minlength=SLOTS)
    idf = np.where(df > 0, np.log((1 + len(texts)) / (1 + df)) + 1, 0).astype(np.float32)
    w = (weight * idf[slot]).astype(np.float32)
    w /= np.sqrt(np.bincount(text, w * w, minlength=len(texts)))[text]
    gram = np.zeros((len(texts), len(texts)), np.float32)
    step = 1024
    order = np.argsort(slot, kind="stable")
    edges = np.searchsorted(slot[order], np.arange(0, SLOTS + step, step))
    blocks = list(zip(range(0, SLOTS, step), edges[:-1], edges[1:], strict=True))

    def dense(s, a, b):
        block = np.zeros((len(texts), step), np.float32)
        block[text[order[a:b]], slot[order[a:b]] - s] = w[order[a:b]]
        return block

    for s, a, b in blocks:
        block = dense(s, a, b)
        gram += block @ block.T
    values, vectors = np.linalg.eigh(gram)
    top = np.argsort(-values)[: min(rank, len(texts))]
    top = top[values[top] > 1e-6 * max(values.max(), 1e-9)]
    u = (vectors[:, top] / np.sqrt(values[top])).astype(np.float32)
    return idf, np.concatenate([dense(*x).T @ u for x in blocks])


def vote(vectors: np.ndarray, labelled: np.ndarray, labels: np.ndarray, k: int = NEIGHBOURS, power: float = POWER) -> np.ndarray:
    """Share of label 1 among each row's ``k`` most similar labelled vectors, weighted by cosine ** power."""
    out = np.empty(len(vectors))
    k = min(k, len(labelled))
    for i in range(0, len(vectors), 512):
        cosines = vectors[i : i + 512] @ labelled.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosines, near, 1), 1e-3).astype(np.float64) ** power
        out[i : i + 512] = (w * labels[near]).sum(1) / w.sum(1)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, labelled: DataFrame, text: str = "text", label: str = "label", max_labelled: int = LABELLED) -> DataFrame:
    """``docs`` with ``score``; ``labelled`` has ``text`` and a 0/1 ``label``."""
    body = F.coalesce(F.col(text), F.lit(""))
    known_rows = labelled.where(F.col(label).isNotNull()).select(body.alias("t"), F.col(label).cast("int").alias("y"))
    rows = bounded_sample(known_rows, F.col("t"), max_labelled).collect()
    held = None
    if rows:
        known = utf8([r["t"] for r in rows])
        idf, basis = fit(known)
        held = docs.sparkSession.sparkContext.broadcast((idf, basis, project(known, idf, basis), np.array([r["y"] for r in rows], np.float64)))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            if held is None:
                yield pd.Series(np.full(len(b), 0.5))
            else:
                idf, basis, vectors, labels = held.value
                yield pd.Series(vote(project(utf8(b), idf, basis), vectors, labels))

    return docs.withColumn("score", run(F.col(text)))


def op7_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (doc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"))
    known = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    known = known.where(F.col("label").isNotNull() & (doc_remainder(F.col("doc_id"), 3) != 1))
    # LABELLED rows at most, so they are sent to the texts
    out = score(docs, docs.join(F.broadcast(bounded_sample(known, F.col("doc_id"), LABELLED)), "doc_id"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
