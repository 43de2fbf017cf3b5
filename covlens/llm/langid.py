"""Language identification by a convolutional network over UTF-8 bytes.

Bytes are embedded, convolved with filters of several widths, max-pooled over a
window and classified by softmax; the network is trained in numpy by Adam. A text is
cut into windows of ``WINDOW`` bytes (the last one padded with byte 0), every window
is scored, and the text's probabilities are the windows' mean, weighted by bytes.

Training rows: texts with a known language, at most ``TRAIN_DOCS`` (those with the
smallest hash), one window from a hashed place of each. Prediction reads the text
alone. A null text or one without a letter is ``und`` with score 0, as is everything
if no row can be learned from. Ties go to the first language in order of name.
Repeated rows get equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import bounded_sample, doc_remainder, replace_columns, spare, table, utf8

WINDOW = 256
TRAIN_DOCS = 8000
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4), 16
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Windows that a worker convolves at a time.
BLOCK = 64


def windows(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of ``text`` as rows of bytes, and how many bytes each has."""
    n = -(-len(text) // window)
    out = np.zeros(n * window, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    sizes = np.full(n, window)
    if n:
        sizes[-1] = len(text) - (n - 1) * window
    return out.reshape(n, window), sizes


class ByteCNN:
    """Embedding, multi-width filters, max pooling over places, softmax."""

    def __init__(self, labels: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.labels, self.span = labels, max(WIDTHS)
        k = FILTERS * len(WIDTHS)
        self.mask = np.zeros((self.span, EMBED, k), np.float32)  # a filter of width w sees the first w places
        for i, w in enumerate(WIDTHS):
            self.mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
        self.p = {
            "e": r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "w": (r.normal(0, 0.3, self.mask.shape) * self.mask).astype(np.float32),
            "b": np.zeros(k, np.float32),
            "v": r.normal(0, 0.1, (k, len(labels))).astype(np.float32),
            "c": np.zeros(len(labels), np.float32),
        }

    @classmethod
    def of(cls, labels: list[str], p: dict[str, np.ndarray]) -> ByteCNN:
        net = cls(labels)
        net.p = p
        return net

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses by place (rows, places, filters) and the patches they come from."""
        e = self.p["e"][x].reshape(len(x), -1)
        patches = np.lib.stride_tricks.sliding_window_view(e, self.span * EMBED, axis=1)[:, ::EMBED]
        return patches @ self.p["w"].reshape(-1, self.p["w"].shape[-1]), patches

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(self.pooled(x)[0].max(axis=1) + self.p["b"], 0)
        return softmax(h @ self.p["v"] + self.p["c"])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        conv, patches = self.pooled(x)
        place = conv.argmax(axis=1)
        rows = np.arange(len(x))[:, None]
        pre = np.take_along_axis(conv, place[:, None], 1)[:, 0] + self.p["b"]
        h = np.maximum(pre, 0)
        d = softmax(h @ self.p["v"] + self.p["c"])
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        dh = (d @ self.p["v"].T) * (pre > 0)
        at = patches[rows, place]  # (rows, filters, span * EMBED)
        w = self.p["w"].reshape(-1, len(self.p["b"]))
        dw = np.einsum("nf,nfk->kf", dh, at).reshape(self.p["w"].shape) * self.mask
        dpatch = (dh[:, :, None] * w.T[None]).reshape(*dh.shape, self.span, EMBED)
        de = np.zeros_like(self.p["e"])
        np.add.at(de, x[rows[:, :, None], place[:, :, None] + np.arange(self.span)], dpatch)
        return {"e": de, "w": dw, "b": dh.sum(0), "v": h.T @ d, "c": d.sum(0)}

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        r, m, v, step = np.random.default_rng(seed), {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for i in range(0, len(x), BATCH):
                step += 1
                part = order[i : i + BATCH]
                for k, g in self.gradients(x[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = TRAIN_DOCS) -> ByteCNN | None:
    """A network for rows with a text and a label; ``max_docs`` windows reach the driver."""
    body = F.col(text)
    place = F.pmod(F.xxhash64(body), F.greatest(F.length(body) - WINDOW // 2, F.lit(1))).cast("int") + 1
    known = labelled.where(body.isNotNull() & F.col(lang).isNotNull()).select(F.substring(body, place, F.lit(WINDOW)).alias("t"), F.col(lang).alias("l"))
    rows = bounded_sample(known, F.col("t"), max_docs).collect()
    x = [(windows(utf8([r["t"]])[0])[0][:1], r["l"]) for r in rows if r["t"] and any(c.isalpha() for c in r["t"])]
    if not x:
        return None
    labels = sorted({lab for _, lab in x})
    net = ByteCNN(labels)
    net.fit(np.concatenate([w for w, _ in x]), np.array([labels.index(lab) for _, lab in x]))
    return net


def predict(docs: DataFrame, net: ByteCNN | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text."""
    held = docs.sparkSession.sparkContext.broadcast((net.labels, net.p) if net else None)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = ByteCNN.of(*held.value) if held.value else None
        for b in batches:
            out = [("und", 0.0)] * len(b)
            keep = [i for i, t in enumerate(b) if net and isinstance(t, str) and any(map(str.isalpha, t))]
            sums = np.zeros((len(b), len(net.labels) if net else 0))
            total = np.zeros(len(b))
            parts, owner, sizes, n = [], [], [], 0

            def flush():
                if n:
                    x, o, s = np.concatenate(parts), np.concatenate(owner), np.concatenate(sizes)
                    for k in range(0, n, BLOCK):
                        np.add.at(sums, o[k : k + BLOCK], net.probabilities(x[k : k + BLOCK]) * s[k : k + BLOCK, None])
                    np.add.at(total, o, s)
                    parts.clear(), owner.clear(), sizes.clear()

            for i in keep:
                w, size = windows(utf8([b.iloc[i]])[0])
                parts.append(w), owner.append(np.full(len(w), i)), sizes.append(size)
                n += len(w)
                if n >= 16 * BLOCK:
                    flush()
                    n = 0
            flush()
            for i in keep:
                k = int(sums[i].argmax())
                out[i] = (net.labels[k], min(1.0, float(sums[i, k] / total[i])))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    name = spare(docs, "_p")
    return replace_columns(docs.withColumn(name, run(F.col(f"`{text}`"))), {c: F.col(f"{name}.{c}") for c in ("lang_pred", "score")}).drop(name)


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", doc_remainder(F.col("doc_id"), 5) == 0)
    return predict(docs.select("doc_id", "held_out", "text"), train(docs.where("not held_out"))).select("doc_id", "held_out", "lang_pred", "score")
