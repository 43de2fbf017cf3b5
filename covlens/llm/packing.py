"""Lexical retrieval packing: documents that share rare words share a sequence.

Documents are packed into windows of ``WINDOW`` tokens. Spark first deals the documents of the whole
corpus by their rarest word that any other document has, so that lexical neighbours meet wherever
they come from; a word that is the rarest one of more documents than a task should hold is dealt to several.
Each partition reads its documents, in the order of those words, into shards of about
``SHARD_TOKENS`` tokens and builds a BM25 inverted index of every shard. The document that opens a window is its seed: the shard's
unused documents, best BM25 score first, fill the rest, and the one that meets the
end of the window is cut there and seeds the next. A window that is open when a
shard ends goes on in the next shard, so only the last window of a partition is
short, and that one is cut into sequences whose lengths are powers of two: nothing
is padded.

Document frequencies and the mean length are counted over the whole corpus, in
``SLOTS`` hashed words: the table is of a fixed size and is all that is broadcast.
The texts' words are counted twice, for these figures and where the documents are dealt, from where
the counts are shuffled beside the texts; nothing else is written. A worker holds one shard.

Null and empty texts are a single end token. Repeated rows are packed once each.
An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import itertools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.llm.common import chunks, hash_words, joined, table, utf8

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1 << 20
SLOTS = 1 << 17
K1, B = 1.2, 0.75
#: Entries that a worker's word tables hold before they are emptied.
CACHE_WORDS = 300_000
#: Most documents of one rarest word that are dealt to one task.
DEALT_TOGETHER = 20_000
#: Texts that are encoded together.
TEXTS_AT_ONCE = 100
#: Bytes of text whose words are hashed together; the arrays stay in a core's cache.
HASHED_BYTES = 1 << 17


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The tokenizer's own pieces of a Latin-1 text in lower case: contractions, letters, one digit, marks.
_LETTER, _NUMBER, _WHITE = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t-\\r \u0085\u00a0"
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^{_WHITE}{_LETTER}{_NUMBER}]+")


class _Pieces(dict):
    """Ids of pieces of Latin-1 words, remembered."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        # printable bytes stand for themselves, the others for U+0100 and on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: 0x100 + k for k, b in enumerate(hidden)}

    def __missing__(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters)
        value = self[piece] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return value


class _Words(dict):
    """Ids of words, remembered."""

    def __init__(self, tokenizer, pieces: _Pieces):
        super().__init__()
        self.tokenizer, self.pieces = tokenizer, pieces

    def __missing__(self, word: str) -> bytes:
        value = self[word] = self.ids(word)
        return value

    def ids(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return self.pieces[word.lower()]
            plain = "<|" not in word
        else:
            plain = max(word) < "\u0100" and "<|" not in word
        if not plain:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(word.lower())))


class Encoder:
    """Token ids of whole texts, with the end id, by the tokenizer file at ``path``.

    The tokenizer lowers a text, drops its white space and encodes each piece by itself,
    so the ids of words and of their pieces are remembered. A piece of a Latin-1 word goes
    to the tokenizer's model at once, in its letters for bytes; any other word, and one
    that may hold a special token, goes through the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = array("I", [end_id]).tobytes()
        # neither refers to the encoder: with its last use the memory goes at once, not when a collector runs
        self.pieces = _Pieces(self.tokenizer.model)
        self.words = _Words(self.tokenizer, self.pieces)

    def __call__(self, texts: list) -> list[np.ndarray]:
        for memory in (self.words, self.pieces):
            if len(memory) > CACHE_WORDS:
                memory.clear()
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") if isinstance(t, str) else [] for t in texts]
        return [np.frombuffer(b"".join([*map(self.words.__getitem__, ws), self.end]), "<u4") for ws in split]


_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def slots_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, count) of the distinct word slots of each text, by text; words are runs of letters and digits."""
    found = []
    for i, j in chunks(texts, HASHED_BYTES):
        data, begin = joined([t.lower() for t in texts[i:j]])
        starts, h = hash_words(data, _IS_TERM[data])
        owner = np.searchsorted(begin, starts, side="right") - 1
        small = np.int32 if j - i < 1 << 13 else np.int64
        key, count = np.unique(owner.astype(small) * small(SLOTS) + (h & np.uint64(SLOTS - 1)).astype(small), return_counts=True)
        found.append((key.astype(np.int64) // SLOTS + i, key % SLOTS, count))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3


def corpus_statistics(docs: DataFrame, text: str) -> tuple[np.ndarray, int, float]:
    """Documents with each word slot, documents, and mean words; SLOTS + 2 numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, n, total = np.zeros(SLOTS, np.int64), 0, 0
        for b in batches:
            for i in range(0, len(b), 10 * TEXTS_AT_ONCE):
                _, slot, times = slots_of(utf8(b["text"].iloc[i : i + 10 * TEXTS_AT_ONCE]))
                found += np.bincount(slot, minlength=SLOTS)
                total += int(times.sum())
            n += len(b)
        at = np.flatnonzero(found)
        yield pd.DataFrame({"slot": np.concatenate((at, [-1, -2])), "n": np.concatenate((found[at], [n, total]))})

    counts = docs.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    by = dict(zip(counts["slot"], counts["n"], strict=True))
    n, total = int(by.pop(-1, 0)), int(by.pop(-2, 0))
    df = np.zeros(SLOTS, np.int64)
    df[list(by)] = list(by.values())
    return df, n, total / n if n else 0.0


def rarest(owner: np.ndarray, slot: np.ndarray, texts: int, df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the slot that the fewest texts have, but two at least (-1 without any), and how many have it; of ``slots_of``."""
    shared = df[slot] >= 2
    slot, owner = slot[shared], owner[shared]
    out, n = np.full(texts, -1, np.int64), np.ones(texts, np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    if len(first):
        least = np.minimum.reduceat(df[slot] * SLOTS + slot, first)
        out[owner[first]], n[owner[first]] = least % SLOTS, least // SLOTS
    return out, n


def counted(docs: DataFrame, id_col: str, text: str, df) -> DataFrame:
    """id, text, its distinct word slots (by number) with their counts, as 32-bit integers, its rarest shared word and in how many parts that is dealt.

    ``df`` is a broadcast of the documents that have each slot.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), TEXTS_AT_ONCE):
                part = b.iloc[i : i + TEXTS_AT_ONCE]
                owner, slot, count = slots_of(utf8(part["text"]))
                word, n = rarest(owner, slot, len(part), df.value)
                edge = np.searchsorted(owner, np.arange(len(part) + 1))
                slot, count = slot.astype("<i4"), count.astype("<i4")
                own = list(itertools.pairwise(edge))
                yield part.assign(slots=[slot[i:j].tobytes() for i, j in own], counts=[count[i:j].tobytes() for i, j in own], word=word, parts=-(-n // DEALT_TOGETHER))

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("slots", T.BinaryType()),
                           T.StructField("counts", T.BinaryType()), T.StructField("word", T.LongType()), T.StructField("parts", T.LongType())])
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInPandas(run, schema)


class Shard:
    """An inverted index of some documents: per word slot, who holds it and with which BM25 weight."""

    def __init__(self, slots: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean_words: float):
        self.slots, self.idf, self.n = slots, idf, len(slots)
        sizes = np.array([len(s) for s in slots])
        term, doc = np.concatenate(slots), np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        tf = np.concatenate(counts).astype(np.float32)
        length = np.array([c.sum() for c in counts], np.float32)[doc]
        weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(mean_words, 1)))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order] * idf[term[order]]
        self.edge = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=SLOTS))))  # of each slot's holders

    def ranked(self, query: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Unused documents by BM25 score for the words of ``query``; ties by place."""
        first = self.edge[query]
        size = self.edge[query + 1] - first
        index = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        score = np.bincount(self.doc[index], self.weight[index], minlength=self.n)
        free = np.flatnonzero(~used)
        return free[np.argsort(-score[free], kind="stable")]


class Packer:
    """Fills windows; ``rows`` are (doc, start, ids, doc_tokens, sequence, offset) of full ones."""

    def __init__(self, window: int):
        self.window, self.open, self.fill, self.sequence, self.rows = window, [], 0, 0, []
        self.seed = None  # word slots of the open window's first document

    def add(self, doc, ids: np.ndarray, slots: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            if not self.fill:
                self.seed = slots
            part = ids[start : start + self.window - self.fill]
            self.open.append((doc, start, part, len(ids)))
            start, self.fill = start + len(part), self.fill + len(part)
            if self.fill == self.window:
                self.close(self.open)
                self.open, self.fill = [], 0

    def close(self, pieces) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.rows.append((doc, start, ids, n, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """The open window as sequences of descending powers of two."""
        rest, pieces = self.fill, self.open
        while rest:
            room = 1 << (rest.bit_length() - 1)
            rest -= room
            now = []
            while room:
                doc, start, ids, n = pieces.pop(0)
                now.append((doc, start, ids[:room], n))
                if len(ids) > room:
                    pieces.insert(0, (doc, start + room, ids[room:], n))
                room -= min(room, len(ids))
            self.close(now)
        self.open, self.fill = [], 0

    def shard(self, docs: list[tuple], idf: np.ndarray, mean_words: float) -> None:
        """Packs (id, token ids, slots, counts) of one shard."""
        index = Shard([d[2] for d in docs], [d[3] for d in docs], idf, mean_words)
        used, left, next_seed, seed, ranking = np.zeros(len(docs), bool), len(docs), 0, None, iter(())
        while left:
            if not self.fill:
                while used[next_seed]:
                    next_seed += 1
                k = next_seed
            else:
                if seed is not self.seed:
                    seed = self.seed
                    ranking = iter(index.ranked(seed, used))
                k = next(ranking)
            used[k] = True
            left -= 1
            self.add(docs[k][0], docs[k][1], docs[k][2])


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, id_col: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``window`` must be a power of two. ``tokenizer`` must exist on every executor.
    """
    path = tokenizer or default_tokenizer()
    df, n, mean_words = corpus_statistics(docs, text)
    held = docs.sparkSession.sparkContext.broadcast(np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32))
    placed = counted(docs, id_col, text, docs.sparkSession.sparkContext.broadcast(df))
    # without a shared word a document has no neighbours, and any place will do
    part = F.when(F.col("word") < 0, F.pmod(F.xxhash64("text"), F.lit(SLOTS))).otherwise(F.pmod(F.xxhash64("text", "id"), F.col("parts")))
    dealt = placed.withColumn("part", part).repartition("word", "part").sortWithinPartitions("word", "part").select("id", "text", "slots", "counts")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def frame(packer: Packer) -> pd.DataFrame:
        r, packer.rows = packer.rows, []
        base = TaskContext.get().partitionId() << 40
        return pd.DataFrame({
            id_col: pd.Series([x[0] for x in r], dtype=object), "start": [x[1] for x in r], "length": [len(x[2]) for x in r], "ids": [x[2].tobytes() for x in r],
            "doc_tokens": [x[3] for x in r], "sequence_id": [base + x[4] for x in r], "offset": [x[5] for x in r]}).astype({"start": "int64", "length": "int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = Encoder(path), Packer(window)
        shard, tokens = [], 0
        for b in batches:
            for i in range(0, len(b), TEXTS_AT_ONCE):
                part = b.iloc[i : i + TEXTS_AT_ONCE]
                for doc, ids, slots, counts in zip(part["id"], encode(list(part["text"])), part["slots"], part["counts"], strict=True):
                    shard.append((None if pd.isna(doc) else doc, ids, np.frombuffer(slots, "<i4"), np.frombuffer(counts, "<i4")))
                    tokens += len(ids)
                    if tokens >= shard_tokens:
                        packer.shard(shard, held.value, mean_words)
                        shard, tokens = [], 0
                        yield frame(packer)
        if shard:
            packer.shard(shard, held.value, mean_words)
        packer.finish()
        yield frame(packer)

    return dealt.mapInPandas(run, schema)


def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
