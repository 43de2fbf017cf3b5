"""Near-duplicate classes by a chosen-path set similarity join.

A text's set is its distinct shingles of ``words`` words (A-Z in lower case, words
without white space), as 64-bit hashes; ``POSITIONS`` minwise tokens stand for it.
Texts with equal sets are one class at once. The classes descend ``TREES``
independent trees: a node is a path of (position, token) choices, the positions of
a node's children are drawn from a hash of its path, and a class follows a child if
it has that token there. Then, level by level:

* a node of at most ``SMALL`` classes is compared exhaustively by tokens;
* so is a larger one with at most ``FEW`` members outside its largest component: they meet all others,
  block by block, and the members of the component do not meet each other;
* any other node branches into ``BRANCH`` children;
* large roots are first compared within blocks of about ``BLOCK`` members, which joins their copies. The first
  tree's roots come first, so that the other trees meet a group of copies as one component;
* after ``LEVELS`` levels all blocks outside the largest component meet all other blocks.

Two members that agree in at least ``AGREE`` of the positions (five standard deviations
below the threshold) are compared by their full sets, which travel to the first group in which the two meet, and only links that join
two components leave it: no list of candidate pairs is made, and a block yields fewer links than it has members.
Two classes at a threshold of 0.8 meet in a tree
with probability 0.8 if its root nodes are small, and with 0.753 if their nodes stay large through all ``LEVELS``.
With what ``AGREE`` rejects (4 in a million) they are missed with about 7 in a million, or about 2 in 100,000.

Components are found by alternating large and small stars on tables. Nothing that
grows with the corpus is collected, and every step between two stages is written to
the shared checkpoint folder.

Null and empty texts have the empty set (0 shingles) and are linked with nothing;
rows without an id stand alone and have no component; rows with one id are one node
of the graph. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import SIDE_BYTES, Scratch, chunks, hash_words, is_space, joined, mix, small_batches, table, utf8

POSITIONS, TREES, BRANCH, LEVELS = 64, 8, 2, 3
SMALL, FEW, BLOCK = 512, 512, 512
AGREE = 36
#: Most groups of an id that are listed beside it.
MANY = 256
#: Bytes of text that a worker hashes at a time; its arrays take some 40 times as many.
TEXT_BYTES = 1 << 17
#: Links that one task contracts at a time.
LOCAL_LINKS = 250_000
_ODD = mix(np.arange(1, POSITIONS + 65, dtype=np.uint64)) | np.uint64(1)
_XOR = mix(np.arange(1001, 1001 + POSITIONS, dtype=np.uint64))


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    for i, j in chunks(texts, TEXT_BYTES):
        data, begin = joined([t.lower() for t in texts[i:j]])
        starts, h = hash_words(data, ~is_space(data))
        edges = np.searchsorted(starts, np.append(begin, len(data)))
        with np.errstate(over="ignore"):
            n = max(0, len(h) - words + 1)
            rolled = mix(sum((h[k : k + n] * _ODD[k] for k in range(words)), np.zeros(n, np.uint64)))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a >= words:
                    yield np.unique(rolled[a : b - words + 1])
                elif b > a:
                    yield mix(np.array([(h[a:b] * _ODD[: b - a]).sum() + np.uint64(b - a)]))
                else:
                    yield np.empty(0, np.uint64)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, POSITIONS) tokens of 32 bits; no set may be empty."""
    every = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), POSITIONS), "<u4")
    with np.errstate(over="ignore"):
        for p in range(POSITIONS):
            out[:, p] = np.minimum.reduceat((every ^ _XOR[p]) * _ODD[p], first) & np.uint64(0xFFFFFFFF)
    return out


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """id, n_shingles, set_key (digest of the set), tokens and sketch (a byte of each token); null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = utf8(b["text"])
            for i, j in chunks(texts, TEXT_BYTES):
                sets = list(shingle_sets(texts[i:j], words))
                full = [s for s in sets if len(s)]
                tokens = minwise(full) if full else np.empty((0, POSITIONS), "<u4")
                at = np.cumsum([len(s) > 0 for s in sets]) - 1
                yield pd.DataFrame({
                    "id": b["id"].iloc[i:j].array, "n_shingles": [len(s) for s in sets],
                    "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "tokens": [tokens[k].tobytes() if len(s) else None for k, s in zip(at, sets, strict=True)],
                    "sketch": [tokens[k].astype(np.uint8).tobytes() if len(s) else None for k, s in zip(at, sets, strict=True)]})

    return docs.mapInPandas(run, "id long, n_shingles long, set_key binary, tokens binary, sketch binary")


def token(position: Column) -> Column:
    return F.substring(F.col("tokens"), position * 4 + 1, F.lit(4))


def _matrix(values) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, POSITIONS)


def by_key(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on frames that hold whole groups of equal ``key``, dealt by key and sorted; groups are bounded by the caller."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            key = b["key"].to_numpy()
            earlier = np.flatnonzero(key != key[-1])
            last = int(earlier[-1]) + 1 if len(earlier) else 0
            if last or (rest and rest[-1]["key"].iloc[0] != key[0]):
                yield from work(pd.concat([*rest, b.iloc[:last]], ignore_index=True))
                rest = []
            rest.append(b.iloc[last:])
        if rest:
            yield from work(pd.concat(rest, ignore_index=True))

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, schema)


def with_partners(rows: DataFrame) -> DataFrame:
    """Of rows (key, id, c, sketch) those that agree with one of another component in their group."""

    def work(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, c, sketch = b["key"].to_numpy(), b["c"].to_numpy(), _matrix(b["sketch"])
        found = np.zeros(len(b), bool)
        for d in range(1, len(key)):
            i = np.flatnonzero(key[:-d] == key[d:])
            if not len(i):
                break
            i = i[c[i] != c[i + d]]
            agree = (sketch[i] == sketch[i + d]).sum(axis=1) >= AGREE
            found[i[agree]] = found[i[agree] + d] = True
        if found.any():
            yield b[found]

    return by_key(rows.select("key", "id", "c", "sketch"), work, "key long, id long, c long, sketch binary")


def once(rows: DataFrame) -> DataFrame:
    """Of rows (key, id, c, sketch) those that agree in their group with one that they meet in no group of a smaller key.

    So a pair that meets in several groups is compared in the first of them alone. An id of more than MANY groups is taken to meet its partners there only.
    """

    def work(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, c, sketch = b["key"].to_numpy(), b["c"].to_numpy(), _matrix(b["sketch"])
        found = np.zeros(len(b), bool)
        for i, j in itertools.pairwise([0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]):
            before = [np.asarray(k, np.int64) for k in b["keys"].iloc[i:j]]
            before = [k[k < key[i]] for k in before]
            names, name = np.unique(np.concatenate(before), return_inverse=True)
            row = np.repeat(np.arange(j - i), [*map(len, before)])
            met = np.zeros((j - i, j - i), bool)
            for k in range(0, len(names), BLOCK):
                own = (name >= k) & (name < k + BLOCK)
                member = np.zeros((j - i, BLOCK), np.float32)
                member[row[own], name[own] - k] = 1
                met |= member @ member.T > 0
            new = ~met & (c[i:j, None] != c[i:j])
            for x in np.flatnonzero(new.any(axis=1)):
                other = np.flatnonzero(new[x, x + 1 :]) + x + 1
                other = other[(sketch[i + other] == sketch[i + x]).sum(axis=1) >= AGREE]
                if len(other):
                    found[i + x] = found[i + other] = True
        if found.any():
            yield b[["key", "id", "c", "sketch"]][found]

    ids = rows.groupBy("id").agg(F.first("sketch").alias("sketch"), F.collect_list(F.struct("key", "c")).alias("_places"))
    ids = ids.withColumn("keys", F.when(F.size("_places") <= MANY, F.col("_places.key")).otherwise(F.array().cast("array<bigint>")))
    return by_key(ids.select("id", "sketch", "keys", F.inline("_places")), work, "key long, id long, c long, sketch binary")


def joining(rows: DataFrame, similarity: int) -> DataFrame:
    """Links (u, v) that join the components of each group of rows (key, id, c, sketch, members).

    Rows that agree are linked if 100 * intersection >= similarity * union of their full sets;
    those that are joined already are not compared.
    """

    def work(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, ids, sketch = b["key"].to_numpy(), b["id"].to_numpy(), _matrix(b["sketch"])
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
        links = []
        for i, j in itertools.pairwise(edges):
            sets = [np.frombuffer(m, np.uint64) for m in b["members"].iloc[i:j]]
            links += [(ids[i + x], ids[i + y]) for x, y in spanning(sets, sketch[i:j], b["c"].to_numpy()[i:j], similarity)]
        if links:
            yield pd.DataFrame(links, columns=["u", "v"])

    return by_key(rows.select("key", "id", "c", "sketch", "members"), work, "u long, v long")


def spanning(sets: list[np.ndarray], sketch: np.ndarray, c: np.ndarray, similarity: int) -> Iterator[tuple[int, int]]:
    """Similar pairs of places that join two components, each pair joining two that those before it have not."""
    values, member = np.unique(np.concatenate(sets), return_inverse=True)
    n = np.array([len(s) for s in sets])
    first = np.cumsum(n) - n
    seen, label = np.zeros(len(values), np.int32), c.copy()
    for i in range(len(sets) - 1):
        other = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        other = other[(sketch[other] == sketch[i]).sum(axis=1) >= AGREE]
        if not len(other):
            continue
        own = member[first[i] : first[i] + n[i]]
        seen[own] = 1
        lo, hi = other[0], other[-1]
        common = np.add.reduceat(seen[member[first[lo] : first[hi] + n[hi]]], first[lo : hi + 1] - first[lo])[other - lo]
        seen[own] = 0
        for j in other[100 * common >= similarity * (n[i] + n[other] - common)]:
            if label[j] != label[i]:
                yield i, int(j)
                label[label == label[j]] = label[i]


def children(rows: DataFrame, branch: int) -> DataFrame:
    """(path, id, sketch) of the ``branch`` children of every row's node; the node's path alone picks the positions."""
    options = [F.xxhash64("path", F.lit(k), token(F.pmod(F.xxhash64("path", F.lit(k)), F.lit(POSITIONS)).cast("int"))) for k in range(branch)]
    return rows.select(F.explode(F.array(*options)).alias("path"), "id", "sketch")


def contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (u, v) of a part as (id, the least id that they join it with)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist(), strict=True):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    ids = list(parent)
    for i in range(0, len(ids), 1 << 16):
        some = ids[i : i + (1 << 16)]
        out = pd.DataFrame({"u": some, "v": [root(x) for x in some]}, dtype="int64")
        yield out[out["u"] != out["v"]]


class Components:
    """Components of a growing set of links; ``labels`` has (id, component) of linked ids, others are their own."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.labels: DataFrame | None = None
        self.few = True  # labels are broadcast

    def of(self, df: DataFrame, col: str, out: str) -> DataFrame:
        if self.labels is None:
            return df.withColumn(out, F.col(col))
        known = self.labels.select(F.col("id").alias(col), F.col("component").alias("_c"))
        return df.join(F.broadcast(known) if self.few else known, col, "left").withColumn(out, F.coalesce("_c", F.col(col))).drop("_c")

    def add(self, links: DataFrame) -> None:
        """Joins the components of ``links`` (u, v).

        Links are first contracted within parts of about LOCAL_LINKS of them, each to stars around its
        components' least ids; then large and small stars take turns until only stars are left.
        """
        if self.labels is not None:
            links = links.unionByName(self.labels.select(F.col("id").alias("u"), F.col("component").alias("v")))
        edges = self.scratch.cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct())
        parts = max(1, -(-self.scratch.size(edges) // (8 * LOCAL_LINKS)))  # of at least 8 bytes each, mostly
        edges = self.scratch.cut(edges.repartition(parts).mapInPandas(contracted, "u long, v long").distinct() if parts > 1 else edges.coalesce(1).mapInPandas(contracted, "u long, v long"))
        while parts > 1 and not self.only_stars(edges):
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            edges = self.scratch.cut(moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        self.few = self.scratch.size(edges) <= SIDE_BYTES
        self.labels = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))

    @staticmethod
    def only_stars(edges: DataFrame) -> bool:
        """No id has two parents, and no parent has one."""
        ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("child")))
        wrong = ends.groupBy("id").agg(F.sum("child").alias("parents"), F.min("child").alias("least")).where("parents > 1 or (parents = 1 and least = 0)")
        return wrong.isEmpty()


def sets_of(docs: DataFrame, found: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """(id, members) of the ids of ``found``: their full sets, written once."""
    ids = scratch.side(found.select("id").distinct())  # if they are too many, the texts are shuffled

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = utf8(b["text"])
            for i, j in chunks(texts, TEXT_BYTES):
                yield pd.DataFrame({"id": b["id"].iloc[i:j].array, "members": [s.tobytes() for s in shingle_sets(texts[i:j], words)]})

    return scratch.cut(docs.join(ids, "id", "left_semi").mapInPandas(run, "id long, members binary").where("length(members) > 0"))


def by_id(rows: DataFrame, what: Column, table: DataFrame) -> DataFrame:
    """``rows`` (id, sketch and others) with the columns of ``table``, joined once per id; of the others only the struct ``what`` stays.

    An id is in several groups of every tree: the join makes as many rows as there are ids, not groups.
    """
    ids = rows.groupBy("id").agg(F.first("sketch").alias("sketch"), F.collect_list(what).alias("_places"))
    return ids.join(table, "id").withColumn("_place", F.explode("_places")).select("*", "_place.*").drop("_places", "_place")


def link(docs: DataFrame, found: DataFrame, components: Components, words: int, similarity: int, scratch: Scratch) -> None:
    """Joins the components of what is similar within the groups of ``found`` (key, id, c, sketch)."""
    found = scratch.cut(once(found))
    if found.isEmpty():
        return
    sets = sets_of(docs, found, words, scratch)
    links = scratch.cut(joining(by_id(found, F.struct("key", "c"), sets), similarity))
    if not links.isEmpty():
        components.add(links)


def linked(docs: DataFrame, words: int, similarity: int, scratch: Scratch, components: Components) -> DataFrame:
    """Joins in ``components`` what is similar among ``docs`` (id, text); returns (id, n_shingles, set_key, rep), rep standing for rows of equal sets."""
    rows = scratch.cut(fingerprints(docs, words))
    classes = rows.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("rep"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    classes = scratch.cut(classes)
    members = rows.select("id", "n_shingles", "set_key").join(classes.select("set_key", "rep"), "set_key", "left")
    twice = members.where("rep is not null").groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    same_id = scratch.cut(members.join(twice, "id").select(F.col("rep").alias("u"), F.col("lo").alias("v")))
    if not same_id.isEmpty():
        components.add(same_id)

    tokens = classes.select(F.col("rep").alias("id"), "tokens")
    kept = [rows, classes]

    def tidy(*more: DataFrame) -> None:
        scratch.clear(*kept, *more, *([components.labels] if components.labels is not None else []))

    def still_open(nodes: DataFrame) -> DataFrame:
        return scratch.cut(with_main(components.of(nodes, "id", "c"), scratch))

    def compare(found: DataFrame) -> None:
        link(docs, found, components, words, similarity, scratch)

    every = classes.select(F.posexplode(roots(range(TREES))).alias("tree", "path"), F.col("rep").alias("id"), "sketch")

    # the first tree's roots join the groups of copies, so that the others meet each group as one component
    nodes = every.where("tree = 0").drop("tree")
    for turn in range(2):
        shared = still_open(nodes)
        nodes = shared.where(F.col("n") > SMALL).select("path", "id", "sketch")
        compare(with_partners(in_blocks(shared, turn)))
        tidy(shared)
        if nodes.isEmpty():
            break

    shared = still_open(every)
    compare(with_partners(in_blocks(shared.where((F.col("tree") > 0) | (F.col("n") > SMALL)), 2)))
    nodes = shared.where(F.col("n") > SMALL).select("path", "id", "sketch")
    later: list[DataFrame] = []
    for level in range(LEVELS + 1):
        shared = still_open(nodes)
        if shared.isEmpty():
            break
        ready = ((F.col("n") <= SMALL) | (F.col("outside") <= FEW)) if level < LEVELS else F.lit(True)
        later.append(scratch.cut(with_partners(meetings(shared.where(ready)))))
        nodes = scratch.cut(children(by_id(shared.where(~ready), F.struct("path"), tokens), BRANCH))
        tidy(nodes, *later)
    if later:
        compare(reduce(DataFrame.unionByName, later))
    return members


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept (id = component_id).

    ``similarity`` is the least Jaccard similarity of linked texts in hundredths, 80 or more (``AGREE`` is made for that).
    Ids are cast to long. A row without an id has no component and is kept.
    """
    if not 80 <= similarity <= 100:
        raise ValueError("similarity must be 80 to 100")
    scratch = Scratch(docs.sparkSession)
    components = Components(scratch)
    with small_batches(docs.sparkSession):  # rows carry texts and sets
        members = linked(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")), words, similarity, scratch, components)
        out = scratch.cut(components.of(members, "rep", "c").select("id", "n_shingles", "c"))
    scratch.clear(out)
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def roots(trees: range) -> Column:
    """Paths of a class' root nodes, in the order of ``trees``."""
    return F.array(*[F.xxhash64(F.lit(t), token(F.lit(t * (POSITIONS // TREES)))) for t in trees])


def with_main(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (path, id, c and others) of nodes with several components, with their size n, the largest one (main) and how many are outside it.

    The sizes are a table of their own, so that Spark can split a node that holds many rows.
    """
    parts = nodes.groupBy("path", "c").agg(F.count("*").alias("k"))
    main = parts.groupBy("path").agg(F.max(F.struct("k", "c")).alias("m"), F.count("*").alias("parts"), F.sum("k").alias("n"))
    main = main.where("parts > 1").select("path", "n", F.col("m.c").alias("main"), (F.col("n") - F.col("m.k")).alias("outside"))
    return nodes.join(scratch.side(main), "path")


def in_blocks(rows: DataFrame, turn: int) -> DataFrame:
    """Rows of ``with_main`` as groups (key, id, c, sketch): nodes of up to SMALL rows, and blocks of about BLOCK rows of larger ones, others in each turn."""
    blocks = F.when(F.col("n") > SMALL, F.ceil(F.col("n") / BLOCK)).otherwise(1).cast("long")
    return rows.select(F.xxhash64("path", F.pmod(F.xxhash64("id", F.lit(turn)), blocks), F.lit(turn)).alias("key"), "id", "c", "sketch")


def meetings(rows: DataFrame) -> DataFrame:
    """Rows of ``with_main`` as groups (key, id, c, sketch) in which all of a node that are in different components meet.

    In a node of more than SMALL rows those outside the main component are dealt to blocks of about FEW, and those in it to others
    of about BLOCK; a group is two blocks, one at least of the former. So a node with up to FEW outside is written twice at most.
    """
    outer, inner = F.ceil(F.col("outside") / FEW).cast("int"), F.ceil((F.col("n") - F.col("outside")) / BLOCK).cast("int")
    h = F.xxhash64("id", F.lit("block"))
    block = F.when(F.col("c") == F.col("main"), outer + F.pmod(h, inner).cast("int")).otherwise(F.pmod(h, outer).cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("c") == F.col("main"), outer).otherwise(outer + inner) - 1)
    others = F.when(F.col("n") > SMALL, F.filter(others, lambda o: o != F.col("block"))).otherwise(F.array(F.lit(-1)))
    df = rows.withColumn("block", F.when(F.col("n") > SMALL, block).otherwise(-1)).withColumn("other", F.explode(others))
    return df.select(F.xxhash64("path", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "id", "c", "sketch")


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""
OP3_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS g FROM d),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM s),
sized AS (SELECT doc_id, n, h, row_number() OVER (PARTITION BY doc_id ORDER BY h) AS r FROM x),
pre AS (SELECT doc_id, n, h FROM sized WHERE 100 * (r - 1) <= 20 * n),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
inter AS (SELECT a, b, count(*) AS i, any_value(p.n) AS na, any_value(q.n) AS nb FROM cand JOIN x p ON p.doc_id = a JOIN x q ON q.doc_id = b AND q.h = p.h GROUP BY a, b),
e AS (SELECT a, b FROM inter WHERE 100 * i >= 80 * (na + nb - i)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS id, a AS root FROM sym UNION SELECT sym.b, reach.root FROM reach JOIN sym ON sym.a = reach.id WHERE reach.root < sym.b),
c AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id, s.doc_id = coalesce(c.root, s.doc_id) AS kept
FROM s LEFT JOIN c ON c.id = s.doc_id
"""
