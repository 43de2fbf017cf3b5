"""Conversation structure repair by generalised LR parsing over a role grammar.

A conversation is sound if the initials of its roles form a sentence of ``GRAMMAR``:
an optional system turn, then one or more pairs of user and assistant turns, or nothing.
The LR(0) item sets of the grammar are made by ``Grammar``; the recursion is to the left,
so the stacks that shifts and reductions can reach are few. They are the nodes of the
graph-structured stack, and tops from which the same sentences can follow are equal.

``repair`` runs one ordered pass over each conversation. Every turn forks each stack: keep
(cost 0), rerole to user or assistant (3), delete (4, forced for blank and repeated turns),
and before each turn and at the end insert an empty user or assistant turn (3). A kept or reroled
turn that is cut off adds 3. Stacks with equal tops are merged by the least (cost, audit),
where the audit has the edits' initials in order. Two audits of one cost that have read the
same turns are never prefixes of one another, so the least one stays the least whatever
follows, and merging is exact. What is dearer than the cheapest stack by more
than ``SLACK`` can't win any more and is dropped.

Turns are dealt by conversation and sorted by Spark, which spills. A task holds a batch of
turns and four stacks, each with a running SHA-256 and the part of its audit that differs
from the others'; so a conversation of any length takes constant memory and a byte a turn for its audit.
The digest of a conversation's whole repaired text is sequential by definition, so the rows of
one conversation pass through one task.

Null conversation ids are one conversation. Null roles and texts count as one space.
Turns come in the order of turn (nulls first), role, text. Repeated rows are repeats. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covlens.llm.common import table

#: Terminals are the initials of roles; C is the start.
GRAMMAR = [("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua")]
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Any top can do what another does for less: one turn is inserted and one deleted or two reroled.
SLACK = 4 * max(REROLE + TRUNCATED, DELETE, INSERT)

WHITE = " \t\n\x0b\x0c\r"


class Grammar:
    """LR(0) automaton of a grammar with one-letter symbols (nonterminals in capitals), and the stacks it reaches."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = [("Z", rules[0][0]), *rules]
        self.terminals = sorted({c for _, right in rules for c in right if c.islower()})
        self.start = (self.closure({(0, 0)}),)
        self.tops, self.moves, self.accepting = self._reach()

    def closure(self, items) -> frozenset:
        out, todo = set(), list(items)
        while todo:
            rule, dot = item = todo.pop()
            if item not in out:
                out.add(item)
                after = self.rules[rule][1][dot : dot + 1]
                todo += [(i, 0) for i, (left, _) in enumerate(self.rules) if left == after]
        return frozenset(out)

    def goto(self, state: frozenset, symbol: str) -> frozenset:
        return self.closure((r, d + 1) for r, d in state if self.rules[r][1][d : d + 1] == symbol)

    def reductions(self, stack: tuple) -> Iterator[tuple]:
        """Stacks after one reduction of ``stack``."""
        for rule, dot in stack[-1]:
            left, right = self.rules[rule]
            if rule and dot == len(right):
                below = stack[: len(stack) - dot]
                if state := self.goto(below[-1], left):
                    yield (*below, state)

    def every(self, stack: tuple) -> set[tuple]:
        """The stack and all that reductions make of it."""
        out, todo = set(), [stack]
        while todo:
            if (s := todo.pop()) not in out:
                out.add(s)
                todo += self.reductions(s)
        return out

    def shift(self, top: frozenset, symbol: str) -> frozenset:
        """The set of stacks after ``symbol``, each kept as small as reductions make it."""
        shifted = {(*s, state) for s in top if (state := self.goto(s[-1], symbol))}
        return frozenset().union(*map(self.every, shifted)) if shifted else frozenset()

    def _reach(self):
        """Tops (sets of stacks, equal ones merged), moves[top][symbol] and whether a top may end."""
        first = frozenset(self.every(self.start))
        order, todo, raw = {first: 0}, [first], {}
        while todo:
            top = todo.pop()
            for c in self.terminals:
                nxt = self.shift(top, c)
                raw[top, c] = nxt
                if nxt and nxt not in order:
                    order[nxt] = len(order)
                    todo.append(nxt)
        ends = {t: any((0, 1) in s[-1] for s in t) for t in order}
        kind = {t: int(ends[t]) for t in order}
        while True:  # tops with equal futures are one
            sign = {t: (kind[t], *[kind.get(raw[t, c], -1) for c in self.terminals]) for t in order}
            number = {s: i for i, s in enumerate(dict.fromkeys(sign[t] for t in order))}
            refined = {t: number[sign[t]] for t in order}
            if len(set(refined.values())) == len(set(kind.values())):
                break
            kind = refined
        kind = refined
        moves: list[dict[str, int]] = [{} for _ in set(kind.values())]
        accepting = [False] * len(moves)
        for t, k in kind.items():
            accepting[k] = ends[t]
            moves[k] = {c: kind[raw[t, c]] for c in self.terminals if raw[t, c]}
        assert kind[first] == 0
        return len(moves), moves, accepting


class Stack(NamedTuple):
    cost: int
    audit: str  # what follows the part that all stacks share
    digest: object  # running SHA-256 of the repaired turns
    turns: int


class Parser:
    """The stacks of one conversation; ``read`` takes its turns in order."""

    def __init__(self, grammar: Grammar):
        self.g = grammar
        self.shared: list[str] = []
        self.stacks: dict[int, Stack] = {0: Stack(0, "", hashlib.sha256(), 0)}

    @staticmethod
    def said(s: Stack, cost: int, edit: str, role: str, text: str) -> Stack:
        digest = s.digest.copy()
        digest.update(f"{chr(10) if s.turns else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        return Stack(cost, s.audit + edit, digest, s.turns + 1)

    def insert(self) -> None:
        """Follows insertions until none makes a top cheaper."""
        todo = list(self.stacks)
        while todo:
            top = todo.pop()
            s = self.stacks[top]
            for c, nxt in self.g.moves[top].items():
                if c in ROLES:
                    old = self.stacks.get(nxt)
                    if old is None or (s.cost + INSERT, s.audit + "I") < old[:2]:
                        self.stacks[nxt] = self.said(s, s.cost + INSERT, "I", ROLES[c], "")
                        todo.append(nxt)

    def read(self, role: str, text: str, forced: bool, truncated: bool) -> None:
        self.insert()
        extra = TRUNCATED if truncated else 0
        best: dict[int, tuple] = {}

        def offer(top: int, cost: int, audit: str, *how) -> None:
            if top not in best or (cost, audit) < best[top][:2]:
                best[top] = (cost, audit, *how)

        for top, s in self.stacks.items():
            offer(top, s.cost + DELETE, s.audit + "D", s, "")
            if not forced:
                for c, nxt in self.g.moves[top].items():
                    if c == role[:1]:
                        offer(nxt, s.cost + extra, s.audit + "K", s, role)
                    elif c in ROLES:
                        offer(nxt, s.cost + REROLE + extra, s.audit + "R", s, ROLES[c])
        least = min(b[0] for b in best.values())
        self.stacks = {
            top: self.said(s, cost, audit[-1], new, text) if new else Stack(cost, audit, s.digest, s.turns)
            for top, (cost, audit, s, new) in best.items() if cost <= least + SLACK}
        if len(next(iter(self.stacks.values())).audit) > 64 and (n := len(common := commonprefix([s.audit for s in self.stacks.values()]))):
            self.shared.append(common)
            self.stacks = {t: s._replace(audit=s.audit[n:]) for t, s in self.stacks.items()}

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest repair."""
        self.insert()
        s = min((s for t, s in self.stacks.items() if self.g.accepting[t]), key=lambda s: s[:2])
        return s.cost, "".join([*self.shared, s.audit]), s.digest.hexdigest()


class Ledger:
    """What a conversation's turns, read in order, amount to."""

    def __init__(self, grammar: Grammar, conv):
        self.conv, self.parser = conv, Parser(grammar)
        self.least = self.most = self.before = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def read(self, turn, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.distinct += turn != self.most
            self.most = turn
        self.illegal += self.before is not None and self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        self.parser.read(role, text, fault in ("b", "d"), fault == "t")

    def row(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.parser.result())


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None) -> DataFrame:
    """Per conversation the columns of ``RESULT``: gaps between turns, turns by their first fault, adjacent
    roles that the grammar forbids, and the cheapest repair.

    A turn is blank, else duplicate (its role and text came earlier), else truncated (its last character
    that is no white space is none of ``.!?``). ``absent`` names a boolean column of rows that only tell that their conversation exists.
    Conversation ids and turns are cast to long; other columns are not read.
    """
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    gone = F.coalesce(F.col(f"`{absent}`"), F.lit(False)) if absent else F.lit(False)
    named = rows.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), said(role).alias("role"), said(text).alias("text"), gone.alias("gone"))
    dealt = named.withColumn("text", F.when(F.col("gone"), "").otherwise(F.col("text"))).repartition("conv_id")  # the window needs no other exchange
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    fault = F.when(last == "", "b").when(F.col("seen") > 1, "d").when(~last.isin(".", "!", "?"), "t").otherwise("")
    ordered = dealt.withColumn("seen", seen).withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text", "seen")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, now = Grammar(GRAMMAR), None
        for b in batches:
            out = []
            for c, t, r, x, g, f in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text", "gone", "fault")), strict=True):
                if now is None or now.conv != c:
                    if now is not None:
                        out.append(now.row())
                    now = Ledger(grammar, c)
                if not g:
                    now.read(t, r, x, f)
            yield batch(out)
        if now is not None:
            yield batch([now.row()])

    return ordered.mapInArrow(run, RESULT)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [(c.split()[0], pa.int64() if c.endswith(" long") else pa.string()) for c in RESULT.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations damaged by the hash of ``conv_id:turn``: rows dropped (column ``gone``), emptied, cut off, repeated or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    out = rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


def op11_glr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")), absent="gone")


#: The DuckDB SQL folds CRC-32 over the bytes of the key and follows the four states of the grammar written out.
OP11_SQL = r"""
WITH RECURSIVE crc(t) AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))),
said AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
kinds AS (SELECT k, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT k FROM said), crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM said JOIN kinds USING (k) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    right(rtrim(text, E' \t\n\x0b\x0c\r'), 1) AS ending FROM damaged),
rows_ AS MATERIALIZED (SELECT *, CASE WHEN ending = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before FROM placed),
ledger AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows_ GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
ways(p, q, letters, said) AS (VALUES ('0', '0', '', []), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []),
  ('0', 'u', 'I', ['user:']), ('0', 'a', 'II', ['user:', 'assistant:']), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
  ('u', 'a', 'I', ['assistant:']), ('a', 'u', 'I', ['user:'])),
moves(p, initial, q, role) AS (VALUES ('0', 's', 's', ''), ('0', 'u', 'u', 'user'), ('s', 'u', 'u', 'user'), ('u', 'a', 'a', 'assistant'), ('a', 'u', 'u', 'user')),
edits AS (  -- insertions, then one edit of a turn: from p to q
  SELECT w.p, w.p AS q, '' AS letters, [] AS said, 'D' AS edit, '' AS initial, '' AS role FROM ways w WHERE w.p = w.q
  UNION ALL SELECT w.p, w.q, w.letters, w.said, 'D', '', '' FROM ways w WHERE w.p <> w.q
  UNION ALL SELECT w.p, m.q, w.letters, w.said, 'K', m.initial, '' FROM ways w JOIN moves m ON m.p = w.q
  UNION ALL SELECT w.p, m.q, w.letters, w.said, 'R', '', m.role FROM ways w JOIN moves m ON m.p = w.q WHERE m.role <> ''),
dp(conv_id, i, p, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '0', CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM ids
  UNION ALL
  SELECT d.conv_id, r.i, e.q AS q,
    d.cost + 3 * length(e.letters) + CASE WHEN e.edit = 'D' THEN 4 ELSE CASE e.edit WHEN 'R' THEN 3 ELSE 0 END + CASE r.fault WHEN 't' THEN 3 ELSE 0 END END AS new_cost,
    d.audit || e.letters || e.edit AS new_audit,
    list_concat(list_concat(d.said, CAST(e.said AS VARCHAR[])), CAST(CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [e.role || ':' || r.text] END AS VARCHAR[]))
  FROM dp d JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1
  JOIN edits e ON e.p = d.p AND (e.edit = 'D' OR (r.fault NOT IN ('b', 'd') AND (e.edit = 'R' OR e.initial = r.initial)))
  QUALIFY row_number() OVER (PARTITION BY d.conv_id, e.q ORDER BY new_cost, new_audit) = 1),
ends AS (SELECT d.conv_id, d.cost + 3 * length(w.letters) AS total, d.audit || w.letters AS edits, list_concat(d.said, CAST(w.said AS VARCHAR[])) AS said
  FROM dp d JOIN ways w ON w.p = d.p AND w.q IN ('0', 'a') LEFT JOIN ledger l ON l.conv_id IS NOT DISTINCT FROM d.conv_id WHERE d.i = coalesce(l.n, 0)
  QUALIFY row_number() OVER (PARTITION BY d.conv_id ORDER BY total, edits) = 1)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(total AS BIGINT) AS cost, edits AS audit, sha256(array_to_string(said, E'\n')) AS repaired_sha256
FROM ends e LEFT JOIN ledger l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""
