"""Conversation repair against every edit script, and the query against a plain version."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from covlens.llm import conversations as cv
from covlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = cv.RESULT.replace(" long", "").replace(" string", "").split(", ")


def scripts(rows, longest):
    """(cost, audit, repaired) of every edit script with at most ``longest`` insertions, sound or not."""
    def after(i, left):
        if left:
            for role in ("user", "assistant"):
                for c, a, out in after(i, left - 1):
                    yield c + 3, "I" + a, [(role, ""), *out]
        if i == len(rows):
            yield 0, "", []
            return
        role, text, fault = rows[i]
        for c, a, out in after(i + 1, left):
            yield c + 4, "D" + a, out
            if fault not in ("b", "d"):
                extra = 3 if fault == "t" else 0
                yield c + extra, "K" + a, [(role, text), *out]
                for new in ("user", "assistant"):
                    yield c + extra + 3, "R" + a, [(new, text), *out]

    return after(0, longest)


def plain_repair(rows):
    longest = len(rows) + 1 if len(rows) < 4 else 3
    sound = [s for s in scripts(rows, longest) if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in s[2]))]
    cost, audit, out = min(sound, key=lambda s: s[:2])
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def plain(rows):
    """The ledger of each conversation, by a dynamic program over the four states of the grammar written out."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            by[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out[conv] = (gaps, *(faults.count(f) for f in "bdt"), illegal, *dynamic([(r, t, f) for (_, r, t), f in zip(turns, faults, strict=True)]))
    return out


def dynamic(rows):
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    role_of = {"u": "user", "a": "assistant"}

    def better(states, q, way):
        if q not in states or way[:2] < states[q][:2]:
            states[q] = way

    def inserted(states):
        for _ in range(4):
            for p, (c, a, out) in list(states.items()):
                for (x, letter), q in step.items():
                    if x == p and letter != "s":
                        better(states, q, (c + 3, a + "I", [*out, (role_of[letter], "")]))
        return states

    states = {"0": (0, "", [])}
    for role, text, fault in rows:
        new = {}
        for p, (c, a, out) in inserted(states).items():
            better(new, p, (c + 4, a + "D", out))
            if fault not in ("b", "d"):
                c += 3 * (fault == "t")
                for (x, letter), q in step.items():
                    if x == p and letter == role[:1]:
                        better(new, q, (c, a + "K", [*out, (role, text)]))
                    elif x == p and letter != "s":
                        better(new, q, (c + 3, a + "R", [*out, (role_of[letter], text)]))
        states = new
    c, a, out = min((v for q, v in inserted(states).items() if q in "0a"), key=lambda v: v[:2])
    return c, a, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def parsed(rows, grammar):
    p = cv.Parser(grammar)
    for role, text, fault in rows:
        p.read(role, text, fault in ("b", "d"), fault == "t")
    return p.result()


@pytest.mark.parametrize("seed", range(60))
def test_repair_against_every_script(seed):
    r = random.Random(seed)
    rows = [(r.choice(["user", "assistant", "system", "tool", "u", ""]), f"t{i}", r.choice(["", "", "", "b", "d", "t"])) for i in range(r.randrange(6))]
    assert parsed(rows, cv.Grammar(cv.GRAMMAR)) == plain_repair(rows) == dynamic(rows)


@pytest.mark.parametrize("seed", range(20))
def test_long_conversations(seed):
    """Audits are shared and dear stacks dropped without a change of the result."""
    r = random.Random(seed)
    roles = r.choice([["user"], ["assistant"], ["user", "assistant"], ["system", "user", "tool"], ["system"]])
    rows = [(r.choice(roles), f"t{i}", r.choice(["", "", "b", "t"])) for i in range(400)]
    assert parsed(rows, cv.Grammar(cv.GRAMMAR)) == dynamic(rows)


def test_the_grammar_has_four_tops():
    g = cv.Grammar(cv.GRAMMAR)
    assert g.tops == 4 and sum(g.accepting) == 2 and g.accepting[0]


def rows_of(df):
    return {r.conv_id: tuple(r[c] for c in FIELDS[1:]) for r in df.collect()}


def test_query_against_plain(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert rows_of(QUERIES["op11_glr_repair"](spark, SF)) == plain(rows)


def test_odd_rows(spark):
    """Nulls anywhere, ties, repeated rows, odd roles, very long texts and other columns."""
    r = random.Random(4)
    texts = [None, "", " \n", "Yes.", "no", "Why? \n", "é!", "long " * 40_000 + "."]
    rows = [(r.choice([None, 1, 2, 2**60 + 1, 2**60 + 2]), r.choice([None, 0, 1, 2, 3, 4, -7, 2**55 + 1]), r.choice([None, "", "user", "assistant", "system", "tool", "User"]), r.choice(texts)) for _ in range(300)]
    rows += [(9, 6, "user", "x.")] * 2
    df = spark.createDataFrame([(*x, 1, "a") for x in rows], "conv_id long, turn long, role string, text string, gone int, Fault string").repartition(5)
    assert rows_of(cv.repair(cv.damage(df), absent="gone")) == plain(rows)
    assert cv.repair(cv.damage(df.limit(0)), absent="gone").count() == 0


def test_every_conversation_is_returned(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    row = cv.repair(cv.damage(df), absent="gone").first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_columns_by_other_names(spark):
    df = spark.createDataFrame([("user", "Hi.", 5, 1), ("assistant", "Yes.", 5, 2)], "`a.role` string, say string, c long, `n` long")
    assert tuple(cv.repair(df, "c", "n", "a.role", "say").first())[:8] == (5, 0, 0, 0, 0, 0, 0, "KK")
