"""The clause grammar against a plain reading of the same rules; held-out accuracy."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from covlens.llm import toxicity as tx
from covlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
STEMS = {b"idiot$": 4.0, b"chlla": 3.0, b"chllave$": 0.0, "réê".encode(): 5.0}


def fitting(word):
    """The stem that decides: the whole word, else the longest beginning."""
    if word + b"$" in STEMS:
        return word + b"$"
    return max((s for s in STEMS if word.startswith(s)), key=len, default=None)


def plain(text):
    """(clause, kinds, weight) of each matched clause: one left-to-right reading that looks back for what is in reach."""
    out = []
    low = "".join(c.lower() if c.isascii() else c for c in text)
    for m in re.finditer(r"[^.!?;:,\n]+", low):
        words = list(re.finditer(r"[a-z0-9'\x80-\U0010ffff]+", m[0]))
        symbols = []
        for w in words:
            b = w[0].encode()
            fits = fitting(b)
            fixed = next((k for k, held in (("N", tx.NEGATIONS), ("R", tx.REPORTS), ("G", tx.TARGETS), ("T", tx.THREATS)) if w[0] in held), "w")
            symbols.append(fixed if fits is None else "I" if STEMS[fits] else "w")
        weights = [STEMS.get(fitting(w[0].encode()), 0) for w in words]
        if "I" not in symbols and "T" not in symbols:
            continue
        kinds, total, pending, threat, insult = [], 0.0, None, None, 0.0
        for i, s in enumerate(symbols):
            near = lambda what: any(symbols[j] == what for j in range(max(0, i - tx.REACH), i))  # noqa: B023,E731
            mark = ("-" if near("N") else "") + ("r" if "R" in symbols[:i] else "")
            if s == "I":
                directed = near("G")
                insult = weights[i]
                kinds.append("I" + mark + ("d" if directed else ""))
                total += insult
                pending = None if directed else i
            elif s == "T":
                threat = (i, "X" + mark)
            elif s == "G":
                if threat and i - threat[0] <= tx.REACH:
                    kinds.append(threat[1])
                    total += 1
                threat = None
                if pending is not None and i - pending <= tx.REACH:
                    kinds.append("+")
                    total += 1
                pending = None
        if kinds:
            out.append((m.start() + words[0].start(), m.start() + words[-1].end(), ",".join(kinds), total))
    return out


def found(texts):
    matches = [[] for _ in texts]
    x = tx.Grammar(STEMS).features([t.encode() for t in texts], matches)
    return x, [[(c["start"], c["end"], c["kinds"], c["weight"]) for c in tx.in_points(t.encode(), m)] for t, m in zip(texts, matches, strict=True)]


@pytest.mark.parametrize("text, kinds", [
    ("You are an idiot.", "Id"), ("you are not an idiot", "I-d"), ("He said you are an idiot", "Ird"), ("What an IDIOT you are!", "I,+"), ("an idiot. you", "I"),
    ("idiots", None), ("I will kill you", "X"), ("I won't, never kill you", "X-"), ("kill the bug", None), ("he said: kill you", "X"), ("they said they kill you", "Xr"),
    ("chllanu and chllave", "I"), ("not in a very long while an idiot", "I"), ("réêou du", "I,+"), ("", None), ("you", None)])
def test_matches(text, kinds):
    assert [c[2] for c in found([text])[1][0]] == ([kinds] if kinds else [])


@pytest.mark.parametrize("piece", [1 << 20, 99])
def test_against_a_plain_reading(piece, monkeypatch):
    monkeypatch.setattr(tx, "PIECE", piece)
    r = random.Random(3)
    words = "idiot Idiot chllanu chllave réêou word é not nicht said you you're er kill töten x1 's".split()
    texts = []
    for _ in range(300):
        clauses = [" ".join(r.choice(words) for _ in range(r.randrange(7 if piece < 100 else 14))) for _ in range(r.randrange(6))]
        texts.append("".join(c[:19] + r.choice([". ", ", ", "\n", "!?", "; "]) if piece < 100 else c + r.choice([". ", ", ", "\n", "!?", "; "]) for c in clauses))
    x, got = found(texts)
    want = [plain(t) for t in texts]
    assert got == want and any(want)
    for row, clauses in zip(x, want, strict=True):
        for k, kind in enumerate(tx.KINDS):
            assert (row[k] > 0) == any(kind in c[2].split(",") for c in clauses)


def test_every_symbol_leads_on():
    nexts, written = tx.machine()
    assert all(len(n) == len(tx.ALPHABET) and max(n) < len(nexts) for n in nexts)
    assert {k for outs in written for o in outs for k in o} == set(range(len(tx.KINDS)))


def test_weights_reach_the_optimum():
    r = np.random.default_rng(0)
    x = np.column_stack([np.abs(r.normal(size=(300, len(tx.MEANS) - 1))), np.ones(300)])
    y, importance = r.integers(0, 2, 300).astype(float), r.uniform(0.5, 2, 300)
    w = tx.fit_weights(x, y, importance)
    p = 1 / (1 + np.exp(-(x @ w)))
    assert np.abs(x.T @ (importance * (p - y)) + (w - tx.MEANS) / tx.SPREAD**2).max() < 1e-6


def test_cover_prefers_what_is_new():
    assert tx.cover([[0, 1], [0, 1], [0, 1], [0, 2], [2], [2], [2]], np.ones(3), [b"abc", b"abcd", b"x"]) == [0, 2]


def test_on_held_out_rows(spark):
    """Of the toxic rows some hold no sign at all (labels are noisy)."""
    rows = QUERIES["op13_clause_grammar"](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("toxic is not null").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.01 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_are_no_input_of_held_out_scores(spark):
    """Labels of held-out rows change nothing."""
    small = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").select("text", F.col("toxic").alias("label"))
    a, b = tx.fit(known), tx.fit(known.repartition(5))
    assert a.stems == b.stems and np.allclose(a.weights, b.weights)


LONG = "an idiot you are and " * 70_000


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, LONG), (4, "You idiot, x."), (4, "You idiot, x."), (None, "fine text."), (5, "日本語 you ñ")]
    df = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in rows], "doc_id long, text string, SCORE string, clauses string, `a.b` int").repartition(3)
    model = tx.Model(STEMS, tx.MEANS)
    out = tx.score(df, model)
    assert sorted(c.lower() for c in out.columns) == ["a.b", "clauses", "doc_id", "score", "text"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.score, [tuple(c) for c in r.clauses]))
    assert got[1] == got[2] == got[None] == got[5] and got[1][0][1] == []
    assert got[4][0] == got[4][1] and got[4][0][1] == [(0, 9, "Id", 4.0)] and got[4][0][0] > got[1][0][0]
    assert sum(len(k.split(",")) for _, _, k, _ in got[3][0][1]) >= 70_000 and 0 <= got[3][0][0] <= 1
    assert tx.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("rows", [[], [("a", 1)], [("a", None), ("b", 0)]])
def test_without_both_labels(spark, rows):
    model = tx.fit(spark.createDataFrame(rows, "text string, label int"))
    assert model.stems == {} and (model.weights == tx.MEANS).all()
