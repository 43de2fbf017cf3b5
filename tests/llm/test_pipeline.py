"""The corpus pipeline against plain versions of its decisions."""

from pathlib import Path

import duckdb
import numpy as np

import corpus_pipeline
from covlens.llm.common import Scratch, table
from covlens.llm import decontaminate, rules
from covlens.session import checkpoint_root
from tests.llm import plain

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    scratch, docs, seen = Scratch(spark), table(spark, SF, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.cut(stage(spark, docs, SF))
        seen[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
        assert name == "packing" or docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == list(seen)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = {r[0] for r in con.sql(f"SELECT doc_id FROM ({rules.OP8_SQL}) WHERE kept").fetchall()}
    assert set(seen["quality_rules"]) == want
    rows = [(i, r.text) for i, r in seen["quality_rules"].items()]
    groups = plain.components(rows, 5)
    assert set(seen["near_duplicates"]) == {i for i, (_, c) in groups.items() if i == c}
    items = con.sql(f"SELECT CAST(item_id AS VARCHAR), text FROM '{SF}/benchmark.parquet'").fetchall()
    windows = set()
    for _, t in items:
        w = decontaminate.words(t.encode())
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}

    def clean(t):
        w = decontaminate.words(t.encode())
        return not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))

    assert all(len(w) == 10 for w in windows)
    assert set(seen["decontamination"]) == {i for i, r in seen["near_duplicates"].items() if clean(r.text)}
    before, after = seen["decontamination"], seen["pseudonyms"]
    assert set(before) == set(after) and any(before[i].text != after[i].text for i in before)
    assert all(len(after[i].text) == after[i].n_chars for i in after if before[i].text != after[i].text)
    tokens = {}
    for p in seen["packing"]:
        tokens[p.doc_id] = tokens.get(p.doc_id, 0) + p.length
        assert len(np.frombuffer(p.ids, "<u4")) == p.length
    assert set(tokens) == set(after)


def test_repeated_ids_leave_one_row(spark):
    docs = spark.createDataFrame([(1, "a text of five words or more", "en", "s", 1), (1, "a text of five words or more", "en", "s", 1), (None, "a", None, None, None), (None, "a", None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near_duplicates(spark, docs, SF).count() == 3


def test_near_duplicates_leave_one_copy_of_the_rows(spark):
    def cuts():
        return set(Path(checkpoint_root(spark).removeprefix("file:"), "covlens").glob("cut-*"))

    docs = spark.createDataFrame([(i, f"text {i // 2} of five words or more", "en", "s", 1) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    before = cuts()
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert len(cuts() - before) == 3 and out.count() == 10  # the rows, their classes and those dropped


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    a, b = "a text of five words or more", "quite another text that is of five words or more as well"
    docs = spark.createDataFrame([(1, a, "en", "s", 1), (1, b, "en", "s", 1), (0, a, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [(0, a), (1, b)]


def test_columns_of_any_name_come_back_as_they_are(spark):
    names = ["kept", "N_WORDS", "fail_bits", "n_hit", "items", "spans", "n_replaced", "Kinds", "_found", "_new", "_changed", "_found0_", "row", "component_id", "document", "a.b", "set_key"]
    text = "Several different words make up this plain text, and none of them is said twice in it. Mail ann@example.org or call."
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(7, text, "en", "s", len(text), *[f"o{i}" for i in range(len(names))])], schema)
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns, name
    row = out.first()
    assert [row[n] for n in names] == [f"o{i}" for i in range(len(names))] and row.text != text and row.n_chars == len(row.text)
    assert out.dtypes == docs.dtypes
