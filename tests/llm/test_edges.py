"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from covlens.llm import decontaminate, htmltext, langid, lmscore, neardup, packing, pii, quality_knn, rules, substrings

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))
SCHEMA = "doc_id long, text string, n_words long, N_HIT string, score string, kept string, component_id long, label int, lang string, html string"
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "same text here, with some more words to it than ten of them."), (6, "same text here, with some more words to it than ten of them."),
        (6, "same text here, with some more words to it than ten of them."), (None, "no id, but a text of several words that is long enough to be counted."), (None, None), (7, "日本語 text ñandú 4111111111111111"), (8, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 7, "a", "b", "c", 9, 1 if i else None, "en" if i else None, t) for i, t in ROWS], SCHEMA).repartition(3).cache()


BENCH = "item_id long, text string"
OPERATORS = {
    "decontaminate": lambda s, d: decontaminate.scan(d, s.createDataFrame([(1, "same text here"), (None, "x"), (2, None), (3, "")], BENCH)),
    "pii": lambda s, d: pii.pseudonymise(d),
    "neardup": lambda s, d: neardup.near_duplicates(d),
    "packing": lambda s, d: packing.pack(d, window=64),
    "langid": lambda s, d: langid.predict(d, langid.train(d)),
    "htmltext": lambda s, d: htmltext.main_text(d),
    "quality_knn": lambda s, d: quality_knn.score(d, d),
    "rules": lambda s, d: rules.apply_policy(rules.ledger(d)),
    "substrings": lambda s, d: substrings.remove_repeats(d),
    "lmscore": lambda s, d: lmscore.score(d, lmscore.fit(d, rounds=1)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, docs, name):
    rows = OPERATORS[name](spark, docs).collect()
    if name == "packing":
        assert {r.doc_id for r in rows} == {r[0] for r in ROWS}
    else:
        assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, docs, name):
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


def by_id(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.where("doc_id is not null").collect()}


def test_defined_results(spark, docs):
    hit = by_id(OPERATORS["decontaminate"](spark, docs), "n_words", "n_hit", "items", "spans")
    assert hit[1] == hit[2] == hit[3] == (0, 0, [], [])
    assert hit[5][1:3] == (3, ["1"]) and [tuple(s) for s in hit[5][3]] == [(0, 14)]
    near = by_id(OPERATORS["neardup"](spark, docs), "n_shingles", "component_id", "kept")
    assert near[1] == (0, 1, True) and near[2] == (0, 2, True) and near[6][1:] == (5, False) and near[5][1:] == (5, True)
    alone = OPERATORS["neardup"](spark, docs).where("doc_id is null").collect()
    assert all(r.component_id is None and r.kept for r in alone)
    langs = by_id(OPERATORS["langid"](spark, docs), "lang_pred", "score")
    assert langs[1] == langs[2] == langs[3] == ("und", 0.0) and langs[8][0] == "en"
    kept = by_id(OPERATORS["rules"](spark, docs), "n_words", "base_failed", "kept", "fail_bits")
    assert kept[1][:3] == (0, True, False) and kept[5] == (13, False, True, 0)
    gone = by_id(OPERATORS["substrings"](spark, docs), "n_bytes", "n_removed", "n_spans")
    n = len(ROWS[4][1])
    assert gone[1] == (0, 0, 0) and gone[6] == (n, n, 1) and gone[5] == (n, 0, 0)
    lm = by_id(OPERATORS["lmscore"](spark, docs), "n_words", "log_prob", "mean_log_prob")
    assert lm[1] == (0, 0.0, None) and lm[5] == lm[6] and lm[5][1] < 0
    assert by_id(OPERATORS["htmltext"](spark, docs), "text")[1] == ("",)
    new = by_id(OPERATORS["pii"](spark, docs), "text", "n_replaced")
    assert new[1] == (None, 0) and new[2] == ("", 0) and new[7][1] == 1
    assert all(0 <= r.score <= 1 for r in OPERATORS["quality_knn"](spark, docs).collect())


def test_langid_without_labels(spark, docs):
    net = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(docs, net).collect()} == {"und"}


#: Names that operators use inside; a column that an operator returns takes the place of the input's, all others stay.
CLASHES = ["_found", "_between", "_new", "_changed", "_p", "_s", "_row", "_gain", "_found0", "_found0_", "_place", "_toxicity", "Kinds", "Score", "a.b", "x y"]
RETURNED = {"pii": ["text", "n_replaced", "kinds"], "langid": ["lang_pred", "score"], "lmscore": ["n_words", "log_prob", "mean_log_prob"],
            "decontaminate": ["n_words", "n_hit", "items", "spans"], "quality_knn": ["score"], "rules": []}


@pytest.mark.parametrize("name", sorted(RETURNED))
def test_clashing_columns_keep_their_values(spark, name, tmp_path):
    rows = [(1, "Some plain text of several words, by ann@example.org.", 1, "en"), (2, None, 0, "de"), (3, "other words are here", 1, "en")]
    schema = "doc_id long, text string, label int, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    df = spark.createDataFrame([(*r, *[f"o{i}" for i in range(len(CLASHES))]) for r in rows], schema)
    out = OPERATORS[name](spark, df)
    lower = [c.lower() for c in out.columns]
    assert len(lower) == len(set(lower))
    out.write.parquet(str(tmp_path / "out"))
    gone = {c.lower() for c in RETURNED[name]}
    for row in out.collect():
        assert [row[c] for c in CLASHES if c.lower() not in gone] == [f"o{i}" for i, c in enumerate(CLASHES) if c.lower() not in gone]
