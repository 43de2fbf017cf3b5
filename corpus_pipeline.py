"""The corpus pipeline: operators of ``covlens.llm`` in the order in which a corpus is cleaned.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept
and is written as Parquet before the next one reads it. All but the last return the
columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm import decontaminate, neardup, packing, pii, rules
from covlens.llm.common import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _held(docs: DataFrame) -> DataFrame:
    """The text, and all columns as they are in one of their own, out of the way of what an operator adds."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("document"), F.col("text"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return rules.apply_policy(rules.ledger(_held(docs))).where("kept").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group (five words, 0.8) the row with the smallest id; rows without an id all stay.

    Each row is judged by its own text: rows of one id whose texts are unlike all stay.
    """
    scratch = Scratch(spark)
    rows = scratch.cut(_held(docs).withColumn("row", F.monotonically_increasing_id()))
    classes = neardup.near_duplicates(rows.where("document.doc_id is not null"), words=5, similarity=80, id_col="row")
    groups = classes.join(classes.where("not kept").select("component_id").distinct(), "component_id", "left_semi")
    groups = scratch.cut(groups.select("row", "component_id"))
    members = groups.join(rows.select("row", F.col("document.doc_id").alias("doc_id")), "row")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    dropped = scratch.side(groups.join(first.select(F.col("first.row").alias("row")), "row", "left_anti").select("row"))
    scratch.clear(rows, dropped)
    return rows.join(dropped, "row", "left_anti").select("document.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.scan(_held(docs), table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("document.*")


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    out = pii.pseudonymise(_held(docs))
    n_chars = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("document.n_chars"))
    new = {"text": F.col("text"), "n_chars": n_chars}
    return out.select(*[new.get(c.lower(), F.col(f"document.`{c}`")).alias(c) for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of up to 4096 tokens, with their token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("packing", sequences),
]

#: Hash functions of the pseudonyms and the tokenizer are not expressible; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what each returns is written before the next reads it."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.cut(docs)
    return docs
