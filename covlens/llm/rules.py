"""Quality rules as a bitmask ledger, by DataFrame functions alone.

Every rule is evaluated once per document. The ledger keeps what was measured
and one bit per failed rule; a policy is a named set of rules, so another
policy, or the effect of leaving a rule out, needs the stored bits only.

Words are maximal runs without space and 0x09-0x0D. Null and empty texts have no
words, fail ``few_words`` and are rejected. Repeated rows get equal rows. Input
columns named like an output give way to it. Counts are per document, in one
pass without a shuffle; only documents with a repeated window sort theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import replace_columns, table

SPACES = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule, and the condition under which a document fails it. The bit is the place in this list.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("shouting", "2 * n_caps_words > n_words"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    ("letters", "10 * n_letter_words < 7 * n_words"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}

#: Policy version and its rules. Versions are never changed, only added.
POLICIES: dict[str, list[str]] = {
    "base-1": ["few_words", "repeated_windows"],
    "v1": [name for name, _ in RULES],
}


def mask(policy: str) -> int:
    return sum(1 << BIT[name] for name in POLICIES[policy])


def _long(c: Column) -> Column:
    return c.cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every measurement the rules use."""
    body = F.coalesce(docs[f"`{text}`"], F.lit(""))
    df = replace_columns(docs, {
        "_words": F.filter(F.split(body, SPACES, -1), lambda w: w != ""),
        "_lines": F.filter(F.split(body, "\n", -1), lambda s: s.rlike(r"[^ \t-\r]")),
        "_body": body,
    })
    w = F.col("_words")
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    df = df.withColumn("_windows", F.when(F.size(w) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    win = F.col("_windows")
    # (hash, place), sorted, only where a window repeats
    pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct(win)) < F.size(win), pairs))
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"]))
    df = df.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    p = F.col("_places")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    measured = {
        "n_words": _long(F.size(w)),
        "word_chars": _long(F.length(F.array_join(w, ""))),
        "n_symbols": _long(F.length("_body") - F.length(F.translate("_body", SYMBOLS, ""))),
        "n_lines": _long(F.size("_lines")),
        "n_dup_lines": _long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
        "n_repeat_words": _long(F.coalesce(covered, F.lit(0))),
        "n_caps_words": _long(F.size(F.filter(w, lambda x: x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}")))),
        "n_letter_words": _long(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))),
    }
    # A generator of one row: a filter on a measurement stays above it instead of measuring again below.
    taken = {*measured, "_words", "_lines", "_body", "_windows", "_sorted", "_places"}
    row = F.inline(F.array(F.struct(*[c.alias(name) for name, c in measured.items()])))
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken], row)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``measure`` and ``fail_bits``: bit i is set where rule i of RULES fails."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return replace_columns(measure(docs, text), {"fail_bits": bits})


def apply_policy(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Ledger rows with ``base_failed`` and the policy's ``kept``."""
    bits = F.col("fail_bits")
    return replace_columns(entries, {
        "base_failed": bits.bitwiseAND(F.lit(mask("base-1"))) != 0,
        "kept": bits.bitwiseAND(F.lit(mask(policy) | mask("base-1"))) == 0,
    })


def ablation(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: failures, documents it alone rejects, documents kept without it.

    The ledger is first counted by its bits (at most 2**rules rows), whatever its size.
    An empty ledger gives zeros.
    """
    chosen = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    counts = entries.groupBy(chosen.alias("bits")).agg(F.count("*").alias("n"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    rules = [
        F.struct(
            F.lit(name).alias("rule"),
            total(F.col("bits").bitwiseAND(F.lit(1 << BIT[name])) != 0).alias("n_failed"),
            total(F.col("bits") == (1 << BIT[name])).alias("n_only"),
            total(F.col("bits").bitwiseAND(F.lit(~(1 << BIT[name]))) == 0).alias("n_kept_without"),
        )
        for name in POLICIES[policy]
    ]
    return counts.agg(F.array(*rules).alias("r")).select(F.inline("r"))


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_policy(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM g) WHERE n >= 2),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM r) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) AS n_caps,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letters
  FROM d LEFT JOIN c USING (rid)),
f AS (
  SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (100 * n_dup_lines > 30 * n_lines)::INT + 16 * (2 * n_caps > n_words)::INT
    + 32 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::INT + 64 * (10 * n_letters < 7 * n_words)::INT AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM f
"""
