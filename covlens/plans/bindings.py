"""Bindings B1-B5: event-feed shaped inputs derived from the driver tables.

The real event feed is not available offline, so each operator is bound to
the driver tables through derived columns. The driver tables contain no NULL,
so NULL and unmatched codes are derived deterministically (same rule in the
SQL oracle). Every derivation reads the whole table; none filters rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covlens.functions.exprs import slice_floor
from covlens.operators.prepare import normalize_codes
from covlens.profiles import RAW_EVENT_FIELDS, raw_event_schema
from covlens.session import file_names, folder_names, path_exists, rename_path, session_key, shared_dir
from covlens.sources.scan import dimension, lookup_scan, strict_scan
from covlens.sources.sinks import write_delimited

# Fixed values of the bindings (parameters of the derived inputs).
CODE_NULL_EVERY = 10            # user_id % 10 = 0 → NULL code
CODE_MODULUS = 30               # code = user_id % 30, so 25-29 miss the 25-key nation table
ALIASES = {28: 3, 29: 3}        # alias → canonical, one level
CATEGORIES = {"click": "n_click", "view": "n_view", "purchase": "n_purchase", "error": "n_error"}
PAIR_NULL_A_EVERY = 7           # l_orderkey % 7 = 0 → NULL actor A
PAIR_NULL_B_EVERY = 5           # l_orderkey % 5 = 0 → NULL actor B
DROPPED_TYPE_KEY = 7            # nation key left out of the type table → unknown code
ENTITY_TYPE = "country"
WINDOW_START, WINDOW_END = "2024-01-05", "2024-01-25"
SLICE_START, SLICE_END = "2024-01-01 00:00:00", "2024-01-30 23:45:00"
SLICE_MINUTES = 15
BASE_DAY = "2024-01-01"
RETRO_MODULUS = 40              # event day = ingest day - user_id % 40 days
RETRO_BEFORE = "2024-01-01"
DECIMALS = 4                    # decimals of events.value and l_extendedprice in the given tables


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the scan handle (listing and schema) is reused within a session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (session_key(spark), path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


# ---------------------------------------------------------------- B1 coded events

def coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``day`` and a derived nullable integer ``raw_code``."""
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    raw = (F.when(uid % CODE_NULL_EVERY == 0, F.lit(None).cast("int"))
           .otherwise((uid % CODE_MODULUS).cast("int")))
    return ev.select("event_id", F.to_date("ts").alias("day"), "ts", "user_id", "event_type",
                     "value", raw.alias("raw_code"))


def normalized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 with ``code`` = ``raw_code`` after the alias map."""
    return normalize_codes(coded_events(spark, sf_dir), "raw_code", ALIASES, out="code")


def fine_measure():
    """A measure with up to 20 decimals, NULL for a third of the users; its sums are exact in any order."""
    return F.when(F.col("user_id") % 3 != 0, F.floor(F.col("value") * 1000) / F.lit(1048576.0))


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code dimension ``(n_nationkey, n_name)`` for binding B1."""
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


# ---------------------------------------------------------------- B2 actor pairs

def pair_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: actor A = customer nation, B = supplier nation."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(cust, F.col("o_custkey") == cust.c_custkey)
         .join(supp, F.col("l_suppkey") == supp.s_suppkey))
    key = F.col("l_orderkey")
    return j.select(
        "l_orderkey",
        F.when(key % PAIR_NULL_A_EVERY == 0, F.lit(None).cast("int"))
        .otherwise(F.col("c_nationkey")).alias("a"),
        F.when(key % PAIR_NULL_B_EVERY == 0, F.lit(None).cast("int"))
        .otherwise(F.col("s_nationkey")).alias("b"),
        F.col("l_extendedprice").alias("tone"))


def entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, entity_type) from ``nation``; one key left out to be unknown."""
    n = table(spark, sf_dir, "nation")
    etype = (F.when(F.col("n_regionkey") < 3, F.lit("country"))
             .when(F.col("n_regionkey") == 3, F.lit("region"))
             .otherwise(F.lit("territory")))
    return (n.where(F.col("n_nationkey") != DROPPED_TYPE_KEY)
            .select(F.col("n_nationkey").alias("code"), etype.alias("entity_type")))


# ---------------------------------------------------------------- B5 text layout

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

_LAYOUTS: dict[tuple[str, str, str], str] = {}


def _layout(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """A derived table written once per session in the shared folder.

    ``write(path)`` writes it; the path is reused until its folder is gone.
    """
    key = (session_key(spark), sf_dir, name)
    path = _LAYOUTS.get(key)
    if path is None or not path_exists(spark, path):
        path = shared_dir(spark, name)
        write(path)
        _LAYOUTS[key] = path
    return path


def events_text_layout(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as tab-separated text, one folder per day (binding B5)."""
    ev = table(spark, sf_dir, "events")
    return _layout(spark, sf_dir, "events-tsv", lambda path: write_delimited(
        ev.withColumn("ingest_day", F.date_format("ts", "yyyyMMdd")), path,
        partition_by=["ingest_day"], one_file=True))


def events_from_text(spark: SparkSession, sf_dir: str,
                     keep_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of the strict scan of the text layout."""
    path = events_text_layout(spark, sf_dir)
    return strict_scan(spark, path, EVENTS_SCHEMA, keep_source=keep_source)


# Fixed values of the slice files: their width, and the grid that they are held against,
# which begins a day before the first event and ends two days after the last one.
FILE_MINUTES = 360
FILE_START, FILE_END = "2023-12-31 00:00:00", "2024-02-01 18:00:00"


def slice_files(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed as one text file per slice in one folder, named ``YYYYMMDDHHMMSS.export.CSV`` as feeds are."""
    def write(path: str) -> None:
        stamp = F.date_format(slice_floor("ts", FILE_MINUTES), "yyyyMMddHHmmss")
        write_delimited(raw_feed_frame(spark, sf_dir, slice=stamp).drop("ingest_day"), f"{path}-slices", partition_by=["slice"], one_file=True)
        for folder in folder_names(spark, f"{path}-slices"):
            for name in file_names(spark, f"{path}-slices/{folder}"):
                if name.startswith("part-"):
                    rename_path(spark, f"{path}-slices/{folder}/{name}", f"{path}/{folder.partition('=')[2]}.export.CSV")

    return _layout(spark, sf_dir, "slice-files", write)


def kept_text_layout(spark: SparkSession, sf_dir: str) -> str:
    """Three columns of ``events`` as text, one file per day: another layout of the same rows."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("ingest_day"))
    return _layout(spark, sf_dir, "kept-tsv", lambda path: write_delimited(ev, path, partition_by=["ingest_day"], one_file=True))


# ---------------------------------------------------------------- B6 raw event feed

RAW_WINDOW = (20240105, 20240125)
RAW_ALIASES = {"G28": "G3", "G29": "G3"}


def raw_feed_frame(spark: SparkSession, sf_dir: str, **extra) -> DataFrame:
    """``events`` reshaped into the 61-column raw export layout (whole table).

    Codes, categories and measures are derived per row; columns the feed
    leaves mostly empty stay NULL. Event codes keep leading zeros and the
    source URL carries the JSON ``props`` text, quotes included. ``extra`` are
    further columns, made from those of ``events``.
    """
    ev = table(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    day = F.date_format("ts", "yyyyMMdd").cast("long")
    event_code = F.lpad((eid % 200).cast("string"), 3, "0")
    derived = {
        "GlobalEventID": eid,
        "SQLDATE": day,
        "MonthYear": F.floor(day / 100).cast("long"),
        "Year": F.floor(day / 10000).cast("long"),
        "FractionDate": F.year("ts") + (F.month("ts") * 30 + F.dayofmonth("ts")) / F.lit(365.0),
        "Actor1Code": F.concat(F.lit("A"), uid.cast("string")),
        "Actor1Name": F.concat(F.lit("ACTOR "), uid.cast("string")),
        "Actor1CountryCode": F.when(uid % 4 != 0, F.concat(F.lit("N"), (uid % 27).cast("string"))),
        "Actor2CountryCode": F.when(eid % 3 != 0, F.concat(F.lit("N"), (eid % 27).cast("string"))),
        "IsRootEvent": eid % 2,
        "EventCode": event_code,
        "EventBaseCode": F.substring(event_code, 1, 3),
        "EventRootCode": F.substring(event_code, 1, 2),
        "QuadClass": eid % 5,
        "GoldsteinScale": (uid % 21).cast("double") - F.lit(10.0),
        "NumMentions": uid % 7 + 1,
        "NumSources": uid % 3 + 1,
        "NumArticles": uid % 5 + 1,
        "AvgTone": F.col("value"),
        "ActionGeo_Type": uid % 5 + 1,
        "ActionGeo_Fullname": F.concat(F.lit("Place "), uid.cast("string")),
        "ActionGeo_CountryCode": F.when(uid % 10 != 0, F.concat(F.lit("G"), (uid % 30).cast("string"))),
        "ActionGeo_Lat": (uid % 180).cast("double") - F.lit(90.0),
        "ActionGeo_Long": (uid % 360).cast("double") - F.lit(180.0),
        "ActionGeo_FeatureID": uid.cast("string"),
        "DATEADDED": F.date_format("ts", "yyyyMMddHHmmss").cast("long"),
        "SOURCEURL": F.col("props"),
    }
    schema = raw_event_schema()
    return ev.select(*[derived.get(name, F.lit(None)).cast(schema[name].dataType).alias(name)
                       for name, _ in RAW_EVENT_FIELDS],
                     F.date_format("ts", "yyyyMMdd").alias("ingest_day"), *[c.alias(n) for n, c in extra.items()])


def raw_feed_layout(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed as tab-separated text, one folder per ingest day (binding B6)."""
    return _layout(spark, sf_dir, "raw-feed", lambda path: write_delimited(
        raw_feed_frame(spark, sf_dir), path, partition_by=["ingest_day"]))


def geo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place-code dimension ``(code, label)``: ``G<nationkey>`` → nation name."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("G"), F.col("n_nationkey").cast("string")).alias("code"),
                    F.col("n_name").alias("label"))


def lookup_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place dimension as a lookup file with CRLF line ends, written once per session and scanned."""
    def write(path: str) -> None:
        geo = geo_dim(spark, sf_dir)
        geo.select(F.concat_ws("\t", "code", F.concat("label", F.lit("\r"))).alias("value")).write.text(path)

    return lookup_scan(spark, _layout(spark, sf_dir, "geo-lookup", write))


def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five place codes as a dimension from in-memory rows."""
    return dimension(spark, [(f"G{i}", f"place {i}") for i in range(5)], "code string, label string")


def actor_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actor-code classification ``(code, entity_type)``: ``N<nationkey>``; one key left out."""
    t = entity_types(spark, sf_dir)
    return t.select(F.concat(F.lit("N"), F.col("code").cast("string")).alias("code"), "entity_type")


# ---------------------------------------------------------------- B7 dirty raw feed

# Which events get which corruption (first matching rule wins).
DIRTY_BAD_ID_EVERY = 97        # GlobalEventID becomes "x<id>": not a bigint
DIRTY_SHORT_EVERY = 89         # last field dropped: 60 fields instead of 61
DIRTY_BAD_TONE_EVERY = 83      # AvgTone gets a "d" suffix: not a double
DIRTY_DIGITS_EVERY = 79        # NumMentions in Arabic digits: not a bigint
DIRTY_HUGE_EVERY = 73          # AvgTone is 1e400, beyond the finite doubles: not a double
DIRTY_NUL_EVERY = 71           # Actor1Name begins with a NUL: a text like any other

def dirty_feed_layout(spark: SparkSession, sf_dir: str) -> str:
    """The raw feed with deterministic bad lines, as text, once per session.

    Every line of ``events`` is kept; some are corrupted so that the strict
    scan must reject them with a known reason.
    """
    def write(path: str) -> None:
        raw = raw_feed_frame(spark, sf_dir)
        eid = F.col("GlobalEventID")
        text = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in RAW_EVENT_FIELDS}

        def spoil(name: str, every: int, how) -> None:
            text[name] = F.when(rule == every, how(text[name])).otherwise(text[name])

        rule = F.lit(0)
        for every in (DIRTY_NUL_EVERY, DIRTY_HUGE_EVERY, DIRTY_DIGITS_EVERY, DIRTY_BAD_TONE_EVERY, DIRTY_SHORT_EVERY, DIRTY_BAD_ID_EVERY):
            rule = F.when(eid % every == 0, every).otherwise(rule)  # the last one wins
        spoil("GlobalEventID", DIRTY_BAD_ID_EVERY, lambda c: F.concat(F.lit("x"), c))
        spoil("AvgTone", DIRTY_BAD_TONE_EVERY, lambda c: F.concat(c, F.lit("d")))
        spoil("NumMentions", DIRTY_DIGITS_EVERY, lambda c: F.translate(c, "0123456789", "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669"))
        spoil("AvgTone", DIRTY_HUGE_EVERY, lambda c: F.lit("1e400"))
        spoil("Actor1Name", DIRTY_NUL_EVERY, lambda c: F.concat(F.lit("\x00"), c))
        short = rule == DIRTY_SHORT_EVERY
        line = F.concat_ws("\t", *[text[n] for n, _ in RAW_EVENT_FIELDS])
        line = F.when(short, F.substring_index(line, "\t", len(RAW_EVENT_FIELDS) - 1)) \
            .otherwise(line)
        (raw.select(line.alias("value"), "ingest_day").write.mode("overwrite")
         .partitionBy("ingest_day").text(path))

    return _layout(spark, sf_dir, "dirty-feed", write)
