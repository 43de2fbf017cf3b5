"""Bundled layout of the raw event feed (public event-export codebook format).

The operators never depend on this layout: every column is a parameter. It is
one *profile* that names the columns of the 61-field tab-separated export and
the roles the operators expect.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# Field names, types and required flags of the 61-column raw
# event export, in file order ("L" long, "D" double, "S" string, "!" required).
RAW_EVENT_FIELDS = [
    ("GlobalEventID", "L!"), ("SQLDATE", "L!"), ("MonthYear", "L!"), ("Year", "L!"),
    ("FractionDate", "D!"),
    ("Actor1Code", "S"), ("Actor1Name", "S"), ("Actor1CountryCode", "S"),
    ("Actor1KnownGroupCode", "S"), ("Actor1EthnicCode", "S"), ("Actor1Religion1Code", "S"),
    ("Actor1Religion2Code", "S"), ("Actor1Type1Code", "S"), ("Actor1Type2Code", "S"),
    ("Actor1Type3Code", "S"),
    ("Actor2Code", "S"), ("Actor2Name", "S"), ("Actor2CountryCode", "S"),
    ("Actor2KnownGroupCode", "S"), ("Actor2EthnicCode", "S"), ("Actor2Religion1Code", "S"),
    ("Actor2Religion2Code", "S"), ("Actor2Type1Code", "S"), ("Actor2Type2Code", "S"),
    ("Actor2Type3Code", "S"),
    ("IsRootEvent", "L"), ("EventCode", "S"), ("EventBaseCode", "S"), ("EventRootCode", "S"),
    ("QuadClass", "L"), ("GoldsteinScale", "D"), ("NumMentions", "L"), ("NumSources", "L"),
    ("NumArticles", "L"), ("AvgTone", "D"),
    ("Actor1Geo_Type", "L"), ("Actor1Geo_Fullname", "S"), ("Actor1Geo_CountryCode", "S"),
    ("Actor1Geo_ADM1Code", "S"), ("Actor1Geo_ADM2Code", "S"), ("Actor1Geo_Lat", "D"),
    ("Actor1Geo_Long", "D"), ("Actor1Geo_FeatureID", "S"),
    ("Actor2Geo_Type", "L"), ("Actor2Geo_Fullname", "S"), ("Actor2Geo_CountryCode", "S"),
    ("Actor2Geo_ADM1Code", "S"), ("Actor2Geo_ADM2Code", "S"), ("Actor2Geo_Lat", "D"),
    ("Actor2Geo_Long", "D"), ("Actor2Geo_FeatureID", "S"),
    ("ActionGeo_Type", "L"), ("ActionGeo_Fullname", "S"), ("ActionGeo_CountryCode", "S"),
    ("ActionGeo_ADM1Code", "S"), ("ActionGeo_ADM2Code", "S"), ("ActionGeo_Lat", "D"),
    ("ActionGeo_Long", "D"), ("ActionGeo_FeatureID", "S"),
    ("DATEADDED", "L!"), ("SOURCEURL", "S"),
]

# The 12 columns kept in the consolidated table.
KEPT_COLUMNS = [
    "GlobalEventID", "SQLDATE", "QuadClass", "GoldsteinScale", "AvgTone",
    "NumMentions", "NumSources", "NumArticles",
    "Actor1CountryCode", "Actor2CountryCode", "ActionGeo_CountryCode", "ActionGeo_Type",
]

# The four event categories of QuadClass and their output names.
QUAD_CLASSES = {
    1: "n_verbal_cooperation",
    2: "n_material_cooperation",
    3: "n_verbal_conflict",
    4: "n_material_conflict",
}

_TYPES = {"L": LongType(), "D": DoubleType(), "S": StringType()}


def raw_event_schema() -> StructType:
    """61-field schema; required fields are declared non-nullable.

    Spark does not enforce ``nullable=False`` on file reads, so
    ``sources.scan.strict_scan`` checks required fields itself.
    """
    return StructType([
        StructField(name, _TYPES[code[0]], nullable=not code.endswith("!"))
        for name, code in RAW_EVENT_FIELDS
    ])
