"""Version-controlled seeds with declared types."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A small in-memory table as a ``VALUES`` relation.

    Unlike ``createDataFrame`` on a Python list it is a local relation: no
    Python worker and no job to read it, and the optimiser knows its exact
    size (so a broadcast of it is planned from a known bound).
    """
    names = [f.name for f in schema.fields]
    casts = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS `{f.name}`"
                      for i, f in enumerate(schema.fields))
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        return spark.sql(f"SELECT {nulls} WHERE false")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    if any(len(r) != len(names) for r in rows):
        raise ValueError("row width differs from schema")
    return spark.sql(f"SELECT {casts} FROM VALUES {values}")


AGE_BAND_SCHEMA = T.StructType([
    T.StructField("age_band_code", T.StringType(), False),
    T.StructField("age_band", T.StringType(), False),
    T.StructField("min_age", T.IntegerType(), False),
    T.StructField("max_age", T.IntegerType(), False),
    T.StructField("sort_order", T.IntegerType(), False),
])

# The 18 five-year population age bands (code, label, min, max, order).
AGE_BANDS = [
    ("A04", "0-4", 0, 4, 1),
    ("A59", "5-9", 5, 9, 2),
    ("A10", "10-14", 10, 14, 3),
    ("A15", "15-19", 15, 19, 4),
    ("A20", "20-24", 20, 24, 5),
    ("A25", "25-29", 25, 29, 6),
    ("A30", "30-34", 30, 34, 7),
    ("A35", "35-39", 35, 39, 8),
    ("A40", "40-44", 40, 44, 9),
    ("A45", "45-49", 45, 49, 10),
    ("A50", "50-54", 50, 54, 11),
    ("A55", "55-59", 55, 59, 12),
    ("A60", "60-64", 60, 64, 13),
    ("A65", "65-69", 65, 69, 14),
    ("A70", "70-74", 70, 74, 15),
    ("A75", "75-79", 75, 79, 16),
    ("A80", "80-84", 80, 84, 17),
    ("8599", "85+", 85, 999, 18),
]

OVERRIDE_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType(), False),
    T.StructField("code", T.StringType(), False),
    T.StructField("note", T.StringType(), True),
])

NAME_CODE_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType(), False),
    T.StructField("code", T.StringType(), False),
])

# Council names the rule chain cannot resolve, with their codes.
COUNCIL_NAME_OVERRIDES = [
    ("PT.PIRIE CITY & DIST. COUNCIL", "46450", "irregular abbreviation"),
    ("DC WUDINNA. (DC LE HUNTE.)", "48640", "renamed council, both names in source"),
    ("DC MALLALA.", "40150", "renamed council, only the new name is official"),
    ("DC FRANKLIN HARBOR.", "41960", "spelling differs from the official name"),
    ("DC NARACOORTE & LUCINDALE.", "45090", "official name drops the conjunction"),
    ("UNINCORP (EASTERN)", "49399", "unincorporated area"),
    ("METRO UNINCORPORATED", "49399", "unincorporated area"),
]

# Codes reserved for non-geographic areas.
NON_GEOGRAPHIC_CODES = ("49399", "49499", "49799")


def age_bands(spark: SparkSession) -> DataFrame:
    return local_table(spark, AGE_BANDS, AGE_BAND_SCHEMA)


def council_overrides(spark: SparkSession) -> DataFrame:
    return local_table(spark, COUNCIL_NAME_OVERRIDES, OVERRIDE_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with declared column types (no inference; codes stay text)."""
    return spark.read.option("header", True).schema(schema).csv(path)
