"""Name conformance: map free-text names to official codes, with provenance.

A bridge is built once from the *distinct* source names (a handful, however
large the fact), so every string function runs on few rows; facts then look
their name up in the bridge.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NormaliseRules:
    """A rule chain: upper-case, literal replacements, character translation,
    whitespace collapse and trim, one leading prefix removed, one trailing
    suffix removed, trim."""

    replacements: Sequence[tuple[str, str]] = ()
    translate_from: str = ""
    translate_to: str = ""
    prefixes: Sequence[str] = ()
    suffixes: Sequence[str] = ()
    conjunction: str = " AND "


# The council-name rule chain (abbreviations, punctuation,
# council-type prefixes and suffixes), in the order they are tried.
COUNCIL_RULES = NormaliseRules(
    replacements=(("PT.", "PORT "), ("MT.", "MOUNT ")),
    translate_from="&,/.",
    translate_to="    ",
    prefixes=("CC OF ", "CC ", "DC OF ", "DC ", "CT ", "MC ", "RC ", "THE CITY OF ", "CITY OF ",
              "TOWN OF ", "DISTRICT COUNCIL OF ", "REGIONAL COUNCIL OF ", "MUNICIPAL COUNCIL OF ",
              "RURAL CITY OF ", "THE "),
    suffixes=(" DISTRICT COUNCIL", " REGIONAL COUNCIL", " TOWN COUNCIL", " CITY COUNCIL", " COUNCIL",
              " DISTRICT", " REGIONAL", " MUNICIPALITY"),
)


def _alternation(words: Sequence[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def normalise(name: Column | str, rules: NormaliseRules = COUNCIL_RULES) -> Column:
    """Apply the rule chain; only the first matching prefix and suffix go."""
    c = F.upper(F.col(name) if isinstance(name, str) else name)
    for old, new in rules.replacements:
        c = F.replace(c, F.lit(old), F.lit(new))
    if rules.translate_from:
        c = F.translate(c, rules.translate_from, rules.translate_to)
    c = F.btrim(F.regexp_replace(c, r"\s+", " "))
    if rules.prefixes:
        c = F.regexp_replace(c, "^(" + _alternation(rules.prefixes) + ")", "")
    if rules.suffixes:
        c = F.regexp_replace(c, "(" + _alternation(rules.suffixes) + ")$", "")
    return F.trim(c)


def without_conjunction(c: Column, conjunction: str = " AND ") -> Column:
    return F.regexp_replace(c, re.escape(conjunction), " ")


def conform_names(source: DataFrame, name_col: str, codelist: DataFrame, code_col: str,
                  official_name_col: str, overrides: DataFrame | None = None,
                  rules: NormaliseRules = COUNCIL_RULES, carry: Sequence[str] = ()) -> DataFrame:
    """Bridge ``(source_name, normalised_name, code, match_method)``.

    Precedence: an override for the raw source name (``seed_override``), then
    the normalised name equal to the upper-cased official name
    (``exact_name``), then both sides with the conjunction removed
    (``name_without_conjunction``); otherwise code and method are NULL. One row
    per distinct non-NULL source name (provided the official names are unique
    under each key, which ``quality.unique`` can assert).

    ``carry`` names columns of a source that already holds one row per name
    (e.g. names with their row counts); they are passed through to the
    bridge instead of taking a distinct.
    """
    names = source.select(F.col(name_col).alias("source_name"), *carry).filter(F.col("source_name").isNotNull())
    if not carry:
        names = names.distinct()
    normalised = names.select("source_name", normalise("source_name", rules).alias("normalised_name"), *carry)

    official = codelist.select(F.col(code_col).cast("string").alias("code"),
                               F.upper(F.col(official_name_col)).alias("official"))
    by_name = official.select(F.col("official").alias("__exact_key"), F.col("code").alias("__exact_code"))
    by_nc = official.select(without_conjunction(F.col("official"), rules.conjunction).alias("__nc_key"),
                            F.col("code").alias("__nc_code"))

    j = normalised.withColumn("__nc_probe", without_conjunction(F.col("normalised_name"), rules.conjunction))
    if overrides is not None:
        ov = overrides.select(F.col("source_name").alias("__ov_name"), F.col("code").cast("string").alias("__ov_code"))
        j = j.join(ov, F.col("source_name") == F.col("__ov_name"), "left")
    else:
        j = j.withColumn("__ov_code", F.lit(None).cast("string"))
    j = j.join(by_name, F.col("normalised_name") == F.col("__exact_key"), "left")
    j = j.join(by_nc, F.col("__nc_probe") == F.col("__nc_key"), "left")

    method = (F.when(F.col("__ov_code").isNotNull(), F.lit("seed_override"))
              .when(F.col("__exact_code").isNotNull(), F.lit("exact_name"))
              .when(F.col("__nc_code").isNotNull(), F.lit("name_without_conjunction")))
    return j.select("source_name", "normalised_name",
                    F.coalesce("__ov_code", "__exact_code", "__nc_code").alias("code"),
                    method.alias("match_method"), *carry)
