"""The road-crash star schema, built from bronze text tables.

Silver functions type and clean one bronze table each; gold functions build
the dimensions, facts and the per-capita report from them; ``build`` runs
everything in dependency order and writes the gold tables.

Bronze inputs (all text, as landed by ``sources.bronze``):
``crashes``, ``casualties``, ``units``, ``erp`` (population observations),
``codelist`` (official region codes and names).
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import (digits_only_int, flag, parse_day_first_timestamp, pg_initcap, quoted,
                                       sentinel_to_null, split_code_label, strip_extract_suffix, surrogate_key,
                                       trimmed_or_null)
from tessera.operators import conform, dims, quality, report, scd2
from tessera.sources import bronze, seeds

log = logging.getLogger(__name__)

AUDIT = [bronze.SOURCE_RESOURCE, bronze.INGESTED_AT]

# Calendar bounds, region scope and masks of the source data.
CALENDAR_START = _dt.date(2015, 1, 1)
CALENDAR_END_EXCLUSIVE = _dt.date(2027, 1, 1)
STATE_PREFIX = "4"
REGION_TYPE = "LGA2024"
HOSPITAL_MASK = "XXXXXX"
SEX_CODES = (("1", "Male"), ("2", "Female"), ("3", "Persons"))
CONDITION_COLS = ["crash_type", "weather_condition", "moisture_condition", "day_night",
                  "is_dui_involved", "is_drugs_involved"]

# File-name suffix of each entity inside one crash extract.
CRASH_EXTRACT_SUFFIXES = {"crashes": "_Crash.csv", "casualties": "_Casualty.csv", "units": "_Units.csv"}


def _audit(df: DataFrame) -> list:
    return [F.col(c) for c in AUDIT if c in df.columns]


# --------------------------------------------------------------------------- silver

TEXT_PASS_THROUGH = ["Position Type", "Horizontal Align", "Vertical Align", "Road Surface", "Moisture Cond",
                     "Weather Cond", "DayNight", "Crash Type", "Traffic Ctrls", "UNIQUE_LOC"]


def stg_crashes(raw: DataFrame, trim_all: bool = False) -> DataFrame:
    """Typed crash rows: stable id, trimmed text, strict ints, timestamps,
    severity split, two-valued flags, projected coordinates.

    Only the geography columns are trimmed by default; ``trim_all`` also
    trims the descriptive text columns (padded values would otherwise split
    junk-dimension combinations)."""
    sev_code, sev_label = split_code_label(quoted("CSEF Severity"), ":")
    crash_at = parse_day_first_timestamp(quoted("Crash Date Time"))
    if trim_all:
        raw = raw.select(*[trimmed_or_null(quoted(c)).alias(c) if c in TEXT_PASS_THROUGH else quoted(c)
                           for c in raw.columns])
    return raw.select(
        strip_extract_suffix(quoted("REPORT_ID")).alias("report_id"),
        trimmed_or_null(quoted("Stats Area")).alias("stats_area"),
        F.nullif(pg_initcap(F.trim(quoted("Suburb"))), F.lit("")).alias("suburb"),
        trimmed_or_null(quoted("Postcode")).alias("postcode"),
        trimmed_or_null(quoted("LGA Name")).alias("lga_name"),
        quoted("Total Units").cast("int").alias("total_units"),
        quoted("Total Cas").cast("int").alias("total_casualties"),
        quoted("Total Fats").cast("int").alias("total_fatalities"),
        quoted("Total SI").cast("int").alias("total_serious_injuries"),
        quoted("Total MI").cast("int").alias("total_minor_injuries"),
        crash_at.alias("crash_at"),
        F.to_date(crash_at).alias("crash_date"),
        quoted("Year").cast("int").alias("crash_year"),
        quoted("Area Speed").cast("int").alias("area_speed_limit"),
        quoted("Position Type").alias("position_type"),
        quoted("Horizontal Align").alias("horizontal_alignment"),
        quoted("Vertical Align").alias("vertical_alignment"),
        quoted("Road Surface").alias("road_surface"),
        quoted("Moisture Cond").alias("moisture_condition"),
        quoted("Weather Cond").alias("weather_condition"),
        quoted("DayNight").alias("day_night"),
        quoted("Crash Type").alias("crash_type"),
        sev_code.alias("severity_code"),
        sev_label.alias("severity_label"),
        quoted("Traffic Ctrls").alias("traffic_controls"),
        flag(quoted("DUI Involved"), "Y").alias("is_dui_involved"),
        flag(quoted("Drugs Involved"), "Y").alias("is_drugs_involved"),
        quoted("ACCLOC_X").cast("decimal(18,6)").alias("location_x"),
        quoted("ACCLOC_Y").cast("decimal(18,6)").alias("location_y"),
        quoted("UNIQUE_LOC").alias("location_key"),
        *_audit(raw),
    )


def stg_casualties(raw: DataFrame) -> DataFrame:
    """One row per person injured; masked ages and hospitals become NULL."""
    return raw.select(
        strip_extract_suffix(quoted("REPORT_ID")).alias("report_id"),
        quoted("UND_UNIT_NUMBER").cast("int").alias("unit_number"),
        quoted("CASUALTY_NUMBER").cast("int").alias("casualty_number"),
        quoted("Casualty Type").alias("casualty_type"),
        quoted("Sex").alias("sex"),
        digits_only_int(quoted("AGE")).alias("age"),
        quoted("Position In Veh").alias("position_in_vehicle"),
        quoted("Thrown Out").alias("thrown_out"),
        quoted("Injury Extent").alias("injury_extent"),
        quoted("Seat Belt").alias("seat_belt"),
        quoted("Helmet").alias("helmet"),
        sentinel_to_null(quoted("Hospital"), HOSPITAL_MASK).alias("hospital"),
        *_audit(raw),
    )


def stg_units(raw: DataFrame) -> DataFrame:
    """Vehicles and other units of a crash (staged, not used downstream)."""
    return raw.select(
        strip_extract_suffix(quoted("REPORT_ID")).alias("report_id"),
        quoted("Unit No").cast("int").alias("unit_number"),
        quoted("No Of Cas").cast("int").alias("casualty_count"),
        quoted("Unit Type").alias("unit_type"),
        quoted("Veh Reg State").alias("vehicle_registration_state"),
        F.when(quoted("Veh Year").rlike(r"^\d{4}\z"), quoted("Veh Year").cast("int")).alias("vehicle_year"),
        quoted("Direction Of Travel").alias("direction_of_travel"),
        quoted("Sex").alias("driver_sex"),
        digits_only_int(quoted("Age")).alias("driver_age"),
        quoted("Lic State").alias("licence_state"),
        quoted("Licence Class").alias("licence_class"),
        quoted("Licence Type").alias("licence_type"),
        quoted("Towing").alias("towing"),
        quoted("Unit Movement").alias("unit_movement"),
        digits_only_int(quoted("Number Occupants")).alias("occupant_count"),
        quoted("Postcode").alias("postcode"),
        quoted("Rollover").alias("rollover"),
        quoted("Fire").alias("fire"),
        *_audit(raw),
    )


def _in_state(code) -> F.Column:
    return code.startswith(STATE_PREFIX) & (code != F.lit(STATE_PREFIX))


def stg_erp(raw: DataFrame) -> DataFrame:
    """Population observations of the state's regions, sex decoded."""
    sex = None
    for k, v in SEX_CODES:
        sex = F.when(F.col("SEX_ABS") == k, v) if sex is None else sex.when(F.col("SEX_ABS") == k, v)
    return (raw.filter((F.col("REGION_TYPE") == REGION_TYPE) & _in_state(F.col("LGA_2024")))
            .select(F.col("LGA_2024").alias("lga_code"), sex.alias("sex"), F.col("AGE").alias("age_band_code"),
                    F.col("TIME_PERIOD").cast("int").alias("year"), F.col("OBS_VALUE").cast("int").alias("population"),
                    *_audit(raw)))


def stg_codelist(raw: DataFrame) -> DataFrame:
    """Official region codes of the state; the ``(SA)`` disambiguation suffix is dropped."""
    return (raw.filter(_in_state(F.col("code")))
            .select(F.col("code").alias("lga_code"),
                    F.trim(F.regexp_replace("name", r"\s*\(SA\)$", "")).alias("lga_name"),
                    F.col("name").alias("lga_name_abs")))


# --------------------------------------------------------------------------- gold

def region_bridge(crashes: DataFrame, codelist: DataFrame, overrides: DataFrame) -> DataFrame:
    b = conform.conform_names(crashes, "lga_name", codelist, "lga_code", "lga_name", overrides=overrides,
                              rules=conform.COUNCIL_RULES)
    return b.select(F.col("source_name").alias("source_lga_name"), "normalised_name",
                    F.col("code").alias("lga_code"), "match_method")


def codelist_match_keys(codelist: DataFrame) -> DataFrame:
    """The keys the bridge matches on after dropping the conjunction."""
    return codelist.select(conform.without_conjunction(F.upper(F.col("lga_name"))).alias("match_key"))


def region_unknown() -> dict:
    return scd2.unknown_member("lga_code", ["lga_name", "lga_name_abs"], "region_key",
                               extra={"is_incorporated": False})


def dim_region(snapshot: DataFrame) -> DataFrame:
    d = scd2.versioned_dim(snapshot, "lga_code", ["lga_name", "lga_name_abs"], key_col="region_key",
                           derived={"is_incorporated": ~F.col("lga_code").isin(*seeds.NON_GEOGRAPHIC_CODES)},
                           unknown=region_unknown())
    return d.select("region_key", "lga_code", "lga_name", "lga_name_abs", "is_incorporated", "valid_from",
                    "valid_to", "is_current")


def dim_crash_condition(crashes: DataFrame) -> DataFrame:
    return dims.junk_dim(crashes, CONDITION_COLS, "condition_key")


def _with_region(rows: DataFrame, bridge: DataFrame, regions: DataFrame, name_col: str, date_col: str) -> DataFrame:
    """Free-text name -> code via the bridge (unmatched -> ``UNK``), then the
    region version in force on the date."""
    b = bridge.select(F.col("source_lga_name").alias("__src"), F.col("lga_code").alias("__bridge_code"))
    j = rows.join(b, rows[name_col] == b["__src"], "left")
    j = j.withColumn("__code", F.coalesce(F.col("__bridge_code"), F.lit(scd2.UNKNOWN_CODE))) \
        .drop("__src", "__bridge_code")
    out = scd2.point_in_time_join(j, regions, "__code", date_col, "lga_code", ["region_key"])
    return out.drop("__code")


def fact_road_crashes(crashes: DataFrame, bridge: DataFrame, regions: DataFrame) -> DataFrame:
    j = _with_region(crashes, bridge, regions, "lga_name", "crash_date")
    return j.select("report_id", "region_key", "crash_date",
                    surrogate_key(CONDITION_COLS).alias("condition_key"),
                    "crash_at", "severity_code", "severity_label", "stats_area", "suburb", "postcode",
                    "area_speed_limit", "crash_type", "total_units", "total_casualties", "total_fatalities",
                    "total_serious_injuries", "total_minor_injuries")


def fact_crash_casualties(casualties: DataFrame, crash_fact: DataFrame, bands: DataFrame) -> DataFrame:
    """Casualties inherit region and date from their crash (inner: orphans
    drop, as the reconciliation check reports), age bucketed to the bands."""
    parent = crash_fact.select(F.col("report_id").alias("__rid"), "region_key", "crash_date",
                               F.col("severity_code").alias("crash_severity_code"))
    j = casualties.join(parent, casualties.report_id == parent["__rid"], "inner").drop("__rid")
    banded = dims.band_join(j, "age", bands, code_col="age_band_code", lo="min_age", hi="max_age")
    return banded.select("report_id", "unit_number", "casualty_number", "region_key", "crash_date", "age_band_code",
                         "sex", "age", "casualty_type", "injury_extent", "position_in_vehicle", "thrown_out",
                         "seat_belt", "helmet", "hospital", "crash_severity_code",
                         F.lit(1).alias("casualty_count"))


def fact_population_annual(erp: DataFrame, regions: DataFrame) -> DataFrame:
    """Additive cells only: published totals (sex ``Persons``, age ``TOT``) are dropped."""
    cells = (erp.filter(F.col("sex").isin("Male", "Female") & (F.col("age_band_code") != "TOT"))
             .withColumn("year_date", F.make_date("year", F.lit(1), F.lit(1))))
    j = scd2.point_in_time_join(cells, regions, "lga_code", "year_date", "lga_code", ["region_key"])
    return j.select("region_key", "year_date", "year", "sex", "age_band_code", "population")


def rpt_lga_crash_rates(crash_fact: DataFrame, population_fact: DataFrame, regions: DataFrame,
                        grain: str = "version") -> DataFrame:
    """Crashes, casualties and fatalities per 10,000 residents by region and year.

    ``grain="version"`` (default) joins the facts on the region *version*: a
    region renamed mid-year splits into two keys and crashes after the rename
    find no population (anchored to 1 January). ``grain="code"`` aggregates
    both facts by the stable region code instead and names it by its current
    version.
    """
    f = crash_fact.withColumn("year", F.year("crash_date").cast("int"))
    aggs = {"crashes": F.count(F.lit(1)),
            "casualties": F.sum("total_casualties").cast("long"),
            "fatalities": F.sum("total_fatalities").cast("long"),
            "serious_injuries": F.sum("total_serious_injuries").cast("long")}
    rates = {"crashes_per_10k": ("crashes", 0), "casualties_per_10k": ("casualties", 0)}
    if grain == "version":
        return report.rate_report(f, population_fact, regions, keys=["region_key", "year"], numerator_aggs=aggs,
                                  denominator_col="population", dim_key="region_key",
                                  dim_cols=["lga_name", "lga_code"], rates=rates)
    if grain != "code":
        raise ValueError("grain must be 'version' or 'code'")
    codes = regions.select("region_key", "lga_code")
    current = regions.filter(F.col("is_current")).select("lga_code", "lga_name")
    return report.rate_report(f.join(codes, "region_key"), population_fact.join(codes, "region_key"), current,
                              keys=["lga_code", "year"], numerator_aggs=aggs, denominator_col="population",
                              dim_key="lga_code", dim_cols=["lga_name", "lga_code"], rates=rates)


def rpt_casualty_rates_by_age(casualty_fact: DataFrame, population_fact: DataFrame, regions: DataFrame) -> DataFrame:
    """Casualties per 10,000 residents by region, year and age band."""
    f = (casualty_fact.filter(F.col("age_band_code").isNotNull())
         .withColumn("year", F.year("crash_date").cast("int")))
    return report.rate_report(
        f, population_fact, regions, keys=["region_key", "year", "age_band_code"],
        numerator_aggs={"casualties": F.sum("casualty_count").cast("long")},
        denominator_col="population", dim_key="region_key", dim_cols=["lga_name", "lga_code"],
        rates={"casualties_per_10k": ("casualties", 0)})


def warehouse_checks(t: Mapping[str, DataFrame]) -> list:
    """Every declared check of the warehouse, per table, plus the two
    cross-table assertions (crash/casualty reconciliation, year coverage).

    ``t`` holds the seeds, the silver frames, the bridge and the gold tables
    under their model names.
    """
    Q = quality
    nn, uq = Q.NotNull, Q.Unique

    def rel(col, parent, parent_col):
        return Q.Relationship(col, t[parent], parent_col, parent)

    crash_years = t["fact_road_crashes"].select(F.year("crash_date").cast("int").alias("year"))
    return [
        ("seed_abs_age_bands", t["seed_abs_age_bands"], [uq("age_band_code"), nn("age_band_code")]),
        ("seed_lga_name_overrides", t["seed_lga_name_overrides"], [uq("source_name"), nn("source_name"), nn("code")]),
        ("stg_crashes", t["stg_crashes"], [
            uq("report_id"), nn("report_id"), nn("crash_date"), nn("severity_code"),
            Q.AcceptedValues("severity_code", [1, 2, 3, 4])]),
        ("stg_casualties", t["stg_casualties"], [
            nn("report_id"), rel("report_id", "stg_crashes", "report_id"),
            Q.UniqueCombination(["report_id", "unit_number", "casualty_number"])]),
        ("stg_units", t["stg_units"], [
            nn("report_id"), rel("report_id", "stg_crashes", "report_id"),
            Q.UniqueCombination(["report_id", "unit_number"])]),
        ("stg_erp", t["stg_erp"], [
            nn("population"), nn("sex"), Q.AcceptedValues("sex", ["Male", "Female", "Persons"]),
            Q.UniqueCombination(["lga_code", "year", "sex", "age_band_code"])]),
        ("stg_codelist", t["stg_codelist"], [uq("lga_code"), nn("lga_code"), uq("lga_name"), nn("lga_name")]),
        # the conjunction-free match key must be unique too, or the bridge fans out
        ("stg_codelist_match_key", t["codelist_match_keys"], [uq("match_key")]),
        ("int_lga_name_conformed", t["int_lga_name_conformed"], [
            uq("source_lga_name"), nn("source_lga_name"), nn("lga_code"),
            rel("lga_code", "stg_codelist", "lga_code"), nn("match_method"),
            Q.AcceptedValues("match_method", ["seed_override", "exact_name", "name_without_conjunction"])]),
        ("dim_region", t["dim_region"], [
            uq("region_key"), nn("region_key"), nn("lga_code"), nn("lga_name"), nn("valid_from"), nn("valid_to"),
            nn("is_current")]),
        ("dim_date", t["dim_date"], [
            uq("date_day"), nn("date_day"), nn("year"), nn("is_weekend"),
            Q.MaxBetween("date_day", _dt.date(2026, 12, 31), None)]),
        ("dim_age_band", t["dim_age_band"], [uq("age_band_code"), nn("age_band_code"), uq("age_band"), nn("age_band")]),
        ("dim_crash_condition", t["dim_crash_condition"], [
            uq("condition_key"), nn("condition_key"), nn("is_dui_involved"), nn("is_drugs_involved")]),
        ("fact_road_crashes", t["fact_road_crashes"], [
            uq("report_id"), nn("report_id"), nn("region_key"), rel("region_key", "dim_region", "region_key"),
            nn("crash_date"), rel("crash_date", "dim_date", "date_day"),
            nn("condition_key"), rel("condition_key", "dim_crash_condition", "condition_key"),
            nn("severity_code"), Q.AcceptedValues("severity_code", [1, 2, 3, 4]),
            Q.AcceptedValues("severity_label", ["PDO", "MI", "SI", "Fatal"]),
            Q.AcceptedValues("stats_area", ["1 City", "2 Metropolitan", "3 Country"]),
            Q.Between("total_casualties", 0, 100), Q.RowCountBetween(40000, 200000)]),
        ("fact_crash_casualties", t["fact_crash_casualties"], [
            nn("region_key"), rel("region_key", "dim_region", "region_key"),
            nn("crash_date"), rel("crash_date", "dim_date", "date_day"),
            rel("age_band_code", "dim_age_band", "age_band_code"),
            Q.AcceptedValues("sex", ["Male", "Female", "Unknown"]),
            Q.Between("age", 0, 120, row_condition="age is not null"),
            Q.AcceptedValues("casualty_count", [1]),
            Q.UniqueCombination(["report_id", "unit_number", "casualty_number"])]),
        ("fact_population_annual", t["fact_population_annual"], [
            nn("region_key"), rel("region_key", "dim_region", "region_key"),
            nn("year_date"), rel("year_date", "dim_date", "date_day"),
            nn("sex"), Q.AcceptedValues("sex", ["Male", "Female"]),
            nn("age_band_code"), rel("age_band_code", "dim_age_band", "age_band_code"),
            nn("population"), Q.Between("population", 0, 50000),
            Q.UniqueCombination(["region_key", "year", "sex", "age_band_code"])]),
        ("rpt_lga_crash_rates", t["rpt_lga_crash_rates"], [
            nn("crashes_per_10k"), Q.Between("crashes_per_10k", 0, 500),
            Q.UniqueCombination(["lga_code", "year"])]),
        ("fact_road_crashes", t["fact_road_crashes"], [
            Q.Violations("reconcile_casualty_rows", "total_casualties",
                         Q.reconcile(t["fact_road_crashes"], t["fact_crash_casualties"], "report_id",
                                     "total_casualties")),
            Q.Violations("population_covers_crash_years", "year",
                         Q.coverage_gaps(crash_years, t["fact_population_annual"], "year"))]),
    ]


def register_views(spark: SparkSession, raw: Mapping[str, DataFrame] | None = None,
                   paths: Mapping[str, str] | None = None) -> list[str]:
    """Expose the layers to SQL users: silver models as temporary views over
    the bronze frames, gold tables as views over their written Parquet.

    ``spark.sql("select * from rpt_lga_crash_rates where year = 2024")`` then
    plans against the stored facts like any other query.
    """
    names: list[str] = []
    if raw is not None:
        silver = {"stg_crashes": stg_crashes, "stg_casualties": stg_casualties, "stg_units": stg_units,
                  "stg_erp": stg_erp, "stg_codelist": stg_codelist}
        source = {"stg_crashes": "crashes", "stg_casualties": "casualties", "stg_units": "units",
                  "stg_erp": "erp", "stg_codelist": "codelist"}
        for view, fn in silver.items():
            if source[view] in raw:
                fn(raw[source[view]]).createOrReplaceTempView(view)
                names.append(view)
    for name, path in (paths or {}).items():
        spark.read.parquet(path).createOrReplaceTempView(name)
        names.append(name)
    return names


def build(spark: SparkSession, raw: Mapping[str, DataFrame], out_dir: str, run_ts: _dt.datetime,
          previous_snapshot: DataFrame | None = None, fail_on_violation: bool = False,
          trim_all: bool = False, report_grain: str = "version") -> dict[str, str]:
    """Build and write the gold layer from bronze frames.

    Order: silver views -> region snapshot (written as a new version, then
    re-read: the snapshot is the only state carried between runs) -> bridge
    and dimensions -> facts (re-read after writing, which also cuts lineage)
    -> reports -> checks. Layers are written to their own folders
    (``snapshots/``, ``intermediate/``, ``marts/``). Returns model name -> path.
    """
    out = out_dir.rstrip("/")
    absent = [e for e in ("crashes", "casualties", "units", "erp", "codelist") if e not in raw]
    if absent:
        raise bronze.MissingEntityError(f"inputs lack entities: {absent}")
    crashes, casualties = stg_crashes(raw["crashes"], trim_all=trim_all), stg_casualties(raw["casualties"])
    erp, codelist = stg_erp(raw["erp"]), stg_codelist(raw["codelist"])
    paths: dict[str, str] = {}

    def write(name: str, df: DataFrame, layer: str = "marts", folder: str | None = None,
              cluster_by: str | None = None) -> DataFrame:
        """Each layer lives in its own folder: ``marts/``, ``intermediate/``, ``snapshots/``.

        ``cluster_by`` sorts rows inside each task before writing (no shuffle),
        so every Parquet row group covers a narrow range of that column and a
        date-range filter skips the rest.
        """
        path = f"{out}/{layer}/{folder or name}"
        if cluster_by:
            df = df.sortWithinPartitions(cluster_by)
        bronze.full_refresh(df, path)      # staged write, swapped in after success
        paths[name] = path
        return spark.read.parquet(path)

    snap_src = codelist.select("lga_code", "lga_name", "lga_name_abs")
    run_id = run_ts.strftime("%Y%m%dT%H%M%S")
    # every run is a new snapshot version; the previous one is only read
    snap = write("region_snapshot", scd2.snapshot_merge(previous_snapshot, snap_src, "lga_code", ["lga_name"], run_ts),
                 layer="snapshots", folder=f"region_snapshot/run={run_id}")
    regions = write("dim_region", dim_region(snap))
    bridge = write("int_lga_name_conformed", region_bridge(crashes, codelist, seeds.council_overrides(spark)),
                   layer="intermediate")
    tables: dict[str, DataFrame] = {
        "dim_region": regions, "int_lga_name_conformed": bridge,
        "seed_abs_age_bands": seeds.age_bands(spark), "seed_lga_name_overrides": seeds.council_overrides(spark),
        "stg_crashes": crashes, "stg_casualties": casualties, "stg_erp": erp, "stg_codelist": codelist,
        "codelist_match_keys": codelist_match_keys(codelist),
    }
    tables["stg_units"] = stg_units(raw["units"])
    tables["dim_date"] = write("dim_date", dims.date_dim(spark, CALENDAR_START, CALENDAR_END_EXCLUSIVE))
    tables["dim_age_band"] = write("dim_age_band", seeds.age_bands(spark))
    tables["dim_crash_condition"] = write("dim_crash_condition", dim_crash_condition(crashes))
    tables["fact_road_crashes"] = write("fact_road_crashes", fact_road_crashes(crashes, bridge, regions),
                                        cluster_by="crash_date")
    tables["fact_crash_casualties"] = write(
        "fact_crash_casualties",
        fact_crash_casualties(casualties, tables["fact_road_crashes"], tables["dim_age_band"]),
        cluster_by="crash_date")
    tables["fact_population_annual"] = write("fact_population_annual", fact_population_annual(erp, regions))
    tables["rpt_lga_crash_rates"] = write(
        "rpt_lga_crash_rates",
        rpt_lga_crash_rates(tables["fact_road_crashes"], tables["fact_population_annual"], regions,
                            grain=report_grain))
    write("rpt_casualty_rates_by_age",
          rpt_casualty_rates_by_age(tables["fact_crash_casualties"], tables["fact_population_annual"], regions))
    card = write("quality_scorecard", quality.scorecard(warehouse_checks(tables)))
    if fail_on_violation:
        quality.assert_clean(card)
    return paths
