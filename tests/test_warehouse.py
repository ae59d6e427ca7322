import datetime as dt

from pyspark.sql import functions as F

from tessera.plans import warehouse as W
from tessera.sources import bronze

import warehouse_fixture as FX


def load(spark, folder):
    raw = bronze.read_extract(spark, folder, W.CRASH_EXTRACT_SUFFIXES)
    raw["erp"] = bronze.read_text_csv(spark, f"{folder}/erp.csv", blank_as_null=False)
    raw["codelist"] = bronze.read_text_csv(spark, f"{folder}/codes.csv")
    return raw


def test_silver(spark, tmp_path):
    FX.write_all(str(tmp_path))
    raw = load(spark, str(tmp_path))
    c = {r.report_id: r for r in W.stg_crashes(raw["crashes"]).collect()}
    r = c["2023-1"]
    assert (r.suburb, r.stats_area, r.severity_code, r.severity_label, r.is_dui_involved, r.is_drugs_involved) == \
        ("O'Halloran Hill", "2 Metropolitan", 2, "MI", True, False)
    assert r.crash_at == dt.datetime(2023, 7, 5, 9, 5) and r.crash_date == dt.date(2023, 7, 5)
    assert c["2024-4"].lga_name is None
    cas = {(r.report_id, r.casualty_number): r for r in W.stg_casualties(raw["casualties"]).collect()}
    assert cas[("2023-1", 1)].age == 41 and cas[("2023-1", 1)].hospital is None
    assert cas[("2023-1", 2)].age is None and cas[("2023-1", 2)].hospital == "RAH"
    erp = W.stg_erp(raw["erp"])
    assert erp.filter(F.col("lga_code").isin("4", "10050")).count() == 0
    assert {r.sex for r in erp.collect()} == {"Male", "Female", "Persons"}
    codes = {r.lga_code: r.lga_name for r in W.stg_codelist(raw["codelist"]).collect()}
    assert codes["41010"] == "Campbelltown" and "4" not in codes and "10050" not in codes
    assert W.stg_units(raw["units"]).first().driver_age == 41


def test_build(spark, tmp_path):
    src = tmp_path / "bronze"
    src.mkdir()
    FX.write_all(str(src))
    raw = load(spark, str(src))
    paths = W.build(spark, raw, str(tmp_path / "gold"), dt.datetime(2025, 1, 1))
    read = lambda n: spark.read.parquet(paths[n])

    bridge = {r.source_lga_name: (r.lga_code, r.match_method) for r in read("int_lga_name_conformed").collect()}
    assert bridge["CITY OF ADELAIDE"] == ("40070", "exact_name")
    assert bridge["DC MT.BARKER."] == ("44550", "exact_name")
    assert bridge["NORWOOD,PAYNEHAM & ST PETERS"] == ("45290", "name_without_conjunction")
    assert bridge["DC MALLALA."] == ("40150", "seed_override")
    assert bridge["ATLANTIS"] == (None, None)

    regions = {r.region_key: r for r in read("dim_region").collect()}
    crashes = read("fact_road_crashes").collect()
    assert len(crashes) == len(FX.CRASHES)               # every crash lands, none duplicated
    by_id = {r.report_id: regions[r.region_key].lga_code for r in crashes}
    assert by_id["2024-4"] == "UNK" and by_id["2024-5"] == "UNK" and by_id["2023-1"] == "40070"

    cas = {(r.report_id, r.casualty_number): r for r in read("fact_crash_casualties").collect()}
    assert len(cas) == len(FX.CASUALTIES)
    assert cas[("2023-1", 1)].age_band_code == "A40" and cas[("2023-1", 2)].age_band_code is None
    assert cas[("2023-2", 1)].age_band_code == "8599" and cas[("2024-2", 1)].age_band_code == "A04"
    assert cas[("2023-2", 1)].crash_severity_code == 4 and cas[("2023-2", 1)].casualty_count == 1

    pop = read("fact_population_annual")
    assert {r.sex for r in pop.collect()} == {"Male", "Female"}
    assert pop.filter(F.col("age_band_code") == "TOT").count() == 0

    rpt = {(r.lga_code, r.year): r for r in read("rpt_lga_crash_rates").collect()}
    a23 = rpt[("40070", 2023)]
    assert (a23.crashes, a23.casualties, a23.fatalities, a23.population) == (2, 3, 1, 29118)
    assert a23.crashes_per_10k == 0.7 and a23.casualties_per_10k == 1.0
    assert all(k[0] != "UNK" for k in rpt)              # no population for the unknown member

    by_age = {(r.lga_code, r.year, r.age_band_code): r for r in read("rpt_casualty_rates_by_age").collect()}
    # the only population cells are band A20; casualties aged 20-24 exist nowhere in the fixture
    assert by_age == {}
    card = read("quality_scorecard").collect()
    assert len(card) == 90       # 87 declared checks + 2 cross-table assertions + the T7 match-key check
    score = {(r.table_name, r.check_name, r.column_name): r.violations for r in card}
    assert score[("fact_road_crashes", "not_null", "region_key")] == 0
    assert score[("fact_road_crashes", "row_count_between", "*")] == 1   # 7 rows, far below 40,000
    assert score[("stg_casualties", "relationships", "report_id")] == 0
    assert score[("int_lga_name_conformed", "not_null", "lga_code")] == 1  # ATLANTIS: the designed alarm
    assert score[("fact_road_crashes", "reconcile_casualty_rows", "total_casualties")] == 1  # 2024-4: 1 stated, 2 rows
    assert score[("fact_road_crashes", "population_covers_crash_years", "year")] == 0
    assert score[("dim_date", "max_between", "date_day")] == 0
    import pytest
    from tessera.operators import quality
    with pytest.raises(quality.DataQualityError, match="row_count_between"):
        quality.assert_clean(read("quality_scorecard"))

    # rates by stable code equal rates by version when nothing was renamed
    by_code = W.rpt_lga_crash_rates(read("fact_road_crashes"), read("fact_population_annual"),
                                    read("dim_region"), grain="code")
    assert sorted(map(tuple, by_code.select(*read("rpt_lga_crash_rates").columns).collect())) == \
        sorted(map(tuple, read("rpt_lga_crash_rates").collect()))

    # SQL over the built layers
    views = W.register_views(spark, raw, paths)
    assert "stg_crashes" in views and "rpt_lga_crash_rates" in views
    got = spark.sql("SELECT lga_name, crashes_per_10k FROM rpt_lga_crash_rates WHERE lga_code = '40070' "
                    "AND year = 2023").collect()
    assert [(r.lga_name, r.crashes_per_10k) for r in got] == [("Adelaide", 0.7)]
    assert spark.sql("SELECT count(*) AS n FROM stg_crashes WHERE lga_name IS NULL").first().n == 1

    # second run with a renamed region: old version closed, new one opened
    codes2 = raw["codelist"].withColumn("name", F.when(F.col("code") == "40070", "City of Adelaide")
                                        .otherwise(F.col("name")))
    assert paths["region_snapshot"].endswith("/snapshots/region_snapshot/run=20250101T000000")
    assert paths["dim_region"].endswith("/marts/dim_region")
    snap1 = read("region_snapshot")
    paths2 = W.build(spark, {**raw, "codelist": codes2}, str(tmp_path / "gold2"), dt.datetime(2025, 6, 1),
                     previous_snapshot=snap1)
    versions = spark.read.parquet(paths2["dim_region"]).filter(F.col("lga_code") == "40070").collect()
    assert sorted((v.lga_name, v.valid_from, v.valid_to, v.is_current) for v in versions) == [
        ("Adelaide", dt.date(1900, 1, 1), dt.date(2025, 6, 1), False),
        ("City of Adelaide", dt.date(2025, 6, 1), dt.date(9999, 12, 31), True)]


def test_population_parts_sum_to_published_totals(spark, tmp_path):
    """The additive cells (Male + Female) reproduce the published Persons total."""
    FX.write_all(str(tmp_path))
    erp = W.stg_erp(load(spark, str(tmp_path))["erp"]).filter(F.col("age_band_code") != "TOT")
    parts = erp.filter(F.col("sex").isin("Male", "Female")).groupBy("lga_code", "year", "age_band_code") \
        .agg(F.sum("population").alias("parts"))
    totals = erp.filter(F.col("sex") == "Persons").select("lga_code", "year", "age_band_code",
                                                          F.col("population").alias("total"))
    j = parts.join(totals, ["lga_code", "year", "age_band_code"], "full_outer")
    assert j.filter(~F.col("parts").eqNullSafe(F.col("total"))).count() == 0


def test_casualty_rates_by_age(spark):
    cas = spark.createDataFrame([("r1", dt.date(2024, 3, 1), "A40", 1), ("r1", dt.date(2024, 5, 1), "A40", 1),
                                 ("r1", dt.date(2024, 5, 1), "A20", 1), ("r1", dt.date(2024, 6, 1), None, 1)],
                                "region_key string, crash_date date, age_band_code string, casualty_count int")
    pop = spark.createDataFrame([("r1", 2024, "Male", "A40", 3000), ("r1", 2024, "Female", "A40", 3001),
                                 ("r1", 2024, "Male", "A20", 0)],
                                "region_key string, year int, sex string, age_band_code string, population int")
    regions = spark.createDataFrame([("r1", "40070", "Adelaide")], "region_key string, lga_code string, lga_name string")
    got = [tuple(r) for r in W.rpt_casualty_rates_by_age(cas, pop, regions).collect()]
    # 2 casualties / 6,001 residents -> 3.3 per 10k; A20 has no residents; masked ages are left out
    assert got == [("Adelaide", "40070", 2024, "A40", 2, 6001, 3.3)]
