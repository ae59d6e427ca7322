from tessera.sources import seeds


def test_read_seed_keeps_declared_types(spark, tmp_path):
    p = tmp_path / "bands.csv"
    p.write_text("age_band_code,age_band,min_age,max_age,sort_order\nA04,0-4,0,4,1\n0085,85+,85,999,18\n")
    df = seeds.read_seed(spark, str(p), seeds.AGE_BAND_SCHEMA)
    assert df.schema.simpleString() == seeds.AGE_BAND_SCHEMA.simpleString()
    assert [tuple(r) for r in df.collect()] == [("A04", "0-4", 0, 4, 1), ("0085", "85+", 85, 999, 18)]


def test_local_seed_tables(spark):
    bands = seeds.age_bands(spark)
    assert bands.count() == 18
    assert bands._jdf.queryExecution().optimizedPlan().getClass().getSimpleName() == "LocalRelation"
    over = {r.source_name: r.code for r in seeds.council_overrides(spark).collect()}
    assert over["DC MALLALA."] == "40150" and len(over) == 7
    assert seeds.local_table(spark, [], seeds.NAME_CODE_SCHEMA).count() == 0
