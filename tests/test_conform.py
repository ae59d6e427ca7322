from tessera.operators import conform
from tessera.sources import seeds


def norm(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return [r.r for r in df.select(conform.normalise("n").alias("r")).collect()]


def test_rule_chain(spark):
    assert norm(spark, ["CITY OF SALISBURY", "DC MT.BARKER.", "CC PT.AUGUSTA.", "THE RURAL CITY OF MURRAY BRIDGE",
                        "NORWOOD,PAYNEHAM & ST PETERS", "  ADELAIDE   HILLS  COUNCIL "]) == [
        "SALISBURY", "MOUNT BARKER", "PORT AUGUSTA", "RURAL CITY OF MURRAY BRIDGE", "NORWOOD PAYNEHAM ST PETERS",
        "ADELAIDE HILLS"]


def test_bridge_precedence_and_unmatched(spark):
    src = spark.createDataFrame([(n,) for n in [
        "CITY OF SALISBURY", "NORWOOD,PAYNEHAM & ST PETERS", "DC MALLALA.", "NOWHERE", None,
        "DC NARACOORTE & LUCINDALE.", "CITY OF SALISBURY"]], "lga_name string")
    codes = spark.createDataFrame([("47140", "Salisbury"), ("45290", "Norwood Payneham And St Peters"),
                                   ("40150", "Adelaide Plains"), ("45090", "Naracoorte Lucindale")],
                                  "lga_code string, lga_name string")
    b = conform.conform_names(src, "lga_name", codes, "lga_code", "lga_name", overrides=seeds.council_overrides(spark))
    got = {r.source_name: (r.code, r.match_method) for r in b.collect()}
    assert got == {
        "CITY OF SALISBURY": ("47140", "exact_name"),
        "NORWOOD,PAYNEHAM & ST PETERS": ("45290", "name_without_conjunction"),
        "DC MALLALA.": ("40150", "seed_override"),
        "DC NARACOORTE & LUCINDALE.": ("45090", "seed_override"),
        "NOWHERE": (None, None),
    }
