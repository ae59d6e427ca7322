import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import rejects as R

RAW = "id string, n string, amount string, at string, kind string, coded string, note string"
ROWS = [("1", "12", "3.50", "2024-01-31 10:00:00", "A", "4: Fatal", "ok"),
        ("2", "", "3.5.0", "2024-02-31 10:00:00", "a", "x: Fatal", None),
        ("3", "999999999999", "1234567.89", "31/01/2024", "B", ":", "late"),
        ("4", None, None, None, None, None, None),
        (None, "1e3", "-1", "2024-01-31 10:00:00", "A", "7", ""),
        ("6", " 7 ", "0.004", "2024-01-31 24:00:00", "C", " 5 : x", "é")]
RULES = [R.number("n_int", "n"), R.number("amount", "amount", "decimal(7,2)"), R.moment("day", "at", kind="date"),
         R.one_of("kind", "kind", ["A", "B"]), R.code_before("code", "coded", ":"), R.number("key", "id", "bigint", required=True),
         R.matching("word", "note", r"^\p{L}+\z")]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(ROWS, RAW).withColumn("_row", F.monotonically_increasing_id())


def cells(df):
    return sorted(((r["_row"], r["column"], r["raw"], r["rule"]) for r in df.collect()), key=str)


def test_every_bad_cell_is_named(spark):
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], RAW + ", _row int")
    routed = R.route(raw, RULES, keep=["_row"])
    day = "date yyyy-MM-dd HH:mm:ss"
    assert cells(R.rejects(routed, ["_row"])) == sorted([
        (1, "n_int", "", "int"), (1, "amount", "3.5.0", "decimal(7,2)"), (1, "day", "2024-02-31 10:00:00", day),
        (1, "kind", "a", "accepted values"), (1, "code", "x: Fatal", "code before :"),
        (2, "n_int", "999999999999", "int"), (2, "amount", "1234567.89", "decimal(7,2)"), (2, "day", "31/01/2024", day),
        (2, "code", ":", "code before :"),
        (4, "n_int", "1e3", "int"), (4, "key", None, "required"), (4, "word", "", r"matches ^\p{L}+\z"),
        (5, "day", "2024-01-31 24:00:00", day), (5, "kind", "C", "accepted values")], key=str)
    good = {r["_row"]: r for r in R.typed(routed).collect()}
    assert set(good) == {0, 3} and good[0]["day"] == dt.date(2024, 1, 31) and good[0]["code"] == 4 and good[3]["n_int"] is None
    counts = {(r["column"], r["rule"]): r["cells"] for r in R.summary(routed).collect()}
    assert counts[("*", "read")] == 6 and counts[("*", "typed")] == 2 and counts[("*", "rejected")] == 4 and counts[("day", day)] == 3


def test_one_pass_lands_both(spark, tmp_path, raw):
    path = str(tmp_path / "landed")
    good, bad, counts = R.land_typed(raw, RULES, path, keep=["_row"])
    assert counts == {"read": 6, "typed": 2, "rejected": 4} and good.count() == 2
    assert cells(bad) == cells(R.rejects(R.route(raw, RULES, keep=["_row"]), ["_row"]))
    # a load without rejects, and one of no rows
    good, bad, counts = R.land_typed(raw.filter("id = '1'"), RULES, path, keep=["_row"])
    assert counts == {"read": 1, "typed": 1, "rejected": 0} and bad.count() == 0 and good.count() == 1
    good, bad, counts = R.land_typed(raw.limit(0), RULES, path, keep=["_row"])
    assert counts == {"read": 0, "typed": 0, "rejected": 0} and bad.count() == 0 == good.count()


def test_no_shuffle_and_name_checks(spark, raw):
    plan = R.route(raw, RULES, keep=["_row"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    with pytest.raises(ValueError, match="twice"):
        R.route(raw, RULES, keep=["kind"])
    assert {r["rule"]: r["cells"] for r in R.summary(R.route(raw.limit(0), RULES)).collect()} == {"read": 0, "typed": 0, "rejected": 0}
