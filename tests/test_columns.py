import datetime as dt

from tessera.functions import columns as C


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_strip_extract_suffix(spark):
    assert one(spark, C.strip_extract_suffix("v"), "2020-1-19/09/2025") == "2020-1"
    assert one(spark, C.strip_extract_suffix("v"), "2020-1") == "2020-1"


def test_split_code_label(spark):
    code, label = C.split_code_label("v", ":")
    row = spark.createDataFrame([("4: Fatal",)], "v string").select(code.alias("c"), label.alias("l")).first()
    assert (row.c, row.l) == (4, "Fatal")


def test_digits_only_int(spark):
    df = spark.createDataFrame([("041",), ("XX",), ("XXX",), (None,), ("12\n",), ("",)], "v string")
    got = [r.r for r in df.select(C.digits_only_int("v").alias("r")).collect()]
    assert got == [41, None, None, None, None, None]


def test_sentinel_and_blank(spark):
    assert one(spark, C.sentinel_to_null("v", "XXXXXX"), "XXXXXX") is None
    assert one(spark, C.sentinel_to_null("v", "XXXXXX"), "Royal") == "Royal"
    assert one(spark, C.trimmed_or_null("v"), "   ") is None
    assert one(spark, C.trimmed_or_null("v"), "  a b ") == "a b"
    assert one(spark, C.blank_to_null("v"), "") is None


def test_flag(spark):
    df = spark.createDataFrame([("Y",), (None,), ("N",)], "v string")
    assert [r.r for r in df.select(C.flag("v").alias("r")).collect()] == [True, False, False]


def test_pg_initcap(spark):
    assert one(spark, C.pg_initcap("v"), "O'HALLORAN HILL") == "O'Halloran Hill"
    assert one(spark, C.pg_initcap("v"), "o'halloran-hill st. x2Y") == "O'Halloran-Hill St. X2y"
    assert one(spark, C.pg_initcap("v"), None) is None
    assert one(spark, C.pg_initcap("v"), "") == ""


def test_surrogate_key_null_is_not_skipped(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    keys = [r.k for r in df.select(C.surrogate_key(["x", "y", "z"]).alias("k")).collect()]
    assert keys[0] != keys[1]
    import hashlib
    assert keys[0] == hashlib.md5(b"a-_null_-b").hexdigest()


def test_timestamp_one_digit_parts(spark):
    got = one(spark, C.parse_day_first_timestamp("v"), "5/7/2021 9:05:00")
    assert got == dt.datetime(2021, 7, 5, 9, 5)


def test_financial_year_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 30),), (dt.date(2020, 7, 1),)], "d date")
    rows = df.select(C.financial_year("d").alias("fy"), C.iso_day_of_week("d").alias("dow")).collect()
    assert [r.fy for r in rows] == [2020, 2021]
    assert [r.dow for r in rows] == [2, 3]


def test_strict_int_raises_on_malformed(spark):
    import pytest
    with pytest.raises(Exception):
        spark.createDataFrame([("1.0",)], "v string").select(C.strict_int("v")).collect()
    assert one(spark, C.strict_int("v"), " 041 ") == 41


def test_decode_without_else(spark):
    e = C.decode("v", [("1", "Male"), ("2", "Female")])
    assert one(spark, e, "2") == "Female"
    assert one(spark, e, "9") is None


def _pg_initcap_reference(s):
    out, prev_alnum = [], False
    for ch in s:
        out.append(ch.lower() if prev_alnum else ch.upper())
        prev_alnum = ch.isalnum()
    return "".join(out)


def test_pg_initcap_property(spark):
    from hypothesis import given, settings, strategies as st

    values = []

    @settings(max_examples=200, deadline=None)
    @given(st.text(alphabet="abcXYZé9 '-.\t_/", max_size=12))
    def collect(v):
        values.append(v)

    collect()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.r for r in df.select(C.pg_initcap("v").alias("r")).collect()]
    assert got == [_pg_initcap_reference(v) for v in values]
