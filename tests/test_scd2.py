import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import scd2

T1 = dt.datetime(2021, 3, 1, 10, 0)
T2 = dt.datetime(2022, 5, 2, 9, 30)
T3 = dt.datetime(2023, 1, 1, 0, 0)
SRC = "code string, name string, passive string"


def snap_rows(df):
    rows = [(r.code, r.name, r.passive, r.valid_from_ts, r.valid_to_ts) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_merge_cases(spark):
    s1 = spark.createDataFrame([("A", "Alpha", "p1"), ("B", "Beta", "p1"), ("C", "Gamma", "p1"), ("N", None, "p1")], SRC)
    s2 = spark.createDataFrame([("A", "Alpha", "p2"), ("B", "Beta2", "p2"), ("D", "Delta", "p2"), ("N", None, "p2")], SRC)
    snap1 = scd2.snapshot_merge(None, s1, "code", ["name"], T1)
    snap2 = scd2.snapshot_merge(snap1, s2, "code", ["name"], T2)
    assert set(snap_rows(snap2)) == {
        ("A", "Alpha", "p1", T1, None),          # unchanged: kept, passive not refreshed
        ("B", "Beta", "p1", T1, T2),             # changed: closed
        ("B", "Beta2", "p2", T2, None),          # ... and reopened
        ("C", "Gamma", "p1", T1, None),          # deleted at source: stays open
        ("D", "Delta", "p2", T2, None),          # new
        ("N", None, "p1", T1, None),             # NULL == NULL: unchanged
    }
    # idempotent: the same source again changes nothing
    again = scd2.snapshot_merge(snap2, s2, "code", ["name"], T3)
    assert snap_rows(again) == snap_rows(snap2)


def test_merge_invalidate_deleted(spark):
    s1 = spark.createDataFrame([("A", "x", "p"), ("C", "y", "p")], SRC)
    s2 = spark.createDataFrame([("A", "x", "p")], SRC)
    snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], T1), s2, "code", ["name"], T2,
                               invalidate_deleted=True)
    assert ("C", "y", "p", T1, T2) in snap_rows(snap)


def test_history_equals_iterated_merges(spark):
    rng = random.Random(7)
    runs = [dt.datetime(2020 + i, 1, 1) for i in range(5)]
    extracts = []
    for r in runs:
        for k in range(12):
            if rng.random() < 0.7:
                extracts.append((f"K{k}", rng.choice(["a", "b", None]), f"p{r.year}", r))
    ddl = "code string, name string, passive string, run_ts timestamp"
    all_df = spark.createDataFrame(extracts, ddl)
    snap = None
    for r in runs:
        part = all_df.filter(F.col("run_ts") == F.lit(r)).drop("run_ts")
        snap = scd2.snapshot_merge(snap, part, "code", ["name"], r)
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # cut the plan between runs
    hist = scd2.snapshot_history(all_df, "code", ["name"], "run_ts")
    assert snap_rows(hist) == snap_rows(snap)


def dim_of(spark):
    s1 = spark.createDataFrame([("A", "Alpha", "x"), ("B", "Beta", "x")], SRC)
    s2 = spark.createDataFrame([("A", "Alpha2", "x"), ("B", "Beta", "x")], SRC)
    snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], T1), s2, "code", ["name"], T2)
    unk = scd2.unknown_member("code", ["name", "passive"], "key")
    return scd2.versioned_dim(snap, "code", ["name", "passive"], key_col="key", unknown=unk), unk


def test_versioned_dim(spark):
    dim, _ = dim_of(spark)
    rows = {(r.code, r.name): r for r in dim.collect()}
    a1, a2 = rows[("A", "Alpha")], rows[("A", "Alpha2")]
    assert a1.valid_from == dt.date(1900, 1, 1) and a1.valid_to == T2.date() and not a1.is_current
    assert a2.valid_from == T2.date() and a2.valid_to == dt.date(9999, 12, 31) and a2.is_current
    u = rows[("UNK", "Unknown")]
    assert u.valid_from == dt.date(1900, 1, 1) and u.is_current
    assert len({r.key for r in rows.values()}) == len(rows)


def test_same_day_changes_leave_no_empty_version(spark):
    s1 = spark.createDataFrame([("A", "v1", "x")], SRC)
    s2 = spark.createDataFrame([("A", "v2", "x")], SRC)
    s3 = spark.createDataFrame([("A", "v3", "x")], SRC)
    d1, d2, d3 = dt.datetime(2021, 1, 1), dt.datetime(2021, 6, 1, 8), dt.datetime(2021, 6, 1, 17)
    snap = scd2.snapshot_merge(scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], d1),
                                                   s2, "code", ["name"], d2), s3, "code", ["name"], d3)
    dim = scd2.versioned_dim(snap, "code", ["name"], key_col="key")
    assert sorted(r.name for r in dim.collect()) == ["v1", "v3"]


def test_point_in_time_boundaries(spark):
    dim, unk = dim_of(spark)
    facts = spark.createDataFrame([
        (1, "A", T2.date()),                        # on valid_to of version 1 -> version 2
        (2, "A", T2.date() - dt.timedelta(days=1)),  # last day of version 1
        (3, "A", dt.date(1990, 1, 1)),              # before the first run -> backdated version 1
        (4, "UNK", dt.date(2022, 1, 1)),
        (5, "Z", dt.date(2022, 1, 1)),              # code unknown to the dimension
    ], "id int, code string, d date")
    names = dim.select("key", "name")
    inner = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"]).join(names, "key")
    got = {r.id: r.name for r in inner.collect()}
    assert got == {1: "Alpha2", 2: "Alpha", 3: "Alpha", 4: "Unknown"}
    routed = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"], unknown=unk).join(names, "key")
    got = {r.id: r.name for r in routed.collect()}
    assert got == {1: "Alpha2", 2: "Alpha", 3: "Alpha", 4: "Unknown", 5: "Unknown"}
    # every (code, date) of a known code hits exactly one version
    assert inner.count() == 4


def test_pit_join_keeps_every_fact_row(spark):
    """Property: with routing to the unknown member, every fact row gets
    exactly one version, whatever its code or date."""
    from hypothesis import given, settings, strategies as st

    dim, unk = dim_of(spark)
    cases = []

    @settings(max_examples=60, deadline=None)
    @given(st.sampled_from(["A", "B", "UNK", "Z", None]),
           st.dates(min_value=dt.date(1901, 1, 1), max_value=dt.date(9998, 12, 30)))
    def collect(code, day):
        cases.append((len(cases), code, day))

    collect()
    facts = spark.createDataFrame(cases, "id int, code string, d date")
    out = scd2.point_in_time_join(facts, dim, "code", "d", "code", ["key"], unknown=unk)
    ids = [r.id for r in out.collect()]
    assert sorted(ids) == list(range(len(cases)))


def test_merge_idempotent_property(spark):
    from hypothesis import given, settings, strategies as st

    releases = []

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.sampled_from(["x", "y", None])),
                    min_size=0, max_size=4, unique_by=lambda t: t[0]),
           st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.sampled_from(["x", "y", None])),
                    min_size=0, max_size=4, unique_by=lambda t: t[0]))
    def collect(r1, r2):
        releases.append((r1, r2))

    collect()
    for r1, r2 in releases:
        s1 = spark.createDataFrame([(k, v, "p") for k, v in r1], SRC)
        s2 = spark.createDataFrame([(k, v, "p") for k, v in r2], SRC)
        snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], T1), s2, "code", ["name"], T2)
        snap = spark.createDataFrame(snap.collect(), snap.schema)
        again = scd2.snapshot_merge(snap, s2, "code", ["name"], T3)
        assert snap_rows(again) == snap_rows(snap)
        # exactly one open version per key ever seen
        opened = [r for r in snap.collect() if r.valid_to_ts is None]
        assert sorted(r.code for r in opened) == sorted({k for k, _ in r1} | {k for k, _ in r2})


def test_merge_with_column_drift(spark):
    s1 = spark.createDataFrame([("A", "Alpha", "gone")], "code string, name string, old_col string")
    s2 = spark.createDataFrame([("A", "Alpha2", "new"), ("B", "Beta", "new")], "code string, name string, new_col string")
    snap = scd2.snapshot_merge(scd2.snapshot_merge(None, s1, "code", ["name"], T1), s2, "code", ["name"], T2)
    assert set(snap.columns) == {"code", "name", "old_col", "new_col", scd2.VALID_FROM_TS, scd2.VALID_TO_TS}
    rows = sorted((r.code, r.name, r.old_col, r.new_col, r.valid_to_ts is None) for r in snap.collect())
    assert rows == [("A", "Alpha", "gone", None, False), ("A", "Alpha2", None, "new", True),
                    ("B", "Beta", None, "new", True)]


def test_merge_keeps_null_keys_and_rejects_repeated_ones(spark):
    import datetime as dt

    import pytest
    src = spark.createDataFrame([(None, "a"), ("x", "b")], "code string, name string")
    one = scd2.snapshot_merge(None, src, "code", ["name"], dt.datetime(2020, 1, 1))
    two = scd2.snapshot_merge(one, src, "code", ["name"], dt.datetime(2021, 1, 1))
    assert sorted((r.code or "", r.name, r.valid_to_ts) for r in two.collect()) == [("", "a", None), ("x", "b", None)]
    twice = src.union(src)
    assert {(r.code, r.n) for r in scd2.repeated_keys(twice, "code").collect()} == {(None, 2), ("x", 2)}
    with pytest.raises(Exception, match="more than once"):
        scd2.snapshot_merge(one, twice, "code", ["name"], dt.datetime(2022, 1, 1)).collect()


def _apply(spark, state, extracts, run, **kw):
    release = extracts.filter(F.col("run_ts") == F.lit(run)).drop("run_ts")
    state = scd2.release_merge(state, release, "code", ["name"], run, **kw)
    return spark.createDataFrame(state.collect(), state.schema)     # cut the plan between runs


def test_releases_in_any_order_give_the_history(spark):
    for seed in range(3):
        rng = random.Random(seed)
        runs = [dt.datetime(2020 + i, 1, 1) for i in range(6)]
        rows = [(f"K{k}" if k else None, rng.choice(["a", "b", None]), f"p{r.year}" if rng.random() < 0.8 else None, r)
                for r in runs for k in range(25) if rng.random() < 0.7]
        extracts = spark.createDataFrame(rows, "code string, name string, passive string, run_ts timestamp")
        order = runs[:]
        rng.shuffle(order)
        state = None
        for run in [*order, order[1]]:                              # the last one is delivered twice
            state = _apply(spark, state, extracts, run)
        history = scd2.snapshot_history(extracts, "code", ["name"], "run_ts")
        assert snap_rows(scd2.snapshot_of(state)) == snap_rows(history)
        sights = {(r.code, x.run_ts, x.passive.passive) for r in state.collect() for x in r.seen}
        assert sights == {(c, r, p) for c, _, p, r in rows}


def test_a_late_release_splits_joins_and_extends(spark):
    def state_of(*releases):
        state = None
        for run, name in releases:
            release = spark.createDataFrame([("A", name, f"p{run.year}")], SRC)
            state = scd2.release_merge(state, release, "code", ["name"], run)
        return snap_rows(scd2.snapshot_of(state))
    assert state_of((T1, "x"), (T3, "x"), (T2, "y")) == [
        ("A", "x", "p2021", T1, T2), ("A", "x", "p2023", T3, None), ("A", "y", "p2022", T2, T3)]
    assert state_of((T1, "x"), (T3, "y"), (T2, "y")) == [("A", "x", "p2021", T1, T2), ("A", "y", "p2022", T2, None)]
    assert state_of((T2, "x"), (T1, "x")) == [("A", "x", "p2021", T1, None)]
    assert state_of((T2, "x"), (T1, "y")) == [("A", "x", "p2022", T2, None), ("A", "y", "p2021", T1, T2)]


def test_late_release_with_repeated_keys_new_columns_and_no_rows(spark):
    one = scd2.release_merge(None, spark.createDataFrame([("A", "x", "p")], SRC), "code", ["name"], T2)
    wider = spark.createDataFrame([("A", "x", 5), ("B", "z", None)], "code string, name string, extra int")
    two = scd2.release_merge(one, wider, "code", ["name"], T1)
    assert sorted((r.code, r.passive, r.extra, r.valid_from_ts) for r in two.collect()) == [("A", None, 5, T1), ("B", None, None, T1)]
    three = scd2.release_merge(two, wider.limit(0), "code", ["name"], T3)
    assert sorted(map(str, three.collect())) == sorted(map(str, two.collect()))
    twice = spark.createDataFrame([("A", "x", "p"), ("A", "y", "p")], SRC)
    with pytest.raises(Exception, match="more than once"):
        scd2.release_merge(one, twice, "code", ["name"], T3).collect()
