from tessera.operators import quality as Q


def card(df):
    return sorted((r.table_name, r.check_name, r.column_name, r.violations) for r in df.collect())


def test_scorecard_null_rules(spark):
    t = spark.createDataFrame([(1, "a", 5, "x"), (1, None, 50, "y"), (None, "c", None, "x"), (None, "c", 7, "z")],
                              "k int, s string, v int, g string")
    parent = spark.createDataFrame([(1,)], "k int")
    sc = Q.scorecard([("t", t, [
        Q.NotNull("k"), Q.Unique("k"), Q.UniqueCombination(["k", "s"]), Q.AcceptedValues("s", ["a", "c"]),
        Q.Between("v", 0, 10), Q.Between("v", 6, None, row_condition="g = 'x'"), Q.MaxBetween("v", 0, 10),
        Q.RowCountBetween(1, 3), Q.Relationship("k", parent, "k")])])
    assert card(sc) == sorted([
        ("t", "not_null", "k", 2),               # NULL fails
        ("t", "unique", "k", 1),                 # NULLs ignored, 1 duplicated
        ("t", "unique_combination", "k,s", 1),   # NULLs group together: (None, c) twice
        ("t", "accepted_values", "s", 0),        # NULL passes
        ("t", "between", "v", 1),                # 50 fails, NULL passes
        ("t", "between", "v", 1),                # only rows with g = x: 5 < 6 fails
        ("t", "max_between", "v", 1),
        ("t", "row_count_between", "*", 1),
        ("t", "relationships", "k", 0),          # NULL child passes
    ])


def test_reconcile_zero_preserving(spark):
    parents = spark.createDataFrame([("r1", 2), ("r2", 0), ("r3", 1), ("r4", None)], "id string, total int")
    kids = spark.createDataFrame([("r1",), ("r1",), ("r3",), ("r3",)], "id string")
    bad = Q.reconcile(parents, kids, "id", "total")
    assert sorted((r.id, r.total, r.observed) for r in bad.collect()) == [("r3", 1, 2)]


def test_coverage_gaps(spark):
    a = spark.createDataFrame([(2020,), (2021,), (2021,), (2024,)], "year int")
    b = spark.createDataFrame([(2020,), (2021,)], "year int")
    assert [r.year for r in Q.coverage_gaps(a, b, "year").collect()] == [2024]


def test_coverage_gap_reports_null(spark):
    a = spark.createDataFrame([(2020,), (None,)], "year int")
    b = spark.createDataFrame([(2020,), (None,)], "year int")
    assert [r.year for r in Q.coverage_gaps(a, b, "year").collect()] == [None]


def test_uniqueness_checks_of_a_table_are_one_exchange(spark):
    t = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, "a", 5), (None, "b", 5), (None, "b", 5), (3, None, 7), (4, None, 7)],
                              "k int, s string, v int")
    checks = [Q.Unique("k"), Q.Unique("s"), Q.UniqueCombination(["k", "s"]), Q.UniqueCombination(["s", "k", "v"]),
              Q.UniqueCombination(["s"]), Q.UniqueCombination(["s", "v"])]
    sc = Q.scorecard([("t", t, checks)])
    plan = sc._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand [") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert card(sc) == sorted([("t", "unique", "k", 1), ("t", "unique", "s", 2), ("t", "unique_combination", "k,s", 2),
                               ("t", "unique_combination", "s,k,v", 1), ("t", "unique_combination", "s", 3),
                               ("t", "unique_combination", "s,v", 3)])
    assert [r.violations for r in Q.scorecard([("t", t.limit(0), checks)]).collect()] == [0] * 6
