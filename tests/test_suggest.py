import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import suggest


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(mine, official, most):
    found = set()
    for m in {m for m in mine if m is not None}:
        near = sorted((d, o, c) for o, c in {(o, c) for o, c in official if o is not None} if (d := edits(m, o)) <= most)
        first, after = near[0] if near else (None, None, None), near[1][0] if len(near) > 1 else None
        found.add((m, first[1], first[2], first[0], after, bool(near) and (after is None or first[0] < after)))
    return found


@pytest.mark.parametrize("most", [1, 2, 3])
def test_equals_comparing_all_names(spark, most):
    rng = random.Random(most)
    word = lambda n: "".join(rng.choice("ABCÉ ") for _ in range(n))
    official = [(word(rng.randint(0, 14)), f"c{i % 40}") for i in range(60)] + [(None, "x"), ("ADELAIDE PLAINS", "a"), ("ADELAIDE PLAINS", "b"),
                                                                                 ("AAAAAAAAAAAA", "r"), ("UNLEY", "u")]
    mine = [None, "", "UNLEY", "UNLY", "ADELAID PLAINS", "AAAAAAAAAA", "NOTHING LIKE IT AT ALL"]
    for name, _ in official[:40]:
        name = list(name)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(name))
            name[at:at + rng.randint(0, 1)] = rng.choice(["", "A", "X"])
        mine.append("".join(name))
    got = suggest.suggest_names(spark.createDataFrame([(m,) for m in mine * 2], "n string"), spark.createDataFrame(official, "o string, c string"),
                                "n", "o", "c", max_edits=most)
    assert set(map(tuple, got.collect())) == brute(mine, official, most) and got.count() == len(set(mine)) - 1


def test_no_cross_join_and_empty_tables(spark):
    names = spark.createDataFrame([("UNLEY", "1"), ("BURNSIDE", "2")], "n string, c string")
    plan = suggest.suggest_names(names, names, "n", "n", "c")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert suggest.suggest_names(names.limit(0), names, "n", "n", "c").count() == 0
    alone = suggest.suggest_names(names, names.limit(0), "n", "n", "c").collect()
    assert {(r.source_name, r.suggestion, r.clear) for r in alone} == {("UNLEY", None, False), ("BURNSIDE", None, False)}


def test_long_names_and_names_beside_them(spark):
    rng = random.Random(9)
    official = [("".join(rng.choice("ABCD ") for _ in range(n)), f"c{n}") for n in [*range(27, 40)] * 2]
    mine = []
    for name, _ in official * 2:
        name = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(name))
            name[at:at + rng.randint(0, 1)] = rng.choice(["", "A", "X"])
        mine.append("".join(name))
    got = suggest.suggest_names(spark.createDataFrame([(m,) for m in mine], "n string"), spark.createDataFrame(official, "o string, c string"),
                                "n", "o", "c")
    assert set(map(tuple, got.collect())) == brute(mine, official, 2)


def test_meetings_grow_with_the_names_and_not_with_their_square(spark):
    def meetings(n):
        rng = random.Random(5)
        words = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(6)) for _ in range(n)]
        names = spark.createDataFrame([(f"{a} {b}",) for a in words for b in words], "name string")
        rank = names.select(F.explode(suggest._grams(F.col("name"))).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
        return suggest._keys(names, rank, 2).groupBy("key").count().selectExpr("sum(count * count)").first()[0] / n ** 2
    assert meetings(40) < 1.5 * meetings(10)


def test_exploded_keys_are_not_broadcast(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("ABCDEFGH") for _ in range(n)) for n in [12] * 300 + [40] * 300]
    official = spark.createDataFrame([(n, "c") for n in names], "o string, c string")
    found = suggest.suggest_names(spark.createDataFrame([(n[1:],) for n in names], "n string"), official, "n", "o", "c", max_edits=1)
    assert {(r.source_name, r.suggestion) for r in found.collect() if r.clear} >= {(n[1:], n) for n in names if len(n) == 40}
    plan = found._jdf.queryExecution().executedPlan().toString()                    # the final one, as it ran
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[key#\d+L?\], \[key#\d+L?\], (\w+)(?:, (\w+))?", plan.split("Initial Plan")[0])
    assert ("SortMergeJoin", "Inner") in [j[:2] for j in joins]
    assert {j for j in joins if j[0] == "BroadcastHashJoin"} <= {("BroadcastHashJoin", "LeftOuter", "BuildRight")}
