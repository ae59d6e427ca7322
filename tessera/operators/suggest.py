"""Suggestions for names that no conformance rule resolves.

The best official name within a few edits, with how far it is ahead of the next
one; a person decides, nothing is applied. Pairs are found by shared pieces and
not by comparing all names with all names: two names within ``d`` edits share
a form with at most ``d`` letters deleted from each, so these forms are the join
keys: few names share one, however many names there are. Names of over
``LONGEST`` letters, which have too many forms, share one of their ``q * d + 1``
rarest q-grams instead. Distances are tried one by one, and a name that has two
suggestions looks no further. The exact distance decides; nothing is left out
that could be among the first two.

Spark takes a table of exploded keys to be as large as the names that it comes
from, so it would be sent whole through the driver although it has some fifty
rows for each name: no join here broadcasts one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpointed

LONGEST = 32                # letters of a name that meets others by its forms
Q = 2                       # letters of a gram; names are padded, so a name of n letters has n + 1


def _grams(name: Column) -> Column:
    """The numbered q-grams of a padded name: the second ``AN`` of a name is another gram than its first."""
    padded = F.concat(F.lit("\x01" * (Q - 1)), name, F.lit("\x02" * (Q - 1)))
    cut = F.transform(F.sequence(F.lit(1), F.length(padded) - (Q - 1)), lambda i: F.substring(padded, i, F.lit(Q)))
    return F.transform(cut, lambda g, i: F.concat(g, F.lit("\x03"), F.size(F.filter(F.slice(cut, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def _deleted(name: Column, edits: int) -> Column:
    """All forms of a name with up to ``edits`` letters deleted."""
    forms = F.array(name)
    for _ in range(edits):
        shorter = F.flatten(F.transform(forms, lambda f: F.when(F.length(f) > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(f), F.lit(1))),
            lambda i: F.concat(F.substring(f, F.lit(1), i - 1), F.substring(f, i + 1, F.length(f))))).otherwise(F.array().cast("array<string>"))))
        forms = F.array_distinct(F.concat(forms, shorter))
    return F.transform(forms, lambda f: F.concat(F.lit("\x04"), f))


def _forms(names: DataFrame, edits: int) -> DataFrame:
    """``name, key``: the hashes of a name's forms. A pair with a name within ``edits`` of ``LONGEST`` letters meets here."""
    short = names.filter(F.length("name") <= LONGEST + edits)
    return short.select("name", F.explode(F.transform(_deleted(F.col("name"), edits), lambda f: F.xxhash64(f))).alias("key"))


def _rare_grams(names: DataFrame, rank: DataFrame, edits: int) -> DataFrame:
    """``name, key``: the hashes of the rarest grams of a long name. ``rank`` has every gram; in a left join only it can be broadcast."""
    grams = names.filter(F.length("name") > LONGEST).select("name", F.explode(_grams(F.col("name"))).alias("key")).join(rank, "key", "left")
    rarest = grams.groupBy("name").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "key"))), 1, Q * edits + 1).alias("g"))
    return rarest.select("name", F.explode(F.transform("g", lambda g: F.xxhash64(g["key"]))).alias("key"))


def _keys(names: DataFrame, rank: DataFrame, edits: int) -> DataFrame:
    """``name, key``: what a name meets others within ``edits`` by."""
    return _forms(names, edits).unionByName(_rare_grams(names, rank, edits))


def suggest_names(unmatched: DataFrame, official: DataFrame, name_col: str, official_col: str, code_col: str,
                  max_edits: int = 2) -> DataFrame:
    """For every distinct unmatched name the nearest official one within ``max_edits``.

    Returns ``source_name, suggestion, code, edits, next_edits, clear``: the
    official name with the fewest edits (ties: first by name, then code), the
    edits of the next best one (NULL if none is within reach), and whether the
    suggestion is strictly nearer than that. Names without any suggestion are
    listed with NULLs; NULL names are left out. An official name with two codes
    is two candidates, so it is never clear.

    Candidates are distinct pairs of names that share a key; with ``edits`` of
    them tried, only names with fewer than two candidates go on to the next.
    """
    if Q * max_edits + 1 > LONGEST:
        raise ValueError(f"max_edits must be under {LONGEST / Q}")
    mine = unmatched.select(F.col(name_col).cast("string").alias("name")).filter("name is not null").distinct()
    theirs = official.select(F.col(official_col).cast("string").alias("name"), F.col(code_col).cast("string").alias("code")).filter(
        "name is not null").distinct()
    mine, theirs = checkpointed(mine), checkpointed(theirs)
    names = theirs.select("name").distinct()
    long = mine.unionByName(names).filter(F.length("name") > LONGEST)
    rank = long.select(F.explode(_grams(F.col("name"))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    best, open_names = None, mine
    for edits in range(1, max_edits + 1) if max_edits else [0]:
        a = _keys(open_names, rank, edits).withColumnRenamed("name", "source_name")
        b = _keys(names, rank, edits).withColumnRenamed("name", "suggestion")
        near = F.abs(F.length("source_name") - F.length("suggestion")) <= edits
        pairs = a.join(b.hint("merge"), "key").filter(near).select("source_name", "suggestion").distinct()
        pairs = pairs.withColumn("edits", F.levenshtein("source_name", "suggestion", edits)).filter("edits >= 0")
        found = _best_two(pairs.join(theirs.withColumnRenamed("name", "suggestion"), "suggestion"))
        if edits < max_edits:
            found = checkpointed(found)
            done = found.filter("next_edits is not null")
            open_names = open_names.join(done.select(F.col("source_name").alias("name")), "name", "left_anti")
            found = done
        best = found if best is None else best.unionByName(found)
    found = mine.select(F.col("name").alias("source_name")).join(best, "source_name", "left")
    return found.withColumn("clear", F.col("edits").isNotNull() & (F.col("next_edits").isNull() | (F.col("edits") < F.col("next_edits"))))


def _best_two(pairs: DataFrame) -> DataFrame:
    """Of the candidates of each source name the first, and the edits of the second."""
    order = Window.partitionBy("source_name").orderBy("edits", "suggestion", "code")
    two = pairs.withColumn("place", F.row_number().over(order)).filter("place <= 2")
    pick = lambda c, place: F.max(F.when(F.col("place") == place, F.col(c)))
    return two.groupBy("source_name").agg(pick("suggestion", 1).alias("suggestion"), pick("code", 1).alias("code"),
                                          pick("edits", 1).alias("edits"), pick("edits", 2).alias("next_edits"))
