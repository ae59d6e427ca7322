"""Type-2 history: snapshot merge, versioned dimension, point-in-time join.

Layout of a snapshot table: the business key, the tracked (``check``) columns,
any passive columns, and two timestamps ``valid_from_ts`` / ``valid_to_ts``
(``valid_to_ts`` NULL while the version is open).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.columns import surrogate_key

VALID_FROM_TS = "valid_from_ts"
VALID_TO_TS = "valid_to_ts"

# The open interval of a dimension and its unknown member.
BEGINNING_OF_TIME = _dt.date(1900, 1, 1)
END_OF_TIME = _dt.date(9999, 12, 31)
UNKNOWN_CODE = "UNK"
UNKNOWN_NAME = "Unknown"


def _ts(value) -> Column:
    """Run timestamp as a Column; Python values are read in the session time
    zone (not the driver machine's)."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def repeated_keys(source: DataFrame, key: str) -> DataFrame:
    """Keys (NULL included) that more than one row of an extract has, with the number of rows."""
    return source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _one_per_key(source: DataFrame, key: str) -> DataFrame:
    """``source``, failing at run time on a repeated key (combined before the
    shuffle; the merge's join reuses the partitioning)."""
    grouped = source.groupBy(F.col(key).alias("__key")).agg(
        F.first(F.struct(*source.columns)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    repeated = F.concat(F.lit(f"source holds key {key} = "), F.coalesce(F.col("__key").cast("string"), F.lit("NULL")),
                        F.lit(" more than once"))
    checked = F.when(F.col("__n") > 1, F.raise_error(repeated).cast(source.schema.simpleString())).otherwise(F.col("__row"))
    return grouped.select(checked.alias("__row")).select("__row.*")


def snapshot_merge(current: DataFrame | None, source: DataFrame, key: str,
                   check_cols: Sequence[str], run_ts, invalidate_deleted: bool = False) -> DataFrame:
    """One run of a check-strategy type-2 snapshot.

    * key only in ``source``: a new open version starting at ``run_ts``;
    * key in both, a check column differs (NULL-safe): the open version is
      closed at ``run_ts`` and a new one opens;
    * key in both, unchanged: the stored version is kept as it is (passive
      columns are *not* refreshed, as in a check-strategy snapshot);
    * key only in the snapshot (deleted at source): kept open, or closed at
      ``run_ts`` when ``invalidate_deleted``.

    A NULL key is a key like any other (keys meet NULL-safe), so its row is
    stored once and kept. A key that the source holds more than once has no
    defined version: the merge fails with its value when it is run
    (``repeated_keys`` lists such keys beforehand).

    Closed history never takes part in the join; only open versions meet the
    source, in one full outer join on ``key`` (both sides hold one row per key,
    so no key can be skewed). Each joined row emits one or two versions through
    a single ``explode`` instead of a union of two passes over the join.
    Returns a new snapshot; the caller writes it to a *new* location (Spark
    cannot overwrite a table it is reading).
    """
    if key not in source.columns:
        raise ValueError(f"key {key!r} not in source columns {source.columns}")
    run = _ts(run_ts)
    source = _one_per_key(source, key)
    if current is None:
        return source.select(*source.columns, run.alias(VALID_FROM_TS),
                             F.lit(None).cast("timestamp").alias(VALID_TO_TS))

    # Column drift between runs: the snapshot keeps the union of columns; a
    # new source column is NULL on older versions, a dropped one is NULL on
    # versions opened from now on.
    kept = [c for c in current.columns if c not in (VALID_FROM_TS, VALID_TO_TS)]
    cols = list(source.columns) + [c for c in kept if c not in source.columns]

    def from_current(c):
        return F.col(c) if c in current.columns else F.lit(None).cast(source.schema[c].dataType)

    def from_source(c):
        return F.col(c) if c in source.columns else F.lit(None).cast(current.schema[c].dataType)

    history = current.filter(F.col(VALID_TO_TS).isNotNull()).select(
        *[from_current(c).alias(c) for c in cols], VALID_FROM_TS, VALID_TO_TS)
    open_rows = current.filter(F.col(VALID_TO_TS).isNull()).select(
        *[from_current(c).alias(c) for c in cols], VALID_FROM_TS)

    o = open_rows.select(*[F.col(c).alias(f"o__{c}") for c in open_rows.columns], F.lit(True).alias("o__present"))
    s = source.select(*[from_source(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__present"))
    j = o.join(s, F.col(f"o__{key}").eqNullSafe(F.col(f"s__{key}")), "full_outer")

    in_old = F.col("o__present").isNotNull()
    in_new = F.col("s__present").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"o__{c}").eqNullSafe(F.col(f"s__{c}"))
    changed = in_old & in_new & ~same
    deleted = in_old & ~in_new

    close_old = changed | deleted if invalidate_deleted else changed
    old_version = F.struct(
        *[F.col(f"o__{c}").alias(c) for c in cols],
        F.col(f"o__{VALID_FROM_TS}").alias(VALID_FROM_TS),
        F.when(close_old, run).otherwise(F.lit(None).cast("timestamp")).alias(VALID_TO_TS),
    )
    new_version = F.struct(
        *[F.col(f"s__{c}").alias(c) for c in cols],
        run.alias(VALID_FROM_TS),
        F.lit(None).cast("timestamp").alias(VALID_TO_TS),
    )
    versions = F.array(
        F.when(in_old, old_version),
        F.when(in_new & (~in_old | changed), new_version),
    )
    merged = (j.select(F.explode(versions).alias("v"))
              .filter(F.col("v").isNotNull())
              .select("v.*"))
    return history.unionByName(merged)


def snapshot_history(extracts: DataFrame, key: str, check_cols: Sequence[str], run_col: str) -> DataFrame:
    """The snapshot left by replaying many full extracts in run order.

    ``extracts`` stacks every extract, ``run_col`` holding its run timestamp
    (at most one row per key and run). The result equals running
    ``snapshot_merge`` once per run in order (deleted keys stay open), but is
    computed in one pass: a key opens a version at its first appearance and
    at every appearance whose tracked values differ (NULL-safe) from its
    previous appearance; a version ends where the key's next version starts.
    Passive columns come from the row that opened the version. One shuffle by
    key; each key's rows are ordered by run inside its partition.
    """
    w = Window.partitionBy(key).orderBy(F.col(run_col).asc())
    tracked = F.struct(*[F.col(c) for c in check_cols])
    flagged = extracts.select(
        "*", F.row_number().over(w).alias("__rn"), F.lag(tracked).over(w).alias("__prev"))
    starts = flagged.filter((F.col("__rn") == 1) | ~tracked.eqNullSafe(F.col("__prev")))
    out_cols = [c for c in extracts.columns if c != run_col]
    return starts.select(*out_cols, F.col(run_col).cast("timestamp").alias(VALID_FROM_TS),
                         F.lead(F.col(run_col)).over(w).cast("timestamp").alias(VALID_TO_TS))


SEEN = "seen"


def release_merge(state: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str], run_ts) -> DataFrame:
    """One release into a snapshot, whatever its run time is against those that came before.

    ``state`` is a snapshot with one more column, ``seen``: for each version
    the runs that showed it, with the passive columns they had. With it a late
    release finds its place: the stored interval that holds ``run_ts`` is kept
    (same tracked values), ends there, or is split in two around the late
    version, the second part starting at the first later run that showed the
    old values again; a late version that equals the next one is put together
    with it. Releases in any order so give the table of ``snapshot_history``
    over all of them, passive columns included (keys missing from a release
    stay as they are). ``snapshot_of`` drops ``seen``.

    A key that the release holds more than once fails the merge; a NULL key is
    a key. A key that has already been shown at ``run_ts`` keeps its first
    row, so a release that is delivered twice changes nothing. Columns may be
    added or dropped between releases (NULL where a row has no value).

    One full outer join on the key. A version only looks at its neighbours in
    its key (at most one version per release), so the touched versions are
    rewritten in place and no other state is needed.
    """
    if key not in source.columns:
        raise ValueError(f"key {key!r} not in source columns {source.columns}")
    run = _ts(run_ts)
    source = _one_per_key(source, key)
    stored = [] if state is None else [c for c in state.columns if c not in (VALID_FROM_TS, VALID_TO_TS, SEEN)]
    cols = list(source.columns) + [c for c in stored if c not in source.columns]
    kinds = {c: (source if c in source.columns else state).schema[c].dataType for c in cols}
    passive = [c for c in cols if c != key and c not in check_cols]

    def row(of, at, **other):
        """The value columns of a version, from ``of``, and its passive columns, from ``at``."""
        return [(at(c) if c in passive else of(c)).cast(kinds[c]).alias(c) for c in cols]

    late = lambda c: F.col(f"l__{c}") if c in source.columns else F.lit(None)
    new = source.select(*[F.col(f"`{c}`").alias(f"l__{c}") for c in source.columns], F.lit(True).alias("l__here"))
    extra = F.struct(*[late(c).cast(kinds[c]).alias(c) for c in passive], F.lit(True).alias("_"))
    sight = F.struct(run.alias("run_ts"), extra.alias("passive"))
    if state is None:
        return new.select(*row(late, late), run.alias(VALID_FROM_TS), F.lit(None).cast("timestamp").alias(VALID_TO_TS),
                          F.array(sight).alias(SEEN))

    have = lambda c: F.col(f"v__{c}") if c in stored else F.lit(None)
    tracked = lambda get: F.struct(*[get(c).cast(kinds[c]).alias(c) for c in check_cols])
    shown = F.transform(F.col(SEEN), lambda x: F.struct(
        x["run_ts"].alias("run_ts"), F.struct(*[(x["passive"][c] if c in stored else F.lit(None)).cast(kinds[c]).alias(c)
                                                for c in passive], F.lit(True).alias("_")).alias("passive")))
    versions = state.select(*[F.col(f"`{c}`").alias(f"v__{c}") for c in stored], F.col(VALID_FROM_TS).alias("f"),
                            F.col(VALID_TO_TS).alias("t"), shown.alias("shown"))
    along = Window.partitionBy(f"v__{key}").orderBy("f")
    versions = (versions.withColumn("value", tracked(have))
                .withColumn("before", F.lag(F.struct("value", "f", F.element_at("shown", -1)["run_ts"].alias("last"))).over(along))
                .withColumn("after", F.lead("value").over(along)).withColumn("v__here", F.lit(True)))
    j = versions.join(new.withColumn("late", tracked(late)), F.col(f"v__{key}").eqNullSafe(F.col(f"l__{key}")), "full_outer")

    touched = F.col("v__here").isNotNull() & F.col("l__here").isNotNull()
    again = F.exists("shown", lambda x: x["run_ts"] == run)
    holds = touched & ~again & (F.col("f") <= run) & (F.col("t").isNull() | (run < F.col("t")))
    same = F.col("value").eqNullSafe(F.col("late"))
    earlier = F.filter("shown", lambda x: x["run_ts"] < run)
    later = F.filter("shown", lambda x: x["run_ts"] > run)
    # the version begins where the late row does: it has the same values, and nothing stands between them
    begins = touched & same & (run < F.col("f")) & (F.col("before").isNull() | (
        (F.col("before.f") <= run) & (F.col("before.last") < run) & ~F.col("before.value").eqNullSafe(F.col("late"))))
    first = touched & ~same & F.col("before").isNull() & (run < F.col("f"))

    def version(of, at, start, end, seen):
        return F.struct(*row(of, at), start.cast("timestamp").alias(VALID_FROM_TS), end.cast("timestamp").alias(VALID_TO_TS), seen.alias(SEEN))
    passive_of = lambda seen: lambda c: seen[0]["passive"][c]
    sights = F.array(sight)
    old, keep_end = (lambda s, e, seen: version(have, passive_of(seen), s, e, seen)), F.col("t")
    none = F.lit(None).cast("timestamp")
    shown_now = F.col("shown")
    late_until = lambda end: version(late, late, run, end, sights)
    out = F.when(F.col("v__here").isNull(), F.array(late_until(none)))
    out = out.when(holds & same, F.array(old(F.col("f"), keep_end, F.concat(earlier, sights, later))))
    out = out.when(holds & (F.size(later) > 0), F.array(
        old(F.col("f"), run, earlier), late_until(later[0]["run_ts"]), old(later[0]["run_ts"], keep_end, later)))
    out = out.when(holds & F.col("after").eqNullSafe(F.col("late")) & F.col("t").isNotNull(), F.array(old(F.col("f"), run, shown_now)))
    out = out.when(holds, F.array(old(F.col("f"), run, shown_now), late_until(keep_end)))
    out = out.when(begins, F.array(old(run, keep_end, F.concat(sights, shown_now))))
    out = out.when(first, F.array(late_until(F.col("f")), old(F.col("f"), keep_end, shown_now)))
    out = out.otherwise(F.array(old(F.col("f"), keep_end, shown_now)))
    return j.select(F.explode(out).alias("v")).select("v.*")


def snapshot_of(state: DataFrame) -> DataFrame:
    """The snapshot table of a ``release_merge`` state."""
    return state.drop(SEEN)


def unknown_member(code_col: str, name_cols: Sequence[str], key_col: str,
                   extra: Mapping[str, object] | None = None) -> dict[str, Column]:
    """Literal columns of the explicit unknown member of a versioned dimension."""
    out: dict[str, Column] = {
        key_col: surrogate_key([F.lit(UNKNOWN_CODE), F.lit(BEGINNING_OF_TIME.isoformat())]),
        code_col: F.lit(UNKNOWN_CODE),
    }
    for c in name_cols:
        out[c] = F.lit(UNKNOWN_NAME)
    for c, v in (extra or {}).items():
        out[c] = v if isinstance(v, Column) else F.lit(v)
    out["valid_from"] = F.lit(BEGINNING_OF_TIME)
    out["valid_to"] = F.lit(END_OF_TIME)
    out["is_current"] = F.lit(True)
    return out


def versioned_dim(snapshot: DataFrame, key: str, attrs: Sequence[str], key_col: str = "region_key",
                  derived: Mapping[str, Column] | None = None,
                  unknown: Mapping[str, Column] | None = None) -> DataFrame:
    """Type-2 dimension from a snapshot.

    ``version_number`` orders the versions of a key; version 1 is backdated to
    1900-01-01 so facts older than the first snapshot run still find a version;
    the open version ends 9999-12-31. Intervals are half-open
    ``[valid_from, valid_to)`` on dates; a version that starts and ends on the
    same day covers no date and is dropped. ``key_col`` hashes the business key
    with the version's start timestamp. ``unknown`` (see ``unknown_member``)
    adds the explicit unknown member.
    """
    w = Window.partitionBy(key).orderBy(F.col(VALID_FROM_TS).asc())
    ranked = snapshot.withColumn("version_number", F.row_number().over(w))
    cols = [
        surrogate_key([F.col(key), F.col(VALID_FROM_TS)]).alias(key_col),
        F.col(key),
        *[F.col(a) for a in attrs],
        *[c.alias(n) for n, c in (derived or {}).items()],
        F.when(F.col("version_number") == 1, F.lit(BEGINNING_OF_TIME))
         .otherwise(F.to_date(F.col(VALID_FROM_TS))).alias("valid_from"),
        F.coalesce(F.to_date(F.col(VALID_TO_TS)), F.lit(END_OF_TIME)).alias("valid_to"),
        F.col(VALID_TO_TS).isNull().alias("is_current"),
    ]
    versions = ranked.select(*cols).filter(F.col("valid_from") < F.col("valid_to"))
    if unknown is None:
        return versions
    spark = snapshot.sparkSession
    names = versions.columns
    one = spark.range(1).select(*[unknown[c].cast(versions.schema[c].dataType).alias(c) for c in names])
    return versions.unionByName(one)


def point_in_time_join(fact: DataFrame, dim: DataFrame, fact_code: Column | str, event_date: Column | str,
                       dim_code: str, dim_cols: Sequence[str], unknown: Mapping[str, Column] | None = None,
                       salt_buckets: int = 0) -> DataFrame:
    """Attach the dimension version in force on the event date.

    Match = ``dim_code == fact_code`` and ``valid_from <= date < valid_to``.

    * ``unknown`` None: inner join, as a fact whose code was already routed to
      the unknown member (``coalesce(code, 'UNK')``).
    * ``unknown`` given: left join; a row that finds no version takes the
      unknown member's values. For a dimension built by ``versioned_dim`` the
      versions of a code tile 1900-01-01..9999-12-31, so "no version" means
      "code unknown to the dimension", which is exactly the rows the inner
      form would route to ``UNK`` beforehand, with one join instead of two. The
      forms differ for a row whose event date is NULL: the inner form drops it,
      the left form sends it to the unknown member.

    The equi part (code) drives the plan: a broadcast hash join when the
    dimension is small (AQE decides from the measured size), else a sort-merge
    join on code, where AQE splits a hot code (e.g. ``UNK``) across tasks. It
    can do so only if both sides are shuffled for the join; a dimension that is
    already partitioned by its code (straight from a window) has no exchange,
    so pass ``salt_buckets`` of 2 or more for it. The date range is a residual
    predicate on the matched pairs.

    ``salt_buckets > 1`` spreads every code over that many join keys without
    relying on AQE: each fact row gets a salt from a hash of its own columns
    (deterministic, so a retried task sees the same salt) and each dimension
    row is repeated once per salt. A hot code then lands in ``salt_buckets``
    tasks; the dimension grows by that factor, which is cheap because it holds
    a few versions per code. Results are identical.
    """
    code = F.col(fact_code) if isinstance(fact_code, str) else fact_code
    d = F.col(event_date) if isinstance(event_date, str) else event_date
    wanted = list(dict.fromkeys([*dim_cols]))
    dsel = dim.select(F.col(dim_code).alias("__dim_code"), F.col("valid_from").alias("__vf"),
                      F.col("valid_to").alias("__vt"), *[F.col(c).alias(f"__d_{c}") for c in wanted])
    f = fact.withColumn("__code", code).withColumn("__date", d.cast("date"))
    if unknown is not None and isinstance(f.schema["__code"].dataType, T.StringType):
        # a NULL code can only end at the unknown member; giving it that code
        # keeps NULL keys from piling up in one shuffle partition (numeric
        # codes keep NULL, and AQE splits that partition if it is large)
        f = f.withColumn("__code", F.coalesce(F.col("__code"), F.lit(UNKNOWN_CODE)))
    cond = ((F.col("__code") == F.col("__dim_code")) & (F.col("__date") >= F.col("__vf"))
            & (F.col("__date") < F.col("__vt")))
    if salt_buckets > 1:
        f = f.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets)))
        dsel = dsel.withColumn("__dsalt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                               F.lit(salt_buckets - 1).cast("long"))))
        cond = cond & (F.col("__salt") == F.col("__dsalt"))
    if unknown is None:
        j = f.join(dsel, cond, "inner")
        picked = [F.col(f"__d_{c}").alias(c) for c in wanted]
    else:
        j = f.join(dsel, cond, "left")
        hit = F.col("__dim_code").isNotNull()
        picked = [F.when(hit, F.col(f"__d_{c}")).otherwise(unknown[c]).alias(c) for c in wanted]
    keep = [c for c in fact.columns if c not in wanted]
    return j.select(*[F.col(c) for c in keep], *picked)
