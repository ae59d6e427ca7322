"""Loading and keeping history, over the shared test tables: rejects, late releases, overlaps, partial reloads.

Each ``qNN_*`` function takes ``(spark, sf_dir)`` and reads whole tables;
``ORACLES`` holds the same queries in DuckDB SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import intervals, profile, rejects, report, scd2, suggest
from tessera.plans import oracle_sql as base
from tessera.plans import star_queries as sq
from tessera.session import ensure_checkpoint_dir, stored
from tessera.sources import bronze, colocated, refresh

# Fixed values of the test scenario (parameters, not data subsets).
KNOWN_STATUS = ("F", "O")
KNOWN_FLAGS = ("A", "R")
CHANGED_FROM = 2000                                 # first year that the second load of the report's orders changes
BIG_SPENDER = 400000                                # yearly order value above which a customer is a big one
ARCHIVED_YEAR, SETTLED_YEAR = 1995, 1997            # what differs between the two loads of the reload query


def order_rules() -> list[rejects.Rule]:
    return [rejects.number("order_key", "o_orderkey", "bigint", required=True), rejects.number("customer_id", "o_custkey", "bigint"),
            rejects.number("total_price", "o_totalprice", "decimal(7,2)"), rejects.moment("order_date", "o_orderdate", kind="date"),
            rejects.code_before("priority_code", "o_orderpriority", "-"), rejects.one_of("order_status", "o_orderstatus", KNOWN_STATUS),
            rejects.matching("priority_label", "o_orderpriority", r"^\d-[A-Z]+\z")]


def line_rules() -> list[rejects.Rule]:
    return [rejects.number("order_key", "l_orderkey", "bigint", required=True), rejects.number("line_number", "l_linenumber"),
            rejects.number("quantity", "l_quantity", "decimal(4,2)"), rejects.number("extended_price", "l_extendedprice", "decimal(6,2)"),
            rejects.moment("ship_date", "l_shipdate", kind="date"), rejects.one_of("return_flag", "l_returnflag", KNOWN_FLAGS)]


def text_landing(spark, sf_dir, name: str, money: dict[str, str]) -> DataFrame:
    """A table as landed text; ``money`` are the columns that are written as decimals."""
    t = sq._t(spark, sf_dir, name)
    return bronze.land_text(t.select(*[F.col(c).cast(money[c]).alias(c) if c in money else F.col(c) for c in t.columns]),
                            f"{name}.parquet", with_timestamp=False)


@sq._query
def q26_rejects(spark, sf_dir):
    """Strict typing of the landed orders and line items, with the rejected cells by column and rule, and the
    rows read, typed and rejected (B3, B4)."""
    two = "decimal(18,2)"
    tables = [("orders", text_landing(spark, sf_dir, "orders", {"o_totalprice": two}), order_rules()),
              ("lineitem", text_landing(spark, sf_dir, "lineitem", {"l_extendedprice": two, "l_quantity": two}), line_rules())]
    parts = [rejects.summary(rejects.route(raw, rules)).select(F.lit(name).alias("table_name"), "*") for name, raw, rules in tables]
    both = parts[0].unionByName(parts[1])
    return both.select("table_name", F.col("column").alias("column_name"), "rule", F.col("cells").cast("long").alias("cells"))


@sq._query
def q27_late_releases(spark, sf_dir):
    """All yearly releases merged out of order, every second one late, into the history that they have in order."""
    given = sq.releases(spark, sf_dir)
    state = None
    for run, release in [*given[1::2], *given[0::2][::-1]]:
        state = stored(scd2.release_merge(state, release, "customer_id", ["priority"], run), "state")
    return sq.snapshot_rows(scd2.snapshot_of(state))


def spending_history(spark, sf_dir) -> DataFrame:
    """Versions of whether a customer's orders of a year came to more than ``BIG_SPENDER``."""
    o = sq._t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    years = o.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum(sq._money("o_totalprice")).alias("spent"))
    runs = years.select(F.col("o_custkey").alias("customer_id"), (F.col("spent") > BIG_SPENDER).alias("big_spender"),
                        F.make_timestamp(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("run_ts"))
    s = scd2.snapshot_history(runs, "customer_id", ["big_spender"], "run_ts")
    return s.select("customer_id", "big_spender", F.to_date(scd2.VALID_FROM_TS).alias("valid_from"),
                    F.to_date(scd2.VALID_TO_TS).alias("valid_to"))


@sq._query
def q28_overlapping_histories(spark, sf_dir):
    """Two histories of the customers, priority and spending, joined where their versions overlap."""
    versions = sq.customer_versions(spark, sf_dir).filter("customer_id is not null").select(
        "customer_id", "customer_code", "priority", "valid_from", "valid_to")
    return intervals.overlap_join(versions, spending_history(spark, sf_dir), ["customer_id"], salt_buckets=2)


@sq._query
def q29_partition_refresh(spark, sf_dir):
    """Orders by year loaded twice, a year archived and one settled in between: what the second load does to each
    partition, and the rows of the table afterwards (A7, A14)."""
    o = sq._t(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orders-by-year-{uuid.uuid4().hex}"
    refresh.refresh_partitions(o, path, ["year"])
    settled = (F.col("year") == SETTLED_YEAR) & (F.col("o_orderstatus") == "P")
    later = o.filter(F.col("year") != ARCHIVED_YEAR).withColumn(
        "o_orderstatus", F.when(settled, F.lit("O")).otherwise(F.col("o_orderstatus")))
    done = refresh.refresh_partitions(later, path, ["year"])
    now = spark.read.schema(o.schema).parquet(path).groupBy("year").agg(
        F.count(F.lit(1)).alias("stored"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    return done.join(now, "year", "left").select("year", "action", "rows", "old_rows", "stored", "pending")


def code_documents(spark, sf_dir) -> DataFrame:
    """Stand-in documents: one per event, with its codes at the usual place, or as its kind has them."""
    e = sq._t(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    entry = F.concat(F.lit('{"id": '), F.get_json_object("props", "$.k"), F.lit(', "name": "user '), F.col("user_id").cast("string"),
                     F.lit('", "extra": [1]}'))
    at = lambda codes: F.concat(F.lit('{"meta": {"v": 2}, "data": {"codelists": [{"codes": '), codes, F.lit("}]}}"))
    kind = F.col("event_type")
    text = (F.when(kind == "click", at(F.concat(F.lit("["), entry, F.lit(', {"id": "x", "name": null}]'))))
            .when(kind == "view", at(F.concat(F.lit("["), entry, F.lit(', {"name": "no id"}, 7]'))))
            .when(kind == "signup", F.lit('{"data": {"lists": []}}'))
            .when(kind == "purchase", at(F.lit("[]"))).otherwise(F.concat(F.lit('{"data": '), entry)))
    return e.select("event_id", text.alias("doc"))


@sq._query
def q30_code_lists(spark, sf_dir):
    """Nested code lists out of JSON text, with what faulty documents and entries lack."""
    return bronze.flatten_code_text(code_documents(spark, sf_dir), "doc", keep=["event_id"])


REPORT = {"dim_key": "region_key", "dim_cols": ["nation_name", "nation_code"],
          "rates": {"orders_per_10k": ("orders", 0), "value_per_10k": ("order_value_cents", 2)}}
MEASURES = ["orders", "order_value_cents"]


@sq._query
def q31_incremental_report(spark, sf_dir):
    """The rate report kept up to date from stored sums: late prices, new and cancelled orders of the last years
    touch some groups, which alone are computed again (I15)."""
    keys, sums = ["region_key", "year"], {"orders": F.lit(1), "order_value_cents": (sq._money("o_totalprice") * 100).cast("long")}
    o = sq._t(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    before, after = two_loads(o)
    changes = stored(report.change_set(before, after, "o_orderkey"), "changes")
    fact = lambda rows: sq.with_nation(spark, sf_dir, rows).withColumn("year", F.year("order_date").cast("int"))
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    dim = sq.nation_dim(spark, sf_dir)
    orders = stored(report.rate_state(fact(before.select(*columns)), keys, sums), "order-sums")
    people = {"population": F.col("population")}
    population = stored(report.rate_state(sq.fact_population(spark, sf_dir), keys, people), "population-sums")
    unmoved = population.withColumn(report.TOUCHED, F.lit(False))
    # the first report is the same step with every group touched
    first = report.refresh_report(spark.createDataFrame([], "nation_name string, nation_code string, year int, orders long, "
                                                        "order_value_cents long, population long, orders_per_10k double, value_per_10k double"),
                                  orders.withColumn(report.TOUCHED, F.lit(True)), unmoved, dim, keys, MEASURES, **REPORT)
    first = stored(first.drop("recomputed"), "report")
    now = stored(report.apply_changes(orders, fact(changes.select(*columns, report.SIGN)), keys, sums), "order-sums")
    return report.refresh_report(first, now, unmoved, dim, keys, MEASURES, **REPORT)


def two_loads(o: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stand-in loads of the orders: in the last years the first one has other prices, fewer and more orders."""
    late = F.col("y") >= CHANGED_FROM
    price = F.when(late & (F.col("o_orderstatus") == "P"), F.lit(0.0)).otherwise(F.col("o_totalprice"))
    before = o.filter(~(late & (F.col("o_orderpriority") == "5-LOW"))).withColumn("o_totalprice", price)
    return before, o.filter(~(late & (F.col("o_orderpriority") == "1-URGENT")))


def _opening(text: Column) -> Column:
    """The letters A-Z of the first two words of a text, as capitals."""
    return F.upper(F.trim(F.regexp_replace(F.substring_index(text, " ", 2), "[^A-Za-z ]", "")))


@sq._query
def q32_name_suggestions(spark, sf_dir):
    """The nearest official name for every name that matches none: the openings of the documents are the official
    names, those of the conversations' turns and misspelt openings the source's (I6)."""
    d = sq._t(spark, sf_dir, "documents").select("doc_id", "text")
    official = d.select(_opening(F.col("text")).alias("official"), "doc_id").groupBy("official").agg(F.min("doc_id").alias("code"))
    misspelt = official.select(F.concat(F.substring("official", 1, 2), F.expr("substring(official, 4)"), F.lit("S")).alias("name"))
    turns = sq._t(spark, sf_dir, "conversations").select(_opening(F.col("text")).alias("name"))
    names = misspelt.unionByName(turns).join(official.select(F.col("official").alias("name")), "name", "left_anti")
    return suggest.suggest_names(names, official, "name", "official", "code")


@sq._query
def q33_colocated_lines(spark, sf_dir):
    """Settled orders and all line items stored in the same buckets: lines by the state of their order and by return
    flag, and the lines without a settled order, both without an exchange of rows (C4, C12, I12, J3)."""
    o = sq._t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") != "P")
    li = sq._t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", sq._money("l_quantity").alias("quantity"))
    name = f"lines_{uuid.uuid4().hex}"
    pair = colocated.store_pair(o, li, "o_orderkey", "l_orderkey", name, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}",
                                int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = [F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("double").alias("quantity")]
    found = colocated.joined(spark, pair).groupBy("o_orderstatus", "l_returnflag").agg(*sums)
    lost = colocated.orphan_rows(spark, pair).groupBy("l_returnflag").agg(*sums)
    out = found.select("o_orderstatus", "l_returnflag", "lines", "quantity").unionByName(
        lost.select(F.lit("none").alias("o_orderstatus"), "l_returnflag", "lines", "quantity"))
    return out.withColumnsRenamed({"o_orderstatus": "order_status", "l_returnflag": "return_flag"})


DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03             # six standard errors of the sketches, and twice the quantiles' bound


@sq._query
def q34_learned_bounds(spark, sf_dir):
    """Profiles of the yearly loads of the orders, each held against the merged ones before it; the sketched numbers are
    compared with exact ones (D9, J7, J8)."""
    o = sq._t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice", F.col("o_custkey"))
    columns = ["o_totalprice", "o_custkey"]
    judged = stored(profile.judged(stored(profile.profiles(o, "year", columns), "profiles")), "judged")
    cells = o.select("year", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                                                 for c in columns])).alias("c")).select("year", "c.*")
    values = cells.groupBy("column_name", "value", "year").agg(F.count(F.lit(1)).alias("n"))
    medians = judged.select(F.col("load").alias("year"), "column_name", "median")
    exact = values.join(medians, ["year", "column_name"]).groupBy("year", "column_name").agg(
        F.count("value").alias("distinct_values"), F.sum(F.when(F.col("value") <= F.col("median"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") < F.col("median"), F.col("n")).otherwise(0)).alias("under"), F.sum("n").alias("all"))
    first = values.groupBy("column_name", "value").agg(F.min("year").alias("year")).groupBy("column_name", "year").agg(F.count("value").alias("fresh"))
    before = Window.partitionBy("column_name").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    exact = exact.join(first, ["year", "column_name"], "left").withColumn("e_distinct_values", F.sum(F.coalesce("fresh", F.lit(0))).over(before))
    near = lambda a, b: F.abs(a - b) <= b * DISTINCT_ERROR
    j = judged.alias("j").join(exact.alias("x"), (F.col("j.load") == F.col("x.year")) & (F.col("j.column_name") == F.col("x.column_name")))
    return j.select(
        F.col("j.load").alias("year"), "j.column_name", "j.rows", "j.nulls", "j.low", "j.high", "j.e_low", "j.e_high",
        F.array_join("j.faults", ",").alias("faults"), F.col("x.distinct_values"), F.col("x.e_distinct_values"),
        near(F.col("j.distinct_values"), F.col("x.distinct_values")).alias("distinct_near"),
        near(F.col("j.e_distinct_values"), F.col("x.e_distinct_values")).alias("e_distinct_near"),
        ((F.col("x.under") <= F.col("x.all") * (0.5 + RANK_ERROR)) & (F.col("x.below") >= F.col("x.all") * (0.5 - RANK_ERROR))).alias("median_near"))


QUERIES = {
    "q34_learned_bounds": q34_learned_bounds,
    "q33_colocated_lines": q33_colocated_lines,
    "q32_name_suggestions": q32_name_suggestions,
    "q31_incremental_report": q31_incremental_report,
    "q26_rejects": q26_rejects,
    "q27_late_releases": q27_late_releases,
    "q28_overlapping_histories": q28_overlapping_histories,
    "q29_partition_refresh": q29_partition_refresh,
    "q30_code_lists": q30_code_lists,
}


def _rejects_sql(table: str, faults: list[tuple[str, str, str]]) -> str:
    any_fault = " OR ".join(f"({cond})" for _, _, cond in faults)
    rows = [("*", "read", "true"), ("*", "typed", f"NOT coalesce({any_fault}, false)"), ("*", "rejected", f"coalesce({any_fault}, false)")]
    parts = [f"SELECT '{table}' AS table_name, '{c}' AS column_name, {base._sql_str(r)} AS rule, "
             f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS cells FROM {table}" for c, r, cond in rows]
    parts += [f"SELECT * FROM (SELECT '{table}' AS table_name, '{c}' AS column_name, {base._sql_str(r)} AS rule, "
              f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS cells FROM {table}) WHERE cells > 0" for c, r, cond in faults]
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    ql = {}
    known = lambda values: ", ".join(base._sql_str(v) for v in values)
    ql["q26_rejects"] = _rejects_sql("orders", [
        ("total_price", "decimal(7,2)", "CAST(o_totalprice AS DECIMAL(18,2)) >= 100000"),
        ("order_status", "accepted values", f"o_orderstatus NOT IN ({known(KNOWN_STATUS)})"),
        ("priority_label", r"matches ^\d-[A-Z]+\z", r"NOT regexp_full_match(o_orderpriority, '\d-[A-Z]+')")]) + "\nUNION ALL\n" + _rejects_sql("lineitem", [
            ("extended_price", "decimal(6,2)", "CAST(l_extendedprice AS DECIMAL(18,2)) >= 10000"),
            ("return_flag", "accepted values", f"l_returnflag NOT IN ({known(KNOWN_FLAGS)})")])
    ql["q27_late_releases"] = base.oracle_sql()["q13_scd2_merge"]
    ql["q28_overlapping_histories"] = base._with(base.CUSTOMER_DIM, f"""
spend AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) > {BIG_SPENDER} AS big_spender
  FROM orders GROUP BY ALL)""", """
spend_flag AS (
  SELECT *, row_number() OVER w AS rn, lag(big_spender) OVER w AS prev FROM spend WINDOW w AS (PARTITION BY o_custkey ORDER BY y))""", """
spend_hist AS (
  SELECT o_custkey, big_spender, make_date(y + 1, 1, 1) AS valid_from,
         coalesce(make_date(lead(y) OVER (PARTITION BY o_custkey ORDER BY y) + 1, 1, 1), DATE '9999-12-31') AS valid_to
  FROM spend_flag WHERE rn = 1 OR big_spender IS DISTINCT FROM prev)""") + """
SELECT s.o_custkey AS customer_id, d.customer_code, d.priority, s.big_spender,
       greatest(d.valid_from, s.valid_from) AS overlap_from, least(d.valid_to, s.valid_to) AS overlap_to
FROM customer_dim d JOIN spend_hist s ON d.customer_code = CAST(s.o_custkey AS VARCHAR)
 AND d.valid_from < s.valid_to AND s.valid_from < d.valid_to"""
    ql["q29_partition_refresh"] = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN year(o_orderdate) = {ARCHIVED_YEAR} THEN 'removed' WHEN year(o_orderdate) = {SETTLED_YEAR}
             AND count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'changed' ELSE 'kept' END AS action,
       CASE WHEN year(o_orderdate) <> {ARCHIVED_YEAR} THEN count(*) END AS rows, count(*) AS old_rows,
       CASE WHEN year(o_orderdate) <> {ARCHIVED_YEAR} THEN count(*) END AS stored,
       CASE WHEN year(o_orderdate) <> {ARCHIVED_YEAR} THEN count(*) FILTER (WHERE o_orderstatus = 'P' AND year(o_orderdate) <> {SETTLED_YEAR}) END AS pending
FROM orders GROUP BY year(o_orderdate)"""
    full = base.oracle_sql()["q18_rate_report"]
    late = f"year(o_orderdate) >= {CHANGED_FROM}"
    cte, body = full.rsplit("\nSELECT d.nation_name", 1)
    kept = cte.replace("FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
                       f"FROM (SELECT * FROM orders WHERE NOT ({late} AND o_orderpriority = '1-URGENT')) o JOIN customer c ON o.o_custkey = c.c_custkey")
    ql["q31_incremental_report"] = kept + f""", moved AS (
  SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS nation_code, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE {late} AND (o_orderpriority IN ('1-URGENT', '5-LOW') OR (o_orderstatus = 'P' AND o_totalprice <> 0)))
SELECT r.*, m.year IS NOT NULL AS recomputed FROM (SELECT d.nation_name{body}) r
LEFT JOIN moved m ON m.nation_code = r.nation_code AND m.year = r.year"""
    opening = "upper(trim(regexp_replace(array_to_string(string_split(text, ' ')[1:2], ' '), '[^A-Za-z ]', '', 'g')))"
    ql["q32_name_suggestions"] = f"""
WITH official AS (SELECT {opening} AS name, CAST(min(doc_id) AS VARCHAR) AS code FROM documents WHERE text IS NOT NULL GROUP BY 1),
names AS (
  SELECT DISTINCT name FROM (SELECT substr(name, 1, 2) || substr(name, 4) || 'S' AS name FROM official
                             UNION ALL SELECT {opening} FROM conversations WHERE text IS NOT NULL)
  WHERE name NOT IN (SELECT name FROM official)),
pairs AS (
  SELECT n.name AS source_name, o.name AS suggestion, o.code, CAST(levenshtein(n.name, o.name) AS INTEGER) AS edits
  FROM names n JOIN official o ON abs(length(n.name) - length(o.name)) <= 2 AND levenshtein(n.name, o.name) <= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY edits, suggestion, code) AS place FROM pairs)
SELECT n.name AS source_name, a.suggestion, a.code, a.edits, b.edits AS next_edits,
       a.edits IS NOT NULL AND (b.edits IS NULL OR a.edits < b.edits) AS clear
FROM names n LEFT JOIN ranked a ON a.source_name = n.name AND a.place = 1
LEFT JOIN ranked b ON b.source_name = n.name AND b.place = 2"""
    ql["q33_colocated_lines"] = """
SELECT CASE WHEN o.o_orderkey IS NULL THEN 'none' ELSE o.o_orderstatus END AS order_status, l_returnflag AS return_flag,
       count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o.o_orderkey
WHERE l_orderkey IS NOT NULL GROUP BY 1, 2"""
    ql["q34_learned_bounds"] = f"""
WITH cells AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'o_totalprice' AS column_name, CAST(o_totalprice AS DOUBLE) AS value FROM orders
  UNION ALL SELECT CAST(year(o_orderdate) AS INTEGER), 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders),
loads AS (
  SELECT year, column_name, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS nulls, min(value) AS low, max(value) AS high,
         count(DISTINCT value) AS distinct_values FROM cells GROUP BY ALL),
fresh AS (
  SELECT year, column_name, count(*) AS n FROM (SELECT column_name, value, min(year) AS year FROM cells WHERE value IS NOT NULL GROUP BY ALL)
  GROUP BY ALL),
seen AS (
  SELECT l.*, sum(coalesce(n, 0)) OVER w AS e_distinct_values, min(low) OVER w AS e_low, max(high) OVER w AS e_high, min(rows) OVER w AS least,
         max(rows) OVER w AS most, max(nulls / rows) OVER w AS null_share
  FROM loads l LEFT JOIN fresh f ON f.year = l.year AND f.column_name = l.column_name
  WINDOW w AS (PARTITION BY l.column_name ORDER BY l.year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT year, column_name, rows, nulls, low, high, e_low, e_high,
       concat_ws(',', CASE WHEN low < e_low - (e_high - e_low) * {profile.MARGIN} THEN 'low' END,
                      CASE WHEN high > e_high + (e_high - e_low) * {profile.MARGIN} THEN 'high' END,
                      CASE WHEN nulls / rows > null_share + {profile.NULL_MARGIN} THEN 'nulls' END,
                      CASE WHEN rows * {profile.ROWS_FACTOR} < least OR rows > most * {profile.ROWS_FACTOR} THEN 'rows' END) AS faults,
       distinct_values, CAST(e_distinct_values AS BIGINT) AS e_distinct_values, true AS distinct_near,
       CASE WHEN least IS NOT NULL THEN true END AS e_distinct_near, true AS median_near
FROM seen"""
    k = "json_extract_string(props, '$.k')"
    ql["q30_code_lists"] = f"""
SELECT event_id, CAST(0 AS INTEGER) AS position, {k} AS code, 'user ' || user_id AS name, CAST(NULL AS VARCHAR) AS fault
FROM events WHERE event_type IN ('click', 'view')
UNION ALL SELECT event_id, 1, 'x', NULL, NULL FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 1, NULL, 'no id', 'no code' FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, 2, NULL, NULL, 'no code' FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, NULL, NULL, NULL, CASE event_type WHEN 'signup' THEN 'no list' ELSE 'not json' END
FROM events WHERE coalesce(event_type, '') NOT IN ('click', 'view', 'purchase')"""
    return ql
