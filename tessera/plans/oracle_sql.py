"""The driver queries restated in DuckDB SQL (the correctness oracle).

Written independently of the Spark code: plain SQL over the registered test
tables. Conventions shared with the Spark side (see SURVEY §7.4): integer
types cast explicitly, money through DECIMAL(18,2), rates by exact integer
division, no current timestamps.
"""

from __future__ import annotations

from tessera.plans import star_queries as sq
from tessera.operators.conform import COUNCIL_RULES


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _normalise_sql(expr: str, rules) -> str:
    out = f"upper({expr})"
    for old, new in rules.replacements:
        out = f"replace({out}, {_sql_str(old)}, {_sql_str(new)})"
    if rules.translate_from:
        out = f"translate({out}, {_sql_str(rules.translate_from)}, {_sql_str(rules.translate_to)})"
    out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
    if rules.prefixes:
        alts = "|".join(rules.prefixes)
        out = f"regexp_replace({out}, {_sql_str('^(' + alts + ')')}, '')"
    if rules.suffixes:
        alts = "|".join(rules.suffixes)
        out = f"regexp_replace({out}, {_sql_str('(' + alts + ')$')}, '')"
    return f"trim({out})"


def _initcap_sql(expr: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + expr + "), "
            "'[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+'), lambda t: upper(t[1]) || t[2:]), '')")


def _key_sql(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '_null_')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def _bands_sql(start: int, width: int, count: int, prefix: str) -> str:
    rows = []
    for i in range(count):
        lo = start + i * width
        hi = lo + width - 1
        rows.append(f"('{prefix}{lo:02d}', '{lo}-{hi}', {lo}, {hi}, {i + 1})")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) t(band_code, band, min_value, max_value, sort_order))"


UNKNOWN_KEY = "md5('UNK-1900-01-01')"

PLACE_NAMES = """
place_names AS (
  SELECT c_custkey,
    CASE c_mktsegment
      WHEN 'BUILDING' THEN 'CITY OF ' || n_name || ' AND ' || r_name
      WHEN 'MACHINERY' THEN n_name || ' & ' || r_name || '.'
      WHEN 'AUTOMOBILE' THEN 'DC ' || n_name || ',' || r_name || ' COUNCIL'
      WHEN 'FURNITURE' THEN n_name || ' ' || substr(r_name, 1, 3)
      ELSE 'PT.' || n_name END AS place_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def _bridge_ctes() -> str:
    ov = ", ".join(f"({_sql_str(n)}, {_sql_str(c)})" for n, c in sq.NATION_OVERRIDES)
    return PLACE_NAMES + f""",
bridge_names AS (SELECT DISTINCT place_name AS source_name FROM place_names WHERE place_name IS NOT NULL),
bridge_norm AS (SELECT source_name, {_normalise_sql('source_name', COUNCIL_RULES)} AS normalised_name FROM bridge_names),
bridge_codes AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code, upper(n_name || ' and ' || lower(r_name)) AS official
  FROM nation JOIN region ON n_regionkey = r_regionkey),
bridge_ov AS (SELECT * FROM (VALUES {ov}) t(source_name, code)),
bridge AS (
  SELECT n.source_name, n.normalised_name, coalesce(ov.code, e.code, nc.code) AS code,
    CASE WHEN ov.code IS NOT NULL THEN 'seed_override'
         WHEN e.code IS NOT NULL THEN 'exact_name'
         WHEN nc.code IS NOT NULL THEN 'name_without_conjunction' END AS match_method
  FROM bridge_norm n
  LEFT JOIN bridge_ov ov ON ov.source_name = n.source_name
  LEFT JOIN bridge_codes e ON e.official = n.normalised_name
  LEFT JOIN bridge_codes nc
    ON regexp_replace(nc.official, ' AND ', ' ', 'g') = regexp_replace(n.normalised_name, ' AND ', ' ', 'g'))"""


ORD_COND = f"""
ord_cond AS (
  SELECT *, o_orderstatus AS status,
    nullif(trim(split_part(o_orderpriority, '-', 2)), {_sql_str(sq.PRIORITY_SENTINEL)}) AS priority,
    o_totalprice > {sq.LARGE_ORDER} AS is_large
  FROM orders)"""

NON_PRIORITY = ", ".join(_sql_str(v) for v in sq.NON_PRIORITY)

CUSTOMER_DIM = f"""
cust_ext AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_code, x.priority, c.c_name AS customer_name,
         c.c_mktsegment AS segment, make_timestamp(x.y + 1, 1, 1, 0, 0, 0) AS run_ts
  FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS priority,
               row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) x
  JOIN customer c ON c.c_custkey = x.o_custkey
  WHERE x.rn = 1),
cust_flag AS (
  SELECT *, row_number() OVER (PARTITION BY customer_code ORDER BY run_ts) AS rn,
         lag(priority) OVER (PARTITION BY customer_code ORDER BY run_ts) AS prev_priority
  FROM cust_ext),
cust_snap AS (
  SELECT customer_code, priority, customer_name, segment, run_ts AS valid_from_ts,
         lead(run_ts) OVER (PARTITION BY customer_code ORDER BY run_ts) AS valid_to_ts
  FROM cust_flag WHERE rn = 1 OR priority IS DISTINCT FROM prev_priority),
cust_ver AS (
  SELECT *, row_number() OVER (PARTITION BY customer_code ORDER BY valid_from_ts) AS version_number
  FROM cust_snap),
customer_dim AS (
  SELECT * FROM (
    SELECT {_key_sql('customer_code', 'valid_from_ts')} AS customer_key, customer_code, priority, customer_name,
           segment, NOT (priority IN ({NON_PRIORITY})) AS is_priority,
           CASE WHEN version_number = 1 THEN DATE '1900-01-01' ELSE CAST(valid_from_ts AS DATE) END AS valid_from,
           coalesce(CAST(valid_to_ts AS DATE), DATE '9999-12-31') AS valid_to,
           valid_to_ts IS NULL AS is_current
    FROM cust_ver) v
  WHERE valid_from < valid_to
  UNION ALL
  SELECT {UNKNOWN_KEY}, 'UNK', 'Unknown', 'Unknown', 'Unknown', false, DATE '1900-01-01', DATE '9999-12-31', true)"""

FACT_ORDERS = ORD_COND + f""",
fact_orders AS (
  SELECT o.o_orderkey AS order_key, coalesce(d.customer_key, {UNKNOWN_KEY}) AS customer_key,
         CAST(o.o_orderdate AS DATE) AS order_date,
         {_key_sql('o.status', 'o.priority', 'o.is_large')} AS condition_key,
         o.o_orderstatus AS order_status, o.o_totalprice AS total_price
  FROM ord_cond o LEFT JOIN customer_dim d
    ON d.customer_code = CAST(o.o_custkey AS VARCHAR)
   AND CAST(o.o_orderdate AS DATE) >= d.valid_from AND CAST(o.o_orderdate AS DATE) < d.valid_to)"""

FACT_LINES = f"""
fact_lines AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, f.customer_key, f.order_date,
         b.band_code AS quantity_band, l.l_quantity AS quantity, l.l_extendedprice AS extended_price,
         1 AS line_count
  FROM lineitem l JOIN fact_orders f ON f.order_key = l.l_orderkey
  LEFT JOIN {_bands_sql(1, 10, 5, 'Q')} b ON l.l_quantity BETWEEN b.min_value AND b.max_value)"""

NATION_RUN = sq.NATION_RUN_TS.strftime("%Y-%m-%d %H:%M:%S")

NATION_DIM = f"""
nation_dim AS (
  SELECT {_key_sql('nation_code', _sql_str(NATION_RUN))} AS region_key, nation_code, nation_name, region_name,
         DATE '1900-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM (SELECT CAST(n_nationkey AS VARCHAR) AS nation_code, n_name AS nation_name, r_name AS region_name
        FROM nation JOIN region ON n_regionkey = r_regionkey) c
  UNION ALL
  SELECT {UNKNOWN_KEY}, 'UNK', 'Unknown', 'Unknown', DATE '1900-01-01', DATE '9999-12-31', true)"""

FACT_POPULATION = """
first_y AS (SELECT o_custkey, min(CAST(year(o_orderdate) AS INTEGER)) AS first_year FROM orders GROUP BY 1),
new_c AS (
  SELECT c_nationkey, c_mktsegment, first_year, count(*) AS new_customers
  FROM first_y JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
spread AS (
  SELECT c_nationkey, c_mktsegment, new_customers,
         unnest(generate_series(first_year, (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders))) AS year
  FROM new_c),
cells AS (
  SELECT c_nationkey, c_mktsegment, year, CAST(sum(new_customers) AS BIGINT) AS population
  FROM spread GROUP BY ALL),
pop_obs AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS nation_code, c_mktsegment AS segment, CAST(year AS INTEGER) AS year,
         population FROM cells
  UNION ALL
  SELECT CAST(c_nationkey AS VARCHAR), 'TOT', CAST(year AS INTEGER), CAST(sum(population) AS BIGINT)
  FROM cells GROUP BY c_nationkey, year),
fact_population AS (
  SELECT d.region_key, make_date(p.year, 1, 1) AS year_date, p.year, p.segment, p.population
  FROM pop_obs p JOIN nation_dim d
    ON d.nation_code = p.nation_code AND make_date(p.year, 1, 1) >= d.valid_from
   AND make_date(p.year, 1, 1) < d.valid_to
  WHERE p.segment <> 'TOT')"""

ORDERS_NAT = """
orders_nat AS (
  SELECT o.o_orderkey, CAST(c.c_nationkey AS VARCHAR) AS nation_code, c.c_mktsegment,
         CAST(o.o_orderdate AS DATE) AS order_date, o.o_totalprice, d.region_key
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation_dim d ON d.nation_code = CAST(c.c_nationkey AS VARCHAR)
   AND CAST(o.o_orderdate AS DATE) >= d.valid_from AND CAST(o.o_orderdate AS DATE) < d.valid_to)"""


def _rate(num: str, den: str, factor: int) -> str:
    return (f"CAST((2 * CAST({num} AS HUGEINT) * {factor} + {den}) // (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / 10.0")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _checks_sql() -> str:
    """Scorecard rows, one SELECT per check, mirroring ``star_checks``."""
    parts = []

    def add(table, check, column, expr, source=None):
        parts.append(f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
                     f"CAST(({expr}) AS BIGINT) AS violations FROM {source or table}")

    def not_null(t, c):
        add(t, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)")

    def unique(t, c):
        parts.append(f"SELECT '{t}', 'unique', '{c}', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")

    def unique_comb(t, cols):
        cl = ", ".join(cols)
        parts.append(f"SELECT '{t}', 'unique_combination', '{','.join(cols)}', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT {cl} FROM {t} GROUP BY {cl} HAVING count(*) > 1)")

    def accepted(t, c, values):
        vals = ", ".join(_sql_str(v) for v in values)
        add(t, "accepted_values", c, f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({c} IN ({vals})))")

    def between(t, c, lo, hi, cond=None):
        rng = " AND ".join(x for x in [f"{c} >= {lo}" if lo is not None else "",
                                       f"{c} <= {hi}" if hi is not None else ""] if x) or "true"
        extra = f" AND coalesce({cond}, false)" if cond else ""
        add(t, "between", c, f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({rng}){extra})")

    def max_between(t, c, lo, hi):
        add(t, "max_between", c,
            f"CASE WHEN max({c}) IS NOT NULL AND NOT (max({c}) >= {lo} AND max({c}) <= {hi}) THEN 1 ELSE 0 END")

    def row_count(t, lo, hi):
        rng = " AND ".join(x for x in [f"count(*) >= {lo}" if lo is not None else "",
                                       f"count(*) <= {hi}" if hi is not None else ""] if x)
        add(t, "row_count_between", "*", f"CASE WHEN NOT ({rng}) THEN 1 ELSE 0 END")

    def relationship(t, c, parent, pc):
        parts.append(f"SELECT '{t}', 'relationships', '{c}', CAST(count(*) AS BIGINT) FROM {t} "
                     f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)")

    not_null("customer_dim", "customer_key")
    unique("customer_dim", "customer_key")
    not_null("customer_dim", "customer_code")
    unique_comb("customer_dim", ["customer_code", "valid_from"])
    accepted("customer_dim", "segment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown"])
    unique("nation_dim", "region_key")
    not_null("nation_dim", "nation_name")
    row_count("nation_dim", 1, 1000)
    not_null("fact_orders", "customer_key")
    unique("fact_orders", "order_key")
    relationship("fact_orders", "customer_key", "customer_dim", "customer_key")
    accepted("fact_orders", "order_status", ["F", "O"])
    between("fact_orders", "total_price", 0, 500000)
    between("fact_orders", "total_price", 1000, None, "order_status = 'F'")
    max_between("fact_orders", "order_date", "DATE '1995-01-01'", "DATE '2000-12-31'")
    row_count("fact_orders", 1, None)
    not_null("fact_lines", "quantity_band")
    unique_comb("fact_lines", ["order_key", "line_number"])
    relationship("fact_lines", "order_key", "fact_orders", "order_key")
    between("fact_lines", "quantity", 1, 50)
    not_null("fact_population", "region_key")
    relationship("fact_population", "region_key", "nation_dim", "region_key")
    unique_comb("fact_population", ["region_key", "year", "segment"])
    between("fact_population", "population", 0, None)
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    ql = {}
    ql["q01_bronze_land"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, 'orders.parquet' AS _source_resource
FROM orders"""
    pat = "'^https?://[^/]+/([a-z]{2})/(\\d+)'"
    ql["q02_latest_extract"] = f"""
SELECT lang, page_id, url, number FROM (
  SELECT page_id, url, regexp_extract(url, {pat}, 1) AS lang,
         CAST(regexp_extract(url, {pat}, 2) AS INTEGER) AS number
  FROM pages WHERE regexp_matches(url, {pat}))
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY number DESC, page_id ASC) = 1"""
    ql["q03_json_flatten"] = """
SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""
    ql["q04_union_parts"] = """
SELECT kind, year, count(*) AS rows, count(value) AS valued, CAST(sum(value) AS DOUBLE) AS total_value FROM (
  SELECT 'order' AS kind, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders
  UNION ALL
  SELECT 'line', CAST(year(l_shipdate) AS INTEGER), CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
  UNION ALL
  SELECT coalesce(event_type, 'unknown'), CAST(NULL AS INTEGER), CAST(value AS DECIMAL(18,2)) FROM events) p
GROUP BY kind, year"""
    label = "trim(split_part(o_orderpriority, '-', 2))"
    ql["q05_silver_orders"] = f"""
SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_custkey AS BIGINT) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' END AS order_status,
       coalesce(o_orderstatus = 'F', false) AS is_fulfilled,
       CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_code,
       nullif({_initcap_sql(label)}, 'Not Specified') AS priority_label,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders"""
    brand = "split_part(p_brand, '#', 2)"
    ql["q06_guarded_cast"] = f"""
SELECT p_partkey,
  CASE WHEN regexp_full_match({brand}, '\\d+') THEN TRY_CAST({brand} AS INTEGER) END AS brand_number,
  CASE WHEN regexp_full_match(p_type, '\\d+') THEN TRY_CAST(p_type AS INTEGER) END AS type_number,
  CASE WHEN regexp_full_match(CAST(p_size AS VARCHAR), '\\d+') THEN CAST(p_size AS INTEGER) END AS size_number
FROM part"""
    ql["q07_normalise"] = f"""
SELECT source_name, {_normalise_sql('source_name', sq.CUSTOMER_RULES)} AS normalised_name
FROM (SELECT DISTINCT c_name AS source_name FROM customer)"""
    ql["q08_conform_bridge"] = _with(_bridge_ctes()) + "SELECT * FROM bridge"
    ql["q09_match_methods"] = _with(_bridge_ctes(), """
src_rows AS (SELECT place_name, count(*) AS n FROM place_names GROUP BY place_name)""") + """
SELECT coalesce(b.match_method, 'unmatched') AS match_method, count(*) AS names,
       CAST(sum(coalesce(s.n, 0)) AS BIGINT) AS source_rows
FROM bridge b LEFT JOIN src_rows s ON s.place_name = b.source_name
GROUP BY 1"""
    ql["q10_junk_dim"] = _with(ORD_COND) + f"""
SELECT {_key_sql('status', 'priority', 'is_large')} AS condition_key, status, priority, is_large
FROM (SELECT DISTINCT status, priority, is_large FROM ord_cond)"""
    ql["q11_date_dim"] = """
WITH b AS (
  SELECT CAST(date_trunc('year', least((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
                                       (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem))) AS DATE) AS lo,
         CAST(date_trunc('year', greatest((SELECT max(CAST(o_orderdate AS DATE)) FROM orders),
                                          (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)))
              + INTERVAL 1 YEAR AS DATE) AS hi),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY,
                                            INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       isodow(d) IN (6, 7) AS is_weekend,
       CAST(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS financial_year
FROM days"""
    ql["q12_band_dim"] = f"""
WITH bands AS {_bands_sql(1, 5, 10, 'S')},
cnt AS (SELECT b.band_code, count(*) AS parts FROM part p
        JOIN bands b ON p.p_size BETWEEN b.min_value AND b.max_value GROUP BY 1)
SELECT b.band_code, b.band, b.min_value, b.max_value, b.sort_order, CAST(coalesce(c.parts, 0) AS BIGINT) AS parts
FROM bands b LEFT JOIN cnt c ON c.band_code = b.band_code"""
    ql["q24_text_columns"] = """
SELECT o_orderpriority AS priority, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus <> 'P') AS dated,
       count(*) FILTER (WHERE o_orderpriority LIKE '1-%') AS urgent, max(CAST(o_orderkey AS VARCHAR)) AS last_id,
       CAST(max(o_orderdate) FILTER (WHERE o_orderstatus <> 'P') AS DATE) AS last_day
FROM orders GROUP BY 1"""
    ql["q25_bridge_fact"] = """
SELECT r_name AS region_name, count(*) AS suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1"""
    ql["q13_scd2_merge"] = _with(CUSTOMER_DIM) + """
SELECT customer_code, priority, customer_name, segment, CAST(valid_from_ts AS DATE) AS valid_from_date,
       CAST(valid_to_ts AS DATE) AS valid_to_date
FROM cust_snap"""
    ql["q23_snapshot_merge"] = ql["q13_scd2_merge"]
    ql["q14_versioned_dim"] = _with(CUSTOMER_DIM) + "SELECT * FROM customer_dim"
    ql["q15_fact_orders"] = _with(CUSTOMER_DIM, FACT_ORDERS) + "SELECT * FROM fact_orders"
    ql["q16_fact_lines"] = _with(CUSTOMER_DIM, FACT_ORDERS, FACT_LINES) + "SELECT * FROM fact_lines"
    ql["q17_periodic_fact"] = _with(NATION_DIM, FACT_POPULATION) + "SELECT * FROM fact_population"
    ql["q18_rate_report"] = _with(NATION_DIM, FACT_POPULATION, ORDERS_NAT, """
num AS (SELECT region_key, CAST(year(order_date) AS INTEGER) AS year, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS order_value_cents
        FROM orders_nat GROUP BY 1, 2)""", """
den AS (SELECT region_key, year, CAST(sum(population) AS BIGINT) AS population FROM fact_population GROUP BY 1, 2)
""") + f"""
SELECT d.nation_name, d.nation_code, n.year, n.orders, n.order_value_cents, p.population,
       {_rate('n.orders', 'p.population', 100000)} AS orders_per_10k,
       {_rate('n.order_value_cents', 'p.population', 1000)} AS value_per_10k
FROM num n JOIN den p ON p.region_key = n.region_key AND p.year = n.year
JOIN nation_dim d ON d.region_key = n.region_key
WHERE p.population > 0"""
    ql["q19_rate_by_band"] = _with(NATION_DIM, FACT_POPULATION, ORDERS_NAT, """
per_order AS (SELECT l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS DECIMAL(18,2)) AS quantity
              FROM lineitem GROUP BY 1)""", """
num AS (SELECT o.region_key, CAST(year(o.order_date) AS INTEGER) AS year, o.c_mktsegment AS segment,
               CAST(sum(l.lines) AS BIGINT) AS lines, CAST(sum(l.quantity) * 100 AS BIGINT) AS quantity_cents
        FROM per_order l JOIN orders_nat o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3)""", """
den AS (SELECT region_key, year, segment, CAST(sum(population) AS BIGINT) AS population
        FROM fact_population GROUP BY 1, 2, 3)
""") + f"""
SELECT d.nation_name, d.nation_code, n.year, n.segment, n.lines, n.quantity_cents, p.population,
       {_rate('n.lines', 'p.population', 100000)} AS lines_per_10k,
       {_rate('n.quantity_cents', 'p.population', 1000)} AS quantity_per_10k
FROM num n JOIN den p ON p.region_key = n.region_key AND p.year = n.year AND p.segment = n.segment
JOIN nation_dim d ON d.region_key = n.region_key
WHERE p.population > 0"""
    ql["q20_reconcile"] = """
SELECT order_key, CAST(stated AS DOUBLE) AS stated_total, CAST(observed AS DOUBLE) AS line_total FROM (
  SELECT o.o_orderkey AS order_key, CAST(o.o_totalprice AS DECIMAL(18,2)) AS stated,
         coalesce(l.observed, 0) AS observed
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, round(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))
                                 * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS observed
    FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey)
WHERE stated <> observed"""
    ql["q21_coverage"] = """
SELECT CAST(o_orderdate AS DATE) AS day FROM orders
EXCEPT
SELECT CAST(l_shipdate AS DATE) FROM lineitem"""
    ql["q22_scorecard"] = _with(CUSTOMER_DIM, FACT_ORDERS, FACT_LINES, NATION_DIM, FACT_POPULATION) + _checks_sql()
    return ql
