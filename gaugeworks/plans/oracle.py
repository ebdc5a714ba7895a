"""ANSI SQL with the same result as each query, for an engine that reads the same
tables."""

from __future__ import annotations

_FACT = """
fact AS (
  SELECT o_orderkey AS unique_id,
         CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS indicator_id,
         c_nationkey AS geo_join_id,
         strftime(o_orderdate, '%Y-%m') AS time_period,
         CAST(o_orderdate AS DATE) AS start_date,
         o_totalprice AS data_value,
         o_orderstatus AS message
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

_GEO = """
geographic AS (
  SELECT n_nationkey AS geo_join_id, r_name AS geo_type_name, n_name AS geo_place_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_PLACES = f"""{_FACT}, {_GEO},
places AS (SELECT fact.*, geo_place_name FROM fact JOIN geographic USING (geo_join_id))"""

_BLANKS = "chr(9) || chr(10) || chr(32) || chr(160) || chr(12288)"


def _padded(column: str) -> str:
    return f"CASE WHEN k % 19 = 0 THEN chr(9) || ' ' || {column} || chr(160) || ' ' ELSE {column} END"


def _clean(column: str) -> str:
    return f"nullif(trim({column}, {_BLANKS}), '')"


_TEXTS = [
    "unique_id",
    "indicator_id",
    "name",
    "measure",
    "measure_info",
    "geo_type_name",
    "geo_join_id",
    "geo_place_name",
    "time_period",
    "start_date",
    "data_value",
    "message",
]

# Spoiled wide rows, cleaned and given the first broken rule.
_TAGGED = f"""{_GEO},
spoiled AS (
  SELECT o_orderkey AS k,
         CAST(o_orderkey AS VARCHAR) AS unique_id,
         CASE WHEN o_orderkey % 29 = 0 THEN '12.0' ELSE substring(o_orderpriority, 1, 1) END AS indicator_id,
         CASE WHEN o_orderkey % 22 = 0 THEN '   ' WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE o_orderpriority END AS name,
         o_orderstatus AS measure,
         c_mktsegment AS measure_info,
         geo_type_name,
         CAST(geo_join_id AS VARCHAR) AS geo_join_id,
         geo_place_name,
         strftime(o_orderdate, '%Y-%m') AS time_period,
         CASE WHEN o_orderkey % 17 = 0 THEN '2020-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
         CASE WHEN o_orderkey % 13 = 0 THEN 'abc' WHEN o_orderkey % 31 = 0 THEN ' '
              ELSE CAST(o_totalprice AS VARCHAR) END AS data_value,
         CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS message
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN geographic ON c_nationkey = geo_join_id
),
padded AS (SELECT k, {", ".join(f"{_padded(c)} AS {c}" for c in _TEXTS)} FROM spoiled),
wide AS (
  SELECT 0 AS c, * FROM padded
  UNION ALL
  SELECT 1 AS c, * REPLACE ('0' AS data_value) FROM padded WHERE k % 23 = 0
),
cleaned AS (SELECT c, k, {", ".join(f"{_clean(c)} AS {c}" for c in _TEXTS)} FROM wide),
tagged AS (
  SELECT *, CASE
    WHEN unique_id IS NULL THEN 'Missing required field: unique_id'
    WHEN indicator_id IS NULL THEN 'Missing required field: indicator_id'
    WHEN name IS NULL THEN 'Missing required field: name'
    WHEN geo_type_name IS NULL THEN 'Missing required field: geo_type_name'
    WHEN geo_place_name IS NULL THEN 'Missing required field: geo_place_name'
    WHEN start_date IS NULL THEN 'Missing required field: start_date'
    WHEN NOT regexp_full_match(unique_id, '[+-]?[0-9]+') THEN 'Invalid integer field'
    WHEN NOT regexp_full_match(indicator_id, '[+-]?[0-9]+') THEN 'Invalid integer field'
    WHEN NOT regexp_full_match(geo_join_id, '[+-]?[0-9]+') THEN 'Invalid integer field'
    WHEN data_value IS NOT NULL AND try_cast(data_value AS DOUBLE) IS NULL
      THEN 'Invalid numeric value for data_value'
    WHEN try_strptime(start_date, '%Y-%m-%d') IS NULL THEN 'Invalid date format for start_date'
  END AS error_reason FROM cleaned
)"""

_DATE_TEXTS = """
dated AS (
  SELECT o_orderkey, o_totalprice, CASE o_orderkey % 12
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y/%-m/%-d')
    WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
    WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN 4 THEN strftime(o_orderdate, '%b %-d, %Y')
    WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT23:30:00Z')
    WHEN 6 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 7 THEN strftime(o_orderdate, '%Y')
    WHEN 8 THEN '2020-02-30'
    WHEN 9 THEN strftime(o_orderdate, 'Winter %Y')
    WHEN 10 THEN strftime(o_orderdate, '%-d/%-m/%Y')
    WHEN 11 THEN strftime(o_orderdate, '%m/%d/%Y 12:00:00 AM')
  END AS date_text FROM orders
),
parsed AS (
  SELECT *, CAST(coalesce(
    CASE WHEN regexp_full_match(date_text, '[0-9]{4}-[0-9]+-[0-9]+') THEN try_strptime(date_text, '%Y-%m-%d') END,
    CASE WHEN regexp_full_match(date_text, '[0-9]{4}/[0-9]+/[0-9]+') THEN try_strptime(date_text, '%Y/%m/%d') END,
    CASE WHEN regexp_full_match(date_text, '[0-9]{1,2}/[0-9]+/[0-9]{4}') THEN
      coalesce(try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%d/%m/%Y')) END,
    CASE WHEN regexp_full_match(date_text, '[0-9]{8}') THEN try_strptime(date_text, '%Y%m%d') END,
    CASE WHEN regexp_full_match(date_text, '[A-Z][a-z]{2} [0-9]+, [0-9]{4}') THEN
      try_strptime(date_text, '%b %d, %Y') END,
    CASE WHEN date_text LIKE '%Z' THEN try_strptime(substring(date_text, 1, 10), '%Y-%m-%d') END,
    CASE WHEN regexp_full_match(date_text, '[0-9]{4}-[0-9]{2}') THEN try_strptime(date_text || '-01', '%Y-%m-%d') END,
    CASE WHEN regexp_full_match(date_text, '[0-9]{4}') THEN try_strptime(date_text || '-01-01', '%Y-%m-%d') END,
    CASE WHEN date_text LIKE '% AM' THEN try_strptime(substring(date_text, 1, 10), '%m/%d/%Y') END
  ) AS DATE) AS start_date FROM dated
)"""

_SEASON = """CASE WHEN month(start_date) IN (12, 1, 2) THEN 1 WHEN month(start_date) IN (6, 7, 8) THEN 2
       WHEN month(start_date) IN (9, 10, 11) THEN 3 WHEN month(start_date) IN (3, 4, 5) THEN 4 END"""
_SEASON_NAME = "CASE season_idx WHEN 1 THEN 'Winter' WHEN 2 THEN 'Summer' WHEN 3 THEN 'Fall' WHEN 4 THEN 'Spring' END"

_DEVIATIONS = f"""{_PLACES},
deviations AS (
  SELECT data_value - avg(data_value) OVER (PARTITION BY geo_place_name) AS d FROM places
),
spread AS (SELECT min(d) AS low, max(d) AS high, count(*) AS n, stddev_samp(d) AS sd FROM deviations)"""

_LINE_ORDER = """l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus"""

_VALID_FACT = """
  SELECT CAST(unique_id AS INTEGER) AS unique_id, CAST(indicator_id AS INTEGER) AS indicator_id,
         CAST(geo_join_id AS INTEGER) AS geo_join_id, time_period, start_date,
         CAST(data_value AS DOUBLE) AS data_value, message, 'run-1' AS run_id, TRUE AS has_load_time
  FROM tagged WHERE error_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY CAST(unique_id AS INTEGER) ORDER BY k, c) = 1"""

ORACLE: dict[str, str] = {
    "scan_fact": "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders",
    "filter_indicator": f"""WITH {_FACT}
SELECT unique_id, indicator_id, geo_join_id, CAST(start_date AS VARCHAR) AS start_date, data_value
FROM fact WHERE indicator_id = 1""",
    "map_columns": """SELECT o_orderkey AS unique_id, o_totalprice AS data_value, o_orderpriority AS name,
  CAST(NULL AS VARCHAR) AS message FROM orders""",
    "normalize_headers": """SELECT c_custkey AS cust_key, c_name AS customer__name, c_nationkey AS "nation-key",
  c_acctbal AS acct_bal, c_mktsegment AS mkt_segment FROM customer""",
    "fact_projection": f"""WITH {_FACT}
SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date), 'run-1' AS run_id FROM fact WHERE message <> 'P'""",
    "src_csv_headers": """SELECT o_orderkey AS unique_id, o_orderpriority AS name,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date, o_totalprice AS data_value FROM orders""",
    "src_csv": """SELECT o_orderkey AS unique_id, o_orderpriority AS name,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date, o_totalprice AS data_value FROM orders""",
    "src_csv_breaks": """SELECT o_orderkey AS unique_id, o_orderpriority
    || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '"a",' || chr(13) || chr(10) || chr(10) ELSE ', b' END || '.' AS name,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date, o_totalprice AS data_value FROM orders""",
    "src_json": """SELECT o_orderkey AS unique_id, o_orderpriority AS name,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date, o_totalprice AS data_value FROM orders""",
    "sink_csv": f"""WITH {_FACT}
SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date), CAST(year(start_date) AS INTEGER) AS year,
  CAST(month(start_date) AS INTEGER) AS month, CAST(day(start_date) AS INTEGER) AS day FROM fact""",
    "inject_bad_row": """SELECT o_orderkey, o_orderpriority AS name FROM orders
UNION ALL SELECT min(o_orderkey), NULL FROM orders""",
    "null_tokens": """WITH told AS (SELECT o_orderkey, CASE o_orderkey % 22
    WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN 'NULL' WHEN 3 THEN '  NA ' WHEN 4 THEN 'nan' WHEN 5 THEN '#N/A'
    WHEN 6 THEN '-1.#IND' WHEN 7 THEN '<NA>' WHEN 8 THEN 'none' WHEN 9 THEN 'None' WHEN 10 THEN 'NaT'
    ELSE o_orderpriority END AS token FROM orders)
SELECT o_orderkey, CASE WHEN token NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
  '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN token END AS token
FROM told""",
    "clean_values": f"""WITH padded AS (SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN chr(9) || ' ' || o_orderpriority || chr(160) || ' '
    WHEN 1 THEN chr(12288) || o_orderpriority || chr(10)
    WHEN 2 THEN chr(160) || chr(9) WHEN 3 THEN '' ELSE o_orderpriority END AS name,
  CASE WHEN o_orderkey % 5 <> 4 THEN o_totalprice END AS data_value FROM orders)
SELECT o_orderkey, {_clean("name")} AS name, data_value FROM padded""",
    "parse_dates": f"""WITH {_DATE_TEXTS}
SELECT o_orderkey, date_text, CAST(start_date AS VARCHAR) AS start_date FROM parsed""",
    "coerce_dropna": f"""WITH {_DATE_TEXTS}
SELECT o_orderkey, CAST(start_date AS VARCHAR) AS start_date, o_totalprice AS data_value,
  'somewhere' AS geo_place_name
FROM parsed WHERE start_date IS NOT NULL AND o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0""",
    "validate_split": f"""WITH {_TAGGED}
SELECT k AS order_key, c AS copy_number, unique_id, indicator_id, geo_join_id, start_date,
  CASE WHEN error_reason IS NULL THEN CAST(data_value AS DOUBLE) END AS data_value,
  CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'rejected' END AS outcome FROM tagged""",
    "reject_reason": f"WITH {_TAGGED} SELECT k AS order_key, c AS copy_number, error_reason FROM tagged",
    "default_rules": f"""WITH {_TAGGED}
SELECT error_reason, count(*) AS reject_count FROM tagged WHERE error_reason IS NOT NULL GROUP BY error_reason""",
    "default_reasons": f"""WITH {_TAGGED}, named AS (
  SELECT k, c, CASE WHEN k % 2 = 0 THEN error_reason END AS error_reason FROM tagged WHERE error_reason IS NOT NULL),
stored AS (SELECT coalesce(error_reason, 'Unknown validation error') AS error_reason, count(*) AS reject_count FROM named GROUP BY 1),
reported AS (SELECT coalesce(error_reason, 'Validation failed') AS error_reason, count(*) AS reject_count FROM named GROUP BY 1
  ORDER BY reject_count DESC, min(k * 10 + c) LIMIT 5)
SELECT *, 'stored' AS place FROM stored UNION ALL SELECT *, 'reported' FROM reported""",
    "parse_date_forms": """WITH texts AS (
  SELECT o_orderkey, o_orderkey % 10 AS kind, CASE o_orderkey % 10
    WHEN 0 THEN strftime(o_orderdate, '%m/%d/%y') WHEN 1 THEN strftime(o_orderdate, '%d-%b-%Y') WHEN 2 THEN strftime(o_orderdate, '%b %Y')
    WHEN 3 THEN strftime(o_orderdate, '%m/%Y') WHEN 4 THEN strftime(o_orderdate, '%m.%d.%Y') WHEN 5 THEN strftime(o_orderdate, '%Y%m%dT%H%M%S')
    WHEN 6 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 7 THEN strftime(o_orderdate, '%d%b%Y') WHEN 8 THEN strftime(o_orderdate, '%Y-%b-%d')
    ELSE 'Mon ' || strftime(o_orderdate, '%b %-d %Y') END AS date_text FROM orders)
SELECT o_orderkey, date_text, CAST(CAST(CASE kind
    WHEN 0 THEN strptime(date_text, '%m/%d/%y') WHEN 1 THEN strptime(date_text, '%d-%b-%Y') WHEN 2 THEN strptime('1 ' || date_text, '%d %b %Y')
    WHEN 3 THEN strptime('01/' || date_text, '%d/%m/%Y') WHEN 4 THEN strptime(date_text, '%m.%d.%Y') WHEN 5 THEN strptime(date_text, '%Y%m%dT%H%M%S')
    WHEN 6 THEN strptime(date_text, '%B %d, %Y') WHEN 7 THEN strptime(date_text, '%d%b%Y') WHEN 8 THEN strptime(date_text, '%Y-%b-%d') END AS DATE) AS VARCHAR) AS start_date
FROM texts""",
    "reject_summary": f"""WITH {_TAGGED}
SELECT error_reason, count(*) AS reject_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total_rejected
FROM tagged WHERE error_reason IS NOT NULL GROUP BY error_reason
ORDER BY reject_count DESC, min(k * 2 + c) LIMIT 5""",
    "reject_samples": f"""WITH {_TAGGED}
SELECT error_reason, unique_id, indicator_id, geo_place_name, start_date
FROM tagged WHERE error_reason IS NOT NULL ORDER BY k, c LIMIT 5""",
    "run_metrics": f"""WITH {_TAGGED}
SELECT count(*) AS total_records, count(*) FILTER (error_reason IS NULL) AS valid_records,
  count(error_reason) AS rejected_records FROM tagged""",
    "reject_rows": f"""WITH {_TAGGED}
SELECT 'run-1' AS run_id, error_reason, 'orders.parquet' AS source_file, unique_id, indicator_id, name,
  geo_place_name, start_date, message, TRUE AS reason_removed FROM tagged WHERE error_reason IS NOT NULL""",
    "run_log_latest": """WITH ended AS (
  SELECT l_orderkey, max(l_shipdate) AS e, count(*) AS total, count(*) FILTER (l_returnflag = 'R') AS rejected
  FROM lineitem GROUP BY l_orderkey),
runs AS (
  SELECT o.*, e, total, rejected,
    l_orderkey IS NOT NULL AND NOT (total = 1 AND o_orderstatus = 'P') AS done
  FROM orders o LEFT JOIN ended ON l_orderkey = o_orderkey)
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS source_file,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
  CASE WHEN done THEN strftime(greatest(e, o_orderdate), '%Y-%m-%d %H:%M:%S') END AS end_timestamp,
  CASE WHEN done THEN CAST(total AS VARCHAR) END AS total_records,
  CASE WHEN done THEN CAST(total - rejected AS VARCHAR) END AS valid_records,
  CASE WHEN done THEN CAST(rejected AS VARCHAR) END AS rejected_records,
  CASE WHEN done THEN CAST(total - rejected AS VARCHAR) END AS inserted_records,
  CASE WHEN done THEN '0' END AS skipped_records,
  CASE WHEN NOT done THEN 'STARTED' WHEN total = rejected THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN done AND total = rejected THEN 'no valid record' END AS error_message
FROM runs""",
    "dedupe_first": f"""SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) = 1""",
    "count_duplicates": """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
  FROM lineitem)) AS duplicate_count FROM lineitem""",
    "extract_dimension": f"""WITH {_TAGGED}
SELECT CAST(indicator_id AS INTEGER) AS indicator_id, name, measure, measure_info
FROM tagged WHERE error_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY CAST(indicator_id AS INTEGER) ORDER BY k, c) = 1""",
    "append_new_rows": f"""WITH {_FACT}
SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date) FROM fact WHERE message <> 'F'""",
    "append_indexed": f"""WITH {_FACT}
SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date) FROM fact WHERE message <> 'F'""",
    "ingest_indexed": f"""WITH {_FACT}, {_GEO}
SELECT 'fact' AS kind, CAST(unique_id AS VARCHAR) AS id, CASE WHEN unique_id % 3 = 2 THEN 1.5 ELSE data_value END AS data_value,
  'run-' || (unique_id % 3 + 1) AS label FROM fact JOIN geographic USING (geo_join_id)""",
    "ingest_reload": f"""WITH {_FACT}, {_GEO}, early AS (SELECT * FROM fact WHERE unique_id % 2 = 0 AND indicator_id < 5)
SELECT 'fact' AS kind, CAST(unique_id AS VARCHAR) AS id,
  CASE WHEN unique_id IN (SELECT unique_id FROM early) THEN data_value ELSE 1.5 END AS data_value,
  CASE WHEN unique_id IN (SELECT unique_id FROM early) THEN 'run-1' ELSE 'run-2' END AS label FROM fact
UNION ALL SELECT DISTINCT 'indicator', CAST(indicator_id AS VARCHAR), CAST(NULL AS DOUBLE), 'kind ' || indicator_id FROM fact
UNION ALL SELECT DISTINCT 'place', CAST(geo_join_id AS VARCHAR), CAST(NULL AS DOUBLE),
  CASE WHEN geo_join_id IN (SELECT geo_join_id FROM early) THEN geo_place_name ELSE 'renamed' END
FROM fact JOIN geographic USING (geo_join_id)""",
    "merged_moments": f"""WITH {_FACT}
SELECT indicator_id, count(*) AS n, round(avg(data_value) + 1e8, 3) AS mean, round(min(data_value) + 1e8, 2) AS low,
  round(max(data_value) + 1e8, 2) AS high, round(stddev_samp(data_value), 3) AS deviation,
  round(corr(data_value, month(start_date)), 6) AS correlation FROM fact GROUP BY indicator_id""",
    "sketch_ranks": f"""WITH {_FACT}, seasons AS (SELECT {_SEASON} AS season_idx, count(*) AS n FROM fact GROUP BY 1)
SELECT season_idx, probability, n, TRUE AS is_near
FROM seasons, (VALUES (CAST(0.05 AS DOUBLE)), (0.25), (0.5), (0.75), (0.95)) p(probability)""",
    "ingest_profiled": f"""WITH {_PLACES}
SELECT geo_place_name, count(*) AS group_count, round(sum(data_value), 2) AS group_sum, round(min(data_value), 4) AS group_min,
  round(max(data_value), 4) AS group_max, round(stddev_samp(data_value), 4) AS deviation
FROM places WHERE indicator_id = 1 GROUP BY geo_place_name""",
    "price_quantiles": """SELECT l_returnflag, probability, round(CASE probability
  WHEN 0.1 THEN quantile_cont(l_extendedprice, 0.1) WHEN 0.5 THEN quantile_cont(l_extendedprice, 0.5)
  ELSE quantile_cont(l_extendedprice, 0.99) END, 4) AS quantile
FROM lineitem, (VALUES (CAST(0.1 AS DOUBLE)), (0.5), (0.99)) p(probability) GROUP BY l_returnflag, probability""",
    "ingest_measurements": f"WITH {_TAGGED} {_VALID_FACT}",
    "ingest_rejects": f"""WITH {_TAGGED}
SELECT 'run-1' AS run_id, error_reason, count(*) AS reject_count, count(*) AS distinct_ids
FROM tagged WHERE error_reason IS NOT NULL GROUP BY error_reason""",
    "join_geo_left": f"""WITH {_FACT}, {_GEO}
SELECT unique_id, indicator_id, geo_join_id, geo_place_name, CAST(start_date AS VARCHAR) AS start_date, data_value
FROM fact LEFT JOIN (SELECT * FROM geographic WHERE geo_type_name <> 'AFRICA') USING (geo_join_id)""",
    "join_indicator_inner": f"""WITH {_FACT}, indicators AS (
  SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS indicator_id, o_orderpriority AS name
  FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT fact.* REPLACE (CAST(start_date AS VARCHAR) AS start_date), name FROM fact JOIN indicators USING (indicator_id)""",
    "table_audit": """WITH o AS (
  SELECT CASE WHEN o_orderkey % 50 <> 0 THEN CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey - 1 ELSE o_orderkey END END AS o_orderkey,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders),
c AS (SELECT * FROM customer WHERE c_custkey % 7 > 0), r AS (SELECT * FROM region WHERE r_regionkey < 4)
SELECT 'primary key' AS check_kind, 'orders' AS table_name, 'o_orderkey' AS column_name,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT o_orderkey, count(*) AS n FROM o GROUP BY 1) WHERE n > 1 OR o_orderkey IS NULL) AS violations
UNION ALL SELECT 'primary key', 'customer', 'c_name', (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT c_name, count(*) AS n FROM c GROUP BY 1) WHERE n > 1 OR c_name IS NULL)
UNION ALL SELECT 'primary key', 'nation', 'n_regionkey', (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1) WHERE n > 1 OR n_regionkey IS NULL)
UNION ALL SELECT 'foreign key', 'orders', 'o_custkey', (SELECT count(*) FROM o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c WHERE c_custkey = o_custkey))
UNION ALL SELECT 'foreign key', 'customer', 'c_nationkey', (SELECT count(*) FROM c WHERE c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey))
UNION ALL SELECT 'foreign key', 'nation', 'n_regionkey', (SELECT count(*) FROM nation WHERE n_regionkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE r_regionkey = n_regionkey))
UNION ALL SELECT 'not null', 'orders', 'o_custkey', (SELECT count(*) FROM o WHERE o_custkey IS NULL)
UNION ALL SELECT 'not null', 'orders', 'o_orderpriority', (SELECT count(*) FROM o WHERE o_orderpriority IS NULL)
UNION ALL SELECT 'not null', 'nation', 'n_name', (SELECT count(*) FROM nation WHERE n_name IS NULL)""",
    "pk_violations": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_orphans": """SELECT o_custkey, count(*) AS row_count FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY o_custkey""",
    "not_null_violations": f"""WITH {_FACT}, {_GEO}, joined AS (
  SELECT * FROM fact LEFT JOIN (SELECT geo_join_id, geo_place_name FROM geographic
    WHERE geo_type_name <> 'AFRICA') USING (geo_join_id))
SELECT 'geo_place_name' AS column_name, count(*) - count(geo_place_name) AS null_count FROM joined
UNION ALL SELECT 'data_value', count(*) - count(data_value) FROM joined
UNION ALL SELECT 'start_date', count(*) - count(start_date) FROM joined""",
    "dimension_conflicts": """SELECT c_nationkey, count(DISTINCT c_mktsegment) AS variant_count FROM customer
GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1""",
    "group_mean": f"""WITH {_PLACES}
SELECT geo_place_name, round(avg(data_value), 4) AS mean_value FROM places GROUP BY geo_place_name""",
    "top_groups": f"""WITH {_PLACES}
SELECT geo_place_name, round(avg(data_value), 4) AS mean_value FROM places WHERE indicator_id = 1
GROUP BY geo_place_name ORDER BY avg(data_value) DESC, geo_place_name LIMIT 10""",
    "group_deviation": f"""WITH {_PLACES}, means AS (
  SELECT *, avg(data_value) OVER (PARTITION BY geo_place_name) AS m FROM places)
SELECT unique_id, geo_place_name, round(m, 4) AS location_avg_pollution,
  round(data_value - m, 4) AS pollution_deviation FROM means""",
    "season_index": f"""WITH {_FACT}, seasons AS (
  SELECT unique_id, CAST(month(start_date) AS INTEGER) AS month, {_SEASON} AS season_idx FROM fact)
SELECT *, {_SEASON_NAME} AS season FROM seasons""",
    "date_parts": f"""WITH {_FACT}
SELECT unique_id, CAST(start_date AS VARCHAR) AS start_date, CAST(year(start_date) AS INTEGER) AS year,
  CAST(month(start_date) AS INTEGER) AS month, CAST(day(start_date) AS INTEGER) AS day FROM fact""",
    "one_hot": """SELECT o_orderkey, o_totalprice AS data_value,
  CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "name_2-HIGH",
  CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "name_3-MEDIUM",
  CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "name_4-NOT SPECIFIED",
  CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "name_5-LOW" FROM orders""",
    "one_hot_sparse": """WITH placed AS (
  SELECT c_custkey, c_nationkey, dense_rank() OVER (ORDER BY c_name) AS r FROM customer)
SELECT c_custkey, c_nationkey, CAST((SELECT max(r) FROM placed) - 1 AS INTEGER) AS size,
  CASE WHEN r > 1 THEN CAST(r - 2 AS INTEGER) END AS place, CASE WHEN r > 1 THEN 1.0::DOUBLE END AS value FROM placed""",
    "season_corr": f"""WITH {_FACT}, seasons AS (SELECT {_SEASON} AS season_idx, data_value FROM fact)
SELECT round(corr(season_idx, data_value), 6) AS correlation FROM seasons""",
    "season_corr_constant": f"""WITH seasons AS (
  SELECT {_SEASON.replace("start_date", "ts")} AS season_idx, value FROM events)
SELECT CASE WHEN stddev_samp(season_idx) > 0 AND stddev_samp(value) > 0
  THEN round(corr(season_idx, value), 6) END AS correlation FROM seasons""",
    "season_boxplot": f"""WITH {_FACT}, seasons AS (SELECT {_SEASON} AS season_idx, data_value AS v FROM fact),
boxes AS (
  SELECT season_idx, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM seasons GROUP BY season_idx),
near AS (
  SELECT season_idx, q1, median, q3, v, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM seasons JOIN boxes USING (season_idx))
SELECT season_idx, {_SEASON_NAME} AS season, count(*) AS n, round(q1, 4) AS q1, round(median, 4) AS median,
  round(q3, 4) AS q3, round(least(min(v) FILTER (inside), q1), 4) AS whisker_low,
  round(greatest(max(v) FILTER (inside), q3), 4) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM near GROUP BY season_idx, q1, median, q3""",
    "deviation_histogram": f"""WITH {_DEVIATIONS},
placed AS (
  SELECT CAST(least(floor((d - low) / (high - low) * 50), 49) AS INTEGER) AS bin, count(*) AS bin_count
  FROM deviations, spread GROUP BY 1),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT bin, round(low + bin * ((high - low) / 50), 4) AS bin_start,
  round(low + (bin + 1) * ((high - low) / 50), 4) AS bin_end, coalesce(bin_count, 0) AS bin_count
FROM grid CROSS JOIN spread LEFT JOIN placed USING (bin)""",
    "deviation_kde": f"""WITH {_DEVIATIONS},
scott AS (SELECT *, sd * power(n, -0.2) AS h, (high - low) / 199 AS step FROM spread),
grid AS (SELECT CAST(range AS INTEGER) AS point FROM range(200))
SELECT point, round(low + point * step, 4) AS x,
  round(sum(exp(-0.5 * power((low + point * step - d) / h, 2))) * ((high - low) / 50 / (h * sqrt(2 * pi()))), 4)
    AS density
FROM grid, scott, deviations GROUP BY point, low, high, step, h""",
    "deviation_kde_binned": f"""WITH {_DEVIATIONS},
scott AS (SELECT *, sd * power(n, -0.2) AS h, (high - low) / 199 AS step FROM spread),
grid AS (SELECT CAST(range AS INTEGER) AS point FROM range(200)),
cells AS (SELECT floor((d - low) / (h / 256)) AS cell, count(*) AS held, sum((d - low) / (h / 256) - floor((d - low) / (h / 256))) AS upper
  FROM deviations, scott GROUP BY 1),
nodes AS (SELECT cell AS node, held - upper AS weight FROM cells UNION ALL SELECT cell + 1, upper FROM cells)
SELECT point, round(low + point * step, 4) AS x,
  round(sum(weight * exp(-0.5 * power((low + point * step - (low + node * (h / 256))) / h, 2)))
    * ((high - low) / 50 / (h * sqrt(2 * pi()))), 4) AS density
FROM grid, scott, nodes GROUP BY point, low, high, step, h""",
}
