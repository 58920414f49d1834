"""The catalogue's queries as plain SQL over the given tables, written independently of the
operators: the period rule is a window over every fact row here, gaps are a plain ``lag``,
reconciliation is a full join."""

from __future__ import annotations

FACTS = """facts AS (
  SELECT l_partkey, l_returnflag,
         'Flag ' || l_returnflag || ', status ' || l_linestatus AS series_title,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CASE WHEN l_returnflag = 'R' OR l_linenumber % 3 = 0 THEN 'Q05'
              ELSE 'Q0' || CAST(quarter(l_shipdate) AS VARCHAR) END AS period,
         l_quantity AS value
  FROM lineitem)"""

SUMS = f"""{FACTS},
flagged AS (
  SELECT *, max(CASE WHEN period <> 'Q05' THEN 1 ELSE 0 END)
              OVER (PARTITION BY l_partkey, l_returnflag) AS has_quarters
  FROM facts),
sums AS (
  SELECT l_partkey, l_returnflag, series_title, year,
         CAST(round(sum(value), 2) AS DECIMAL(18,2)) AS yearly_sum
  FROM flagged
  WHERE (has_quarters = 1 AND period <> 'Q05') OR (has_quarters = 0 AND period = 'Q05')
  GROUP BY ALL)"""

BEST = f"""{SUMS},
best AS (
  SELECT l_partkey, l_returnflag, series_title, year, yearly_sum FROM (
    SELECT *, rank() OVER (PARTITION BY l_partkey, l_returnflag
                           ORDER BY yearly_sum DESC) AS place FROM sums)
  WHERE place = 1)"""

YEARS = """years AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population
  FROM orders WHERE year(o_orderdate) <> 1998 GROUP BY 1)"""

ALL_YEARS = """years AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population
  FROM orders GROUP BY 1)"""

GAPS = f"""{YEARS},
gaps AS (
  SELECT year, population, CAST(year - lag(year) OVER (ORDER BY year) AS INTEGER) AS year_gap
  FROM years)"""

KEYED = f"""{FACTS}, {YEARS},
wanted AS (
  SELECT l_partkey, year, period, CAST(sum(value) AS DECIMAL(18,2)) AS value
  FROM facts WHERE l_partkey = 25 AND period = 'Q05' GROUP BY ALL),
keyed AS (
  SELECT wanted.*, population FROM wanted LEFT JOIN years ON wanted.year = years.year)"""

AUDIT = f"""WITH {FACTS},
ruled AS (
  SELECT f.*, r.rule FROM (
    SELECT *, max(CASE WHEN period <> 'Q05' THEN 1 ELSE 0 END)
                OVER (PARTITION BY l_partkey, l_returnflag) AS has_quarters FROM facts) f,
    (VALUES ('fallback'), ('all_periods'), ('quarters_only')) r(rule)
  WHERE rule = 'all_periods'
     OR (rule = 'quarters_only' AND period <> 'Q05')
     OR (rule = 'fallback' AND (period <> 'Q05') = (has_quarters = 1))),
totals AS (
  SELECT rule, l_partkey, l_returnflag, series_title, year, round(sum(value), 2) AS s
  FROM ruled GROUP BY ALL),
won AS (
  SELECT rule, l_partkey, l_returnflag,
         string_agg(series_title || year, '|' ORDER BY series_title, year) AS answer
  FROM (SELECT *, rank() OVER (PARTITION BY rule, l_partkey, l_returnflag
                               ORDER BY s DESC) AS place FROM totals)
  WHERE place = 1 GROUP BY ALL)
SELECT r.rule, count(w.answer) AS series,
       count(*) FILTER (w.answer <> b.answer) AS changed,
       count(*) FILTER (w.answer IS NULL) AS vanished
FROM (SELECT * FROM won WHERE rule = 'fallback') b
CROSS JOIN (VALUES ('fallback'), ('all_periods'), ('quarters_only')) r(rule)
LEFT JOIN won w ON w.rule = r.rule AND w.l_partkey = b.l_partkey
               AND w.l_returnflag = b.l_returnflag
GROUP BY r.rule"""

LABELLED = """labelled AS (
  SELECT l.*, r.r_name, n.n_name,
         'Brand ' || split_part(p.p_brand, '#', 2) AS brand_text, lower(p.p_type) AS type_text
  FROM lines l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

LINKS = """links AS (
  SELECT page_id, url, CAST(i - 1 AS INTEGER) AS position, found[i] AS link,
         split_part(found[i], '/', -1) AS filename
  FROM (SELECT page_id, url, found, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)href="([^"]+)"', 1) AS found
              FROM pages))
  WHERE NOT ends_with(found[i], '/') AND NOT starts_with(found[i], '?')
    AND split_part(found[i], '/', -1) <> '')"""

RECONCILED = f"""{LINKS},
listing AS (SELECT DISTINCT filename FROM links WHERE starts_with(url, 'https:')),
landed AS (SELECT DISTINCT filename FROM links WHERE NOT starts_with(url, 'https:')),
both_sides AS (
  SELECT coalesce(a.filename, b.filename) AS filename,
         CASE WHEN b.filename IS NULL THEN 'new'
              WHEN a.filename IS NULL THEN 'unpublished' ELSE 'present' END AS status
  FROM listing a FULL JOIN landed b ON a.filename = b.filename)"""

SEEN = """seen AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events)"""

TOP10 = f"""{BEST},
top10 AS (
  SELECT * FROM best
  ORDER BY yearly_sum DESC, l_partkey, l_returnflag, series_title, year LIMIT 10)"""

CUSTOMER_RULES = """rules AS (
  SELECT 'non_null_segment' AS rule, 'drop' AS action, c_mktsegment <> 'MACHINERY' AS ok FROM customer
  UNION ALL
  SELECT 'balance_not_negative', 'drop',
         coalesce(nullif(c_nationkey, 7) >= 0 AND c_acctbal >= 0, false) FROM customer
  UNION ALL
  SELECT 'known_nation', 'fail', c_nationkey BETWEEN 0 AND 24 FROM customer)"""

FLOW = """reported AS (
  SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS year,
         unnest(CASE WHEN coalesce(p_type = 'ECONOMY', false)
                       OR (l_partkey % 3 = 1 AND year(l_shipdate) % 2 = 0) THEN ['Q05']
                     WHEN l_partkey % 3 = 0 THEN ['Q0' || quarter(l_shipdate), 'Q05/4']
                     ELSE ['Q0' || quarter(l_shipdate)] END) AS code,
         l_linestatus, l_quantity
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
data AS (
  SELECT l_partkey, year, left(code, 3) AS period,
         CAST(sum(CASE WHEN code = 'Q05/4' THEN l_quantity / 4 ELSE l_quantity END) AS DECIMAL(18,2)) AS value
  FROM reported GROUP BY 1, 2, 3, l_linestatus),
silver AS (
  SELECT 'PART' || l_partkey AS series_id,
         concat_ws(', ', upper(p_brand), lower(p_type), 'size ' || p_size,
                   upper(split_part(p_name, ' ', 1))) AS series_title,
         year, period, max(value) AS value
  FROM data LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL),
people AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population
  FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) <> 1998 GROUP BY 1),
stats AS (
  SELECT avg(population) AS m, stddev_samp(population) AS d
  FROM people WHERE year BETWEEN 1996 AND 2000),
flow_best AS (
  SELECT * FROM (
    SELECT *, rank() OVER (PARTITION BY series_id ORDER BY yearly_sum DESC) AS place
    FROM (SELECT series_id, series_title, year, sum(value) AS yearly_sum
          FROM (SELECT *, max(CASE WHEN period <> 'Q05' THEN 1 ELSE 0 END) OVER (PARTITION BY series_id) AS quarterly
                FROM silver)
          WHERE (period <> 'Q05') = (quarterly = 1) GROUP BY ALL))
  WHERE place = 1),
flow_values AS (
  SELECT series_id, year, value, population FROM silver LEFT JOIN people USING (year)
  WHERE series_id = 'PART25' AND period = 'Q01')"""

ORACLES: dict[str, str] = {
    "best_year": f"WITH {BEST} SELECT * FROM best",
    "best_year_sql": f"WITH {BEST} SELECT * FROM best",
    "best_year_single": f"""WITH {SUMS}
SELECT l_partkey, l_returnflag, series_title, year, yearly_sum FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag
                               ORDER BY yearly_sum DESC, year, series_title) AS place FROM sums)
WHERE place = 1""",
    "period_rule_audit": AUDIT,
    "equivalence_diff": f"""WITH {BEST},
other AS (
  SELECT s.* FROM sums s JOIN (
    SELECT l_partkey, l_returnflag, max(yearly_sum) AS peak FROM sums GROUP BY ALL) m
  ON s.l_partkey = m.l_partkey AND s.l_returnflag = m.l_returnflag AND s.yearly_sum = m.peak)
SELECT (SELECT count(*) FROM (SELECT * FROM best EXCEPT ALL SELECT * FROM other)) AS only_left,
       (SELECT count(*) FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM best)) AS only_right""",
    "twins_diff": f"""WITH {BEST},
other AS (
  SELECT s.* FROM sums s JOIN (
    SELECT l_partkey, l_returnflag, max(yearly_sum) AS peak FROM sums GROUP BY ALL) m
  ON s.l_partkey = m.l_partkey AND s.l_returnflag = m.l_returnflag AND s.yearly_sum = m.peak),
{YEARS},
stats AS (
  SELECT round(avg(population), 2) AS m, round(stddev_samp(population), 2) AS d
  FROM years WHERE year BETWEEN 1996 AND 2000),
stats_again AS (
  SELECT round(s / n, 2) AS m, round(sqrt((q - s * s / n) / (n - 1)), 2) AS d
  FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(population) AS DOUBLE) AS s,
               CAST(sum(population * population) AS DOUBLE) AS q
        FROM years WHERE year BETWEEN 1996 AND 2000)),
wanted AS (
  SELECT l_partkey, year, period, CAST(sum(value) AS DECIMAL(18,2)) AS value
  FROM facts WHERE l_partkey = 25 AND period = 'Q05' GROUP BY ALL),
keyed AS (
  SELECT wanted.*, population FROM wanted LEFT JOIN years ON wanted.year = years.year),
keyed_again AS (
  SELECT w.*, (SELECT count(*) FROM orders WHERE year(o_orderdate) = w.year AND w.year <> 1998
               HAVING count(*) > 0) AS population
  FROM wanted w)
SELECT 'best_year' AS answer,
       (SELECT count(*) FROM (SELECT * FROM best EXCEPT ALL SELECT * FROM other)) AS only_left,
       (SELECT count(*) FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM best)) AS only_right
UNION ALL
SELECT 'range_stats', (SELECT count(*) FROM (SELECT * FROM stats EXCEPT ALL SELECT * FROM stats_again)),
       (SELECT count(*) FROM (SELECT * FROM stats_again EXCEPT ALL SELECT * FROM stats))
UNION ALL
SELECT 'keyed_value', (SELECT count(*) FROM (SELECT * FROM keyed EXCEPT ALL SELECT * FROM keyed_again)),
       (SELECT count(*) FROM (SELECT * FROM keyed_again EXCEPT ALL SELECT * FROM keyed))""",
    "range_stats": f"""WITH {ALL_YEARS}
SELECT CAST(round(avg(population), 2) AS DECIMAL(18,2)) AS mean_population,
       CAST(round(stddev_samp(population), 2) AS DECIMAL(18,2)) AS stddev_population
FROM years WHERE year BETWEEN 1996 AND 2000""",
    "reference_years": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
    "keyed_value_with_reference": f"WITH {KEYED} SELECT * FROM keyed",
    "coverage_gaps": f"WITH {GAPS} SELECT * FROM gaps",
    "coverage_gaps_by_key": """
SELECT user_id, CAST(day AS VARCHAR) AS day,
       CAST(day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS gap
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)""",
    "dedupe_by_key": """
SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_partkey, l_suppkey,
       CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS place
      FROM lineitem)
WHERE place = 1""",
    "typed_clean": """
SELECT p_partkey, p_brand, CASE WHEN p_size > 5 THEN p_size END AS p_size,
       CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part""",
    "labelled_facts": f"""WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
         CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_suppkey DESC, l_partkey DESC, l_quantity DESC) AS place FROM lineitem)
  WHERE place = 1), {LABELLED}
SELECT *, concat_ws(', ', r_name, n_name, brand_text, type_text) AS series_title FROM labelled""",
    "lookup_resolution": f"""WITH lines AS (SELECT * FROM lineitem), {LABELLED}
SELECT 'r_name' AS label, count(*) AS rows, count(*) - count(r_name) AS missing FROM labelled
UNION ALL SELECT 'n_name', count(*), count(*) - count(n_name) FROM labelled
UNION ALL SELECT 'brand_text', count(*), count(*) - count(brand_text) FROM labelled
UNION ALL SELECT 'type_text', count(*), count(*) - count(type_text) FROM labelled""",
    "delimited_roundtrip": """
SELECT 'customer' AS source, c_custkey AS code, c_name AS label FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation""",
    "json_records": """
SELECT c_custkey AS customer_id, 'balance' AS measure, CAST(c_acctbal AS DECIMAL(18,2)) AS amount
FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT c_custkey, 'nation', CAST(c_nationkey AS DECIMAL(18,2)) FROM customer WHERE c_acctbal >= 0""",
    "rescue_malformed": """
SELECT event_id, user_id,
       CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) END AS value,
       CASE WHEN event_type = 'error'
            THEN event_id || chr(9) || user_id || chr(9) || 'n/a' END AS rescued
FROM events""",
    "schema_drift": """
SELECT * FROM (
  SELECT 'c_custkey' AS "column", 'bigint' AS expected_type, 'bigint' AS actual_type,
         'ok' AS status, CAST(NULL AS BIGINT) AS "values"
  UNION ALL SELECT 'c_name', 'string', 'string', 'ok', NULL
  UNION ALL SELECT 'c_nationkey', 'bigint', 'int', 'retyped', count(c_nationkey) FROM customer
  UNION ALL SELECT 'c_phone', 'string', NULL, 'missing', NULL
  UNION ALL SELECT 'c_acctbal', 'double', 'double', 'ok', NULL
  UNION ALL SELECT 'c_mktsegment', NULL, 'string', 'unexpected', count(c_mktsegment) FROM customer)""",
    "expect_drop": """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey <> 7 AND c_acctbal >= 0""",
    "rule_violations": """
SELECT c_custkey, concat_ws(',',
         CASE WHEN c_mktsegment IS NULL OR c_mktsegment = 'MACHINERY' THEN 'non_null_segment' END,
         CASE WHEN NOT coalesce(c_nationkey <> 7 AND c_nationkey >= 0 AND c_acctbal >= 0, false)
              THEN 'balance_not_negative' END,
         CASE WHEN NOT coalesce(c_nationkey BETWEEN 0 AND 24, false) THEN 'known_nation' END,
         CASE WHEN NOT coalesce(c_nationkey < 20, false) THEN 'home_market' END) AS violated
FROM customer WHERE violated <> ''""",
    "expect_metrics": f"""WITH {GAPS}, {CUSTOMER_RULES}
SELECT 'customer' AS dataset, rule, action, count(*) AS rows,
       count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed,
       count(*) FILTER (NOT ok AND action = 'drop') AS dropped
FROM rules GROUP BY ALL
UNION ALL
SELECT 'coverage', 'no_year_gap', 'warn', count(*),
       count(*) FILTER (year_gap IS NULL OR year_gap = 1), count(*) FILTER (year_gap <> 1), 0
FROM gaps""",
    "volume_freshness": """
SELECT 'events' AS dataset, count(*) AS rows, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS newest,
       count(*) >= 1 AS volume_ok, max(CAST(ts AS DATE)) >= DATE '2024-02-01' AS fresh_ok
FROM events""",
    "listing_links": f"WITH {LINKS} SELECT page_id, position, filename, link FROM links",
    "landing_reconcile": f"""WITH {RECONCILED}
SELECT filename, status, CASE WHEN status = 'unpublished' THEN 'retain' ELSE 'fetch' END AS action
FROM both_sides""",
    "landing_summary": f"""WITH {RECONCILED}
SELECT status, CASE WHEN status = 'unpublished' THEN 'delete' ELSE 'fetch' END AS action,
       count(*) AS files
FROM both_sides GROUP BY ALL""",
    "stale_sources": f"""WITH {RECONCILED}
SELECT DISTINCT l.filename FROM links l JOIN both_sides b ON l.filename = b.filename
WHERE l.position = 0 AND b.status = 'unpublished'""",
    "run_summary": f"""WITH {RECONCILED}
SELECT (SELECT count(*) FILTER (length(filename) % 5 NOT IN (0, 1)) FROM listing) AS downloaded,
       (SELECT count(*) FILTER (length(filename) % 5 IN (0, 1)) FROM listing) AS failed,
       count(*) FILTER (status = 'unpublished') AS unpublished,
       count(*) FILTER (status = 'unpublished') AS deleted
FROM both_sides""",
    "manifest_seen": f"""WITH {SEEN},
spans AS (
  SELECT user_id, event_type, min(day) AS first_seen, max(day) AS last_seen
  FROM seen GROUP BY ALL)
SELECT user_id, event_type, CAST(first_seen AS VARCHAR) AS first_seen,
       CAST(last_seen AS VARCHAR) AS last_seen,
       CAST((SELECT min(day) FROM seen WHERE day > last_seen) AS VARCHAR) AS retired_on
FROM spans""",
    "latest_snapshot": """
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "report_top10": f"WITH {TOP10} SELECT * FROM top10",
    "report_best_table": f"""WITH {BEST}
SELECT *, CAST(year AS VARCHAR) AS year_display,
       format('{{:,.2f}}', CAST(yearly_sum AS DOUBLE)) AS yearly_sum_display
FROM best""",
    "report_title_totals": f"""WITH {TOP10}
SELECT series_title, CAST(sum(yearly_sum) AS DECIMAL(18,2)) AS yearly_sum
FROM top10 GROUP BY series_title""",
    "report_trend": f"""WITH {ALL_YEARS}
SELECT year, population, population - lag(population) OVER (ORDER BY year) AS change
FROM years WHERE year BETWEEN 1996 AND 2000""",
    "report_value_by_year": f"WITH {KEYED} SELECT year, value, population FROM keyed",
    "highest_series": f"""WITH {BEST}
SELECT * FROM best WHERE yearly_sum = (SELECT max(yearly_sum) FROM best)""",
    "result_profile": f"""WITH {BEST}
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS series, count(*) FILTER (n > 1) AS tied
FROM (SELECT count(*) AS n FROM best GROUP BY l_partkey, l_returnflag)""",
    "stream_ingest": """
SELECT event_type, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
FROM events GROUP BY event_type""",
    "medallion_flow": f"""WITH {FLOW}
SELECT 'pop_stats.mean_population' AS answer, CAST(NULL AS VARCHAR) AS series_id,
       CAST(NULL AS VARCHAR) AS series_title, CAST(NULL AS INTEGER) AS year,
       CAST(round(m, 2) AS DECIMAL(18,2)) AS amount FROM stats
UNION ALL SELECT 'pop_stats.stddev_population', NULL, NULL, NULL,
       CAST(round(d, 2) AS DECIMAL(18,2)) FROM stats
UNION ALL SELECT 'best_year.yearly_sum', series_id, series_title, year,
       CAST(yearly_sum AS DECIMAL(18,2)) FROM flow_best
UNION ALL SELECT 'value_pop.value', series_id, NULL, year, CAST(value AS DECIMAL(18,2))
FROM flow_values
UNION ALL SELECT 'value_pop.population', series_id, NULL, year, CAST(population AS DECIMAL(18,2))
FROM flow_values""",
    "best_year_incremental": f"WITH {BEST} SELECT * FROM best",
    "guarded_lookup": """
SELECT s_name AS label, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM lineitem LEFT JOIN supplier ON s_suppkey = CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_suppkey END
GROUP BY ALL""",
    "header_rescue": """
SELECT c_custkey, c_name,
       CASE WHEN c_custkey % 3 <> 2 AND c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 0 AND c_acctbal < 0 THEN '{"c_acctbal":"overdrawn"}'
            WHEN c_custkey % 3 = 1 THEN
              '{' || CASE WHEN c_acctbal < 0 THEN '"c_acctbal":"overdrawn",' ELSE '' END
              || '"c_mktsegment":"' || c_mktsegment || '"}' END AS rescued
FROM customer""",
    "landing_guards": f"""WITH {RECONCILED},
bad AS (SELECT filename FROM listing WHERE length(filename) % 5 = 0)
SELECT 'no listing' AS guard, 'stopped' AS outcome
UNION ALL SELECT 'listing', 'passed' FROM listing HAVING count(*) > 0
UNION ALL SELECT 'failures', count(*) || ' item(s) failed; all are listed in guards.failures' FROM bad
UNION ALL SELECT 'comment', 'Files that failed'
UNION ALL SELECT 'quality', 'landing'
UNION ALL SELECT 'failed', filename FROM bad""",
    "snapshot_as_of": """
SELECT event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
       CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS ingest_date
FROM events
WHERE date_trunc('week', ts) = (SELECT max(date_trunc('week', ts)) FROM events
                                WHERE date_trunc('week', ts) <= DATE '2024-01-20')""",
    "runs_out_of_bounds": """
WITH lines AS (
  SELECT CAST(ts AS DATE) AS run, 'rows' AS "check", count(*) AS number FROM events GROUP BY 1
  UNION ALL
  SELECT CAST(ts AS DATE), 'no_error', count(*) FILTER (event_type = 'error') FROM events GROUP BY 1
  UNION ALL
  SELECT CAST(ts AS DATE), 'value_below_150', count(*) FILTER (value >= 150) FROM events GROUP BY 1),
bounds AS (
  SELECT *, count(*) OVER earlier AS runs_before, min(number) OVER earlier AS least, max(number) OVER earlier AS most
  FROM lines
  WINDOW earlier AS (PARTITION BY "check" ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT 'events' AS dataset, "check", CAST(run AS VARCHAR) AS run, number, runs_before,
       CASE WHEN runs_before >= 5 THEN CAST(least AS DOUBLE) END AS lower,
       CASE WHEN runs_before >= 5 THEN CAST(most AS DOUBLE) END AS upper,
       runs_before >= 5 AND (number < least OR number > most) AS outside
FROM bounds""",
    "planted_differences": """
WITH a AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer),
kept AS (
  SELECT c_custkey, c_name, c_nationkey,
         CAST(CASE WHEN c_custkey % 89 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS DECIMAL(18,2)) AS c_acctbal
  FROM a WHERE c_custkey % 97 <> 0),
b AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE c_custkey % 83 = 0),
sides AS (
  SELECT *, 1 AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
  UNION ALL SELECT *, -1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(sum(n) AS BIGINT) AS surplus FROM sides GROUP BY ALL""",
    "layout_skipping": """
SELECT 'l_partkey' AS filter, count(*) AS rows, true AS sorted_skips, true AS curve_skips
FROM lineitem WHERE l_partkey = 25
UNION ALL
SELECT 'year', count(*), false, true FROM lineitem WHERE year(l_shipdate) = 1995""",
    "stream_upsert": """
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS place
      FROM events)
WHERE place = 1""",
}
ORACLES["manifest_runs"] = ORACLES["manifest_seen"]
