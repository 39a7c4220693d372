"""DuckDB SQL for every registered query, over the driver's views.

statement is self-contained.
"""

_RAW = """
raw AS (
  SELECT
    CASE WHEN l_returnflag = 'R' AND l_orderkey % 10 = 0 THEN 'c'
         WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || l_orderkey AS invoice_no,
    CAST(l_partkey AS VARCHAR) AS stock_code,
    CASE WHEN l_partkey % 50 <> 0 THEN p_name END AS product_description,
    CAST(CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN 0
              WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN NULL
              WHEN l_returnflag = 'R' THEN -l_quantity
              WHEN l_returnflag = 'A' AND l_orderkey % 17 = 0 THEN -l_quantity
              ELSE l_quantity END AS INTEGER) AS quantity,
    CASE WHEN l_orderkey % 89 <> 0 THEN o_orderdate END AS invoice_date,
    l_orderkey % 89 = 0 AS bad_date,
    CAST(CASE WHEN l_partkey % 83 = 0 THEN 0
              WHEN l_partkey % 79 = 0 THEN NULL
              WHEN l_partkey % 71 = 0 THEN -1
              ELSE p_retailprice END AS DECIMAL(18,4)) AS unit_price,
    CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS customer_id,
    CASE WHEN l_orderkey % 13 = 0 THEN 'NATION_0' ELSE n_name END AS country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

_SILVER = (
    _RAW
    + """,
silver AS (
  SELECT invoice_no, stock_code, product_description, quantity, invoice_date, unit_price,
         COALESCE(customer_id, -1) AS customer_id, country,
         CASE WHEN invoice_no LIKE 'C%' OR invoice_no LIKE 'c%' THEN 1 ELSE 0 END AS is_cancelled,
         quantity * unit_price AS total_line_price,
         strftime(invoice_date, '%Y-%m') AS invoice_year_month,
         CAST(year(invoice_date) AS INTEGER) AS invoice_year,
         CAST(month(invoice_date) AS INTEGER) AS invoice_month
  FROM raw
  WHERE (quantity IS NULL OR quantity <> 0) AND unit_price > 0
)"""
)

_SILVER_COLUMNS = """
  invoice_no, stock_code, product_description, quantity, invoice_date,
  CAST(unit_price AS DOUBLE) AS unit_price, customer_id, country, is_cancelled,
  CAST(total_line_price AS DOUBLE) AS total_line_price,
  invoice_year_month, invoice_year, invoice_month"""

_PRODUCT = """
product AS (
  SELECT product_description, stock_code,
         CAST(SUM(quantity) AS BIGINT) AS net_units_sold,
         CAST(SUM(total_line_price) AS DOUBLE) AS net_revenue,
         CAST(SUM(is_cancelled) AS BIGINT) AS total_cancellations,
         COUNT(DISTINCT invoice_no) AS distinct_transactions
  FROM silver GROUP BY product_description, stock_code
)"""

_COUNTRY = """
country_customers AS (
  SELECT country, COUNT(*) AS total_registered_customers
  FROM (SELECT DISTINCT country, customer_id FROM silver WHERE customer_id <> -1)
  GROUP BY country
),
country_invoices AS (
  SELECT country, COUNT(*) AS total_invoices
  FROM (SELECT DISTINCT country, invoice_no FROM silver WHERE invoice_no IS NOT NULL)
  GROUP BY country
),
country_amounts AS (
  SELECT country, CAST(SUM(total_line_price) AS DOUBLE) AS net_revenue
  FROM silver GROUP BY country
),
by_country AS (
  SELECT a.country, COALESCE(total_registered_customers, 0) AS total_registered_customers,
         COALESCE(total_invoices, 0) AS total_invoices, net_revenue
  FROM country_amounts a
  LEFT JOIN country_customers c ON a.country IS NOT DISTINCT FROM c.country
  LEFT JOIN country_invoices i ON a.country IS NOT DISTINCT FROM i.country
)"""

_MONTHLY = """
months AS (
  SELECT DISTINCT invoice_year_month, invoice_year, invoice_month FROM silver
),
sold AS (
  SELECT invoice_year_month AS m, SUM(total_line_price) AS gross
  FROM silver WHERE is_cancelled = 0 GROUP BY invoice_year_month
),
given_back AS (
  SELECT invoice_year_month AS m, SUM(total_line_price) AS net, SUM(ABS(total_line_price)) AS refunded
  FROM silver WHERE is_cancelled = 1 GROUP BY invoice_year_month
),
month_invoices AS (
  SELECT invoice_year_month AS m, COUNT(*) AS invoices
  FROM (SELECT DISTINCT invoice_year_month, invoice_no FROM silver) GROUP BY invoice_year_month
),
monthly AS (
  SELECT invoice_year_month, invoice_year, invoice_month,
         CAST(COALESCE(gross, 0) + COALESCE(net, 0) AS DOUBLE) AS net_monthly_revenue,
         CAST(COALESCE(gross, 0) AS DOUBLE) AS gross_monthly_revenue,
         CAST(COALESCE(refunded, 0) AS DOUBLE) AS total_refunded_amount,
         CAST(COALESCE(refunded, 0) AS DOUBLE) / NULLIF(CAST(COALESCE(gross, 0) AS DOUBLE), 0)
           AS return_rate,
         invoices AS monthly_transactions
  FROM months
  LEFT JOIN sold ON sold.m IS NOT DISTINCT FROM invoice_year_month
  LEFT JOIN given_back ON given_back.m IS NOT DISTINCT FROM invoice_year_month
  LEFT JOIN month_invoices ON month_invoices.m IS NOT DISTINCT FROM invoice_year_month
)"""

_RFM = """
rfm AS (
  SELECT customer_id, country,
         MAX(invoice_date) AS last_purchase_date,
         COUNT(DISTINCT invoice_no) AS frequency_of_purchase,
         CAST(SUM(total_line_price) AS DOUBLE) AS monetary_value,
         CAST(SUM(total_line_price) AS DOUBLE) / NULLIF(COUNT(total_line_price), 0)
           AS average_order_value
  FROM silver WHERE customer_id <> -1 GROUP BY customer_id, country
)"""

_STEPS = """
steps AS (
  SELECT user_id AS id, event_id AS seq, event_type,
         CASE WHEN event_type = 'click' THEN 'SELECT ' || event_id
              WHEN event_type = 'view' THEN 'gold_fact_sales'
              WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'BLOCKED: ' || event_id
              WHEN event_type = 'error' THEN 'Error: ' || CAST(value AS DECIMAL(18,2))
              WHEN event_id % 2 = 0 THEN '[(' || CAST(value AS DECIMAL(18,2)) || ',)]'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS payload
  FROM events WHERE event_type <> 'signup'
),
linked AS (
  SELECT *,
         LAG(event_type) OVER (PARTITION BY id ORDER BY seq) AS before_type,
         LAG(payload) OVER (PARTITION BY id ORDER BY seq) AS before_payload
  FROM steps
),
pairs AS (
  SELECT id, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq) AS query_no, seq,
         before_payload AS query, payload AS result
  FROM linked WHERE event_type IN ('purchase', 'error') AND before_type = 'click'
)"""

_GOLDEN = """
order_values AS (
  SELECT c_custkey AS id, c_name, c_mktsegment, order_value
  FROM customer LEFT JOIN (
    SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS order_value
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
),
golden AS (
  SELECT id, id AS position, 'What is the order value of ' || c_name || '?' AS question,
         id % 7 <> 6 AS has_expected,
         CASE WHEN id % 7 = 6 OR id % 11 = 10 OR id % 3 = 0 THEN NULL
              WHEN id % 2 = 1 AND best_sale IS NOT NULL THEN CAST(best_sale AS DOUBLE)
              ELSE CAST(order_value AS DOUBLE) END AS expected_num,
         CASE WHEN id % 7 = 6 OR id % 11 = 10 THEN NULL
              WHEN id % 3 = 0 THEN c_mktsegment
              WHEN id % 2 = 1 AND best_sale IS NOT NULL THEN NULL
              WHEN order_value IS NULL THEN 'none' END AS expected_str
  FROM order_values LEFT JOIN (
    SELECT user_id, MAX(CAST(value AS DECIMAL(18,2))) AS best_sale
    FROM events WHERE event_type = 'purchase' GROUP BY user_id) ON id = user_id
),
runs AS (
  SELECT id, id % 13 = 12 AS failed, 0.25 + CAST(id % 400 AS DOUBLE) / 100 AS latency_sec,
         CASE WHEN id % 13 = 12 THEN NULL
              WHEN id % 5 = 4 THEN 'Mostly the ' || lower(c_mktsegment) || ' segment'
              WHEN order_value IS NULL THEN 'none found'
              ELSE 'The total is ' || CASE id % 5
                WHEN 0 THEN CAST(CAST(order_value AS DECIMAL(28,2)) AS VARCHAR)
                WHEN 1 THEN CAST(order_value + CAST(0.005 AS DECIMAL(4,3)) AS VARCHAR)
                WHEN 2 THEN CAST(order_value + CAST(0.02 AS DECIMAL(3,2)) AS VARCHAR)
                ELSE CAST(CAST(trunc(order_value) AS BIGINT) // 1000 AS VARCHAR) || ',' ||
                     lpad(CAST(CAST(trunc(order_value) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
                     || '.' || right(CAST(order_value AS VARCHAR), 2)
              END || '.' END AS final_output
  FROM order_values WHERE id % 29 <> 28
)"""

_VERIFIED = """
observed AS (
  SELECT id, string_agg(result, '' ORDER BY seq) AS observation,
         COUNT(*) FILTER (WHERE contains(result, 'Error') OR contains(result, 'BLOCKED')) AS retries,
         COUNT(*) AS queries
  FROM pairs GROUP BY id
),
verified AS (
  SELECT g.id, COALESCE(NOT r.failed, false) AS successful, r.latency_sec,
         COALESCE(CASE WHEN COALESCE(r.failed, true) THEN 0 ELSE o.retries END, 0) AS retries,
         COALESCE(NOT r.failed, false) AND g.has_expected AND COALESCE(
           CASE WHEN g.expected_num IS NOT NULL THEN
             len(list_filter(
               list_transform(
                 list_concat(
                   regexp_extract_all(COALESCE(o.observation, ''), '-?\\d+\\.?\\d*'),
                   regexp_extract_all(COALESCE(r.final_output, ''), '-?\\d+\\.?\\d*')),
                 lambda t: CAST(t AS DOUBLE)),
               lambda v: abs(v - g.expected_num) <= 0.01)) > 0
           ELSE contains(lower(COALESCE(o.observation, '')), lower(g.expected_str))
             OR contains(lower(COALESCE(r.final_output, '')), lower(g.expected_str)) END,
           false) AS is_correct
  FROM golden g LEFT JOIN runs r ON g.id = r.id LEFT JOIN observed o ON g.id = o.id
)"""

_TOKENS = """
tokens AS (
  SELECT CAST(COALESCE(SUM(k), 0) AS BIGINT) AS prompt_tokens,
         CAST(COALESCE(SUM(k % 7), 0) AS BIGINT) AS completion_tokens,
         CAST(COALESCE(SUM(k + k % 7), 0) AS BIGINT) AS total_tokens
  FROM (SELECT CASE WHEN event_id % 15 = 0 THEN 0
                    ELSE CAST(regexp_extract(props, '\\d+') AS BIGINT) END AS k
        FROM events WHERE event_type = 'signup')
),
costs AS (
  SELECT *, CAST(prompt_tokens AS DOUBLE) / 1000000.0::DOUBLE * 0.05::DOUBLE
          + CAST(completion_tokens AS DOUBLE) / 1000000.0::DOUBLE * 0.08::DOUBLE
          AS estimated_cost_usd
  FROM tokens
)"""


def _with(*tables: str) -> str:
    return "WITH " + ",".join(tables)


_GUARD_JOIN = """
  SELECT f.country, COUNT(*) AS cancelled_lines, MAX(c.total_invoices) AS total_invoices
  FROM {fact} f JOIN {by_country} c ON f.country = c.country
  WHERE f.is_cancelled = 1 GROUP BY f.country"""

ORACLES = {
    "bronze_raw": _with(_RAW)
    + """
SELECT invoice_no AS "Invoice", stock_code AS "StockCode", product_description AS "Description",
       CAST(quantity AS VARCHAR) AS "Quantity",
       CASE WHEN bad_date THEN 'not a date'
            ELSE strftime(invoice_date, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
       CASE WHEN unit_price = 0 THEN '0' WHEN unit_price = -1 THEN '-1'
            ELSE CAST(unit_price AS VARCHAR) END AS "Price",
       CAST(customer_id AS VARCHAR) || CASE WHEN customer_id % 4 = 1 THEN '.0' ELSE '' END
         AS "Customer ID",
       country AS "Country"
FROM raw""",
    "silver_cleansed": _with(_SILVER) + f" SELECT {_SILVER_COLUMNS} FROM silver",
    "silver_text_dates": _with(_SILVER)
    + f" SELECT * REPLACE (strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date) FROM (SELECT {_SILVER_COLUMNS} FROM silver)",
    "layer_row_counts": _with(_SILVER)
    + """
SELECT 'bronze_sales_raw' AS layer, COUNT(*) AS row_count FROM raw
UNION ALL SELECT 'silver_sales_cleansed', COUNT(*) FROM silver""",
    "gold_fact_sales": _with(_SILVER) + f" SELECT {_SILVER_COLUMNS} FROM silver",
    "gold_product_metrics": _with(_SILVER, _PRODUCT)
    + " SELECT * FROM product ORDER BY net_revenue DESC",
    "gold_country_metrics": _with(_SILVER, _COUNTRY)
    + " SELECT * FROM by_country ORDER BY net_revenue DESC",
    "gold_monthly_trends": _with(_SILVER, _MONTHLY)
    + " SELECT * FROM monthly ORDER BY invoice_year_month",
    "gold_customer_rfm": _with(_SILVER, _RFM) + " SELECT * FROM rfm ORDER BY monetary_value DESC",
    "gold_product_positions": _with(_SILVER, _PRODUCT)
    + """
SELECT *, ROW_NUMBER() OVER (ORDER BY net_revenue DESC NULLS LAST,
         product_description NULLS FIRST, stock_code NULLS FIRST) AS position FROM product""",
    "gold_country_positions": _with(_SILVER, _COUNTRY)
    + """
SELECT *, ROW_NUMBER() OVER (ORDER BY net_revenue DESC NULLS LAST, country NULLS FIRST) AS position
FROM by_country""",
    "gold_monthly_positions": _with(_SILVER, _MONTHLY)
    + """
SELECT *, ROW_NUMBER() OVER (ORDER BY invoice_year_month NULLS FIRST) AS position FROM monthly""",
    "gold_customer_positions": _with(_SILVER, _RFM)
    + """
SELECT *, ROW_NUMBER() OVER (ORDER BY monetary_value DESC NULLS LAST, customer_id,
         country NULLS FIRST) AS position FROM rfm""",
    "clustered_month_lines": _with(_SILVER)
    + f" SELECT {_SILVER_COLUMNS} FROM silver WHERE invoice_year_month = '1997-05'",
    "clustered_country_lines": _with(_SILVER)
    + f" SELECT {_SILVER_COLUMNS} FROM silver WHERE country = 'NATION_7'",
    "clustered_product_lines": _with(_SILVER)
    + f" SELECT {_SILVER_COLUMNS} FROM silver WHERE stock_code = '77'",
    "kpi_total_net_revenue": _with(_SILVER)
    + " SELECT CAST(SUM(total_line_price) AS DOUBLE) AS total_net_revenue FROM silver",
    "kpi_total_gross_revenue": _with(_SILVER)
    + """
SELECT CAST(SUM(total_line_price) FILTER (WHERE is_cancelled = 0) AS DOUBLE)
         AS total_gross_revenue FROM silver""",
    "kpi_refund_total": _with(_SILVER)
    + """
SELECT CAST(SUM(ABS(total_line_price)) FILTER (WHERE is_cancelled = 1) AS DOUBLE)
         AS refund_total FROM silver""",
    "kpi_country_count": _with(_SILVER)
    + " SELECT COUNT(DISTINCT country) AS country_count FROM silver",
    "kpi_month_revenue": _with(_SILVER, _MONTHLY)
    + """
SELECT invoice_year_month, net_monthly_revenue, gross_monthly_revenue
FROM monthly WHERE invoice_year_month = '1997-05'""",
    "kpi_country_revenue": _with(_SILVER, _COUNTRY)
    + " SELECT country, net_revenue FROM by_country WHERE country = 'NATION_7'",
    "kpi_product_revenue": _with(_SILVER, _PRODUCT)
    + """
SELECT product_description, stock_code, net_revenue FROM product WHERE stock_code = '77'""",
    "kpi_customer_spend": _with(_SILVER)
    + """
SELECT customer_id, CAST(SUM(total_line_price) AS DOUBLE) AS customer_spend
FROM silver WHERE is_cancelled = 0 GROUP BY customer_id""",
    "kpi_top_customers": _with(_SILVER, _RFM)
    + """
SELECT customer_id, country, monetary_value FROM rfm
ORDER BY monetary_value DESC NULLS LAST, customer_id, country LIMIT 10""",
    "kpi_fact_lines": _with(_SILVER)
    + f"""
SELECT {_SILVER_COLUMNS} FROM silver
WHERE is_cancelled = 1 AND invoice_year_month = '1997-05' AND country = 'NATION_7'""",
    "guarded_topk": _with(_SILVER, _RFM)
    + """
SELECT customer_id, country, monetary_value FROM rfm
ORDER BY monetary_value DESC NULLS LAST, customer_id, country LIMIT 100""",
    "guarded_join": _with(_SILVER, _COUNTRY)
    + _GUARD_JOIN.format(fact="silver", by_country="by_country"),
    "tool_call_pairs": _with(_STEPS) + " SELECT id, query_no, seq, query, result FROM pairs",
    "llm_token_usage": _with(_TOKENS) + " SELECT * FROM tokens",
    "llm_cost": _with(_TOKENS) + " SELECT * FROM costs",
    "eval_golden": _with(_GOLDEN) + " SELECT * FROM golden ORDER BY position LIMIT 5",
    "eval_expected": _with(_GOLDEN) + " SELECT * FROM golden",
    "eval_numbers": """
SELECT page_id, source, idx AS number_no, CAST(nums[idx] AS DOUBLE) AS number
FROM (SELECT page_id, source, nums, unnest(range(1, len(nums) + 1)) AS idx
      FROM (SELECT page_id, 'url' AS source, regexp_extract_all(url, '-?\\d+\\.?\\d*') AS nums
            FROM pages
            UNION ALL
            SELECT page_id, 'html', regexp_extract_all(html, '-?\\d+\\.?\\d*') FROM pages))""",
    "eval_observation": _with(_STEPS)
    + """
SELECT id, part, substr(text, CAST(40 * part + 1 AS BIGINT), 40) AS observation
FROM (SELECT id, text, unnest(range(0, (length(text) + 39) // 40)) AS part
      FROM (SELECT id, string_agg(result, '' ORDER BY seq) AS text FROM pairs GROUP BY id))""",
    "eval_verify": _with(_GOLDEN, _STEPS, _VERIFIED) + " SELECT id, is_correct FROM verified",
    "eval_retries": _with(_STEPS)
    + """
SELECT id, COUNT(*) FILTER (WHERE contains(result, 'Error') OR contains(result, 'BLOCKED'))
         AS retries, COUNT(*) AS queries
FROM pairs GROUP BY id""",
    "eval_no_query": _with(_GOLDEN, _STEPS)
    + """
SELECT g.id, g.question FROM golden g
JOIN runs r ON g.id = r.id AND NOT r.failed
LEFT JOIN (SELECT DISTINCT id FROM pairs) p ON g.id = p.id WHERE p.id IS NULL""",
    "eval_run_metrics": _with(_GOLDEN, _STEPS, _VERIFIED, _TOKENS)
    + """
SELECT n AS batch_size, ok AS successful_executions, right_ones AS correct_results,
       CAST(ok AS DOUBLE) / n * 100.0::DOUBLE AS execution_accuracy,
       CAST(right_ones AS DOUBLE) / n * 100.0::DOUBLE AS result_accuracy,
       latency / n AS avg_latency_sec, retries AS total_firewall_blocks_and_retries,
       (SELECT total_tokens FROM costs) AS total_tokens,
       (SELECT estimated_cost_usd FROM costs) AS estimated_cost_usd,
       'unknown_version' AS data_version_hash, 'logged-model' AS model_name,
       CAST(0.0 AS DOUBLE) AS temperature, 'customer' AS golden_set_file,
       'lineitem' AS database_uri
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE successful) AS ok,
             COUNT(*) FILTER (WHERE is_correct) AS right_ones,
             CAST(SUM(CASE WHEN successful THEN CAST(latency_sec AS DECIMAL(18,6)) END) AS DOUBLE)
               AS latency,
             CAST(SUM(retries) AS BIGINT) AS retries
      FROM verified)""",
    "eval_report": _with(_GOLDEN, _STEPS, _VERIFIED)
    + """
, base AS (
  SELECT g.*, v.successful, r.final_output, r.id IS NOT NULL AS logged,
         COALESCE(o.queries, 0) AS queries
  FROM golden g JOIN verified v ON g.id = v.id LEFT JOIN runs r ON g.id = r.id
  LEFT JOIN observed o ON g.id = o.id
)
SELECT id, position, 1 AS line_no,
       'CRITICAL FAIL | ' || CASE WHEN logged THEN 'timeout' ELSE 'no run logged' END AS line
FROM base WHERE NOT successful
UNION ALL SELECT id, position, 1, chr(10) || '=======================' FROM base WHERE successful
UNION ALL SELECT id, position, 2, 'Q' || id || ': ' || question FROM base WHERE successful
UNION ALL SELECT id, position, 3, ' MODEL HALLUCINATED! (No DB queries executed)'
  FROM base WHERE successful AND queries = 0
UNION ALL SELECT p.id, position, 3 * query_no, '--- Query ' || query_no || ' ---'
  FROM pairs p JOIN base b ON p.id = b.id WHERE successful
UNION ALL SELECT p.id, position, 3 * query_no + 1, 'SQL: ' || query
  FROM pairs p JOIN base b ON p.id = b.id WHERE successful
UNION ALL SELECT p.id, position, 3 * query_no + 2, 'DB Result: ' || result
  FROM pairs p JOIN base b ON p.id = b.id WHERE successful
UNION ALL SELECT id, position, CASE WHEN queries = 0 THEN 4 ELSE 3 + 3 * queries END,
                 'Final Output: ' || final_output FROM base WHERE successful
UNION ALL SELECT id, position, CASE WHEN queries = 0 THEN 5 ELSE 4 + 3 * queries END,
                 'CRITICAL FAIL | list index out of range'
  FROM base WHERE successful AND has_expected AND expected_num IS NULL AND expected_str IS NULL""",
}
