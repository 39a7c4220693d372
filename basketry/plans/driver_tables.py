"""Retail and log inputs derived from the given order and event tables.

FIXTURES.md defines every expression.  Nothing is synthesised: each row comes
from one row of the given tables, so all of it grows with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.operators import gold, layout, silver
from basketry.schema import FACT, PRODUCT, ZONES
from basketry.sources.golden import normalise_golden
from basketry.sources.raw_csv import normalise

# Columns read from each table; a given schema saves the job that infers it.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "events": "event_id bigint, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}

# Small files, so that the given tables fill many; larger ones have larger files (`layout.files_for`).
LINES_PER_FILE = 2_000

# A task that sorts or groups lines holds about as many of them.
LINES_PER_TASK = 250_000

# Raw column -> its text, with missing-value tokens where a value is absent.
_RAW_TEXT = {
    "Invoice": """concat(
        CASE WHEN l_returnflag <> 'R' THEN '' WHEN l_orderkey % 10 = 0 THEN 'c' ELSE 'C' END,
        l_orderkey)""",
    "StockCode": "string(l_partkey)",
    "Description": """CASE
        WHEN l_partkey % 100 = 0 THEN 'NA' WHEN l_partkey % 50 = 0 THEN '' ELSE p_name END""",
    "Quantity": """CASE
        WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN '0'
        WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN 'n/a'
        WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND l_orderkey % 17 = 0)
          THEN string(int(-l_quantity))
        ELSE string(int(l_quantity)) END""",
    "InvoiceDate": """CASE
        WHEN l_orderkey % 89 = 0 THEN 'not a date'
        ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END""",
    "Price": """CASE
        WHEN l_partkey % 83 = 0 THEN '0'
        WHEN l_partkey % 79 = 0 THEN 'NaN'
        WHEN l_partkey % 71 = 0 THEN '-1'
        ELSE string(CAST(p_retailprice AS DECIMAL(18,4))) END""",
    "Customer ID": """CASE
        WHEN o_custkey % 4 = 0 THEN ''
        WHEN o_custkey % 4 = 1 THEN concat(o_custkey, '.0')
        ELSE string(o_custkey) END""",
    "Country": "CASE WHEN l_orderkey % 13 = 0 THEN 'NATION_0' ELSE n_name END",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _keyed(spark: SparkSession, sf_dir: str, name: str, **renamed: str) -> DataFrame:
    return table(spark, sf_dir, name).withColumnsRenamed(renamed)


def line_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """How many tasks hold the lines at `LINES_PER_TASK` each; None where the session's cores do.

    The count comes from the footers of the files.
    """
    wanted = -(-table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK)
    return wanted if wanted > spark.sparkContext.defaultParallelism else None


def raw_text(spark: SparkSession, sf_dir: str, n_tasks: int | None = None) -> DataFrame:
    """Retail lines as a raw file holds them: eight text columns, tokens for gaps.

    Orders meet their customers first, so the lines, by far the largest input,
    are shuffled for two joins at most and not for four.  With `n_tasks`
    they meet their orders in so many tasks, or in the session's number if that is larger.
    """
    customers = _keyed(spark, sf_dir, "customer", c_custkey="o_custkey").join(
        _keyed(spark, sf_dir, "nation", n_nationkey="c_nationkey"), "c_nationkey"
    )
    orders = _keyed(spark, sf_dir, "orders", o_orderkey="l_orderkey").join(customers, "o_custkey")
    # However few row groups hold the lines, the work on them is spread; beyond
    # broadcast size the join needs this partitioning anyway.
    spread = [n_tasks, "l_orderkey"] if n_tasks else ["l_orderkey"]
    if n_tasks:
        orders = orders.repartition(*spread)
    return (
        table(spark, sf_dir, "lineitem")
        .repartition(*spread)
        .join(orders, "l_orderkey")
        .join(_keyed(spark, sf_dir, "part", p_partkey="l_partkey"), "l_partkey")
        .selectExpr(*[f"{text} AS `{name}`" for name, text in _RAW_TEXT.items()])
    )


def bronze(spark: SparkSession, sf_dir: str, n_tasks: int | None = None) -> DataFrame:
    return normalise(raw_text(spark, sf_dir, n_tasks))


def silver_lines(spark: SparkSession, sf_dir: str, n_tasks: int | None = None) -> DataFrame:
    return silver.cleanse(bronze(spark, sf_dir, n_tasks))


def gold_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == PRODUCT:
        n_tasks = line_tasks(spark, sf_dir)
        return gold.product_metrics(silver_lines(spark, sf_dir, n_tasks), n_tasks)
    return gold.BUILDERS[name](silver_lines(spark, sf_dir))


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written below the folder that all executors share, and read back."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{top.rstrip('/')}/_tables/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def ordered_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An aggregate as `publish` stores it, in report order."""
    return _stored(spark, gold.in_report_order(name, gold_table(spark, sf_dir, name)))


def clustered_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The fact clustered by month, country and product, and its zones.

    Silver is written first, as in a lake: laying it out reads it more than once.
    """
    lines = _stored(spark, silver_lines(spark, sf_dir))
    fact = _stored(spark, layout.clustered(lines, rows_per_file=LINES_PER_FILE))
    return {FACT: fact, ZONES: layout.zones(fact)}


def tool_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool events per question: id, seq, kind, tool, payload."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type IN ('click', 'view', 'purchase', 'error')")
        .selectExpr(
            "user_id AS id",
            "event_id AS seq",
            "IF(event_type IN ('click', 'view'), 'tool_start', 'tool_end') AS kind",
            "CASE event_type WHEN 'click' THEN 'sql_db_query' "
            "WHEN 'view' THEN 'sql_db_schema' END AS tool",
            """CASE
                WHEN event_type = 'click' THEN concat('SELECT ', event_id)
                WHEN event_type = 'view' THEN 'gold_fact_sales'
                WHEN event_type = 'error' AND event_id % 3 = 0 THEN concat('BLOCKED: ', event_id)
                WHEN event_type = 'error' THEN concat('Error: ', CAST(value AS DECIMAL(18,2)))
                WHEN event_id % 2 = 0 THEN concat('[(', CAST(value AS DECIMAL(18,2)), ',)]')
                ELSE string(CAST(value AS DECIMAL(18,2))) END AS payload""",
        )
    )


def llm_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls with their usage in one of two layouts, in neither, or behind an empty first
    one; some without an id."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'signup'")
        .selectExpr(
            "event_id AS call_id", "user_id AS id", "bigint(get_json_object(props, '$.k')) AS k"
        )
        .selectExpr(
            "IF(call_id % 7 = 3, NULL, call_id) AS call_id",
            "id",
            """CASE WHEN call_id % 3 <> 0 THEN named_struct(
                'input_tokens', k, 'output_tokens', k % 7, 'total_tokens', k + k % 7)
                 WHEN call_id % 2 = 0 THEN named_struct('input_tokens', CAST(NULL AS BIGINT),
                'output_tokens', CAST(NULL AS BIGINT), 'total_tokens', CAST(NULL AS BIGINT))
               END AS usage_metadata""",
            """CASE WHEN call_id % 3 = 0 AND call_id % 15 <> 0 THEN named_struct(
                'prompt_tokens', k, 'completion_tokens', k % 7, 'total_tokens', k + k % 7)
               END AS token_usage""",
        )
    )


def _order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the value of their orders, NULL for customers without any."""
    ordered = (
        table(spark, sf_dir, "orders")
        .selectExpr("o_custkey AS id", "CAST(o_totalprice AS DECIMAL(18,2)) AS order_value")
        .groupBy("id")
        .agg({"order_value": "sum"})
        .withColumnRenamed("sum(order_value)", "order_value")
    )
    return _keyed(spark, sf_dir, "customer", c_custkey="id").join(ordered, "id", "left")


def golden_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One golden question per customer: id, position, question, result_preview (JSON)."""
    best_sales = (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .selectExpr("user_id AS id", "CAST(value AS DECIMAL(18,2)) AS best_sale")
        .groupBy("id")
        .agg({"best_sale": "max"})
        .withColumnRenamed("max(best_sale)", "best_sale")
    )
    return (
        _order_values(spark, sf_dir)
        .join(best_sales, "id", "left")
        .selectExpr(
            "id",
            "id AS position",
            "concat('What is the order value of ', c_name, '?') AS question",
            """CASE
                WHEN id % 7 = 6 THEN '[]'
                WHEN id % 11 = 10 THEN '[{}]'
                WHEN id % 3 = 0 THEN concat('[{"segment": "', c_mktsegment, '", "rows": 7}]')
                WHEN id % 2 = 1 AND best_sale IS NOT NULL
                  THEN concat('[{"best_sale": ', best_sale, ', "rows": 7}]')
                ELSE concat('[{"order_value": ', coalesce(string(order_value), 'null'),
                            ', "rows": 7}]') END AS result_preview""",
        )
    )


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_golden(golden_previews(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged run per golden question, but for every 29th."""
    return (
        _order_values(spark, sf_dir)
        .where("id % 29 <> 28")
        .selectExpr(
            "id",
            """CASE
                WHEN id % 13 = 12 THEN NULL
                WHEN id % 5 = 4 THEN concat('Mostly the ', lower(c_mktsegment), ' segment')
                WHEN order_value IS NULL THEN 'none found'
                ELSE concat('The total is ', CASE id % 5
                  WHEN 0 THEN string(order_value)
                  WHEN 1 THEN string(order_value + CAST('0.005' AS DECIMAL(4,3)))
                  WHEN 2 THEN string(order_value + CAST('0.02' AS DECIMAL(3,2)))
                  ELSE concat(bigint(order_value) div 1000, ',',
                              lpad(string(bigint(order_value) % 1000), 3, '0'), '.',
                              right(string(order_value), 2)) END, '.')
               END AS final_output""",
            "0.25D + (id % 400) / 100D AS latency_sec",
            "id % 13 = 12 AS failed",
            "CASE WHEN id % 13 = 12 THEN 'timeout' END AS error",
        )
    )
