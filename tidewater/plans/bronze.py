"""Bronze relations over the generated star-schema tables.

The marts expect CRM-like and ERP-like sources.  These statements give the local
tables that shape.  They are written in SQL that Spark and DuckDB both run, so
one text feeds the marts and their oracles; ``{orders}`` stands for a table and
``{minutes}`` for the engine's function from a number to an interval.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()

#: Which side knows a customer: every 5th only the CRM; of the others every third is linked, every third shares name and domain, the rest are known to the ERP alone.
_BOTH_NAMED = """
SELECT c_custkey AS k, c_name || ', Inc.' AS name, n_name AS country, 'T' || CAST(c_nationkey AS STRING) AS territory_id,
  lower(replace(c_name, '#', '-')) || '.example' AS domain, DATE '1999-01-01' AS created_date, 1 AS batch FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT c_custkey, 'Old ' || c_name, n_name, 'T' || CAST(c_nationkey AS STRING), 'old.example', DATE '1998-01-01', 0 FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_custkey % 7 = 0"""

BRONZE: dict[str, str] = {
    "crm_accounts": f"""
SELECT 'A' || CAST(k AS STRING) AS account_id, upper(name) AS account_name, 'www.' || domain AS website, country AS billing_country, territory_id, created_date, batch
FROM ({_BOTH_NAMED}) AS c WHERE k % 5 = 0 OR k % 3 <> 2""",
    "erp_customers": f"""
SELECT 'C' || CAST(k AS STRING) AS customer_id, name AS customer_name, country, 'USD' AS currency, 'billing@' || domain AS payment_contact_email, '+1 (415) 555-' || CAST(1000 + k % 9000 AS STRING) AS phone,
  CAST(100000000 + k AS STRING) AS tax_id, created_date, batch
FROM ({_BOTH_NAMED}) AS c WHERE k % 5 <> 0""",
    "crosswalk": "SELECT 'A' || CAST(c_custkey AS STRING) AS crm_account_id, 'C' || CAST(c_custkey AS STRING) AS erp_customer_id FROM {customer} WHERE c_custkey % 5 <> 0 AND c_custkey % 3 = 0",
    "crm_territories": "SELECT 'T' || CAST(n_nationkey AS STRING) AS territory_id, ' ' || n_name || ' ' AS territory_name, lower(r_name) AS region FROM {nation} JOIN {region} ON n_regionkey = r_regionkey",
    "erp_sales_orders": "SELECT 'O' || CAST(o_orderkey AS STRING) AS order_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS DATE) AS order_date, 'usd' AS currency, CAST(o_totalprice AS DECIMAL(18,2)) AS net_total_usd, o_orderstatus AS status FROM {orders}",
    "crm_contracts": "SELECT 'K' || CAST(o_orderkey AS STRING) AS contract_id, 'A' || CAST(o_custkey AS STRING) AS account_id, 'CD-' || CAST(o_orderkey AS STRING) AS contract_number, 'Active' AS status, CAST(o_orderdate AS DATE) AS start_date, CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS DATE) AS end_date, CAST(o_totalprice AS DECIMAL(18,2)) AS contract_value, 'USD' AS currency FROM {orders} WHERE o_orderstatus = 'F'",
    "crm_opportunities": "SELECT 'P' || CAST(o_orderkey AS STRING) AS opportunity_id, 'A' || CAST(o_custkey AS STRING) AS account_id, CASE WHEN o_orderstatus = 'P' THEN 'Closed Won' WHEN o_orderkey % 3 = 0 THEN 'Negotiation' WHEN o_orderkey % 3 = 1 THEN 'Proposal' ELSE 'Closed Lost' END AS stage, CAST(10 + o_orderkey % 9 * 10 AS INT) AS probability, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, 'USD' AS currency, CAST(o_orderdate AS DATE) AS close_date FROM {orders} WHERE o_orderstatus <> 'F'",
    "erp_invoices": "SELECT 'I' || CAST(o_orderkey AS STRING) AS invoice_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS DATE) AS invoice_date, CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS due_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount_usd, 'usd' AS currency, o_orderpriority = '1-URGENT' AS is_disputed FROM {orders}",
    "erp_payments": "SELECT 'Y' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS payment_id, 'I' || CAST(l_orderkey AS STRING) AS invoice_id, 'C' || CAST(o_custkey AS STRING) AS customer_id, CAST(l_shipdate AS DATE) AS payment_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_paid_usd, 'usd' AS currency FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    "crm_activities": "SELECT 'V' || CAST(event_id AS STRING) AS activity_id, 'A' || CAST(user_id AS STRING) AS account_id, event_type AS activity_type, CAST(ts AS DATE) AS activity_date, 'about ' || event_type AS subject, CASE WHEN event_id % 4 = 0 THEN props END AS description FROM {events} WHERE event_type <> 'error'",
    "crm_cases": "SELECT 'S' || CAST(event_id AS STRING) AS case_id, 'A' || CAST(user_id AS STRING) AS account_id, CASE event_id % 4 WHEN 0 THEN 'Closed' WHEN 1 THEN 'Resolved' WHEN 2 THEN 'New' END AS status, CASE WHEN value > 75 THEN 'Critical' WHEN value > 50 THEN 'High' ELSE 'Low' END AS priority, CAST(ts AS DATE) AS opened_date, CASE WHEN event_id % 4 < 2 THEN CAST(CAST(ts AS DATE) + INTERVAL 3 DAY AS DATE) END AS closed_date, 'case about ' || event_type AS subject, CASE WHEN event_id % 3 = 0 THEN props END AS case_comment FROM {events} WHERE event_type = 'error'",
    "erp_products": "SELECT 'M' || CAST(p_partkey AS STRING) AS material_id, p_name AS material_desc, p_brand AS division, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price_usd, DATE '1995-01-01' AS valid_from FROM {part} UNION ALL SELECT 'M' || CAST(p_partkey AS STRING), p_name, p_brand, CAST(p_retailprice * 2 AS DECIMAL(18,2)), DATE '1997-06-01' FROM {part} WHERE p_size % 2 = 0 UNION ALL SELECT 'M' || CAST(p_partkey AS STRING), p_name || ' v3', p_brand, CAST(p_retailprice * 3 AS DECIMAL(18,2)), DATE '1998-03-01' FROM {part} WHERE p_size % 4 = 0",
    "ref_product_hierarchy": "SELECT p_brand AS division, p_type AS category, p_type || ' family' AS family FROM {part}",
    "job_run_timeline": "SELECT 'job-' || CAST(user_id % 10 AS STRING) AS job_id, event_id AS run_id, 'run ' || event_type AS run_name, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'TIMEDOUT' ELSE 'SUCCEEDED' END AS result_state, CASE event_type WHEN 'error' THEN 'RUN_EXECUTION_ERROR' ELSE 'SUCCESS' END AS termination_code, ts AS period_start_time, ts + {minutes}(CAST(event_id % 97 AS INT)) AS period_end_time FROM {events}",
    "pipeline_event_log": """
SELECT ts AS event_time, CASE WHEN event_type = 'error' THEN 'update_progress' ELSE 'flow_progress' END AS event_type,
  CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
  CASE WHEN event_id % 5 = 0 THEN 'Schema mismatch in batch' WHEN event_id % 5 = 1 THEN 'Unexpected column added' ELSE 'ok' END AS message,
  'pipeline-' || CAST(user_id % 3 AS STRING) AS pipeline_id,
  '{{"flow_progress":{{"data_quality":{{"expectations":[{{"name":"has_' || event_type || '","dataset":"d' || CAST(user_id % 4 AS STRING) || '","passed_records":' || CAST(event_id % 50 AS STRING) || ',"failed_records":' || CAST(event_id % 3 AS STRING) || '}},{{"name":"valid","dataset":"d0","passed_records":1}}]}}}}}}' AS details
FROM {events}""",
    "ops_tables": "SELECT CASE n_nationkey % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' ELSE 'ops' END AS table_schema, lower(n_name) AS table_name, 'MANAGED' AS table_type, CAST(TIMESTAMP '2024-01-31 00:00:00' - {minutes}(CAST(n_nationkey * 97 AS INT)) AS TIMESTAMP) AS last_altered FROM {nation}",
    "table_lineage": "SELECT 'gold' AS source_schema, 't' || CAST(r_regionkey AS STRING) AS source_table, 'gold' AS target_schema, 'u' || CAST(n_nationkey AS STRING) AS target_table, DATE '2024-01-30' AS event_date FROM {nation} JOIN {region} ON n_regionkey = r_regionkey UNION ALL SELECT 'gold', 'u' || CAST(n_nationkey AS STRING), 'ops', 'u' || CAST((n_nationkey * 7 + 3) % 25 AS STRING) || 'x', DATE '2024-01-29' FROM {nation} UNION ALL SELECT 'ops', 'u' || CAST(n_nationkey AS STRING) || 'x', 'gold', 't' || CAST(n_regionkey AS STRING), DATE '2024-01-28' FROM {nation} WHERE n_nationkey % 5 = 0",
    "column_lineage": "SELECT 'gold' AS source_schema, 't' || CAST(n_regionkey AS STRING) AS source_table, 'c' || CAST(n_nationkey % 3 AS STRING) AS source_column, 'gold' AS target_schema, 'u' || CAST(n_nationkey AS STRING) AS target_table, 'c' || CAST(n_nationkey % 2 AS STRING) AS target_column FROM {nation}",
    "table_tags": "SELECT 'gold' AS schema_name, 'u' || CAST(n_nationkey AS STRING) AS table_name, CASE WHEN n_nationkey % 2 = 0 THEN 'certified' ELSE 'sensitivity' END AS tag_name, CASE WHEN n_nationkey % 4 = 1 THEN 'pii' WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'public' END AS tag_value FROM {nation}",
    "column_tags": "SELECT 'gold' AS schema_name, 'u' || CAST(n_nationkey AS STRING) AS table_name, 'c' || CAST(n_nationkey % 3 AS STRING) AS column_name, 'mask' AS tag_name, CASE n_nationkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' ELSE 'tax_id' END AS tag_value FROM {nation}",
    "audit_log": "SELECT ts AS event_time, 'user' || CAST(user_id % 20 AS STRING) || '@example.com' AS user_email, CASE event_type WHEN 'view' THEN 'getTable' WHEN 'click' THEN 'commandSubmit' WHEN 'purchase' THEN 'updatePermissions' ELSE event_type END AS action_name, 'gold.' || event_type || CAST(event_id % 3 AS STRING) AS table_full_name FROM {events}",
    "billing_usage": "SELECT CAST(ts AS DATE) AS usage_date, 'cluster-' || CAST(user_id % 5 AS STRING) AS cluster_id, CASE user_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'qa' ELSE 'prod' END AS env, CAST(event_id % 100 AS DECIMAL(18,2)) AS dbus FROM {events}",
}


def spark_source(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Bronze relations and raw tables by name, read from ``sf_dir``."""
    names = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}

    def source(name: str) -> DataFrame:
        if name in BRONZE:
            return spark.sql(BRONZE[name].format(**names, minutes="_minutes"))
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION _minutes(n INT) RETURNS INTERVAL DAY TO SECOND RETURN make_dt_interval(0, 0, n)")
    return source


def duckdb_text(name: str) -> str:
    return BRONZE[name].format(**{t: t for t in TABLES}, minutes="to_minutes")
