"""The marts and reports again, as SQL for DuckDB.

Each entry names a relation and its SELECT over others; :func:`text` puts the
ones it needs, and the bronze relations below them, into one WITH statement.
These are written from the meaning of the datasets, apart from their DataFrame
form, so that the two check each other.
"""

from __future__ import annotations

import re

from ..functions.columns import LEGAL_WORDS
from .bronze import BRONZE, duckdb_text
from .shapes import CURATED

AS_OF = "DATE '2001-08-01'"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"

_NAME = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s]', ' ', 'g'), '\\b(?:" + "|".join(LEGAL_WORDS) + ")\\b', ' ', 'g'), '\\s+', ' ', 'g'))"
_DOMAIN = "regexp_replace(CASE WHEN contains({0}, '@') THEN split_part(lower(trim({0})), '@', 2) ELSE lower(trim({0})) END, '^www\\.', '')"
_FQ = "'FY' || (year({0}) + CASE WHEN month({0}) >= 2 THEN 1 ELSE 0 END) || '-Q' || ((((month({0}) + 10) % 12) // 3) + 1)"

SQL: dict[str, str] = {
    "crm_latest": "SELECT * FROM crm_accounts QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY created_date DESC, batch DESC) = 1",
    "erp_latest": "SELECT * FROM erp_customers QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_date DESC, batch DESC) = 1",
    "crm_keys": f"SELECT account_id, account_name, billing_country, {_NAME.format('account_name')} AS name_key, {_DOMAIN.format('website')} AS domain_key FROM crm_latest",
    "erp_keys": f"SELECT customer_id, customer_name, country, {_NAME.format('customer_name')} AS name_key, {_DOMAIN.format('payment_contact_email')} AS domain_key FROM erp_latest",
    "identity_linked": "SELECT c.*, e.customer_id, e.customer_name, e.country, 'crosswalk' AS match_method FROM crm_keys c JOIN crosswalk x ON x.crm_account_id = c.account_id JOIN erp_keys e ON e.customer_id = x.erp_customer_id",
    "identity_named": "SELECT c.*, e.customer_id, e.customer_name, e.country, CASE WHEN e.customer_id IS NULL THEN 'crm_only' ELSE 'name_domain' END AS match_method FROM crm_keys c LEFT JOIN erp_keys e ON e.name_key = c.name_key AND e.domain_key = c.domain_key WHERE c.account_id NOT IN (SELECT account_id FROM identity_linked)",
    "identity_crm": "SELECT * FROM identity_linked UNION ALL SELECT * FROM identity_named",
    "silver_customer": """SELECT * FROM (
  SELECT sha256(concat_ws('|', account_id, customer_id)) AS customer_sk, account_id AS crm_account_id, customer_id AS erp_customer_id, coalesce(account_name, customer_name) AS company_name, coalesce(billing_country, country) AS country, name_key, domain_key, match_method FROM identity_crm
  UNION ALL
  SELECT sha256(customer_id), NULL, customer_id, customer_name, country, name_key, domain_key, 'erp_only' FROM erp_keys WHERE customer_id NOT IN (SELECT customer_id FROM identity_crm WHERE customer_id IS NOT NULL))
QUALIFY row_number() OVER (PARTITION BY customer_sk ORDER BY CASE match_method WHEN 'crosswalk' THEN 1 WHEN 'name_domain' THEN 2 WHEN 'crm_only' THEN 3 ELSE 4 END, company_name) = 1""",
    "silver_contract": """SELECT c.contract_id, c.contract_source, s.customer_sk, c.crm_account_id, c.contract_number, c.contract_status, c.start_date, c.end_date, c.contract_amount, c.currency FROM (
  SELECT contract_id, 'contract' AS contract_source, account_id AS crm_account_id, contract_number, status AS contract_status, start_date, end_date, contract_value AS contract_amount, currency FROM crm_contracts
  UNION ALL SELECT opportunity_id, 'opportunity', account_id, NULL, 'Won', close_date, NULL, amount, currency FROM crm_opportunities WHERE stage = 'Closed Won') c
LEFT JOIN silver_customer s ON s.crm_account_id = c.crm_account_id""",
    "silver_contract_single": "SELECT * FROM silver_contract c WHERE contract_source = 'contract' OR NOT EXISTS (SELECT 1 FROM crm_contracts k WHERE k.account_id = c.crm_account_id AND k.start_date = c.start_date)",
    "silver_sales_order": "SELECT order_id AS sales_order_id, customer_sk, customer_id AS erp_customer_id, order_date, net_total_usd AS net_amount, upper(o.currency) AS currency, status AS order_status FROM erp_sales_orders o LEFT JOIN silver_customer s ON s.erp_customer_id = o.customer_id",
    "silver_payment": "SELECT payment_id, invoice_id, customer_sk, customer_id AS erp_customer_id, payment_date, amount_paid_usd AS payment_amount, upper(p.currency) AS currency FROM erp_payments p LEFT JOIN silver_customer s ON s.erp_customer_id = p.customer_id",
    "paid": "SELECT invoice_id, sum(payment_amount) AS amount_paid FROM silver_payment GROUP BY invoice_id",
    "invoice_open": "SELECT i.invoice_id, customer_sk, i.customer_id AS erp_customer_id, invoice_date, due_date, amount_usd AS gross_amount, upper(i.currency) AS currency, is_disputed, coalesce(amount_paid, 0) AS amount_paid, amount_usd - coalesce(amount_paid, 0) AS open_amount FROM erp_invoices i LEFT JOIN silver_customer s ON s.erp_customer_id = i.customer_id LEFT JOIN paid p ON p.invoice_id = i.invoice_id",
    "silver_invoice": f"SELECT *, open_amount <= 0.01 AS is_paid, amount_paid > 0 AND amount_paid < gross_amount - 0.01 AS is_partial, open_amount > 0.01 AND due_date < {AS_OF} AS is_late, CASE WHEN open_amount > 0.01 THEN date_diff('day', due_date, {AS_OF}) ELSE 0 END AS days_past_due FROM invoice_open",
    "silver_activity": "SELECT activity_id, customer_sk, account_id AS crm_account_id, activity_type, activity_date, subject AS subject_text, description AS description_text, length(coalesce(subject, '')) > 0 OR length(coalesce(description, '')) > 0 AS has_restricted_text FROM crm_activities a LEFT JOIN silver_customer s ON s.crm_account_id = a.account_id",
    "silver_case": "SELECT case_id, customer_sk, account_id AS crm_account_id, status, priority, opened_date AS created_date, closed_date, coalesce(lower(status), '') NOT IN ('closed', 'resolved') AS is_open, round(date_diff('second', opened_date::TIMESTAMP, closed_date::TIMESTAMP) / 3600, 2) AS resolution_hours, subject AS subject_text, case_comment AS description_text, length(coalesce(subject, '')) > 0 OR length(coalesce(case_comment, '')) > 0 AS has_restricted_text FROM crm_cases c LEFT JOIN silver_customer s ON s.crm_account_id = c.account_id",
    "silver_product": "SELECT material_id AS product_id, material_desc AS product_name, category, category || ' family' AS family, list_price_usd AS unit_price, valid_from AS seq, valid_from AS start_at, lead(valid_from) OVER (PARTITION BY material_id ORDER BY valid_from) AS end_at FROM erp_products LEFT JOIN (SELECT division, min(category) AS category FROM ref_product_hierarchy GROUP BY division) USING (division)",
    "silver_territory": "SELECT territory_id, trim(territory_name) AS territory_name, upper(region) AS region FROM crm_territories",
    "contracts_of": "SELECT customer_sk, count(*) AS contract_count, sum(contract_amount) AS total_contract_amount, max(start_date) AS latest_contract_date FROM silver_contract GROUP BY 1",
    "invoices_of": "SELECT customer_sk, count(*) AS invoice_count, sum(gross_amount) AS total_invoiced, sum(amount_paid) AS total_paid, sum(open_amount) AS total_open_ar, count(*) FILTER (is_late) AS late_invoice_count, max(days_past_due) AS max_days_past_due FROM silver_invoice GROUP BY 1",
    "cases_of": "SELECT customer_sk, count(*) AS case_count, count(*) FILTER (is_open) AS open_case_count, avg(resolution_hours) AS avg_resolution_hours FROM silver_case GROUP BY 1",
    "activities_of": "SELECT customer_sk, count(*) AS activity_count, max(activity_date) AS last_activity_date FROM silver_activity GROUP BY 1",
    "gold_customer_360": "SELECT * FROM silver_customer LEFT JOIN contracts_of USING (customer_sk) LEFT JOIN invoices_of USING (customer_sk) LEFT JOIN cases_of USING (customer_sk) LEFT JOIN activities_of USING (customer_sk)",
    "booked": "SELECT customer_sk, date_trunc('month', start_date)::DATE AS period_month, sum(contract_amount) AS amount, count(*) AS n FROM silver_contract GROUP BY 1, 2",
    "ordered": "SELECT customer_sk, date_trunc('month', order_date)::DATE AS period_month, sum(net_amount) AS amount, count(*) AS n FROM silver_sales_order GROUP BY 1, 2",
    "billed": "SELECT customer_sk, date_trunc('month', invoice_date)::DATE AS period_month, sum(gross_amount) AS amount, count(*) AS n FROM silver_invoice GROUP BY 1, 2",
    "gold_revenue_pipeline": """SELECT coalesce(b.customer_sk, o.customer_sk, i.customer_sk) AS customer_sk, coalesce(b.period_month, o.period_month, i.period_month) AS period_month, coalesce(b.amount, 0) AS booked_amount, coalesce(b.n, 0) AS booking_count, coalesce(o.amount, 0) AS ordered_amount, coalesce(o.n, 0) AS order_count, coalesce(i.amount, 0) AS billed_amount, coalesce(i.n, 0) AS invoice_count
FROM booked b FULL JOIN ordered o ON o.customer_sk = b.customer_sk AND o.period_month = b.period_month FULL JOIN billed i ON i.customer_sk = coalesce(b.customer_sk, o.customer_sk) AND i.period_month = coalesce(b.period_month, o.period_month)""",
    "gold_bookings_vs_billings": "SELECT period_month, sum(booked_amount) AS total_booked, sum(billed_amount) AS total_billed, sum(ordered_amount) AS total_ordered, sum(booked_amount) - sum(billed_amount) AS billings_gap, CASE WHEN sum(booked_amount) <> 0 THEN round(sum(billed_amount)::DOUBLE / sum(booked_amount)::DOUBLE, 4) END AS billed_to_booked_ratio FROM gold_revenue_pipeline GROUP BY 1",
    "aged": "SELECT customer_sk, coalesce(sum(open_amount) FILTER (days_past_due <= 0), 0) AS ar_current, coalesce(sum(open_amount) FILTER (days_past_due BETWEEN 1 AND 30), 0) AS ar_1_30, coalesce(sum(open_amount) FILTER (days_past_due BETWEEN 31 AND 60), 0) AS ar_31_60, coalesce(sum(open_amount) FILTER (days_past_due BETWEEN 61 AND 90), 0) AS ar_61_90, coalesce(sum(open_amount) FILTER (days_past_due > 90), 0) AS ar_90_plus, sum(open_amount) AS total_open_ar, max(days_past_due) AS max_days_past_due, sum(days_past_due * open_amount)::DOUBLE / sum(open_amount)::DOUBLE AS weighted_days_past_due, count(*) FILTER (is_disputed) AS disputed_invoice_count FROM silver_invoice WHERE open_amount > 0 AND customer_sk IS NOT NULL GROUP BY 1",
    "gold_collections_risk": "SELECT a.*, company_name, country, CASE WHEN ar_90_plus > 0 THEN 'high' WHEN ar_61_90 > 0 OR disputed_invoice_count > 0 THEN 'medium' WHEN total_open_ar > 0 THEN 'low' ELSE 'none' END AS risk_tier FROM aged a LEFT JOIN silver_customer USING (customer_sk)",
    "gold_support_performance": "SELECT customer_sk, count(*) AS case_count, count(*) FILTER (is_open) AS open_case_count, avg(resolution_hours) AS avg_resolution_hours, max(created_date) AS last_case_date, count(*) FILTER (lower(priority) IN ('high', 'critical')) AS high_priority_case_count FROM silver_case WHERE customer_sk IS NOT NULL GROUP BY 1",
    "health_inputs": f"SELECT c.customer_sk, c.company_name, c.country, s.open_case_count, s.high_priority_case_count, s.avg_resolution_hours, r.risk_tier, r.total_open_ar, a.last_activity_date, a.activity_count, date_diff('day', a.last_activity_date, {AS_OF}) AS days_since_last_activity FROM silver_customer c LEFT JOIN gold_support_performance s USING (customer_sk) LEFT JOIN gold_collections_risk r USING (customer_sk) LEFT JOIN activities_of a USING (customer_sk)",
    "health_points": "SELECT *, coalesce(open_case_count, 0) + 2 * coalesce(high_priority_case_count, 0) + CASE risk_tier WHEN 'high' THEN 5 WHEN 'medium' THEN 3 WHEN 'low' THEN 1 ELSE 0 END + CASE WHEN days_since_last_activity > 180 THEN 3 WHEN days_since_last_activity > 90 THEN 1 ELSE 0 END AS health_score FROM health_inputs",
    "gold_account_health": "SELECT *, CASE WHEN health_score >= 8 THEN 'at_risk' WHEN health_score >= 4 THEN 'watch' ELSE 'healthy' END AS health_tier FROM health_points",
    "gold_renewal_risk": f"SELECT contract_id, customer_sk, contract_amount, end_date, date_diff('day', {AS_OF}, end_date) AS days_to_expiry, health_tier, health_score, CASE WHEN health_tier = 'at_risk' OR date_diff('day', {AS_OF}, end_date) < 0 THEN 'high' WHEN health_tier = 'watch' OR date_diff('day', {AS_OF}, end_date) <= 60 THEN 'medium' ELSE 'low' END AS renewal_risk_tier FROM silver_contract LEFT JOIN gold_account_health USING (customer_sk) WHERE date_diff('day', {AS_OF}, end_date) BETWEEN -30 AND 180",
    "accounts": "SELECT customer_sk, coalesce(crm_account_id, erp_customer_id) AS account_id, company_name AS account_name, t.territory_id, t.region FROM silver_customer s LEFT JOIN crm_latest c ON c.account_id = s.crm_account_id LEFT JOIN silver_territory t ON t.territory_id = c.territory_id",
    "opportunity_pipeline": f"SELECT opportunity_id, o.account_id, a.region, stage, CASE WHEN stage LIKE 'Closed%' THEN 'Closed' ELSE 'Open' END AS status, amount, probability / 100.0 AS probability, close_date, {_FQ.format('close_date')} AS fiscal_quarter FROM crm_opportunities o LEFT JOIN accounts a ON a.account_id = o.account_id",
    "account_bookings_billings": f"SELECT account_id, account_name, region, period_month AS period, {_FQ.format('period_month')} AS fiscal_quarter, sum(booked_amount) AS bookings_amount, sum(billed_amount) AS billings_amount FROM gold_revenue_pipeline JOIN accounts USING (customer_sk) GROUP BY ALL",
    "account_collections": "SELECT account_id, account_name, total_open_ar AS ar_balance, total_open_ar - ar_current AS overdue_amount, max_days_past_due AS days_overdue, upper(left(risk_tier, 1)) || substr(risk_tier, 2) AS risk_tier, round(greatest((total_open_ar - ar_current)::DOUBLE / total_open_ar::DOUBLE, CASE WHEN ar_90_plus > 0 THEN 0.5 ELSE 0 END), 4) AS risk_score FROM gold_collections_risk JOIN accounts USING (customer_sk)",
    "account_scores": "SELECT account_id, account_name, greatest(0, 100 - 7 * health_score) AS health_score, CASE WHEN coalesce(open_case_count, 0) > 2 THEN 'open cases' WHEN risk_tier = 'high' THEN 'overdue receivables' ELSE 'none' END AS top_negative_driver FROM gold_account_health JOIN accounts USING (customer_sk)",
    "account_renewals": "SELECT contract_id, account_id, account_name, end_date AS renewal_date, upper(left(renewal_risk_tier, 1)) || substr(renewal_risk_tier, 2) AS risk_tier, CASE renewal_risk_tier WHEN 'high' THEN 0.6 WHEN 'medium' THEN 0.3 ELSE 0.1 END AS churn_probability, contract_amount AS arr FROM gold_renewal_risk JOIN accounts USING (customer_sk)",
    "account_support": "SELECT account_id, account_name, open_case_count AS open_tickets, high_priority_case_count AS open_escalations, round(100.0 * (case_count - open_case_count) / case_count, 1) AS sla_attainment_pct FROM gold_support_performance JOIN accounts USING (customer_sk)",
    # reports
    "exec_pipeline_by_stage": "SELECT stage, count(*) AS deals, round(sum(amount), 0) AS total_amount, round(sum(amount * probability), 0) AS weighted_amount FROM opportunity_pipeline WHERE status = 'Open' GROUP BY 1",
    "exec_latest_periods": "SELECT period, sum(bookings_amount) AS bookings, sum(billings_amount) AS billings, sum(bookings_amount - billings_amount) AS variance FROM account_bookings_billings GROUP BY 1 ORDER BY 1 DESC LIMIT 6",
    "exec_top_overdue": "SELECT account_id, account_name, round(ar_balance, 0) AS ar_balance, round(overdue_amount, 0) AS overdue_amount, days_overdue, round(risk_score, 2) AS risk_score FROM account_collections ORDER BY round(overdue_amount, 0) DESC, account_id LIMIT 15",
    "exec_health_bands": "SELECT CASE WHEN health_score >= 80 THEN 'Healthy (80+)' WHEN health_score >= 60 THEN 'Watch (60-79)' WHEN health_score >= 40 THEN 'At Risk (40-59)' ELSE 'Critical (<40)' END AS health_band, count(*) AS accounts, round(avg(health_score), 1) AS avg_score FROM account_scores GROUP BY 1",
    "exec_kpi_snapshot": "SELECT (SELECT round(sum(amount * probability), 0) FROM opportunity_pipeline WHERE status = 'Open') AS weighted_pipeline, (SELECT round(sum(overdue_amount), 0) FROM account_collections) AS total_overdue, (SELECT count(*) FROM account_scores WHERE health_score < 40) AS critical_accounts, (SELECT count(*) FROM account_renewals WHERE risk_tier = 'High') AS high_renewal_risk",
    "tool_pipeline_by_stage": "SELECT stage, count(*) AS deals, round(sum(amount), 0) AS total_amount, round(sum(amount * probability), 0) AS weighted_amount FROM opportunity_pipeline WHERE status = 'Open' AND fiscal_quarter = 'FY1999-Q2' AND region = 'ASIA' GROUP BY 1",
    "tool_bookings_billings": "SELECT period, region, sum(bookings_amount) AS bookings, sum(billings_amount) AS billings, sum(bookings_amount - billings_amount) AS variance FROM account_bookings_billings WHERE period BETWEEN DATE '1997-01-01' AND DATE '1998-12-01' GROUP BY 1, 2",
    "tool_renewal_risk": f"SELECT * FROM account_renewals WHERE renewal_date <= {AS_OF} + INTERVAL 90 DAY AND risk_tier = 'High'",
    "tool_account_health": "SELECT * FROM account_scores WHERE account_id = 'A10'",
    "tool_support_watchlist": "SELECT * FROM account_support WHERE open_escalations >= 1",
    "tool_top_accounts": "SELECT account_id, account_name, total_contract_amount AS arr, contract_count FROM gold_customer_360 JOIN accounts USING (customer_sk) ORDER BY 3 DESC NULLS LAST, 1 LIMIT 20",
    "tool_variance": "SELECT account_id, account_name, fiscal_quarter, sum(bookings_amount) AS bookings_amount, sum(billings_amount) AS billings_amount, sum(bookings_amount) - sum(billings_amount) AS variance FROM account_bookings_billings WHERE fiscal_quarter = 'FY1999-Q2' GROUP BY 1, 2, 3 HAVING abs(sum(bookings_amount) - sum(billings_amount)) > 1",
    "tool_unmatched_invoices": "SELECT invoice_id, erp_customer_id AS account_id, gross_amount AS invoice_amount, currency, amount_paid AS paid_amount, open_amount AS unpaid_variance FROM silver_invoice WHERE abs(open_amount) > 1",
    "tool_collections_risk": "SELECT * FROM account_collections WHERE risk_score >= 0.5",
    "lineage_direct": "SELECT target_schema AS schema, target_table AS \"table\", max(event_date) AS last_seen FROM table_lineage WHERE source_schema = 'gold' AND source_table = 't1' GROUP BY 1, 2",
    "lineage_upstream": "SELECT DISTINCT source_schema AS schema, source_table AS \"table\" FROM table_lineage WHERE target_schema = 'gold' AND target_table = 'u3'",
    "lineage_reach": "SELECT target_schema AS s, target_table AS t, 1 AS hop FROM table_lineage WHERE source_schema = 'gold' AND source_table = 't1' UNION SELECT e.target_schema, e.target_table, r.hop + 1 FROM lineage_reach r JOIN table_lineage e ON e.source_schema = r.s AND e.source_table = r.t WHERE r.hop < 10",
    "lineage_closure": "SELECT s AS schema, t AS \"table\", min(hop) AS shortest_hop FROM lineage_reach GROUP BY 1, 2",
    "lineage_columns": "SELECT DISTINCT target_schema AS schema, target_table AS \"table\", target_column AS \"column\" FROM column_lineage WHERE source_schema = 'gold' AND source_table = 't1'",
    "lineage_column_sources": "SELECT source_schema, source_table, source_column FROM column_lineage WHERE target_schema = 'gold' AND target_table = 'u3' AND target_column = 'c1'",
    "tool_columns_by_tag": "SELECT * FROM column_tags WHERE tag_name = 'mask' AND tag_value = 'email'",
    "lineage_producers": "SELECT DISTINCT source_schema || '.' || source_table AS producer FROM table_lineage WHERE target_schema = 'gold' AND target_table = 'u3'",
    "governance_unmasked_columns": "SELECT schema_name, table_name, column_name FROM column_tags WHERE tag_name = 'mask' AND tag_value <> 'email'",
    "table_ages": f"SELECT *, epoch({NOW} - last_altered) / 3600.0 AS age FROM ops_tables",
    "sla": "SELECT * FROM (VALUES ('bronze', 6), ('silver', 12), ('gold', 24), ('ops', 24)) AS v(domain, sla_hours)",
    "freshness_age": "SELECT table_schema AS domain, table_name, table_type, round(age, 1) AS age_hours FROM table_ages",
    "freshness_report": "SELECT table_schema, table_name, table_type, strftime(last_altered, '%Y-%m-%d %H:%M') AS last_altered FROM ops_tables WHERE table_schema = 'gold'",
    "freshness_sla": "SELECT domain, table_name, round(age, 1) AS age_hours, sla_hours, CASE WHEN age > sla_hours THEN 'BREACH' ELSE 'OK' END AS sla_status, CASE WHEN age > sla_hours THEN 'BREACH' WHEN age > 0.8 * sla_hours THEN 'WARN' ELSE 'OK' END AS sla_state FROM table_ages JOIN sla ON domain = table_schema",
    "freshness_rollup": "SELECT domain, count(*) AS tables, count(*) FILTER (sla_status = 'BREACH') AS breaching, min(age_hours) AS youngest_hours FROM freshness_sla GROUP BY 1",
    "freshness_breaches": "SELECT count(*) AS breaches FROM freshness_sla WHERE sla_status = 'BREACH'",
    "runs": "SELECT *, (epoch(period_end_time - period_start_time) // 60)::BIGINT AS duration_min FROM job_run_timeline",
    "run_recent": f"SELECT job_id, run_id, run_name, result_state, termination_code, duration_min FROM runs WHERE period_end_time >= {NOW} - INTERVAL 7 DAY",
    "run_failed": f"SELECT job_id, run_id, run_name, result_state, termination_code FROM runs WHERE period_end_time >= {NOW} - INTERVAL 7 DAY AND result_state IN ('FAILED', 'TIMEDOUT', 'ERROR', 'CANCELED')",
    "run_over_sla": f"SELECT job_id, run_id, run_name, result_state, duration_min, 60 AS sla_minutes FROM runs WHERE period_end_time >= {NOW} - INTERVAL 7 DAY AND duration_min > 60",
    "run_reliability": f"SELECT job_id, count(*) AS runs, count(*) FILTER (result_state = 'SUCCEEDED') AS succeeded, round(100.0 * count(*) FILTER (result_state = 'SUCCEEDED') / count(*), 2) AS success_pct, round(quantile_cont(duration_min, 0.95), 1) AS p95_duration_min FROM runs WHERE period_end_time >= {NOW} - INTERVAL 30 DAY GROUP BY 1",
    "tool_job_success_rate": "SELECT * FROM run_reliability WHERE job_id = 'job-3'",
    "rule_events": f"SELECT event_time, json_extract(details, '$.flow_progress.data_quality.expectations[0]') AS x FROM pipeline_event_log WHERE event_type = 'flow_progress' AND event_time >= {NOW} - INTERVAL 240 HOUR UNION ALL SELECT event_time, json_extract(details, '$.flow_progress.data_quality.expectations[1]') FROM pipeline_event_log WHERE event_type = 'flow_progress' AND event_time >= {NOW} - INTERVAL 240 HOUR",
    "rule_counts": "SELECT event_time, json_extract_string(x, '$.name') AS name, json_extract_string(x, '$.dataset') AS dataset, coalesce(json_extract_string(x, '$.passed_records')::BIGINT, 0) AS passed, coalesce(json_extract_string(x, '$.failed_records')::BIGINT, 0) AS failed FROM rule_events",
    "dq_rule_pass_rates": "SELECT dataset, name AS expectation_name, sum(passed)::BIGINT AS passed, sum(failed)::BIGINT AS failed, round(100.0 * sum(passed) / nullif(sum(passed) + sum(failed), 0), 2) AS pass_pct FROM rule_counts GROUP BY 1, 2",
    "dq_failing_rules": "SELECT dataset, name AS expectation_name, max(event_time)::DATE AS last_seen, sum(failed)::BIGINT AS failed_records FROM rule_counts WHERE failed > 0 GROUP BY 1, 2",
    "dq_error_events": f"SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, event_type, level, message FROM pipeline_event_log WHERE level IN ('ERROR', 'WARN') AND event_time >= {NOW} - INTERVAL 240 HOUR",
    "dq_latest_events": "SELECT * FROM dq_error_events ORDER BY event_time DESC, event_type, level, message LIMIT 20",
    "tool_schema_drift": f"SELECT strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, event_type, message FROM pipeline_event_log WHERE pipeline_id = 'pipeline-1' AND event_type IN ('schema_change', 'flow_definition', 'update_progress') AND regexp_matches(lower(message), 'schema|unexpected column|incompatible') AND event_time >= {NOW} - INTERVAL 720 HOUR",
    "audit_sensitive_reads": f"SELECT user_email, table_full_name, count(*) AS reads FROM audit_log WHERE event_time >= {NOW} - INTERVAL 7 DAY AND action_name = 'getTable' AND table_full_name LIKE 'gold.%' GROUP BY 1, 2",
    "audit_grant_changes": f"SELECT DISTINCT user_email, table_full_name, event_time::DATE AS day FROM audit_log WHERE event_time >= {NOW} - INTERVAL 30 DAY AND action_name LIKE '%Permissions%'",
    "billing_by_environment": "SELECT cluster_id, env, sum(dbus) AS dbus FROM billing_usage GROUP BY 1, 2",
}
SQL |= {name: f"SELECT {', '.join(columns)}, CAST({AS_OF} AS TIMESTAMP) AS data_as_of FROM {mart}" for name, (mart, columns) in CURATED.items()}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_0-9]+\b", sql))
    return [n for n in [*BRONZE, *SQL] if n in words]


def with_relations(select: str) -> str:
    """``select`` under a WITH that defines every relation it needs, in dependency order."""
    parts: dict[str, str] = {}

    def visit(name: str) -> None:
        body = duckdb_text(name) if name in BRONZE else SQL[name]
        parts[name] = ""
        for n in _needs(SQL[name]) if name in SQL else []:
            if n != name and n not in parts:
                visit(n)
        del parts[name]
        parts[name] = body

    for n in _needs(select):
        if n not in parts:
            visit(n)
    recursive = "RECURSIVE " if "lineage_reach" in parts else ""
    return (f"WITH {recursive}" + ",\n".join(f"{n} AS ({b})" for n, b in parts.items()) + "\n" if parts else "") + select


def text(name: str, columns: str = "*") -> str:
    return with_relations(f"SELECT {columns} FROM {name}")


#: Columns of money (and of shares written as decimals) in each query's SQL; queries give them as doubles.
DECIMALS: dict[str, str] = {
    "silver_contract": "contract_amount",
    "silver_sales_order": "net_amount",
    "silver_payment": "payment_amount",
    "silver_invoice": "gross_amount amount_paid open_amount",
    "gold_customer_360": "total_contract_amount total_invoiced total_paid total_open_ar",
    "gold_revenue_pipeline": "booked_amount ordered_amount billed_amount",
    "gold_bookings_vs_billings": "total_booked total_billed total_ordered billings_gap",
    "gold_collections_risk": "ar_current ar_1_30 ar_31_60 ar_61_90 ar_90_plus total_open_ar",
    "gold_account_health": "total_open_ar",
    "gold_renewal_risk": "contract_amount",
    "opportunity_pipeline": "amount",
    "account_bookings_billings": "bookings_amount billings_amount",
    "account_collections": "ar_balance overdue_amount",
    "account_renewals": "churn_probability arr",
    "silver_product": "unit_price",
    "silver_contract_single": "contract_amount",
    "customer_360_curated": "total_contract_amount total_invoiced total_paid total_open_ar",
    "account_health_curated": "total_open_ar",
    "revenue_pipeline_curated": "booked_amount ordered_amount billed_amount",
    "collections_risk_curated": "ar_current ar_1_30 ar_31_60 ar_61_90 ar_90_plus total_open_ar",
    "exec_pipeline_by_stage": "total_amount",
    "exec_latest_periods": "bookings billings variance",
    "exec_top_overdue": "ar_balance overdue_amount",
    "exec_kpi_snapshot": "total_overdue",
    "tool_pipeline_by_stage": "total_amount",
    "tool_bookings_billings": "bookings billings variance",
    "tool_renewal_risk": "churn_probability arr",
    "tool_top_accounts": "arr",
    "tool_variance": "bookings_amount billings_amount variance",
    "tool_unmatched_invoices": "invoice_amount paid_amount unpaid_variance",
    "tool_collections_risk": "ar_balance overdue_amount",
    "billing_by_environment": "dbus",
    "answer_scores": "citation_accuracy",
    "retrieval_scores": "hit",
    "fifo_allocation": "allocated",
    "product_current": "list_price_usd",
    "merge_upsert": "price",
}


def as_doubles(name: str, select: str) -> str:
    """The query's SQL with its decimals as doubles, as the registered query gives them."""
    if name not in DECIMALS:
        return select
    return "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS[name].split()) + f") FROM ({select}) AS q"
