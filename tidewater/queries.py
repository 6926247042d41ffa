"""Registered queries over the marts, reports, documents and policies, and their SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import identity_queries, kept_queries, more_queries, quality_queries
from .plans import dashboards as d
from .plans import gold, shapes, silver  # noqa: F401  (they register datasets)
from .plans.bronze import spark_source
from .plans.oracle import as_doubles, text
from .plans.registry import Context
from .shipping import ship

AS_OF, NOW = dt.date(2001, 8, 1), dt.datetime(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    return Context(spark, spark_source(spark, sf_dir), AS_OF, staged=True)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the comparison of results."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`") for f in df.schema.fields])


def _register(name: str, build: Callable[[Context], DataFrame], sql: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return _plain(build(context(spark, sf_dir)))

    QUERIES[name] = run
    if sql:
        ORACLE_SQL[name] = as_doubles(name, sql)


for _name in "silver_customer silver_contract silver_sales_order silver_payment silver_invoice silver_territory gold_customer_360 gold_revenue_pipeline gold_bookings_vs_billings gold_collections_risk gold_support_performance gold_account_health gold_renewal_risk accounts opportunity_pipeline account_bookings_billings account_collections account_scores account_renewals account_support".split():
    _columns = {"silver_territory": "*, CAST(NULL AS VARCHAR) AS parent_territory_id, CAST(NULL AS VARCHAR) AS country_code"}.get(_name, "*")
    _register(_name, lambda ctx, n=_name: ctx.read(n), text(_name, _columns))
for _name in ("silver_activity", "silver_case"):
    _register(_name, lambda ctx, n=_name: ctx.read(n).withColumn("_restricted_columns", F.array_join("_restricted_columns", ",")), text(_name, "*, 'subject_text,description_text' AS _restricted_columns"))
_register("silver_product", lambda ctx: ctx.read("silver_product").drop("status").withColumnsRenamed({"_seq": "seq", "__START_AT": "start_at", "__END_AT": "end_at"}), text("silver_product"))
_register("silver_contract_single", lambda ctx: silver.silver_contract(ctx, without_doubles=True), text("silver_contract_single"))
for _name in shapes.CURATED:
    _register(_name, lambda ctx, n=_name: shapes.curated(ctx, n), text(_name))

REPORTS: dict[str, Callable[[Context], DataFrame]] = {
    "exec_pipeline_by_stage": d.pipeline_by_stage,
    "exec_latest_periods": d.latest_periods,
    "exec_top_overdue": d.top_overdue,
    "exec_health_bands": d.health_bands,
    "exec_kpi_snapshot": d.kpi_snapshot,
    "tool_pipeline_by_stage": lambda c: d.pipeline_by_stage(c, "FY1999-Q2", "ASIA"),
    "tool_bookings_billings": lambda c: d.bookings_billings_between(c, dt.date(1997, 1, 1), dt.date(1998, 12, 1)),
    "tool_renewal_risk": d.accounts_at_renewal_risk,
    "tool_account_health": lambda c: d.account_health_detail(c, "A10"),
    "tool_support_watchlist": d.support_watchlist,
    "tool_top_accounts": d.top_accounts,
    "tool_variance": lambda c: d.bookings_billings_variance(c, "FY1999-Q2"),
    "tool_unmatched_invoices": d.unmatched_invoices,
    "tool_collections_risk": d.collections_risk_from,
    "lineage_direct": lambda c: d.downstream(c, "gold", "t1"),
    "lineage_upstream": lambda c: d.upstream(c, "gold", "u3"),
    "lineage_closure": lambda c: d.closure(c, "gold", "t1"),
    "lineage_columns": lambda c: d.column_impact(c, "gold", "t1", ""),
    "lineage_column_sources": lambda c: d.column_sources(c, "gold", "u3", "c1"),
    "lineage_producers": lambda c: d.untested_producers(c, "gold", "u3"),
    "tool_columns_by_tag": lambda c: d.columns_by_tag(c, "mask", "email"),
    "governance_unmasked_columns": lambda c: d.unmasked_columns(c, c.read("column_tags").where("tag_value = 'email'").select("schema_name", "table_name", "column_name")),
    "freshness_age": lambda c: d.table_age(c, NOW),
    "freshness_report": d.freshness_report,
    "freshness_sla": lambda c: d.freshness_sla(c, NOW),
    "freshness_rollup": lambda c: d.freshness_rollup(c, NOW),
    "freshness_breaches": lambda c: d.breach_count(c, NOW),
    "run_recent": lambda c: d.recent_runs(c, NOW),
    "run_failed": lambda c: d.failed_runs(c, NOW),
    "run_over_sla": lambda c: d.runs_over_sla(c, NOW),
    "run_reliability": lambda c: d.job_reliability(c, NOW),
    "tool_job_success_rate": lambda c: d.job_reliability(c, NOW, job_id="job-3"),
    "dq_rule_pass_rates": lambda c: d.rule_pass_rates(c, NOW, 240),
    "dq_failing_rules": lambda c: d.failing_rules(c, NOW, 240),
    "dq_error_events": lambda c: d.error_events(c, NOW, 240),
    "dq_latest_events": lambda c: d.error_events(c, NOW, 240, 20),
    "tool_schema_drift": lambda c: d.schema_drift_events(c, NOW, "pipeline-1", 720),
    "audit_sensitive_reads": lambda c: d.sensitive_reads(c, NOW),
    "audit_grant_changes": lambda c: d.grant_changes(c, NOW),
    "billing_by_environment": d.spend_by_environment,
}
for _name, _build in REPORTS.items():
    _register(_name, _build, text(_name))
for _name, _build in more_queries.BUILDS.items():
    _register(_name, _build, more_queries.ORACLES.get(_name))
for _part in (kept_queries, identity_queries, quality_queries):
    for _name, _build in _part.BUILDS.items():
        _register(_name, _build, _part.ORACLES.get(_name))
