"""Dashboard queries and parameterised agent tools, over the documented-shape views and the operations relations.

A tool may only read the views on its allow-list.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import Context

ALLOWED = frozenset(
    "opportunity_pipeline account_bookings_billings account_collections account_scores account_renewals account_support gold_customer_360 accounts silver_invoice silver_payment table_lineage column_lineage column_tags table_tags ops_tables job_run_timeline pipeline_event_log audit_log billing_usage".split()
)


def view(ctx: Context, name: str) -> DataFrame:
    if name not in ALLOWED:
        raise ValueError(f"{name!r} is not a view that tools may read")
    return ctx.read(name)


def optional(column: str, value) -> Column:
    """The predicate of an optional parameter: true for all rows if there is no value."""
    return F.lit(True) if value is None or value == "" else F.col(column) == F.lit(value)


def _whole(c: Column) -> Column:
    return F.round(c, 0)


# Executive summary.


def pipeline_by_stage(ctx: Context, fiscal_quarter: str | None = None, region: str | None = None) -> DataFrame:
    """Open deals by stage, with the weighted forecast."""
    rows = view(ctx, "opportunity_pipeline").where((F.col("status") == "Open") & optional("fiscal_quarter", fiscal_quarter) & optional("region", region))
    return rows.groupBy("stage").agg(F.count(F.lit(1)).alias("deals"), _whole(F.sum("amount")).alias("total_amount"), _whole(F.sum(F.col("amount") * F.col("probability"))).alias("weighted_amount")).orderBy(F.desc("total_amount"))


def _balance(df: DataFrame, *keys: str) -> DataFrame:
    a, b = F.sum("bookings_amount"), F.sum("billings_amount")
    return df.groupBy(*keys).agg(a.alias("bookings"), b.alias("billings"), (a - b).alias("variance"))


def latest_periods(ctx: Context, n: int = 6) -> DataFrame:
    return _balance(view(ctx, "account_bookings_billings"), "period").orderBy(F.desc("period")).limit(n)


def top_overdue(ctx: Context, n: int = 15) -> DataFrame:
    rows = view(ctx, "account_collections")
    return rows.select("account_id", "account_name", _whole(F.col("ar_balance")).alias("ar_balance"), _whole(F.col("overdue_amount")).alias("overdue_amount"), "days_overdue", F.round("risk_score", 2).alias("risk_score")).orderBy(F.desc("overdue_amount"), "account_id").limit(n)


def health_bands(ctx: Context) -> DataFrame:
    """Accounts by band of health; bands are ordered by their least score."""
    s = F.col("health_score")
    band = F.when(s >= 80, "Healthy (80+)").when(s >= 60, "Watch (60-79)").when(s >= 40, "At Risk (40-59)").otherwise("Critical (<40)")
    return view(ctx, "account_scores").groupBy(band.alias("health_band")).agg(F.count(F.lit(1)).alias("accounts"), F.round(F.avg(s), 1).alias("avg_score"), F.min(s).alias("_least")).orderBy(F.desc("_least")).drop("_least")


def kpi_snapshot(ctx: Context) -> DataFrame:
    """Four figures in one row; each is a single aggregate, so the cross join is of one row each."""
    weighted = view(ctx, "opportunity_pipeline").where("status = 'Open'").agg(_whole(F.sum(F.col("amount") * F.col("probability"))).alias("weighted_pipeline"))
    overdue = view(ctx, "account_collections").agg(_whole(F.sum("overdue_amount")).alias("total_overdue"))
    critical = view(ctx, "account_scores").where("health_score < 40").agg(F.count(F.lit(1)).alias("critical_accounts"))
    renewals = view(ctx, "account_renewals").where("risk_tier = 'High'").agg(F.count(F.lit(1)).alias("high_renewal_risk"))
    return weighted.crossJoin(overdue).crossJoin(critical).crossJoin(renewals)


# Revenue, customer health, finance.


def bookings_billings_between(ctx: Context, start: dt.date, end: dt.date, region: str | None = None) -> DataFrame:
    rows = view(ctx, "account_bookings_billings").where(F.col("period").between(F.lit(start), F.lit(end)) & optional("region", region))
    return _balance(rows, "period", "region").orderBy("period")


def accounts_at_renewal_risk(ctx: Context, within_days: int = 90, tier: str = "High") -> DataFrame:
    rows = view(ctx, "account_renewals").where((F.col("renewal_date") <= F.date_add(ctx.today, within_days)) & (F.col("risk_tier") == tier))
    return rows.orderBy(F.desc("churn_probability"), "renewal_date")


def account_health_detail(ctx: Context, account_id: str) -> DataFrame:
    return view(ctx, "account_scores").where(F.col("account_id") == account_id)


def support_watchlist(ctx: Context, least: int = 1) -> DataFrame:
    return view(ctx, "account_support").where(F.col("open_escalations") >= least).orderBy(F.desc("open_escalations"), "sla_attainment_pct")


def top_accounts(ctx: Context, n: int = 20) -> DataFrame:
    """Customers with the greatest contract value."""
    rows = view(ctx, "gold_customer_360").join(view(ctx, "accounts").select("customer_sk", "account_id", "account_name"), "customer_sk")
    return rows.select("account_id", "account_name", F.col("total_contract_amount").alias("arr"), "contract_count").orderBy(F.desc_nulls_last("arr"), "account_id").limit(n)


def bookings_billings_variance(ctx: Context, fiscal_quarter: str, tolerance: float = 1.0) -> DataFrame:
    gap = F.sum("bookings_amount") - F.sum("billings_amount")
    rows = view(ctx, "account_bookings_billings").where(F.col("fiscal_quarter") == fiscal_quarter).groupBy("account_id", "account_name", "fiscal_quarter")
    return rows.agg(F.sum("bookings_amount").alias("bookings_amount"), F.sum("billings_amount").alias("billings_amount"), gap.alias("variance")).where(F.abs("variance") > tolerance).orderBy(F.abs("variance").desc())


def unmatched_invoices(ctx: Context, tolerance: float = 1.0) -> DataFrame:
    paid = view(ctx, "silver_payment").groupBy("invoice_id").agg(F.sum("payment_amount").alias("paid_amount"))
    rows = view(ctx, "silver_invoice").join(paid, "invoice_id", "left").withColumn("paid_amount", F.coalesce("paid_amount", F.lit(0).cast("decimal(18,2)")))
    rows = rows.withColumn("unpaid_variance", F.col("gross_amount") - F.col("paid_amount")).where(F.abs("unpaid_variance") > tolerance)
    return rows.select("invoice_id", F.col("erp_customer_id").alias("account_id"), F.col("gross_amount").alias("invoice_amount"), "currency", "paid_amount", "unpaid_variance").orderBy(F.desc("unpaid_variance"))


def collections_risk_from(ctx: Context, least: float = 0.5) -> DataFrame:
    return view(ctx, "account_collections").where(F.col("risk_score") >= least).orderBy(F.desc("overdue_amount"))


# Lineage and stewardship.


def downstream(ctx: Context, schema: str, table: str) -> DataFrame:
    rows = view(ctx, "table_lineage").where((F.col("source_schema") == schema) & (F.col("source_table") == table))
    return rows.groupBy(F.col("target_schema").alias("schema"), F.col("target_table").alias("table")).agg(F.max("event_date").alias("last_seen")).orderBy("schema", "table")


def upstream(ctx: Context, schema: str, table: str) -> DataFrame:
    rows = view(ctx, "table_lineage").where((F.col("target_schema") == schema) & (F.col("target_table") == table))
    return rows.select(F.col("source_schema").alias("schema"), F.col("source_table").alias("table")).distinct().orderBy("schema", "table")


def closure(ctx: Context, schema: str, table: str, most: int = 10) -> DataFrame:
    """Everything downstream, with the least number of hops.  Rounds keep only tables not reached before, so cycles end and paths never multiply; a round that reaches nothing ends it."""
    edges = view(ctx, "table_lineage").select("source_schema", "source_table", "target_schema", "target_table").distinct()
    spark = edges.sparkSession
    front = spark.createDataFrame([(schema, table)], "schema string, table string")
    found = None
    for hop in range(1, most + 1):
        step = front.join(edges, (F.col("schema") == F.col("source_schema")) & (F.col("table") == F.col("source_table"))).select(F.col("target_schema").alias("schema"), F.col("target_table").alias("table")).distinct()
        if found is not None:
            step = step.join(found.select("schema", "table"), ["schema", "table"], "left_anti")
        rows = step.collect()  # names of tables, as many as the catalog has
        if not rows:
            break
        front = spark.createDataFrame(rows, "schema string, table string")
        reached = front.withColumn("shortest_hop", F.lit(hop))
        found = reached if found is None else found.unionByName(reached)
    return found if found is not None else spark.createDataFrame([], "schema string, table string, shortest_hop int")


def column_impact(ctx: Context, schema: str, table: str, column: str | None = None) -> DataFrame:
    rows = view(ctx, "column_lineage").where((F.col("source_schema") == schema) & (F.col("source_table") == table) & optional("source_column", column))
    return rows.select(F.col("target_schema").alias("schema"), F.col("target_table").alias("table"), F.col("target_column").alias("column")).distinct()


def column_sources(ctx: Context, schema: str, table: str, column: str) -> DataFrame:
    rows = view(ctx, "column_lineage").where((F.col("target_schema") == schema) & (F.col("target_table") == table) & (F.col("target_column") == column))
    return rows.select("source_schema", "source_table", "source_column")


def columns_by_tag(ctx: Context, tag: str, value: str) -> DataFrame:
    return view(ctx, "column_tags").where((F.col("tag_name") == tag) & (F.col("tag_value") == value)).orderBy("schema_name", "table_name", "column_name")


def untested_producers(ctx: Context, schema: str, table: str) -> DataFrame:
    """Full names of what feeds a table, to be tested again."""
    return upstream(ctx, schema, table).select(F.concat_ws(".", "schema", "table").alias("producer")).distinct()


def unmasked_columns(ctx: Context, bound: DataFrame) -> DataFrame:
    """Columns tagged for masking that no mask in ``bound`` (schema_name, table_name, column_name) covers."""
    tagged = view(ctx, "column_tags").where("tag_name = 'mask'").select("schema_name", "table_name", "column_name")
    return tagged.join(bound, ["schema_name", "table_name", "column_name"], "left_anti")


# Freshness.

SLA_HOURS = [("bronze", 6), ("silver", 12), ("gold", 24), ("ops", 24)]


def _aged(ctx: Context, now: dt.datetime) -> DataFrame:
    seconds = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last_altered").cast("timestamp"))
    return view(ctx, "ops_tables").withColumn("_age", seconds / 3600.0)


def table_age(ctx: Context, now: dt.datetime) -> DataFrame:
    return _aged(ctx, now).select(F.col("table_schema").alias("domain"), "table_name", "table_type", F.round("_age", 1).alias("age_hours")).orderBy(F.desc("age_hours"))


def freshness_report(ctx: Context, schema: str = "gold") -> DataFrame:
    return view(ctx, "ops_tables").where(F.col("table_schema") == schema).select("table_schema", "table_name", "table_type", F.date_format("last_altered", "yyyy-MM-dd HH:mm").alias("last_altered")).orderBy("last_altered")


def freshness_sla(ctx: Context, now: dt.datetime) -> DataFrame:
    """Each table against its domain's limit, in three states: a warning from 0.8 of the limit on."""
    sla = ctx.spark.createDataFrame(SLA_HOURS, "domain string, sla_hours int")
    rows = _aged(ctx, now).withColumnRenamed("table_schema", "domain").join(F.broadcast(sla), "domain")
    two = F.when(F.col("_age") > F.col("sla_hours"), "BREACH").otherwise("OK")
    three = F.when(F.col("_age") > F.col("sla_hours"), "BREACH").when(F.col("_age") > 0.8 * F.col("sla_hours"), "WARN").otherwise("OK")
    return rows.select("domain", "table_name", F.round("_age", 1).alias("age_hours"), "sla_hours", two.alias("sla_status"), three.alias("sla_state")).orderBy((F.col("age_hours") - F.col("sla_hours")).desc())


def freshness_rollup(ctx: Context, now: dt.datetime) -> DataFrame:
    rows = freshness_sla(ctx, now)
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("tables"), F.sum((F.col("sla_status") == "BREACH").cast("int")).alias("breaching"), F.min("age_hours").alias("youngest_hours")).orderBy(F.desc("breaching"))


def breach_count(ctx: Context, now: dt.datetime) -> DataFrame:
    return freshness_sla(ctx, now).where("sla_status = 'BREACH'").agg(F.count(F.lit(1)).alias("breaches"))


# Run health.


def _runs(ctx: Context, now: dt.datetime, days: int) -> DataFrame:
    end = F.col("period_end_time")
    since = F.lit(now - dt.timedelta(days=days)).cast("timestamp_ntz")
    minutes = F.floor((F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(F.col("period_start_time").cast("timestamp"))) / 60).cast("long")
    return view(ctx, "job_run_timeline").where(end.cast("timestamp_ntz") >= since).withColumn("duration_min", minutes)


def recent_runs(ctx: Context, now: dt.datetime, days: int = 7) -> DataFrame:
    return _runs(ctx, now, days).select("job_id", "run_id", "run_name", "result_state", "termination_code", "duration_min").orderBy(F.desc("run_id"))


BAD_STATES = ("FAILED", "TIMEDOUT", "ERROR", "CANCELED")


def failed_runs(ctx: Context, now: dt.datetime, days: int = 7) -> DataFrame:
    return _runs(ctx, now, days).where(F.col("result_state").isin(*BAD_STATES)).select("job_id", "run_id", "run_name", "result_state", "termination_code")


def runs_over_sla(ctx: Context, now: dt.datetime, minutes: int = 60, days: int = 7) -> DataFrame:
    return _runs(ctx, now, days).where(F.col("duration_min") > minutes).select("job_id", "run_id", "run_name", "result_state", "duration_min", F.lit(minutes).alias("sla_minutes")).orderBy(F.desc("duration_min"))


def job_reliability(ctx: Context, now: dt.datetime, days: int = 30, job_id: str | None = None) -> DataFrame:
    """Runs, successes and the exact 95th percentile of duration of each job."""
    ok = F.sum(F.when(F.col("result_state") == "SUCCEEDED", 1).otherwise(0))
    runs = F.count(F.lit(1))
    rows = _runs(ctx, now, days).where(optional("job_id", job_id)).groupBy("job_id")
    return rows.agg(runs.alias("runs"), ok.alias("succeeded"), F.round(100.0 * ok / F.nullif(runs, F.lit(0)), 2).alias("success_pct"), F.round(F.percentile("duration_min", 0.95), 1).alias("p95_duration_min")).orderBy("success_pct")


# Data quality from the event log.

EXPECTATIONS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def _expectations(ctx: Context, now: dt.datetime, hours: int) -> DataFrame:
    since = F.lit(now - dt.timedelta(hours=hours)).cast("timestamp_ntz")
    log = view(ctx, "pipeline_event_log").where((F.col("event_type") == "flow_progress") & (F.col("event_time").cast("timestamp_ntz") >= since))
    own = F.from_json(F.get_json_object("details", "$.flow_progress.data_quality.expectations"), EXPECTATIONS)
    return log.select("event_time", F.explode(own).alias("x")).select("event_time", "x.name", "x.dataset", F.coalesce("x.passed_records", F.lit(0)).alias("passed"), F.coalesce("x.failed_records", F.lit(0)).alias("failed"))


def rule_pass_rates(ctx: Context, now: dt.datetime, hours: int = 24) -> DataFrame:
    p, f = F.sum("passed"), F.sum("failed")
    return _expectations(ctx, now, hours).groupBy("dataset", F.col("name").alias("expectation_name")).agg(p.alias("passed"), f.alias("failed"), F.round(100.0 * p / F.nullif(p + f, F.lit(0)), 2).alias("pass_pct")).orderBy(F.desc("failed"), "pass_pct")


def failing_rules(ctx: Context, now: dt.datetime, hours: int = 24) -> DataFrame:
    return _expectations(ctx, now, hours).where("failed > 0").groupBy("dataset", F.col("name").alias("expectation_name")).agg(F.max(F.col("event_time").cast("date")).alias("last_seen"), F.sum("failed").alias("failed_records")).orderBy(F.desc("failed_records"))


def _log(ctx: Context, now: dt.datetime, hours: int) -> DataFrame:
    return view(ctx, "pipeline_event_log").where(F.col("event_time").cast("timestamp_ntz") >= F.lit(now - dt.timedelta(hours=hours)).cast("timestamp_ntz"))


def error_events(ctx: Context, now: dt.datetime, hours: int = 24, most: int | None = None) -> DataFrame:
    """Errors and warnings, newest first; with ``most``, the latest so many."""
    rows = _log(ctx, now, hours).where(F.col("level").isin("ERROR", "WARN")).select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "event_type", "level", "message")
    rows = rows.orderBy(F.desc("event_time"), "event_type", "level", "message")
    return rows if most is None else rows.limit(most)


def schema_drift_events(ctx: Context, now: dt.datetime, pipeline_id: str, hours: int = 168) -> DataFrame:
    rows = _log(ctx, now, hours).where((F.col("pipeline_id") == pipeline_id) & F.col("event_type").isin("schema_change", "flow_definition", "update_progress") & F.lower("message").rlike("schema|unexpected column|incompatible"))
    return rows.select(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "event_type", "message")


# Audit and cost.


def sensitive_reads(ctx: Context, now: dt.datetime, days: int = 7) -> DataFrame:
    rows = view(ctx, "audit_log").where((F.col("event_time").cast("timestamp_ntz") >= F.lit(now - dt.timedelta(days=days)).cast("timestamp_ntz")) & (F.col("action_name") == "getTable") & F.col("table_full_name").startswith("gold."))
    return rows.groupBy("user_email", "table_full_name").agg(F.count(F.lit(1)).alias("reads"))


def grant_changes(ctx: Context, now: dt.datetime, days: int = 30) -> DataFrame:
    rows = view(ctx, "audit_log").where((F.col("event_time").cast("timestamp_ntz") >= F.lit(now - dt.timedelta(days=days)).cast("timestamp_ntz")) & F.col("action_name").like("%Permissions%"))
    return rows.select("user_email", "table_full_name", F.col("event_time").cast("date").alias("day")).distinct()


def spend_by_environment(ctx: Context) -> DataFrame:
    tags = F.create_map(F.lit("env"), F.col("env"))
    rows = view(ctx, "billing_usage").withColumn("custom_tags", tags)
    return rows.groupBy("cluster_id", F.col("custom_tags")["env"].alias("env")).agg(F.sum("dbus").alias("dbus"))
