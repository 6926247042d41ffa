"""Documented-shape views: what dashboards and agent tools ask for, built from the marts.

Account-grain views carry ``account_id`` (the CRM's, else the ERP's id) and a
territory's region, so that row filters have something to hold on to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fiscal_quarter
from ..operators.relational import latest
from .registry import Context, dataset


@dataset("gold", shared=True)
def accounts(ctx: Context) -> DataFrame:
    """customer_sk, account_id, account_name, territory_id, region."""
    crm = latest(ctx.read("crm_accounts"), ["account_id"], F.col("created_date").desc(), F.col("batch").desc()).select(F.col("account_id").alias("crm_account_id"), "territory_id")
    region = ctx.read("silver_territory").select("territory_id", "region")
    out = ctx.read("silver_customer").join(crm, "crm_account_id", "left").join(region, "territory_id", "left")
    return out.select("customer_sk", F.coalesce("crm_account_id", "erp_customer_id").alias("account_id"), F.col("company_name").alias("account_name"), "territory_id", "region")


@dataset("gold")
def opportunity_pipeline(ctx: Context) -> DataFrame:
    o = ctx.read("crm_opportunities")
    who = ctx.read("accounts").select("account_id", "region")
    status = F.when(F.lower("stage").startswith("closed"), "Closed").otherwise("Open")
    return o.join(who, "account_id", "left").select("opportunity_id", "account_id", "region", "stage", status.alias("status"), "amount", (F.col("probability") / 100.0).alias("probability"), F.col("close_date"), fiscal_quarter("close_date").alias("fiscal_quarter"))


@dataset("gold")
def account_bookings_billings(ctx: Context) -> DataFrame:
    who = ctx.read("accounts").select("customer_sk", "account_id", "account_name", "region")
    r = ctx.read("gold_revenue_pipeline").join(who, "customer_sk")
    return r.groupBy("account_id", "account_name", "region", F.col("period_month").alias("period"), fiscal_quarter("period_month").alias("fiscal_quarter")).agg(F.sum("booked_amount").alias("bookings_amount"), F.sum("billed_amount").alias("billings_amount"))


@dataset("gold")
def account_collections(ctx: Context) -> DataFrame:
    """Receivables by account, with a score from 0 to 1: the share of overdue money, at least half of it for old debt."""
    who = ctx.read("accounts").select("customer_sk", "account_id", "account_name")
    overdue = F.col("total_open_ar") - F.col("ar_current")
    share = overdue.cast("double") / F.col("total_open_ar").cast("double")
    return ctx.read("gold_collections_risk").join(who, "customer_sk").select("account_id", "account_name", F.col("total_open_ar").alias("ar_balance"), overdue.alias("overdue_amount"), F.col("max_days_past_due").alias("days_overdue"), F.initcap("risk_tier").alias("risk_tier"), F.round(F.greatest(share, F.when(F.col("ar_90_plus") > 0, 0.5).otherwise(0.0)), 4).alias("risk_score"))


@dataset("gold")
def account_scores(ctx: Context) -> DataFrame:
    """Health from 0 to 100, higher is better; 7 for each point of the additive score."""
    who = ctx.read("accounts").select("customer_sk", "account_id", "account_name")
    h = ctx.read("gold_account_health").drop("company_name", "country").join(who, "customer_sk")
    cases, debt = F.coalesce("open_case_count", F.lit(0)), F.coalesce("risk_tier", F.lit("none"))
    return h.select("account_id", "account_name", F.greatest(F.lit(0), 100 - 7 * F.col("health_score")).cast("int").alias("health_score"), F.when(cases > 2, "open cases").when(debt == "high", "overdue receivables").otherwise("none").alias("top_negative_driver"))


@dataset("gold")
def account_renewals(ctx: Context) -> DataFrame:
    who = ctx.read("accounts").select("customer_sk", "account_id", "account_name")
    r = ctx.read("gold_renewal_risk").join(who, "customer_sk")
    churn = F.when(F.col("renewal_risk_tier") == "high", 0.6).when(F.col("renewal_risk_tier") == "medium", 0.3).otherwise(0.1)
    return r.select("contract_id", "account_id", "account_name", F.col("end_date").alias("renewal_date"), F.initcap("renewal_risk_tier").alias("risk_tier"), churn.alias("churn_probability"), F.col("contract_amount").alias("arr"))


@dataset("gold")
def account_support(ctx: Context) -> DataFrame:
    who = ctx.read("accounts").select("customer_sk", "account_id", "account_name")
    s = ctx.read("gold_support_performance").join(who, "customer_sk")
    within = F.round(100.0 * (F.col("case_count") - F.col("open_case_count")) / F.col("case_count"), 1)
    return s.select("account_id", "account_name", F.col("open_case_count").alias("open_tickets"), F.col("high_priority_case_count").alias("open_escalations"), within.alias("sla_attainment_pct"))


#: Curated views: the columns an agent may see of each mart.
CURATED: dict[str, tuple[str, list[str]]] = {
    "customer_360_curated": ("gold_customer_360", "customer_sk crm_account_id company_name country contract_count total_contract_amount latest_contract_date invoice_count total_invoiced total_paid total_open_ar late_invoice_count max_days_past_due case_count open_case_count avg_resolution_hours activity_count last_activity_date".split()),
    "account_health_curated": ("gold_account_health", "customer_sk company_name country open_case_count high_priority_case_count avg_resolution_hours risk_tier total_open_ar last_activity_date activity_count health_score health_tier days_since_last_activity".split()),
    "support_performance_curated": ("gold_support_performance", "customer_sk case_count open_case_count avg_resolution_hours last_case_date high_priority_case_count".split()),
    "revenue_pipeline_curated": ("gold_revenue_pipeline", "customer_sk period_month booked_amount booking_count ordered_amount order_count billed_amount invoice_count".split()),
    "collections_risk_curated": ("gold_collections_risk", "customer_sk company_name country ar_current ar_1_30 ar_31_60 ar_61_90 ar_90_plus total_open_ar max_days_past_due weighted_days_past_due disputed_invoice_count risk_tier".split()),
}


def curated(ctx: Context, name: str) -> DataFrame:
    """A curated view: its columns and ``data_as_of``, the mart's load time (else the context's day)."""
    mart, columns = CURATED[name]
    df = ctx.read(mart)
    stamp = F.col("_gold_loaded_at") if "_gold_loaded_at" in df.columns else ctx.today.cast("timestamp")
    return df.select(*columns, stamp.alias("data_as_of"))
