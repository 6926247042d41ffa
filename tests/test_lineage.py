import pytest

from tests.conftest import DATA
from tidewater import queries as q
from tidewater.plans import dashboards, governance, lineage
from tidewater.plans.bronze import spark_source
from tidewater.plans.lineage import Edge
from tidewater.plans.registry import Context, Principal


@pytest.fixture(scope="module")
def traced(spark):
    return Context(spark, spark_source(spark, DATA), q.AS_OF, traced=True)


#: By hand: source dataset, source column, target column, kind.
EDGES = {
    "silver_customer": """
        crm_accounts account_id crm_account_id value; crm_accounts account_id customer_sk hash; crm_accounts account_name company_name value; crm_accounts account_name name_key value;
        crm_accounts billing_country country value; crm_accounts website domain_key value; erp_customers country country value; erp_customers customer_id customer_sk hash;
        erp_customers customer_id erp_customer_id value; erp_customers customer_id match_method condition; erp_customers customer_name company_name value; erp_customers customer_name name_key value;
        erp_customers payment_contact_email domain_key value""",
    "silver_payment": """
        erp_payments payment_id payment_id value; erp_payments invoice_id invoice_id value; silver_customer customer_sk customer_sk value; erp_payments customer_id erp_customer_id value;
        erp_payments payment_date payment_date value; erp_payments amount_paid_usd payment_amount value; erp_payments currency currency value""",
    "gold_support_performance": """
        silver_case customer_sk customer_sk value; silver_case created_date last_case_date value; silver_case is_open open_case_count value; silver_case priority high_priority_case_count condition;
        silver_case resolution_hours avg_resolution_hours value""",
    "accounts": """
        crm_accounts territory_id territory_id value; silver_customer company_name account_name value; silver_customer crm_account_id account_id value; silver_customer erp_customer_id account_id value;
        silver_customer customer_sk customer_sk value; silver_territory region region value""",
    "gold_renewal_risk": """
        silver_contract contract_id contract_id value; silver_contract customer_sk customer_sk value; silver_contract contract_amount contract_amount value; silver_contract end_date end_date value;
        silver_contract end_date days_to_expiry value; silver_contract end_date renewal_risk_tier condition; gold_account_health health_tier health_tier value; gold_account_health health_score health_score value;
        gold_account_health health_tier renewal_risk_tier condition""",
}


@pytest.mark.parametrize("name", EDGES)
def test_edges_of_marts(traced, name):
    want = sorted(Edge(s, c, name, t, k) for s, c, t, k in (e.split() for e in EDGES[name].split(";")))
    assert lineage.column_edges(traced, name) == want


def test_edges_through_all_kinds_of_operators(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidewater.plans.registry import DATASETS, Dataset

    def odd(ctx):
        a, b = ctx.read("left_table"), ctx.read("right_table")
        again = a.join(b, "k").join(a.select("k", F.col("x").alias("x2")), "k")  # one table twice
        w = Window.partitionBy("k").orderBy("y")
        rows = again.select("k", F.sum("x").over(w).alias("run"), F.when(F.col("y") > 1, F.col("x2")).alias("chosen"), F.explode(F.split("tags", ",")).alias("tag"), F.sha2("tags", 256).alias("h"), F.lit(1).alias("one"))
        more = b.select("k", F.lit(0.0), F.col("y").cast("double"), "tags", F.lit(None), F.lit(2)).toDF(*rows.columns)
        return rows.union(more).groupBy("k").agg(F.max("run").alias("run"), F.max_by("chosen", "tag").alias("chosen"), F.count(F.lit(1)).alias("n"), F.first("h").alias("h"), F.sum("one").alias("one"), F.min("tag").alias("tag"))

    tables = {"left_table": "k int, x double", "right_table": "k int, y int, tags string"}
    ctx = Context(spark, lambda n: spark.createDataFrame([], tables[n]), q.AS_OF, traced=True)
    DATASETS["odd"] = Dataset("odd", "gold", odd)
    try:
        got = {(e.source, e.source_column, e.target_column, e.kind) for e in lineage.column_edges(ctx, "odd")}
    finally:
        del DATASETS["odd"]
    left, right = "left_table", "right_table"
    assert got == {
        (left, "k", "k", "value"), (right, "k", "k", "value"), (left, "x", "run", "value"), (left, "k", "run", "condition"), (right, "y", "run", "condition"),
        (left, "x", "chosen", "value"), (right, "y", "chosen", "value"), (right, "tags", "chosen", "condition"), (right, "tags", "h", "hash"), (right, "tags", "tag", "value"),
    }


def test_lineage_needs_a_trace_and_feeds_the_tools(spark, traced):
    plain = Context(spark, spark_source(spark, DATA), q.AS_OF)
    with pytest.raises(ValueError, match="traced"):
        lineage.column_edges(plain, "silver_customer")
    system = lineage.relation(spark, lineage.all_edges(traced, ["gold_account_health"]))
    ctx = Context(spark, lambda n: system if n == "column_lineage" else spark_source(spark, DATA)(n), q.AS_OF)
    hit = {(r["table"], r["column"]) for r in dashboards.column_impact(ctx, "bronze", "crm_accounts", "account_name").collect()}
    assert hit == {("silver_customer", "company_name"), ("silver_customer", "name_key")}
    assert {tuple(r) for r in dashboards.column_sources(ctx, "gold", "gold_account_health", "company_name").collect()} == {("silver", "silver_customer", "company_name")}


def test_tags_follow_values_and_the_strictest_wins():
    edges = [Edge("a", "x", "b", "x", "value"), Edge("a", "y", "b", "x", "value"), Edge("b", "x", "c", "x", "value"), Edge("a", "x", "b", "h", "hash"), Edge("a", "x", "b", "t", "condition"), Edge("c", "x", "a", "x", "value")]
    got = lineage.spread({("a", "x"): "email", ("a", "y"): "tax_id", ("a", "z"): "unknown"}, edges, governance.STRICTEST)
    assert got == {("a", "x"): "tax_id", ("a", "y"): "tax_id", ("b", "x"): "tax_id", ("c", "x"): "tax_id"}


def test_a_mart_is_masked_though_only_its_source_is_tagged(spark):
    ctx = q.context(spark, DATA)
    tags = [("crm_accounts", "account_name", "free_text"), ("erp_customers", "customer_name", "free_text"), ("erp_customers", "payment_contact_email", "email"), ("crm_accounts", "territory_id", "territory")]
    policy = governance.policy_from_lineage(ctx, ["gold_account_health", "accounts"], tags)
    assert policy.masks["gold_account_health", "company_name"] == "free_text" and policy.masks["silver_customer", "domain_key"] == "email"
    assert ("silver_customer", "customer_sk") not in policy.masks and policy.territory_filtered == {"accounts": "territory_id", "crm_accounts": "territory_id"}
    analyst, steward = Principal("ana@example.com", frozenset({"sales_analysts"})), Principal("s@example.com", frozenset({governance.STEWARDS}))
    assert {r["company_name"] for r in governance.read_as(ctx, "gold_account_health", analyst, policy).collect()} == {"[REDACTED]"}
    assert "[REDACTED]" not in {r["company_name"] for r in governance.read_as(ctx, "gold_account_health", steward, policy).collect()}
    mapping = spark.createDataFrame([("ana@example.com", "T1")], "user_name string, territory string")
    assert {r["territory_id"] for r in governance.read_as(ctx, "accounts", analyst, policy, mapping).collect()} == {"T1"}
