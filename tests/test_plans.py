import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater import queries
from tidewater.plans import actions, dashboards, evals, governance, shapes, silver
from tidewater.plans.registry import DATASETS, Context, Principal, materialize, order


def context(spark, tables, as_of=dt.date(2024, 6, 1), **options):
    return Context(spark, lambda n: tables[n], as_of, **options)


def test_registry(spark, tmp_path):
    ctx = queries.context(spark, DATA)
    names = order(["gold_renewal_risk"], ctx)
    assert names.index("silver_customer") < names.index("gold_collections_risk") < names.index("gold_account_health") < names.index("gold_renewal_risk")
    assert ("silver_contract", "gold_renewal_risk") in ctx.edges
    paths = materialize(queries.context(spark, DATA), ["gold_support_performance"], str(tmp_path))
    assert set(paths) == {"silver_customer", "silver_case", "gold_support_performance"} and spark.read.parquet(paths["gold_support_performance"]).count() > 0
    assert DATASETS["silver_customer"].properties["quality"] == "silver"


def test_stamps_and_failures(spark):
    tables = {"crm_territories": spark.createDataFrame([("T1", " North ", "emea"), (None, "x", "y")], "territory_id string, territory_name string, region string")}
    ctx = context(spark, tables, stamp=True)
    out = ctx.read("silver_territory")
    assert out.count() == 1 and "_silver_loaded_at" in out.columns
    assert ctx.failures["silver_territory"].get == {"has_territory_id": 1, "has_name": 0}


def customers(spark):
    crm = spark.createDataFrame([("A1", "Apex, Inc.", "apex.com", "US", "T1", "2024-01-01", 1), ("A1", "Old Apex", "old.com", "US", "T1", "2023-01-01", 0), ("A2", "Bolt LLC", "www.bolt.com", "US", "T1", "2024-01-01", 1), ("A3", "Lone", None, "US", "T2", "2024-01-01", 1)], "account_id string, account_name string, website string, billing_country string, territory_id string, created_date string, batch int")
    erp = spark.createDataFrame([("C1", "Different", "US", "x@y.com", "2024-01-01", 1), ("C2", "BOLT", "US", "pay@bolt.com", "2024-01-01", 1), ("C9", "Solo", "DE", None, "2024-01-01", 1)], "customer_id string, customer_name string, country string, payment_contact_email string, created_date string, batch int")
    return {"crm_accounts": crm, "erp_customers": erp, "crosswalk": spark.createDataFrame([("A1", "C1")], "crm_account_id string, erp_customer_id string")}


def test_identity(spark):
    got = {(r["crm_account_id"], r["erp_customer_id"]): (r["match_method"], r["company_name"]) for r in context(spark, customers(spark)).read("silver_customer").collect()}
    assert got == {("A1", "C1"): ("crosswalk", "Apex, Inc."), ("A2", "C2"): ("name_domain", "Bolt LLC"), ("A3", None): ("crm_only", "Lone"), (None, "C9"): ("erp_only", "Solo")}


def test_without_domains_nothing_matches_by_name(spark):
    tables = customers(spark)
    tables["crm_accounts"] = tables["crm_accounts"].drop("website")
    got = {r["crm_account_id"]: r["match_method"] for r in context(spark, tables).read("silver_customer").collect()}
    assert got == {"A1": "crosswalk", "A2": "crm_only", "A3": "crm_only", None: "erp_only"}


def test_invoices(spark):
    inv = "invoice_id string, customer_id string, invoice_date string, due_date string, amount_usd double, currency string"
    tables = customers(spark) | {
        "erp_invoices": spark.createDataFrame([("I1", "C1", "2024-01-01", "2024-05-02", 100.0, "usd"), ("I2", "C1", "2024-01-01", None, 50.0, "usd"), ("I3", "C9", "2024-01-01", "2024-07-01", 10.0, "usd"), (None, "C9", "2024-01-01", "2024-07-01", 10.0, "usd"), ("I4", "??", "2024-01-01", "2024-07-01", 5.0, "usd")], inv),
        "erp_payments": spark.createDataFrame([("P1", "I1", "C1", "2024-02-01", 40.0, "usd"), ("P2", "I3", "C9", "2024-02-01", 9.995, "usd"), ("P3", None, "C9", "2024-02-01", 1.0, "usd")], "payment_id string, invoice_id string, customer_id string, payment_date string, amount_paid_usd double, currency string"),
    }
    ctx = context(spark, tables)
    got = {r["invoice_id"]: (float(r["open_amount"]), r["is_paid"], r["is_partial"], r["is_late"], r["days_past_due"], r["customer_sk"] is None) for r in ctx.read("silver_invoice").collect()}
    assert got == {"I1": (60.0, False, True, True, 30, False), "I2": (50.0, False, False, False, 0, False), "I3": (0.0, True, False, False, 0, False), "I4": (5.0, False, False, False, -30, True)}
    risk = {r["company_name"]: (float(r["ar_current"]), float(r["ar_1_30"]), r["risk_tier"]) for r in ctx.read("gold_collections_risk").collect()}
    assert risk == {"Apex, Inc.": (50.0, 60.0, "low")}


def test_contracts_with_and_without_doubles(spark):
    tables = customers(spark) | {
        "crm_contracts": spark.createDataFrame([("K1", "A1", "2024-01-01", "2024-12-31", 10.0, "Active", "usd")], "contract_id string, account_id string, start_date string, end_date string, contract_value double, status string, currency string"),
        "crm_opportunities": spark.createDataFrame([("O1", "A1", "Closed Won", 10.0, "usd", "2024-01-01"), ("O2", "A2", "CLOSED WON!", 20.0, "usd", "2024-02-01"), ("O3", "A2", "Open", 5.0, "usd", "2024-02-01")], "opportunity_id string, account_id string, stage string, amount double, currency string, close_date string"),
    }
    ctx = context(spark, tables)
    assert sorted(r["contract_id"] for r in ctx.read("silver_contract").collect()) == ["K1", "O1", "O2"]
    assert sorted(r["contract_id"] for r in silver.silver_contract(ctx, without_doubles=True).collect()) == ["K1", "O2"]
    tables["crm_opportunities"] = tables["crm_opportunities"].drop("stage")
    assert [r["contract_id"] for r in context(spark, tables).read("silver_contract").collect()] == ["K1"]


def test_tools_read_only_allowed_views(spark):
    with pytest.raises(ValueError, match="not a view"):
        dashboards.view(queries.context(spark, DATA), "silver_customer")
    assert shapes.curated(queries.context(spark, DATA), "support_performance_curated").columns[-1] == "data_as_of"


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("g", "a", "g", "b"), ("g", "b", "g", "c"), ("g", "c", "g", "a"), ("g", "x", "g", "y")], "source_schema string, source_table string, target_schema string, target_table string")
    ctx = context(spark, {"table_lineage": edges})
    assert sorted((r["table"], r["shortest_hop"]) for r in dashboards.closure(ctx, "g", "a").collect()) == [("a", 3), ("b", 1), ("c", 2)]
    assert dashboards.closure(ctx, "g", "y").collect() == []


ACCOUNTS = [
    ("big", "Big", "High", "Stable", 128500.0, 47, 3), ("mid", "Mid", "Medium", "Stable", 9000.0, 75, 1), ("small", "Small", "High", "Stable", 100.0, 50, 1), ("fresh", "Fresh", "High", "Stable", 50000.0, 10, 1),
    ("safe", "Safe", "Low", "Critical", 90000.0, 90, 2), ("sick", "Sick", "High", "Critical", 6000.0, 40, 2), ("slow", "Slow", "Medium", "Stable", 7000.0, 35, 1), ("none", "None", "High", None, None, None, None),
]


def test_actions(spark):
    df = spark.createDataFrame(ACCOUNTS, "account_id string, account_name string, risk_tier string, account_health string, ar_balance double, oldest_invoice_days int, open_invoice_count int")
    found = actions.detect(df).collect()
    assert [(r["account_id"], r["priority"], r["action_type"]) for r in found] == [("big", "P1", "csm_escalation"), ("sick", "P1", "csm_escalation"), ("mid", "P2", "dunning_email"), ("slow", "P3", "dunning_email")]
    assert found[0]["signal"] == "High risk · 47d overdue · $128,500 AR · 3 open invoice(s)"
    queue = actions.propose(df, "r1")
    assert {r["status"] for r in queue.collect()} == {"pending"} and len(queue.first()["action_id"]) == 24
    first = actions.pending(queue).first()
    feedback = spark.createDataFrame([], "action_id string, decision string, reviewer string, final_draft string")
    after, told = actions.decide(queue, feedback, first["action_id"], "edited", "me", "new words")
    assert after.where("status = 'approved'").count() == 1 and told.first()["final_draft"] == "new words"
    assert actions.decisions(told).first()["count"] == 1 and actions.recall(told, queue, first["account_id"]).count() == 1
    drafts = spark.createDataFrame([('sure: {"subject": "S", "body": "B"}',), ("plain",)], "a string").select(actions.parse_draft("a").alias("d")).collect()
    assert [tuple(r["d"]) for r in drafts] == [("S", "B"), ("Account follow-up", "plain")]


def test_evals(spark):
    rows = spark.createDataFrame([("fine [f.pdf p1]", "BANANA47", [("f.pdf", 1)]), ("mail a@b.co [f.pdf p2]", "BANANA47", [("f.pdf", 1)]), ("I don't know", "BANANA47", [])], "answer string, canary string, retrieved array<struct<doc:string,page:int>>")
    scored = evals.score_answers(rows)
    assert [r["citation_accuracy"] for r in scored.collect()] == [1.0, 0.0, 1.0]
    assert evals.gates(scored).first()["pii_leaks"] == 1
    with pytest.raises(evals.GateFailed):
        evals.assert_gates(scored)
    evals.assert_gates(scored.where("pii_leaks = 0"))
    golden = spark.createDataFrame([("q1", [("f.pdf", 1), ("f.pdf", 0)]), ("q2", [])], "request string, refs array<struct<file:string,seq:int>>")
    chunks = spark.createDataFrame([("/x/f.pdf", 0, "c0"), ("/x/f.pdf", 1, "c1")], "source_file string, chunk_seq int, chunk_id string")
    assert {r["request"]: r["expected_chunk_ids"] for r in evals.resolve_golden(golden, chunks).collect()} == {"q1": ["c1", "c0"], "q2": []}
    with pytest.raises(Exception, match="no chunk for"):
        evals.resolve_golden(golden, chunks.where("chunk_seq = 0")).collect()
    pairs = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "a int, b int")
    assert evals.agreement(pairs, "a", "b").first()["kappa"] == pytest.approx(0.5)


def test_governance(spark):
    df = spark.createDataFrame([("j@x.co", "4155550199", "123456789", "note", "T1"), ("k@x.co", None, None, None, "T2")], "email string, phone string, tax string, note string, territory string")
    policy = governance.Policy.from_tags([("d", "email", "email"), ("d", "phone", "phone"), ("d", "tax", "tax_id"), ("d", "note", "free_text"), ("d", "x", "unknown")], territory_filtered={"d": "territory"}, grants={"sales_analysts": frozenset({"d"}), "finance": frozenset({"d"})})
    mapping = spark.createDataFrame([("ana", "T1")], "user_name string, territory string")
    ctx = context(spark, {"d": df})
    analyst, finance, other = Principal("ana", frozenset({"sales_analysts"})), Principal("fin", frozenset({"finance"})), Principal("x", frozenset())
    assert [tuple(r) for r in governance.read_as(ctx, "d", analyst, policy, mapping).collect()] == [("****@x.co", "***-***-0199", "***-**-6789", "[REDACTED]", "T1")]
    assert [r["tax"] for r in governance.read_as(ctx, "d", finance, policy, mapping).collect()] == ["123456789", None]
    with pytest.raises(PermissionError):
        governance.read_as(ctx, "d", other, policy, mapping)
    policy.is_prod = False
    assert governance.read_as(ctx, "d", analyst, policy, mapping).collect() == df.collect()
    governance.register_sql_masks(spark)
    assert spark.sql("SELECT mask_email('a@b.co') AS m").first()["m"] == "****@b.co"
    spark.sql("SET VAR reader_groups = array('data_stewards')")
    assert spark.sql("SELECT mask_email('a@b.co') AS m").first()["m"] == "a@b.co"


def test_lineage_relation(spark):
    ctx = queries.context(spark, DATA)
    ctx.read("gold_support_performance")
    assert ctx.lineage().where(F.col("target") == "gold_support_performance").collect()[0]["source"] == "silver_case"
