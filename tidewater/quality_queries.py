"""Registered queries over rules, the library's own run log, evolving files and the use of retrieved chunks, and their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import rules
from .plans import dashboards, evals
from .plans.oracle import with_relations
from .plans.registry import Context, materialize
from .plans.runlog import RunLog
from .sources.evolution import EvolvingTable
from .staging import place
from .streaming import flows


def dq_rule_catalog(ctx: Context) -> DataFrame:
    """Every rule of the catalog, with the rows that break it."""
    # the marts come first: they have the datasets that they share written, which the rules then read too
    for name in dict.fromkeys(r.dataset for r in reversed(rules.CATALOG)):
        ctx.read(name)
    return rules.check(rules.CATALOG, ctx.read, ctx.as_of)


def dq_scorecard(ctx: Context) -> DataFrame:
    return rules.scorecard(dq_rule_catalog(ctx))


def run_log_rules(ctx: Context) -> DataFrame:
    """Pass rates of expectations, from the log that writing three datasets left behind."""
    log = RunLog(ctx.spark, place(ctx.spark), "conformed")
    materialize(Context(ctx.spark, ctx.source, ctx.as_of), ["silver_invoice", "silver_case", "silver_contract"], place(ctx.spark), log, steps=False)
    told = Context(ctx.spark, log.source(ctx.source), ctx.as_of)
    return dashboards.rule_pass_rates(told, dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(hours=1), 24).where("dataset IN ('silver_invoice', 'silver_case', 'silver_contract')")


def _evolved(ctx: Context) -> DataFrame:
    """Sales as three landings of CSV files: without totals, with whole ones, and as they are, with a word in place of some totals; all taken up by one stream."""
    sales = ctx.read("sales").where("sale_id IS NOT NULL")
    month = F.month("sold_at")
    source, table = place(ctx.spark), EvolvingTable(ctx.spark, place(ctx.spark), "shop")
    checkpoint = place(ctx.spark)
    landings = (
        sales.where(month == 1).select("sale_id", "status"),
        sales.where(month == 2).select("status", "sale_id", F.col("total").cast("bigint").alias("total")),
        sales.where(F.coalesce(month > 2, F.lit(True))).select(F.when(F.col("status") == "open", "unknown").otherwise(F.col("total").cast("string")).alias("total"), "sale_id", "status", "priority"),
    )
    for n, landing in enumerate(landings, 1):
        landing.write.option("header", True).csv(f"{source}/dt=2024-0{n}-01")
        table.ingest(source, checkpoint)
    return table.read()


def evolving_sales(ctx: Context) -> DataFrame:
    return _evolved(ctx).select("sale_id", "status", "total", "priority", F.get_json_object("_rescued_data", "$.total").alias("rescued_total"))


def quarantined_sales(ctx: Context) -> DataFrame:
    """How many rows of each status are clean, and how many are in quarantine with a total that is none."""
    clean, held = flows.split_rescued(_evolved(ctx))
    both = clean.select("status", F.lit("clean").alias("state")).unionByName(held.select("status", F.lit("quarantine").alias("state")))
    return both.groupBy("status", "state").agg(F.count(F.lit(1)).alias("rows"))


def chunk_utilisation(ctx: Context) -> DataFrame:
    """How much of each conversation's earlier turns the assistant's answers repeat, five words in a row at least."""
    turns = ctx.read("conversations").where("text IS NOT NULL").withColumn("answer_id", F.concat_ws("-", "conv_id", "turn"))
    turns = turns.groupBy("conv_id", "turn", "answer_id").agg(F.max("role").alias("role"), F.max("text").alias("text"))  # repeated turns once
    answers = turns.where("role = 'assistant'").select("conv_id", "turn", "answer_id", F.col("text").alias("answer"))
    # an answer's context is the turn before it, or the two before
    before = F.explode(F.array(F.lit(1), F.lit(2))).alias("back")
    asked = answers.select("conv_id", "answer_id", "turn", before).select("conv_id", "answer_id", (F.col("turn") - F.col("back")).alias("turn"))
    retrieved = asked.join(turns.select("conv_id", "turn", "text"), ["conv_id", "turn"]).select("answer_id", F.col("turn").alias("chunk_id"), F.col("text").alias("chunk_text"))
    return evals.chunk_use(answers.select("answer_id", "answer"), retrieved)


BUILDS = {f.__name__: f for f in (dq_rule_catalog, dq_scorecard, run_log_rules, evolving_sales, quarantined_sales, chunk_utilisation)}

_CURRENCY = "currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'AUD', 'CAD', 'INR')"
#: By hand: dataset, rule, kind, and when a row breaks it.
_ROW_RULES = [
    ("silver_customer", "customer_sk_not_null", "not_null", "customer_sk IS NULL"), ("silver_customer", "company_name_not_null", "not_null", "company_name IS NULL"), ("silver_customer", "country_not_null", "not_null", "country IS NULL"),
    ("silver_customer", "match_method_one_of", "one_of", "match_method NOT IN ('crosswalk', 'name_domain', 'crm_only', 'erp_only')"),
    ("silver_contract", "contract_id_not_null", "not_null", "contract_id IS NULL"), ("silver_contract", "contract_amount_not_null", "not_null", "contract_amount IS NULL"), ("silver_contract", "end_date_not_null", "not_null", "end_date IS NULL"),
    ("silver_contract", "contract_amount_within", "within", "contract_amount < 0 OR contract_amount > 1e9"), ("silver_contract", "start_date_before_end_date", "ordered", "start_date > end_date"),
    ("silver_sales_order", "sales_order_id_not_null", "not_null", "sales_order_id IS NULL"), ("silver_sales_order", "customer_sk_not_null", "not_null", "customer_sk IS NULL"), ("silver_sales_order", "currency_accepted", "one_of", _CURRENCY),
    ("silver_sales_order", "order_date_dated", "dated", "order_date < DATE '1992-01-01' OR order_date > DATE '2002-08-01'"),
    ("silver_payment", "payment_id_not_null", "not_null", "payment_id IS NULL"), ("silver_payment", "invoice_id_not_null", "not_null", "invoice_id IS NULL"), ("silver_payment", "payment_amount_not_null", "not_null", "payment_amount IS NULL"),
    ("silver_payment", "payment_date_not_null", "not_null", "payment_date IS NULL"), ("silver_payment", "payment_amount_within", "within", "payment_amount < 0 OR payment_amount > 50000"),
    ("silver_invoice", "invoice_id_not_null", "not_null", "invoice_id IS NULL"), ("silver_invoice", "customer_sk_not_null", "not_null", "customer_sk IS NULL"), ("silver_invoice", "gross_amount_not_null", "not_null", "gross_amount IS NULL"),
    ("silver_invoice", "currency_not_null", "not_null", "currency IS NULL"), ("silver_invoice", "invoice_date_not_null", "not_null", "invoice_date IS NULL"), ("silver_invoice", "currency_accepted", "one_of", _CURRENCY),
    ("silver_invoice", "gross_amount_within", "within", "gross_amount < 0 OR gross_amount > 1e9"), ("silver_invoice", "invoice_date_before_due_date", "ordered", "invoice_date > due_date"),
    ("silver_invoice", "gross_amount_agrees_with_amount_paid", "agrees", "abs(gross_amount - amount_paid) > 100000"), ("silver_invoice", "due_date_dated", "dated", "due_date < DATE '1992-01-01' OR due_date > DATE '1997-06-23'"),
    ("silver_activity", "activity_id_not_null", "not_null", "activity_id IS NULL"), ("silver_activity", "customer_sk_not_null", "not_null", "customer_sk IS NULL"), ("silver_activity", "activity_date_not_null", "not_null", "activity_date IS NULL"),
    ("silver_activity", "activity_type_one_of", "one_of", "activity_type NOT IN ('click', 'view', 'purchase')"),
    ("silver_case", "case_id_not_null", "not_null", "case_id IS NULL"), ("silver_case", "status_not_null", "not_null", "status IS NULL"), ("silver_case", "priority_one_of", "one_of", "priority NOT IN ('Critical', 'High')"),
    ("silver_case", "created_date_before_closed_date", "ordered", "created_date > closed_date"), ("silver_product", "unit_price_within", "within", "unit_price < 1000"),
    ("silver_territory", "territory_id_not_null", "not_null", "territory_id IS NULL"), ("silver_territory", "region_not_null", "not_null", "region IS NULL"), ("silver_territory", "region_one_of", "one_of", "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"),
    ("gold_bookings_vs_billings", "total_booked_agrees_with_total_billed", "agrees", "abs(total_booked - total_billed) > 1"), ("gold_collections_risk", "risk_tier_one_of", "one_of", "risk_tier NOT IN ('high', 'medium', 'none')"),
    ("gold_account_health", "health_score_within", "within", "health_score < 0 OR health_score > 8"), ("gold_renewal_risk", "renewal_risk_tier_one_of", "one_of", "renewal_risk_tier NOT IN ('low', 'medium')"),
]
_UNIQUE = [("silver_customer", "customer_sk"), ("silver_contract", "contract_id"), ("silver_product", "product_id, _seq"), ("gold_customer_360", "customer_sk")]
_REFERENCES = [("silver_contract", "customer_sk", "silver_customer", "customer_sk"), ("silver_payment", "invoice_id", "silver_invoice", "invoice_id"), ("gold_customer_360", "customer_sk", "gold_collections_risk", "customer_sk"), ("gold_collections_risk", "customer_sk", "gold_customer_360", "customer_sk")]
_SEQ = lambda d, c: c.replace("_seq", "seq") if d == "silver_product" else c
_CHECKED = " UNION ALL ".join(
    [f"SELECT '{d}' AS dataset, '{r}' AS rule, '{k}' AS kind, count(*) AS rows, count(*) FILTER ({p}) AS failed FROM {d}" for d, r, k, p in _ROW_RULES]
    + [f"SELECT '{d}', '{c.replace(', ', '_')}_unique', 'unique', count(*), count(*) - count(DISTINCT ({_SEQ(d, c)})) FROM {d}" for d, c in _UNIQUE]
    + [f"SELECT '{d}', '{c}_in_{p}', 'references', count(*), count(*) FILTER ({c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} AS p WHERE p.{k} = {d}.{c})) FROM {d}" for d, c, p, k in _REFERENCES]
)
_TURN = "(SELECT conv_id, turn, max(role) AS role, max(text) AS text FROM conversations WHERE text IS NOT NULL GROUP BY 1, 2)"
_SPLIT = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"

ORACLES = {
    "dq_rule_catalog": with_relations(f"SELECT * FROM ({_CHECKED})"),
    "dq_scorecard": with_relations(f"SELECT dataset, count(*) AS rules, count(*) FILTER (failed > 0) AS broken_rules, max(rows) AS rows, sum(failed)::BIGINT AS failed, coalesce(round(100.0 * (sum(rows) - sum(failed)) / nullif(sum(rows), 0), 2), 100.0) AS score FROM ({_CHECKED}) GROUP BY dataset"),
    "evolving_sales": """SELECT sale_id, status, CASE WHEN month(sold_at) = 1 THEN NULL WHEN month(sold_at) = 2 THEN trunc(total)::DOUBLE WHEN status = 'open' THEN NULL ELSE total END AS total,
  CASE WHEN month(sold_at) IN (1, 2) THEN NULL ELSE priority::BIGINT END AS priority, CASE WHEN coalesce(month(sold_at), 3) > 2 AND status = 'open' THEN 'unknown' END AS rescued_total FROM sales WHERE sale_id IS NOT NULL""",
    "quarantined_sales": """SELECT status, CASE WHEN coalesce(month(sold_at), 3) > 2 AND status = 'open' THEN 'quarantine' ELSE 'clean' END AS state, count(*) AS rows FROM sales WHERE sale_id IS NOT NULL GROUP BY ALL""",
    "chunk_utilisation": f"""WITH t AS {_TURN},
a AS (SELECT conv_id || '-' || turn AS answer_id, conv_id, turn, {_SPLIT.format("text")} AS w FROM t WHERE role = 'assistant'),
g AS (SELECT DISTINCT answer_id, array_to_string(w[i:i + 4], ' ') AS run FROM (SELECT answer_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM a WHERE len(w) >= 5)),
r AS (SELECT answer_id, t.turn AS chunk_id, {_SPLIT.format("t.text")} AS w FROM a JOIN t ON t.conv_id = a.conv_id AND t.turn IN (a.turn - 1, a.turn - 2)),
h AS (SELECT answer_id, chunk_id, i FROM (SELECT answer_id, chunk_id, i, array_to_string(w[i:i + 4], ' ') AS run FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS i FROM r WHERE len(w) >= 5)) JOIN g USING (answer_id, run)),
u AS (SELECT answer_id, chunk_id, count(DISTINCT k) AS used_words FROM (SELECT answer_id, chunk_id, unnest(generate_series(i, i + 4)) AS k FROM h) GROUP BY 1, 2),
l AS (SELECT answer_id, chunk_id, max(n) + 4 AS longest_run FROM (SELECT answer_id, chunk_id, count(*) AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY answer_id, chunk_id ORDER BY i) AS island FROM h) GROUP BY 1, 2, island) GROUP BY 1, 2)
SELECT answer_id, chunk_id, len(w) AS words, coalesce(used_words, 0) AS used_words, coalesce(longest_run, 0)::BIGINT AS longest_run, coalesce(used_words, 0) > 0 AS used FROM r LEFT JOIN u USING (answer_id, chunk_id) LEFT JOIN l USING (answer_id, chunk_id)""",
}
_EXPECTED = [
    ("silver_invoice", "has_invoice_id", "invoice_id IS NOT NULL"), ("silver_invoice", "has_gross_amount", "gross_amount IS NOT NULL"), ("silver_invoice", "valid_currency", "length(currency) = 3"),
    ("silver_invoice", "date_sanity", "due_date IS NULL OR due_date >= invoice_date"), ("silver_invoice", "referential_customer", "customer_sk IS NOT NULL"),
    ("silver_case", "has_case_id", "case_id IS NOT NULL"), ("silver_case", "has_customer", "customer_sk IS NOT NULL"), ("silver_case", "date_sanity", "closed_date IS NULL OR closed_date >= created_date"),
    ("silver_contract", "has_contract_id", "contract_id IS NOT NULL"), ("silver_contract", "has_amount", "contract_amount IS NOT NULL"), ("silver_contract", "has_customer", "customer_sk IS NOT NULL"),
    ("silver_contract", "non_negative_amount", "contract_amount >= 0"), ("silver_contract", "dates_ordered", "end_date IS NULL OR start_date IS NULL OR end_date >= start_date"),
]
_PASSED = " UNION ALL ".join(f"SELECT '{d}' AS dataset, '{r}' AS expectation_name, count(*) FILTER ({p}) AS passed, count(*) - count(*) FILTER ({p}) AS failed FROM {d}" for d, r, p in _EXPECTED)
ORACLES["run_log_rules"] = with_relations(f"SELECT *, round(100.0 * passed / nullif(passed + failed, 0), 2) AS pass_pct FROM ({_PASSED})")
