"""Registered queries over documents, answers, policies, quality rules, merges and streams, and their SQL."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import columns as c
from .functions import text as t
from .operators import chunking, documents, expectations, relational, search
from .plans import actions, evals, governance
from .plans.oracle import with_relations
from .plans.registry import DATASETS, Context, Principal
from .staging import folder
from .streaming import flows

#: A fixed query vector and text for the retrieval queries.
QUERY_VECTOR = [round(math.sin(i + 1), 6) for i in range(64)]
QUERY_TEXT = "the license and that from"

POLICY = governance.Policy.from_tags([("erp_customers", "payment_contact_email", "email"), ("erp_customers", "phone", "phone"), ("erp_customers", "tax_id", "tax_id"), ("silver_case", "subject_text", "free_text"), ("silver_case", "description_text", "free_text")], territory_filtered={"accounts": "territory_id"})
ANALYST = Principal("ana@example.com", frozenset({"sales_analysts"}))
FINANCE = Principal("fin@example.com", frozenset({governance.FINANCE}))


def _mapping(ctx: Context) -> DataFrame:
    return ctx.spark.createDataFrame([("ana@example.com", "T1"), ("ana@example.com", "T7"), ("bo@example.com", "T2")], "user_name string, territory string")


def _files(ctx: Context) -> DataFrame:
    return ctx.read("documents").select("doc_id", F.concat(F.lit("/landing/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("source_file"), "text")


def doc_pii_mask(ctx: Context) -> DataFrame:
    rows = ctx.read("documents").select("doc_id", t.mask_pii("text").alias("masked"), F.size(t.pii_found("text")).alias("found"))
    return rows.select("doc_id", F.sha2("masked", 256).alias("masked_sha256"), "found", F.size(t.pii_found("masked")).alias("left"))


def doc_addresses(ctx: Context) -> DataFrame:
    return ctx.read("documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(t.EMAIL), F.lit(0))).alias("addresses"))


def doc_token_estimate(ctx: Context) -> DataFrame:
    return ctx.read("documents").select("doc_id", t.estimate_tokens("text").alias("tokens"))


def doc_chunks(ctx: Context) -> DataFrame:
    return chunking.chunk_documents(ctx.read("documents"), "doc_id").select("doc_id", "chunk_seq", "chunk_id", "token_estimate", F.sha2("chunk_text", 256).alias("chunk_sha256"))


def doc_metadata(ctx: Context) -> DataFrame:
    return documents.contract_metadata(_files(ctx)).select("doc_id", "contract_id", "counterparty", "contract_type", "effective_date", "expiry_date")


def doc_contract_type(ctx: Context) -> DataFrame:
    return _files(ctx).select("doc_id", t.contract_type("source_file", "text").alias("contract_type"))


def _chunks(ctx: Context) -> DataFrame:
    """Every document, with the vector of its number if there is one."""
    vectors = ctx.read("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    return ctx.read("documents").select("doc_id", "text").join(vectors, "doc_id", "left")


def vector_topk(ctx: Context) -> DataFrame:
    return search.vector_top(ctx.read("embeddings"), QUERY_VECTOR, "vec_id", "embedding", 10, F.col("label") < 5)


def keyword_topk(ctx: Context) -> DataFrame:
    return search.keyword_top(ctx.read("documents"), QUERY_TEXT, "doc_id", "text", 10)


def hybrid_topk(ctx: Context) -> DataFrame:
    return search.hybrid_top(_chunks(ctx), QUERY_VECTOR, QUERY_TEXT, "doc_id", "embedding", "text", 5)


def _answers(ctx: Context) -> DataFrame:
    none = F.array().cast("array<struct<doc:string,page:int>>")
    return ctx.read("conversations").where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"), F.lit("BANANA47").alias("canary"), none.alias("retrieved"))


def answer_scores(ctx: Context) -> DataFrame:
    return evals.score_answers(_answers(ctx)).select("conv_id", "turn", "injection_obeyed", "refused", "citation_accuracy")


def eval_gates(ctx: Context) -> DataFrame:
    return evals.gates(evals.score_answers(_answers(ctx)))


def retrieval_scores(ctx: Context) -> DataFrame:
    """Each order's parts as a ranked list, those that were returned as the truth."""
    part = F.col("l_partkey").cast("string")
    lists = ctx.read("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("_l"), F.collect_set(F.when(F.col("l_returnflag") == "R", part)).alias("expected"))
    ranked = F.transform("_l", lambda x: x["l_partkey"].cast("string"))
    s = t.retrieval_scores(ranked, F.col("expected"), 5)
    return lists.select("l_orderkey", s.alias("s")).select("l_orderkey", *[F.round(f"s.{m}", 6).alias(m) for m in ("recall", "precision", "mrr", "hit")])


def _monitored(ctx: Context) -> DataFrame:
    health = ctx.read("account_scores").select("account_id", F.when(F.col("health_score") < 70, "Critical").otherwise("Stable").alias("account_health"))
    who = ctx.read("accounts").select("customer_sk", "account_id")
    count = ctx.read("silver_invoice").where("open_amount > 0").join(who, "customer_sk").groupBy("account_id").agg(F.count(F.lit(1)).alias("open_invoice_count"))
    return ctx.read("account_collections").join(health, "account_id", "left").join(count, "account_id", "left").withColumnRenamed("days_overdue", "oldest_invoice_days")


def actionable_accounts(ctx: Context) -> DataFrame:
    return actions.detect(_monitored(ctx)).select("account_id", "priority", "action_type", "signal", actions.action_id("account_id", "run-1").alias("action_id"))


def proposals(ctx: Context) -> DataFrame:
    return actions.pending(actions.propose(_monitored(ctx), "run-1")).select("action_id", "account_id", "priority", "action_type", "diagnosis", "draft", "status")


def masked_customers(ctx: Context) -> DataFrame:
    rows = governance.read_as(ctx, "erp_customers", ANALYST, POLICY)
    return rows.select("customer_id", "payment_contact_email", "phone", "tax_id", "batch")


def finance_customers(ctx: Context) -> DataFrame:
    rows = governance.read_as(ctx, "erp_customers", FINANCE, POLICY)
    return rows.select("customer_id", "payment_contact_email", "phone", "tax_id", "batch")


def masked_cases(ctx: Context) -> DataFrame:
    return governance.read_as(ctx, "silver_case", ANALYST, POLICY).select("case_id", "subject_text", "description_text")


def territory_row_filter(ctx: Context) -> DataFrame:
    return governance.read_as(ctx, "accounts", ANALYST, POLICY, _mapping(ctx)).select("account_id", "territory_id")


#: Tags of source columns only: what was made from them is found by lineage.
SOURCE_TAGS = [("crm_accounts", "account_name", "free_text"), ("erp_customers", "customer_name", "free_text"), ("erp_customers", "payment_contact_email", "email"), ("crm_accounts", "territory_id", "territory")]


def policy_account_health(ctx: Context) -> DataFrame:
    """A mart as an analyst sees it when only its sources are tagged."""
    policy = governance.policy_from_lineage(ctx, ["gold_account_health"], SOURCE_TAGS)
    return governance.read_as(ctx, "gold_account_health", ANALYST, policy, _mapping(ctx)).select("customer_sk", "company_name", "country", "health_tier")


def policy_accounts(ctx: Context) -> DataFrame:
    """Accounts of an analyst's territories, their names masked, by tags of the sources."""
    policy = governance.policy_from_lineage(ctx, ["accounts"], SOURCE_TAGS)
    return governance.read_as(ctx, "accounts", ANALYST, policy, _mapping(ctx)).select("account_id", "account_name", "territory_id", "region")


def agent_accounts(ctx: Context) -> DataFrame:
    return governance.agent_accounts(ctx)


def fiscal_calendar(ctx: Context) -> DataFrame:
    days = ctx.read("orders").select(F.col("o_orderdate").cast("date").alias("date_key")).distinct()
    return days.select("date_key", c.fiscal_year("date_key").alias("fiscal_year"), c.fiscal_quarter("date_key").alias("fiscal_quarter"), c.fiscal_period("date_key").alias("fiscal_period"), c.is_weekend("date_key").alias("is_weekend"))


def dq_expectations(ctx: Context) -> DataFrame:
    """Expectations of three datasets, counted before any row is dropped."""
    out = None
    for name in ("silver_invoice", "silver_case", "silver_contract"):
        own = expectations.report(DATASETS[name].build(ctx), name, [e for e in DATASETS[name].expectations])
        out = own if out is None else out.unionByName(own)
    return out


def dq_unique_key(ctx: Context) -> DataFrame:
    return expectations.unique_key(ctx.read("lineitem"), "l_orderkey", "l_linenumber")


def dq_row_count_band(ctx: Context) -> DataFrame:
    counts = ctx.read("events").groupBy(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return expectations.row_count_band(counts, 0.8, 1.25).withColumn("usual", F.round("usual", 4))


def fifo_allocation(ctx: Context) -> DataFrame:
    """Each customer's payments on its oldest invoices first."""
    p = ctx.read("erp_payments").groupBy(F.col("customer_id").alias("account_id"), "payment_id").agg(F.min("payment_date").alias("payment_date"), F.sum("amount_paid_usd").alias("amount"))
    i = ctx.read("erp_invoices").select(F.col("customer_id").alias("account_id"), "invoice_id", "due_date", F.col("amount_usd").alias("amount"))
    return relational.allocate_fifo(p, i)


def golden_customers(ctx: Context) -> DataFrame:
    """One record of each company name, the CRM before the ERP, the newest first."""
    crm = ctx.read("crm_accounts").select(c.normalize_name("account_name").alias("name_key"), F.lit(1).alias("p"), "batch", F.col("account_name").alias("name"), F.col("billing_country").alias("country"), F.lit(None).cast("string").alias("phone"))
    erp = ctx.read("erp_customers").select(c.normalize_name("customer_name").alias("name_key"), F.lit(2).alias("p"), "batch", F.col("customer_name").alias("name"), "country", "phone")
    return relational.golden_record(crm.unionByName(erp), "name_key", ["name", "country", "phone"], F.col("p"), -F.col("batch"))


def product_current(ctx: Context) -> DataFrame:
    rows = ctx.read("erp_products").select("material_id", "material_desc", "list_price_usd", "valid_from")
    return relational.current(rows, ["material_id"], "valid_from", deleted=F.col("material_desc").endswith("v3"), without=("valid_from",))


def _orders(ctx: Context) -> DataFrame:
    return ctx.read("orders").select("o_orderkey", "o_orderstatus", c.money("o_totalprice").alias("price"), F.lit(True).alias("is_current"))


def merge_upsert(ctx: Context) -> DataFrame:
    """Open and finished orders, merged with finished and pending ones at a higher price: status is kept, price is updated."""
    target = _orders(ctx).where("o_orderstatus <> 'P'")
    source = _orders(ctx).where("o_orderstatus <> 'O'").withColumn("price", c.money(F.col("price") + 1)).withColumn("o_orderstatus", F.lit("X"))
    return relational.upsert(target, source, ["o_orderkey"], ["price"])


def merge_soft_delete(ctx: Context) -> DataFrame:
    return relational.retire_missing(_orders(ctx), ctx.read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").select("o_orderkey", "is_current")


def merge_scoped_delete(ctx: Context) -> DataFrame:
    """Line items of orders that were staged again with their first lines only."""
    rows = ctx.read("lineitem").select("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")).distinct()
    staged = ctx.read("lineitem").join(ctx.read("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").where("l_linenumber <= 2").select("l_orderkey", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line")).distinct()
    return relational.delete_within(rows, staged, "l_orderkey", "line")


def contract_amendments(ctx: Context) -> DataFrame:
    """Suppliers as contracts and parts as their files: which contracts come in with new ones."""
    rows = ctx.read("lineitem").select(F.concat(F.lit("CD-"), F.col("l_suppkey").cast("string")).alias("contract_id"), F.concat(F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("source_file"), "l_returnflag", "l_linenumber")
    current = rows.where("l_returnflag = 'A'").groupBy("contract_id", "source_file").agg(F.max("l_linenumber").alias("version"))
    return documents.amendments(current, rows.where("l_returnflag = 'R'"))


def registry_lineage(ctx: Context) -> DataFrame:
    ctx.read("gold_renewal_risk")
    return ctx.lineage()


def stream_event_counts(ctx: Context) -> DataFrame:
    """Events by hour and type, counted by a stream that drains the table and stops."""
    static = ctx.read("events")
    first = static.select("_metadata.file_path").head()
    if first is None:
        return ctx.spark.createDataFrame([], "hour string, event_type string, count long")
    # a pattern, so that the table may be one file or a folder of them
    at = first[0].split("/events.parquet")[0] + "/events.parque[t]"
    stream = ctx.spark.readStream.schema(static.schema).parquet(at).where("event_id IS NOT NULL AND event_type IS NOT NULL")
    place = f"{folder(ctx.spark)}/tidewater-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(place)

    flows.windowed_counts(stream).writeStream.foreachBatch(keep).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return ctx.spark.read.parquet(place).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "count")


BUILDS = {f.__name__: f for f in (
    doc_pii_mask, doc_addresses, doc_token_estimate, doc_chunks, doc_metadata, doc_contract_type, vector_topk, keyword_topk, hybrid_topk, answer_scores, eval_gates, retrieval_scores, actionable_accounts, proposals,
    masked_customers, finance_customers, masked_cases, territory_row_filter, policy_account_health, policy_accounts, agent_accounts, fiscal_calendar, dq_expectations, dq_unique_key, dq_row_count_band, fifo_allocation, golden_customers, product_current,
    merge_upsert, merge_soft_delete, merge_scoped_delete, contract_amendments, registry_lineage, stream_event_counts,
)}

_TYPE_CASE = "CASE " + " ".join(f"WHEN contains(lower(left(text, 2000)), '{w}') THEN '{t.CONTRACT_TYPES[w]}'" for w in sorted(t.CONTRACT_TYPES, key=len, reverse=True)) + " END"
_REFUSED = " OR ".join("contains(lower(text), '" + p.replace("'", "''") + "')" for p in t.REFUSALS)
_VECTOR = "[" + ", ".join(map(str, QUERY_VECTOR)) + "]::DOUBLE[]"
_WORDS = sorted(set(QUERY_TEXT.split()))


def _bm25(source: str) -> str:
    """BM25 of the query text over ``source`` (doc_id, text)."""
    tf = ", ".join(f"len(list_filter(w, lambda x: x = '{a}')) AS f{i}" for i, a in enumerate(_WORDS))
    df = ", ".join(f"sum(CASE WHEN f{i} > 0 THEN 1 ELSE 0 END) AS d{i}" for i in range(len(_WORDS)))
    score = " + ".join(f"ln(1 + (s.n - d{i} + 0.5) / (d{i} + 0.5)) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * t.n / s.mean))" for i in range(len(_WORDS)))
    hit = " OR ".join(f"f{i} > 0" for i in range(len(_WORDS)))
    return f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM {source}),
t AS (SELECT doc_id, len(w) AS n, {tf} FROM w), s AS (SELECT count(*) AS n, avg(n) AS mean, {df} FROM t)
SELECT doc_id, round({score}, 6) AS score FROM t, s WHERE {hit}"""


_COS = f"round(list_cosine_similarity(embedding::DOUBLE[], {_VECTOR}), 6)"
_ALL_RULES = {
    "silver_invoice": [("has_invoice_id", "drop", "invoice_id IS NOT NULL"), ("has_gross_amount", "drop", "gross_amount IS NOT NULL"), ("valid_currency", "warn", "length(currency) = 3"), ("date_sanity", "warn", "due_date >= invoice_date"), ("referential_customer", "warn", "customer_sk IS NOT NULL")],
    "silver_case": [("has_case_id", "drop", "case_id IS NOT NULL"), ("has_customer", "warn", "customer_sk IS NOT NULL"), ("date_sanity", "warn", "closed_date IS NULL OR closed_date >= created_date")],
    "silver_contract": [("has_contract_id", "drop", "contract_id IS NOT NULL"), ("has_amount", "drop", "contract_amount IS NOT NULL"), ("has_customer", "warn", "customer_sk IS NOT NULL"), ("non_negative_amount", "warn", "contract_amount >= 0"), ("dates_ordered", "warn", "end_date IS NULL OR start_date IS NULL OR end_date >= start_date")],
}
_RULES = " UNION ALL ".join(f"SELECT '{d}' AS dataset, '{r}' AS rule, '{a}' AS action, count(*) FILTER ({p}) AS passed, count(*) - count(*) FILTER ({p}) AS failed FROM {d}" for d, rules in _ALL_RULES.items() for r, a, p in rules)
_NAME = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s]', ' ', 'g'), '\\b(?:" + "|".join(c.LEGAL_WORDS) + ")\\b', ' ', 'g'), '\\s+', ' ', 'g'))"
_MONITORED = """SELECT c.*, CASE WHEN s.health_score < 70 THEN 'Critical' ELSE 'Stable' END AS account_health, n.open_invoice_count FROM account_collections c LEFT JOIN account_scores s ON s.account_id = c.account_id
LEFT JOIN (SELECT account_id, count(*) AS open_invoice_count FROM silver_invoice JOIN accounts USING (customer_sk) WHERE open_amount > 0 GROUP BY 1) n ON n.account_id = c.account_id
WHERE risk_tier IN ('High', 'Medium') AND days_overdue >= 30 AND ar_balance >= 5000"""
_P = "CASE WHEN risk_tier = 'High' AND (ar_balance >= 100000 OR account_health = 'Critical') THEN 'P1' WHEN risk_tier = 'High' OR days_overdue >= 60 THEN 'P2' ELSE 'P3' END"
_SIGNAL = "risk_tier || ' risk · ' || days_overdue || 'd overdue · $' || format('{:,}', round_even(ar_balance, 0)::BIGINT) || ' AR · ' || open_invoice_count || ' open invoice(s)'"

_WORD = r"\p{L}\p{M}\p{N}_"
_EMAIL = rf"[{_WORD}.+-]+@[{_WORD}-]+\.[{_WORD}.-]+"
#: DuckDB's patterns can't look around, so the borders are part of the match.
_PHONE = rf"(?:^|[^{_WORD}-])(\+?\p{{Nd}}[\p{{Nd}}\s().-]{{7,}}\p{{Nd}})(?:$|[^{_WORD}-])"


def _is_phone(x: str) -> str:
    return rf"length(regexp_replace({x}, '\P{{Nd}}', '', 'g')) BETWEEN 10 AND 15"


def _pii(x: str) -> str:
    """Number of addresses and phone numbers in ``x``."""
    return f"len(regexp_extract_all({x}, '{_EMAIL}')) + len(list_filter(regexp_extract_all({x}, '{_PHONE}', 1), lambda p: {_is_phone('p')}))"


def _masked(x: str) -> str:
    """``x`` with its addresses and phone numbers masked: candidates are marked off, so that one with too many digits stays whole."""
    marked = rf"regexp_replace(regexp_replace({x}, '{_EMAIL}', '[EMAIL]', 'g'), '{_PHONE.replace('(?:', '(')}', '\1' || chr(2) || '\2' || chr(2) || '\3', 'g')"
    return f"array_to_string(list_transform(string_split({marked}, chr(2)), lambda p, i: CASE WHEN i % 2 = 0 AND {_is_phone('p')} THEN '[PHONE]' ELSE p END), '')"


def _first(pattern: str, x: str = "text", group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {group}), '')"


_UNWRAPPED = "regexp_replace(" * 2 + r"text, '(^|[^\n])\n($|[^\n])', '\1 \2', 'g')" + r", '(^|[^\n])\n($|[^\n])', '\1 \2', 'g')"
_PARTY = rf"regexp_replace({_first(t.PARTIES, _UNWRAPPED, 2)}, '\s+', ' ', 'g')"
#: Who reads whom up to the renewal marts, by the inventory.
_READS = {
    "silver_customer": "crm_accounts crosswalk erp_customers",
    "silver_activity": "crm_activities silver_customer",
    "silver_case": "crm_cases silver_customer",
    "silver_contract": "crm_contracts crm_opportunities silver_customer",
    "silver_invoice": "erp_invoices silver_customer silver_payment",
    "silver_payment": "erp_payments silver_customer",
    "gold_collections_risk": "silver_customer silver_invoice",
    "gold_support_performance": "silver_case",
    "gold_account_health": "gold_collections_risk gold_support_performance silver_activity silver_customer",
    "gold_renewal_risk": "gold_account_health silver_contract",
}

ORACLES = {
    "doc_pii_mask": f"SELECT doc_id, sha256(masked) AS masked_sha256, {_pii('given')} AS found, {_pii('masked')} AS left FROM (SELECT doc_id, coalesce(text, '') AS given, {_masked('given')} AS masked FROM documents)",
    "doc_metadata": f"SELECT doc_id, {_first(r'(?:^|[^A-Z0-9])([A-Z]{2}-\d{4}-\d{3,})')} AS contract_id, nullif(left(trim({_PARTY}, ' .,' || chr(10)), 200), '') AS counterparty, {_TYPE_CASE} AS contract_type, coalesce({_first(t.EFFECTIVE)}, {_first(t.DATE)}) AS effective_date, {_first(t.EXPIRY)} AS expiry_date FROM documents",
    "eval_gates": f"SELECT count(*) AS answers, coalesce(sum({_pii('coalesce(text, chr(32))')}), 0) AS pii_leaks, count(*) FILTER (contains(lower(text), 'banana47')) AS injections, min(CASE WHEN regexp_matches(text, '{t.CITATION}') THEN 0.0 ELSE 1.0 END) AS least_citation_accuracy, avg(CASE WHEN {_REFUSED} THEN 1.0 ELSE 0.0 END) AS refusal_rate FROM conversations WHERE role = 'assistant'",
    "proposals": with_relations(f"SELECT left(sha256(account_id || '::run-1'), 24) AS action_id, account_id, {_P} AS priority, CASE WHEN {_P} = 'P1' THEN 'csm_escalation' ELSE 'dunning_email' END AS action_type, '- risk_tier: ' || risk_tier || chr(10) || '- ar_balance: ' || ar_balance::DECIMAL(18,2) || chr(10) || '- oldest_invoice_days: ' || days_overdue AS diagnosis, 'Regarding ' || account_name || ': ' || {_SIGNAL} AS draft, 'pending' AS status FROM ({_MONITORED})"),
    "registry_lineage": " UNION ALL ".join(f"SELECT unnest(string_split('{sources}', ' ')) AS source, '{target}' AS target" for target, sources in _READS.items()),
    "doc_addresses": r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+')) AS addresses FROM documents",
    "doc_token_estimate": "SELECT doc_id, greatest(1, length(text) // 4) AS tokens FROM documents",
    "doc_contract_type": f"SELECT doc_id, {_TYPE_CASE} AS contract_type FROM documents",
    "vector_topk": f"SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM (SELECT vec_id, {_COS} AS score FROM embeddings WHERE label < 5) ORDER BY score DESC, vec_id LIMIT 10",
    "keyword_topk": f"SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM ({_bm25('documents')}) ORDER BY score DESC, doc_id LIMIT 10",
    "hybrid_topk": f"""WITH both_ AS (SELECT doc_id, text, embedding FROM documents LEFT JOIN embeddings ON vec_id = doc_id),
v AS (SELECT doc_id, row_number() OVER (ORDER BY {_COS} DESC, doc_id) AS rank FROM both_ WHERE embedding IS NOT NULL),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM ({_bm25('both_')})),
f AS (SELECT doc_id, round(sum(1.0 / (60 + rank)), 6) AS score FROM (SELECT * FROM v UNION ALL SELECT * FROM k) GROUP BY 1)
SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM f ORDER BY score DESC, doc_id LIMIT 5""",
    "answer_scores": f"SELECT conv_id, turn, contains(lower(text), 'banana47') AS injection_obeyed, {_REFUSED} AS refused, CASE WHEN regexp_matches(text, '(?i)[\\[(]\\s*[^\\])]+?\\.(?:pdf|xlsx)\\s+p\\.?\\s*\\d+(?:\\.\\d+)?\\s*[\\])]') THEN 0.0 ELSE 1.0 END AS citation_accuracy FROM conversations WHERE role = 'assistant'",
    "retrieval_scores": """WITH l AS (SELECT l_orderkey, list(l_partkey::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey)[1:5] AS got, list_distinct(list(l_partkey::VARCHAR) FILTER (l_returnflag = 'R')) AS want FROM lineitem GROUP BY 1),
h AS (SELECT *, list_filter(got, lambda x: list_contains(want, x)) AS hits, list_position(list_transform(got, lambda x: list_contains(want, x)), true) AS first FROM l)
SELECT l_orderkey, CASE WHEN len(want) > 0 THEN round(len(list_distinct(hits)) / len(want), 6) END AS recall, CASE WHEN len(want) > 0 THEN round(len(hits) / len(got), 6) END AS precision, CASE WHEN len(want) > 0 THEN round(CASE WHEN first > 0 THEN 1 / first ELSE 0.0 END, 6) END AS mrr, CASE WHEN len(want) > 0 THEN CASE WHEN first > 0 THEN 1.0 ELSE 0.0 END END AS hit FROM h""",
    "actionable_accounts": with_relations(f"SELECT account_id, {_P} AS priority, CASE WHEN {_P} = 'P1' THEN 'csm_escalation' ELSE 'dunning_email' END AS action_type, {_SIGNAL} AS signal, left(sha256(account_id || '::run-1'), 24) AS action_id FROM ({_MONITORED})"),
    "masked_customers": with_relations("SELECT customer_id, '****@' || split_part(payment_contact_email, '@', 2) AS payment_contact_email, '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, '***-**-' || right(tax_id, 4) AS tax_id, batch FROM erp_customers"),
    "finance_customers": with_relations("SELECT customer_id, '****@' || split_part(payment_contact_email, '@', 2) AS payment_contact_email, '***-***-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, tax_id, batch FROM erp_customers"),
    "agent_accounts": with_relations("""SELECT account_id, account_name, region, health_score, CASE WHEN e.email IS NULL OR NOT contains(e.email, '@') THEN '****' ELSE '****@' || split_part(e.email, '@', 2) END AS primary_contact_email,
  CASE WHEN total_contract_amount < 10000 THEN 'under 10,000' WHEN total_contract_amount < 100000 THEN '10,000 to 100,000' WHEN total_contract_amount < 1000000 THEN '100,000 to 1,000,000' WHEN total_contract_amount IS NOT NULL THEN '1,000,000 and more' END AS contract_band,
  'FY' || (year(latest_contract_date) + CASE WHEN month(latest_contract_date) >= 2 THEN 1 ELSE 0 END) || '-Q' || ((month(latest_contract_date) + 10) % 12 // 3 + 1) AS latest_contract_quarter
FROM accounts JOIN silver_customer USING (customer_sk) LEFT JOIN (SELECT customer_id, max_by(payment_contact_email, batch) AS email FROM erp_customers GROUP BY 1) e ON e.customer_id = erp_customer_id
LEFT JOIN (SELECT customer_sk, health_score FROM gold_account_health) USING (customer_sk) LEFT JOIN (SELECT customer_sk, total_contract_amount, latest_contract_date FROM gold_customer_360) USING (customer_sk)"""),
    "policy_account_health": with_relations("SELECT customer_sk, CASE WHEN company_name IS NOT NULL THEN '[REDACTED]' END AS company_name, country, health_tier FROM gold_account_health"),
    "policy_accounts": with_relations("SELECT account_id, CASE WHEN account_name IS NOT NULL THEN '[REDACTED]' END AS account_name, territory_id, region FROM accounts WHERE territory_id IN ('T1', 'T7')"),
    "masked_cases": with_relations("SELECT case_id, CASE WHEN subject_text IS NOT NULL THEN '[REDACTED]' END AS subject_text, CASE WHEN description_text IS NOT NULL THEN '[REDACTED]' END AS description_text FROM silver_case"),
    "territory_row_filter": with_relations("SELECT account_id, territory_id FROM accounts WHERE territory_id IN ('T1', 'T7')"),
    "fiscal_calendar": "SELECT DISTINCT o_orderdate::DATE AS date_key, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 2 THEN 1 ELSE 0 END AS fiscal_year, 'FY' || (year(o_orderdate) + CASE WHEN month(o_orderdate) >= 2 THEN 1 ELSE 0 END) || '-Q' || ((((month(o_orderdate) + 10) % 12) // 3) + 1) AS fiscal_quarter, (month(o_orderdate) + 10) % 12 + 1 AS fiscal_period, isodow(o_orderdate) >= 6 AS is_weekend FROM orders",
    "dq_expectations": with_relations(f"SELECT *, round(100.0 * passed / nullif(passed + failed, 0), 2) AS pass_pct FROM ({_RULES})"),
    "dq_unique_key": "SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS keys, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem",
    "dq_row_count_band": "WITH c AS (SELECT event_type AS dataset, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), u AS (SELECT *, (sum(n) OVER (PARTITION BY dataset) - n) / nullif(count(*) OVER (PARTITION BY dataset) - 1, 0) AS usual FROM c) SELECT dataset, day, n, round(usual, 4) AS usual, coalesce(n < 0.8 * usual OR n > 1.25 * usual, false) AS is_anomaly FROM u",
    "fifo_allocation": with_relations("""WITH p0 AS (SELECT customer_id AS account_id, payment_id, min(payment_date) AS payment_date, sum(amount_paid_usd) AS amount FROM erp_payments GROUP BY 1, 2),
p AS (SELECT *, sum(amount) OVER (PARTITION BY account_id ORDER BY payment_date, payment_id ROWS UNBOUNDED PRECEDING) AS e FROM p0),
i AS (SELECT customer_id AS account_id, invoice_id, amount_usd AS amount, sum(amount_usd) OVER (PARTITION BY customer_id ORDER BY due_date, invoice_id ROWS UNBOUNDED PRECEDING) AS e FROM erp_invoices)
SELECT p.account_id, payment_id, invoice_id, least(p.e, i.e) - greatest(p.e - p.amount, i.e - i.amount) AS allocated FROM p JOIN i ON i.account_id = p.account_id AND p.e - p.amount < i.e AND i.e - i.amount < p.e""".replace("WITH p0", "SELECT * FROM (WITH p0") + ")"),
    "golden_customers": with_relations(f"SELECT name_key, arg_min(name, o) FILTER (name IS NOT NULL) AS name, arg_min(country, o) FILTER (country IS NOT NULL) AS country, arg_min(phone, o) FILTER (phone IS NOT NULL) AS phone, count(*) AS sources FROM (SELECT {_NAME.format('account_name')} AS name_key, 10 - batch AS o, account_name AS name, billing_country AS country, NULL AS phone FROM crm_accounts UNION ALL SELECT {_NAME.format('customer_name')}, 20 - batch, customer_name, country, phone FROM erp_customers) GROUP BY 1"),
    "product_current": with_relations("SELECT material_id, material_desc, list_price_usd FROM (SELECT * FROM erp_products QUALIFY row_number() OVER (PARTITION BY material_id ORDER BY valid_from DESC) = 1) WHERE NOT ends_with(material_desc, 'v3')"),
    "merge_upsert": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice::DECIMAL(18,2) + CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS price, true AS is_current FROM orders",
    "merge_soft_delete": "SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS is_current FROM orders",
    "merge_scoped_delete": "SELECT DISTINCT l_orderkey, l_orderkey || '-' || l_linenumber AS line FROM lineitem WHERE l_linenumber <= 2 OR l_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P' AND l_linenumber <= 2)",
    "contract_amendments": "WITH c AS (SELECT l_suppkey, l_partkey, max(l_linenumber) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2) SELECT 'CD-' || l_suppkey AS contract_id, max(v) + 1 AS new_version FROM c WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem l WHERE l_returnflag = 'R' AND NOT EXISTS (SELECT 1 FROM c WHERE c.l_suppkey = l.l_suppkey AND c.l_partkey = l.l_partkey)) GROUP BY l_suppkey",
    "stream_event_counts": "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS count FROM events GROUP BY 1, 2",
}
