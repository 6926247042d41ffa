"""A catalog of declared quality rules, compiled to one pass over each dataset and one anti-join for each reference, and a scorecard."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Currencies that are accepted.
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "AUD", "CAD", "INR")


@dataclass(frozen=True)
class Rule:
    """A rule of a dataset; but for ``not_null`` and ``unique``, a null breaks none."""

    dataset: str
    name: str
    kind: str
    columns: tuple[str, ...]
    args: tuple[Any, ...] = ()


def not_null(dataset: str, *columns: str) -> list[Rule]:
    return [Rule(dataset, f"{c}_not_null", "not_null", (c,)) for c in columns]


def one_of(dataset: str, column: str, *values: str) -> Rule:
    return Rule(dataset, f"{column}_one_of", "one_of", (column,), values)


def currency(dataset: str, column: str = "currency") -> Rule:
    return Rule(dataset, f"{column}_accepted", "one_of", (column,), CURRENCIES)


def within(dataset: str, column: str, low: float | None, high: float | None) -> Rule:
    return Rule(dataset, f"{column}_within", "within", (column,), (low, high))


def dated(dataset: str, column: str, first: dt.date, ahead: int = 365) -> Rule:
    """Not before a day, nor more than so many days ahead."""
    return Rule(dataset, f"{column}_dated", "dated", (column,), (first, ahead))


def ordered(dataset: str, earlier: str, later: str) -> Rule:
    return Rule(dataset, f"{earlier}_before_{later}", "ordered", (earlier, later))


def agrees(dataset: str, left: str, right: str, tolerance: float) -> Rule:
    return Rule(dataset, f"{left}_agrees_with_{right}", "agrees", (left, right), (tolerance,))


def references(dataset: str, column: str, parent: str, key: str) -> Rule:
    return Rule(dataset, f"{column}_in_{parent}", "references", (column,), (parent, key))


def unique(dataset: str, *columns: str) -> Rule:
    return Rule(dataset, "_".join(columns) + "_unique", "unique", columns)


def _broken(rule: Rule, today: dt.date) -> Column:
    """Whether a row breaks a rule that can be told from the row."""
    a = F.col(rule.columns[0])
    match rule.kind:
        case "not_null":
            return a.isNull()
        case "one_of":
            hit = ~a.isin(*rule.args)
        case "within":
            low, high = rule.args
            hit = F.lit(False) if low is None else a < low
            hit = hit if high is None else hit | (a > high)
        case "dated":
            first, ahead = rule.args
            hit = (a.cast("date") < F.lit(first)) | (a.cast("date") > F.lit(today + dt.timedelta(days=ahead)))
        case "ordered":
            hit = a > F.col(rule.columns[1])
        case "agrees":
            hit = F.abs(a - F.col(rule.columns[1])) > rule.args[0]
        case _:
            raise ValueError(f"no rule is of the kind {rule.kind}")
    return F.coalesce(hit, F.lit(False))


def check(rules: list[Rule], read: Callable[[str], DataFrame], today: dt.date) -> DataFrame:
    """(dataset, rule, kind, rows, failed) of every rule; ``read`` gives datasets by name.

    A dataset's row rules, however many, are one aggregation over it; if it has a
    unique key or a reference, they are counted with the first of these, by its
    key.  A unique key is one aggregation by key, which counts rows beyond the
    first.  A reference is one join of the values in use with the parent's keys.
    """
    names = list(dict.fromkeys((r.dataset, r.name) for r in rules))
    if len(names) != len(rules):
        raise ValueError("a dataset has two rules of one name")
    parts = []

    def told(rule: Rule, failed: Column) -> Column:
        return F.struct(F.lit(rule.dataset).alias("dataset"), F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), F.coalesce("n", F.lit(0)).cast("long").alias("rows"), F.coalesce(failed, F.lit(0)).cast("long").alias("failed"))

    for dataset in dict.fromkeys(r.dataset for r in rules):
        df, own = read(dataset), [r for r in rules if r.dataset == dataset]
        by_row, by_key = ([r for r in own if (r.kind in ("references", "unique")) == keyed] for keyed in (False, True))
        for rule in by_key or [None]:
            counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(_broken(r, today)).alias(f"f{i}") for i, r in enumerate(by_row)]]
            failed = [(r, F.col(f"f{i}")) for i, r in enumerate(by_row)]
            by_row = []
            if rule is None:
                whole = df.agg(*counts)
            else:
                sums = [F.sum(name).alias(name) for name in ("n", *[f"f{i}" for i in range(len(failed))])]
                if rule.kind == "unique":
                    whole = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(rule.columns)]).agg(*counts).agg(*sums, F.sum(F.col("n") - 1).alias("f"))
                else:
                    parent, key = rule.args
                    used = df.groupBy(F.col(rule.columns[0]).alias("_v")).agg(*counts)
                    known = read(parent).select(F.col(key).alias("_k")).where("_k IS NOT NULL").distinct().withColumn("_here", F.lit(True))
                    joined = used.join(known, F.col("_v") == F.col("_k"), "left")
                    whole = joined.agg(*sums, F.sum(F.when(F.col("_v").isNotNull() & F.col("_here").isNull(), F.col("n"))).alias("f"))
                failed.append((rule, F.col("f")))
            parts.append(whole.select(F.explode(F.array(*[told(r, f) for r, f in failed])).alias("t")).select("t.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def scorecard(checked: DataFrame) -> DataFrame:
    """(dataset, rules, broken_rules, rows, failed, score): the share of checks that passed, in per cent, 100 for an empty dataset."""
    checks = F.sum("rows")
    score = F.coalesce(F.round(100.0 * (checks - F.sum("failed")) / F.nullif(checks, F.lit(0)), 2), F.lit(100.0))
    return checked.groupBy("dataset").agg(F.count(F.lit(1)).alias("rules"), F.count_if(F.col("failed") > 0).alias("broken_rules"), F.max("rows").alias("rows"), F.sum("failed").alias("failed"), score.alias("score"))


#: The first day that dates of the given tables may have.
FIRST_DAY = dt.date(1992, 1, 1)
BILLION = 1_000_000_000.0

#: Rules of all conformed datasets and of the marts that are read most.
CATALOG: list[Rule] = [
    *not_null("silver_customer", "customer_sk", "company_name", "country"),
    unique("silver_customer", "customer_sk"),
    one_of("silver_customer", "match_method", "crosswalk", "name_domain", "crm_only", "erp_only"),
    *not_null("silver_contract", "contract_id", "contract_amount", "end_date"),
    unique("silver_contract", "contract_id"),
    within("silver_contract", "contract_amount", 0.0, BILLION),
    ordered("silver_contract", "start_date", "end_date"),
    references("silver_contract", "customer_sk", "silver_customer", "customer_sk"),
    *not_null("silver_sales_order", "sales_order_id", "customer_sk"),
    currency("silver_sales_order"),
    dated("silver_sales_order", "order_date", FIRST_DAY),
    *not_null("silver_payment", "payment_id", "invoice_id", "payment_amount", "payment_date"),
    within("silver_payment", "payment_amount", 0.0, 50_000.0),
    references("silver_payment", "invoice_id", "silver_invoice", "invoice_id"),
    *not_null("silver_invoice", "invoice_id", "customer_sk", "gross_amount", "currency", "invoice_date"),
    currency("silver_invoice"),
    within("silver_invoice", "gross_amount", 0.0, BILLION),
    ordered("silver_invoice", "invoice_date", "due_date"),
    agrees("silver_invoice", "gross_amount", "amount_paid", 100_000.0),
    dated("silver_invoice", "due_date", FIRST_DAY, -1500),
    *not_null("silver_activity", "activity_id", "customer_sk", "activity_date"),
    one_of("silver_activity", "activity_type", "click", "view", "purchase"),
    *not_null("silver_case", "case_id", "status"),
    one_of("silver_case", "priority", "Critical", "High"),
    ordered("silver_case", "created_date", "closed_date"),
    unique("silver_product", "product_id", "_seq"),
    within("silver_product", "unit_price", 1000.0, None),
    *not_null("silver_territory", "territory_id", "region"),
    one_of("silver_territory", "region", "AFRICA", "AMERICA", "ASIA", "EUROPE"),
    unique("gold_customer_360", "customer_sk"),
    references("gold_customer_360", "customer_sk", "gold_collections_risk", "customer_sk"),
    agrees("gold_bookings_vs_billings", "total_booked", "total_billed", 1.0),
    one_of("gold_collections_risk", "risk_tier", "high", "medium", "none"),
    references("gold_collections_risk", "customer_sk", "gold_customer_360", "customer_sk"),
    within("gold_account_health", "health_score", 0, 8),
    one_of("gold_renewal_risk", "renewal_risk_tier", "low", "medium"),
]
