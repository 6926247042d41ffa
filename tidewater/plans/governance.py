"""Who sees what: column masks, row filters, tag-driven policies and grants, applied as a dataset is read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import lineage
from .registry import Context, Principal

# Groups that see clear values, or all territories.
STEWARDS, PLATFORM, SUPPORT, FINANCE = "data_stewards", "platform_engineers", "customer_success", "finance"
UNRESTRICTED = frozenset({STEWARDS, PLATFORM, FINANCE, "executives"})

MASKS: dict[str, tuple[Callable[[str], Column], frozenset[str]]] = {
    "email": (c.mask_email, frozenset({STEWARDS, PLATFORM, SUPPORT})),
    "phone": (c.mask_phone, frozenset({STEWARDS, PLATFORM, SUPPORT})),
    "tax_id": (c.mask_tax_id, frozenset({STEWARDS, PLATFORM, FINANCE})),
    "free_text": (c.mask_free_text, frozenset({STEWARDS, PLATFORM})),
}


@dataclass
class Policy:
    """Masks by dataset and column, datasets filtered by territory, and grants by group."""

    is_prod: bool = True
    masks: dict[tuple[str, str], str] = field(default_factory=dict)
    territory_filtered: dict[str, str] = field(default_factory=dict)
    grants: dict[str, frozenset[str]] = field(default_factory=dict)

    @classmethod
    def from_tags(cls, tags: list[tuple[str, str, str]], **rest) -> Policy:
        """Masks from (dataset, column, kind) tags; unknown kinds are left out."""
        return cls(masks={(d, col): kind for d, col, kind in tags if kind in MASKS}, **rest)


#: Masks from the strictest: what the fewest groups see comes first.
STRICTEST = ["free_text", "tax_id", "phone", "email"]
TERRITORY = "territory"


def policy_from_lineage(ctx: Context, names: list[str], tags: list[tuple[str, str, str]], **rest) -> Policy:
    """A policy for datasets from tags (dataset, column, kind) of base columns.

    Tags follow the values of tagged columns through the plans of all datasets on
    the way, the strictest wins; a column tagged ``territory`` makes every dataset
    that carries its values filter rows by it.  Masks are for texts: a count or a
    date made from a tagged column stays.
    """
    traced = Context(ctx.spark, ctx.source, ctx.as_of, traced=True)
    edges = lineage.all_edges(traced, names)
    masks = lineage.spread({(d, c): k for d, c, k in tags}, edges, STRICTEST)
    where = lineage.spread({(d, c): k for d, c, k in tags}, edges, [TERRITORY])
    texts = {n: {f.name for f in traced.read(n).schema.fields if f.dataType.typeName() in ("string", "varchar", "char")} for n in {d for d, _ in masks}}
    filtered_by: dict[str, str] = {}
    for dataset, column in sorted(where):
        filtered_by.setdefault(dataset, column)
    return Policy(masks={(d, c): k for (d, c), k in masks.items() if c in texts[d]}, territory_filtered=filtered_by, **rest)


def may_read(policy: Policy, who: Principal, name: str) -> bool:
    """Whether any of a reader's groups was granted the dataset; without grants all may."""
    return not policy.grants or any(name in policy.grants.get(g, ()) for g in who.groups)


def masked(df: DataFrame, name: str, policy: Policy, who: Principal) -> DataFrame:
    """The columns as the reader sees them; outside production all values are clear."""
    if not policy.is_prod:
        return df
    return df.select(*[df[col] if (kind := policy.masks.get((name, col))) is None or who.groups & MASKS[kind][1] else MASKS[kind][0](col).alias(col) for col in df.columns])


def filtered(df: DataFrame, column: str, policy: Policy, who: Principal, mapping: DataFrame) -> DataFrame:
    """The rows the reader sees: all for unrestricted groups, else those of territories that ``mapping`` (user_name, territory) gives the user."""
    if not policy.is_prod or who.groups & UNRESTRICTED:
        return df
    own = mapping.where(F.col("user_name") == who.user).select(F.col("territory").alias("_territory"))
    return df.join(own, df[column] == F.col("_territory"), "left_semi")


def read_as(ctx: Context, name: str, who: Principal, policy: Policy, mapping: DataFrame | None = None) -> DataFrame:
    """A dataset through grants, row filter and masks, in that order."""
    if not may_read(policy, who, name):
        raise PermissionError(f"{who.user} may not read {name}")
    df = ctx.read(name)
    if name in policy.territory_filtered and mapping is not None:
        df = filtered(df, policy.territory_filtered[name], policy, who, mapping)
    return masked(df, name, policy, who)


def band(amount: Column | str, *steps: float) -> Column:
    """The half-open step an amount is in, as text: under the first, from one to the next, or the last and more; null for null."""
    a = F.col(amount) if isinstance(amount, str) else amount
    out = F.when(a < steps[0], f"under {steps[0]:,.0f}")
    for low, high in zip(steps, steps[1:], strict=False):
        out = out.when(a < high, f"{low:,.0f} to {high:,.0f}")
    return out.when(a.isNotNull(), f"{steps[-1]:,.0f} and more")


#: Steps of money that agents may see.
MONEY_STEPS = (10_000.0, 100_000.0, 1_000_000.0)


def agent_accounts(ctx: Context) -> DataFrame:
    """What agents may read of accounts, whoever asks: addresses masked, money in bands, quarters instead of days; raw amounts, tax ids and free text are left out."""
    contact = ctx.read("erp_customers").groupBy(F.col("customer_id").alias("erp_customer_id")).agg(F.max_by("payment_contact_email", "batch").alias("_email"))
    who = ctx.read("silver_customer").select("customer_sk", "erp_customer_id").join(contact, "erp_customer_id", "left")
    health = ctx.read("gold_account_health").select("customer_sk", "health_score")
    money = ctx.read("gold_customer_360").select("customer_sk", "total_contract_amount", "latest_contract_date")
    out = ctx.read("accounts").join(who, "customer_sk").join(health, "customer_sk", "left").join(money, "customer_sk", "left")
    return out.select("account_id", "account_name", "region", "health_score", c.mask_email("_email").alias("primary_contact_email"), band("total_contract_amount", *MONEY_STEPS).alias("contract_band"), c.fiscal_quarter("latest_contract_date").alias("latest_contract_quarter"))


def register_sql_masks(spark) -> None:
    """The masks as SQL functions of the session, for unprivileged readers; ``reader_groups`` holds the reader's groups."""
    spark.sql("DECLARE OR REPLACE VARIABLE reader_groups ARRAY<STRING> DEFAULT array()")
    can = lambda kind: "exists(array(" + ", ".join(f"'{g}'" for g in sorted(MASKS[kind][1])) + "), g -> array_contains(reader_groups, g))"
    bodies = {
        "email": "CASE WHEN v IS NULL OR instr(v, '@') = 0 THEN '****' ELSE '****@' || split_part(v, '@', 2) END",
        "phone": "CASE WHEN v IS NULL OR length(regexp_replace(v, '[^0-9]', '')) < 4 THEN '***-****' ELSE '***-***-' || right(regexp_replace(v, '[^0-9]', ''), 4) END",
        "tax_id": "CASE WHEN v IS NULL OR length(v) < 4 THEN '****' ELSE '***-**-' || right(v, 4) END",
        "free_text": "CASE WHEN v IS NOT NULL THEN '[REDACTED]' END",
    }
    for kind, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION mask_{kind}(v STRING) RETURNS STRING RETURN CASE WHEN {can(kind)} THEN v ELSE {body} END")
