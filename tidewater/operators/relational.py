"""Relational building blocks: latest row, upserts, retirement, history, allocation and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first by ``order`` (which must be total for a stable result); Spark prunes all others before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, stamp: str | None = None) -> DataFrame:
    """``target`` after a merge of ``source``: rows with known keys get ``update`` columns (default: all), others are inserted.

    A key that ``source`` has twice makes the merge fail when it runs.  ``stamp``
    names a column that takes the current time in rows that change.
    """
    update = [c for c in (update or source.columns) if c not in keys]
    own = Window.partitionBy(*keys)
    twice = F.concat(F.lit("several source rows for one key of a merge: "), F.to_json(F.struct(*keys)))
    once = source.withColumn("_rows", F.count(F.lit(1)).over(own)).withColumn("_in", F.when(F.col("_rows") > 1, F.raise_error(twice).cast("boolean")).otherwise(True)).drop("_rows")
    t, s = target.alias("t"), once.alias("s")
    both = t.withColumn("_was", F.lit(True)).alias("t").join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full_outer")
    hit, new = F.col("s._in").isNotNull(), F.col("t._was").isNull()

    def value(c: str) -> Column:
        if c == stamp:
            return F.when(hit, F.current_timestamp()).otherwise(F.col(f"t.{c}"))
        if c not in source.columns:
            return F.col(f"t.{c}")
        take = new | (hit & F.lit(c in update))
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return both.select(*[value(c).alias(c) for c in target.columns])


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Conditional update: new values where the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def retire_missing(target: DataFrame, source: DataFrame, key: str, flag: str = "is_current") -> DataFrame:
    """Soft delete: rows whose key is no longer in ``source`` lose their flag."""
    here = source.select(F.col(key).alias("_k")).distinct().withColumn("_here", F.lit(True))
    out = target.join(here, target[key] == F.col("_k"), "left")
    return update_where(out, F.col("_here").isNull(), **{flag: F.lit(False)}).select(*target.columns)


def delete_within(target: DataFrame, staged: DataFrame, scope: str, key: str) -> DataFrame:
    """Scoped hard delete: rows of scopes that ``staged`` has, whose key it hasn't."""
    scopes = staged.select(F.col(scope).alias("_scope")).distinct()
    stale = target.join(scopes, target[scope] == F.col("_scope"), "left_semi").join(staged.select(key), key, "left_anti").select(key)
    return target.join(stale, key, "left_anti").select(*target.columns)


def history(df: DataFrame, keys: list[str], sequence: str, start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """Slowly changing dimension of type 2: each version holds until the next sequence value of its key, the last is open.

    Rows may come in any order; of rows with the same key and sequence the greatest
    by their other columns stays.
    """
    one = latest(df, [*keys, sequence], F.col(sequence), *[F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c != sequence])
    return one.withColumn(start, F.col(sequence)).withColumn(end, F.lead(sequence).over(Window.partitionBy(*keys).orderBy(sequence)))


def current(df: DataFrame, keys: list[str], sequence: str, deleted: Column | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """Slowly changing dimension of type 1: the latest version of each key, unless it is a deletion."""
    out = latest(df, keys, F.col(sequence).desc(), *[F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c != sequence])
    return (out.where(~F.coalesce(deleted, F.lit(False))) if deleted is not None else out).drop(*without)


def allocate_fifo(payments: DataFrame, invoices: DataFrame, account: str = "account_id") -> DataFrame:
    """Payments applied to an account's oldest open invoices first.

    ``payments`` (account, payment_id, payment_date, amount) and ``invoices``
    (account, invoice_id, due_date, amount).  Running totals cut an account's
    money at the end of every payment and of every invoice; between two cuts it
    belongs to the payment and to the invoice that end next.  So one pass over the
    sorted cuts does it, however many an account has.  Returns (account,
    payment_id, invoice_id, allocated); amounts of 0 allocate nothing.
    """

    def cuts(df: DataFrame, key: str, when: str) -> DataFrame:
        w = Window.partitionBy(account).orderBy(when, key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(account, key, F.sum("amount").over(w).alias("_to"))

    every = cuts(payments, "payment_id", "payment_date").unionByName(cuts(invoices, "invoice_id", "due_date"), allowMissingColumns=True)
    down = Window.partitionBy(account).orderBy(F.desc("_to"), F.col("payment_id").desc(), F.col("invoice_id").desc())
    so_far = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.coalesce(F.lead("_to").over(down), F.lit(0))
    out = every.select(account, F.last("payment_id", ignorenulls=True).over(so_far).alias("payment_id"), F.last("invoice_id", ignorenulls=True).over(so_far).alias("invoice_id"), (F.col("_to") - below).alias("allocated"))
    return out.where("allocated > 0 AND payment_id IS NOT NULL AND invoice_id IS NOT NULL")


def to_usd(df: DataFrame, rates: DataFrame, amount: str, currency: str, date: str, out: str = "amount_usd") -> DataFrame:
    """An amount in dollars by the day's rate (rate_date, from_currency, units_per_usd); dollars need none, a missing rate gives null."""
    r = rates.select(F.col("rate_date").alias("_d"), F.upper("from_currency").alias("_c"), F.col("units_per_usd").alias("_u"))
    joined = df.join(r, (df[date] == F.col("_d")) & (F.upper(df[currency]) == F.col("_c")), "left")
    return joined.select(*df.columns, F.when(F.upper(currency) == "USD", F.col(amount).cast("double")).otherwise(F.col(amount) / F.col("_u")).alias(out))


def name_similarity(a: Column | str, b: Column | str) -> Column:
    """1 - edit distance / length of the longer name; 1 for two empty ones."""
    a, b = col(a), col(b)
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def token_overlap(a: Column | str, b: Column | str) -> Column:
    """Share of the two names' distinct words that both have."""
    x, y = F.array_distinct(F.split(col(a), " ")), F.array_distinct(F.split(col(b), " "))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def fuzzy_pairs(left: DataFrame, right: DataFrame, least: float = 0.8) -> DataFrame:
    """Candidate matches of (id, name, country): same country and same sound of the name's first word, then similarity.

    Blocking keeps this an equi-join; a pair is certain from 0.95, for a steward
    below, and dropped under ``least``.
    """

    def blocked(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.col("id").alias(f"{p}_id"), F.col("name").alias(f"{p}_name"), F.col("country").alias(f"{p}_country"), F.soundex(F.split_part("name", F.lit(" "), F.lit(1))).alias(f"{p}_sound"))

    a, b = blocked(left, "l"), blocked(right, "r")
    score = F.greatest(name_similarity("l_name", "r_name"), token_overlap("l_name", "r_name"))
    out = a.join(b, (F.col("l_country") == F.col("r_country")) & (F.col("l_sound") == F.col("r_sound"))).withColumn("score", F.round(score, 4))
    return out.where(F.col("score") >= least).select("l_id", "r_id", "score", F.when(F.col("score") >= 0.95, "auto").otherwise("review").alias("decision"))


def golden_record(df: DataFrame, key: str, fields: list[str], priority: Column, *order: Column) -> DataFrame:
    """Survivorship: each field's first value that isn't null, by source priority and then ``order``; one aggregation, no window."""
    rank = F.struct(priority.alias("_p"), *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(key).agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields], F.count(F.lit(1)).alias("sources"))
