"""Column builders shared by the marts: keys, normal forms, calendars and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Words that company names are compared without.
LEGAL_WORDS = ["incorporated", "inc", "corporation", "corp", "company", "co", "limited", "ltd", "llc", "llp", "lp", "plc", "gmbh", "ag", "sa", "nv", "bv", "pty", "group", "holdings", "the"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(c: Column | str) -> Column:
    """A company name as a join key: lower case, letters and digits only, legal words out, single spaces."""
    plain = F.regexp_replace(F.lower(col(c)), r"[^a-z0-9\s]", " ")
    short = F.regexp_replace(plain, rf"\b(?:{'|'.join(LEGAL_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(short, r"\s+", " "))


def normalize_domain(c: Column | str) -> Column:
    """The domain of an address or of a bare host name, without ``www.``."""
    low = F.lower(F.trim(col(c)))
    return F.regexp_replace(F.when(low.contains("@"), F.split_part(low, F.lit("@"), F.lit(2))).otherwise(low), r"^www\.", "")


def surrogate_key(*cols: Column | str) -> Column:
    """A stable key: SHA-256 of the values joined by ``||``, nulls as ''."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]), 256)


def col_or_null(df: DataFrame, name: str, kind: str | DataType, *others: str) -> Column:
    """The first of the named columns that the frame has, cast; else a typed null.  Decided at analysis, not per row."""
    for c in (name, *others):
        if c in df.columns:
            return F.col(c).cast(kind)
    return F.lit(None).cast(kind)


def money(c: Column | str) -> Column:
    return col(c).cast("decimal(18,2)")


def month(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def basename(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def preview(c: Column | str, n: int = 80) -> Column:
    return F.left(col(c), F.lit(n))


def number_or(c: Column | str, default: float = 0.0) -> Column:
    """The value as a double; null or not a number gives the default."""
    return F.coalesce(col(c).try_cast("double"), F.lit(default))


# Fiscal calendar: the year starts in February and bears the number of the year it ends in.


def fiscal_year(d: Column | str) -> Column:
    return F.year(col(d)) + F.when(F.month(col(d)) >= 2, 1).otherwise(0)


def fiscal_period(d: Column | str) -> Column:
    return F.pmod(F.month(col(d)) - 2, F.lit(12)) + 1


def fiscal_quarter(d: Column | str) -> Column:
    return F.concat(F.lit("FY"), fiscal_year(d).cast("string"), F.lit("-Q"), (F.floor((fiscal_period(d) - 1) / 3) + 1).cast("string"))


def is_weekend(d: Column | str) -> Column:
    return F.weekday(col(d)) >= 5


# Masks.  Each takes the clear value and says what an unprivileged reader sees.


def mask_email(c: Column | str) -> Column:
    at = F.instr(col(c), "@")
    return F.when(col(c).isNull() | (at == 0), "****").otherwise(F.concat(F.lit("****@"), F.split_part(col(c), F.lit("@"), F.lit(2))))


def mask_phone(c: Column | str) -> Column:
    digits = F.regexp_replace(col(c), "[^0-9]", "")
    return F.when(col(c).isNull() | (F.length(digits) < 4), "***-****").otherwise(F.concat(F.lit("***-***-"), F.right(digits, F.lit(4))))


def mask_tax_id(c: Column | str) -> Column:
    return F.when(col(c).isNull() | (F.length(col(c)) < 4), "****").otherwise(F.concat(F.lit("***-**-"), F.right(col(c), F.lit(4))))


def mask_free_text(c: Column | str) -> Column:
    return F.when(col(c).isNotNull(), "[REDACTED]")


def partial_email(c: Column | str) -> Column:
    """First letter and domain: ``j***@acme.com``."""
    return F.when(F.instr(col(c), "@") > 0, F.concat(F.left(col(c), F.lit(1)), F.lit("***@"), F.split_part(col(c), F.lit("@"), F.lit(2))))


def last4(c: Column | str) -> Column:
    return F.concat(F.lit("****"), F.right(col(c), F.lit(4)))


def token(c: Column | str, salt: str) -> Column:
    """A salted, one-way token: ``tok_`` and 16 hex digits."""
    return F.when(col(c).isNotNull(), F.concat(F.lit("tok_"), F.left(F.sha2(F.concat(F.lit(salt), col(c)), 256), F.lit(16))))


def redact_ids(c: Column | str) -> Column:
    """Free text with addresses and 3-2-4 digit ids taken out."""
    return F.regexp_replace(F.regexp_replace(col(c), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"), r"\b\d{3}-\d{2}-\d{4}\b", "[ID]")
