import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.functions import columns as c
from tidewater.functions import text as t


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "want"), [("Apex Industries, Inc.", "apex industries"), ("The ACME  Holdings Group Ltd", "acme"), ("café", "caf"), ("Cohen & Co", "cohen"), (None, None), ("", "")])
def test_normalize_name(spark, name, want):
    assert one(spark, c.normalize_name("v"), v=name) == want


@pytest.mark.parametrize(("value", "want"), [(" A.B@Apex.com ", "apex.com"), ("WWW.apex.com", "apex.com"), ("apex.com", "apex.com"), (None, None)])
def test_normalize_domain(spark, value, want):
    assert one(spark, c.normalize_domain("v"), v=value) == want


@pytest.mark.parametrize(
    ("mask", "value", "want"),
    [
        (c.mask_email, "jane@acme.com", "****@acme.com"), (c.mask_email, "none", "****"), (c.mask_email, None, "****"),
        (c.mask_phone, "+1 (415) 555-0199", "***-***-0199"), (c.mask_phone, "12", "***-****"), (c.mask_phone, None, "***-****"),
        (c.mask_tax_id, "123456789", "***-**-6789"), (c.mask_tax_id, "12", "****"), (c.mask_free_text, "x", "[REDACTED]"), (c.mask_free_text, None, None),
        (c.partial_email, "jane@acme.com", "j***@acme.com"), (c.last4, "99991234", "****1234"), (c.redact_ids, "mail a@b.co id 123-45-6789", "mail [EMAIL] id [ID]"),
    ],
)
def test_masks(spark, mask, value, want):
    assert one(spark, mask("v"), v=value) == want


def test_keys_and_tokens(spark):
    import hashlib

    assert one(spark, c.surrogate_key("a", "b"), a="x", b=None) == hashlib.sha256(b"x||").hexdigest()
    assert one(spark, c.token("a", "salt"), a="x") == "tok_" + hashlib.sha256(b"saltx").hexdigest()[:16]
    assert one(spark, c.number_or("a", 7.0), a="n/a") == 7.0 and one(spark, c.number_or("a"), a="2.5") == 2.5


def test_fiscal(spark):
    days = ["2024-01-31", "2024-02-01", "2025-01-01", "2024-06-30"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d")).select(c.fiscal_year("d"), c.fiscal_quarter("d"), c.fiscal_period("d"), c.is_weekend("d")).collect()
    assert [tuple(r) for r in rows] == [(2024, "FY2024-Q4", 12, False), (2025, "FY2025-Q1", 1, False), (2025, "FY2025-Q4", 12, False), (2025, "FY2025-Q2", 5, True)]


def test_column_present_or_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert df.select(c.col_or_null(df, "b", "date").alias("b"), c.col_or_null(df, "x", "string", "a").alias("a")).first() == (None, "1")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Contact jane.doe@acme.com or call +1 (415) 555-0199 to sign.", "Contact [EMAIL] or call [PHONE] to sign."),
        ("CD-2025-0142 on 2025-01-15 for 1,234,567.89", "CD-2025-0142 on 2025-01-15 for 1,234,567.89"),
        ("415-555-0199", "[PHONE]"), (None, ""), ("", ""),
    ],
)
def test_mask_pii(spark, text, want):
    assert one(spark, t.mask_pii("v"), v=text) == want
    assert one(spark, F.size(t.pii_found(t.mask_pii("v"))), v=text) == 0


@pytest.mark.parametrize(("text", "want"), [("Call 415-555-0199,415-555-0198 now", "Call [PHONE],[PHONE] now"), ("4270558249789290 +1 (427) 555-1339", "4270558249789290 [PHONE]")])
def test_mask_pii_of_numbers_that_follow_at_once(spark, text, want):
    assert one(spark, t.mask_pii("v"), v=text) == want


def test_pii_found(spark):
    assert one(spark, t.pii_found("v"), v="415-555-0199, CD-2025-0142, 2025-01-15, a@b.co") == ["a@b.co", "415-555-0199"]


def plain_mask(text):
    """The same rule with Python's regular expressions."""
    text = re.sub(t.EMAIL.removeprefix("(?U)"), "[EMAIL]", text or "")
    return re.sub(t.PHONE.removeprefix("(?U)"), lambda m: "[PHONE]" if 10 <= len(re.sub(r"\D", "", m[0])) <= 15 else m[0], text)


def test_mask_agrees_with_a_plain_version_on_documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("text", t.mask_pii("text").alias("m")).collect()
    assert all(r["m"] == plain_mask(r["text"]) for r in rows) and any(r["m"] != r["text"] for r in rows)


@pytest.mark.parametrize(
    ("file", "text", "want"),
    [
        ("/x/01_Master_Sales_Agreement_CD-2025-0142.pdf", "pricing", ("CD-2025-0142", "Master Sales Agreement")),
        ("/x/scan.pdf", "ref EX-2025-0076. A warranty and the pricing agreement", ("EX-2025-0076", "Pricing Agreement")),
        ("/x/nda_1.pdf", "", (None, "NDA")),
        ("/x/other.pdf", "nothing", (None, None)),
    ],
)
def test_contract_id_and_type(spark, file, text, want):
    assert (one(spark, t.contract_id("f", "t"), f=file, t=text), one(spark, t.contract_type("f", "t"), f=file, t=text)) == want


def test_parties_and_dates(spark):
    text = "made by and between Acme and Caldwell\nEngineering Partners. Effective date: April 1, 2025\nExpires: 2026-03-31 signed 2024-01-01"
    assert one(spark, t.counterparty("v"), v=text) == "Caldwell Engineering Partners"
    assert one(spark, t.counterparty("v"), v="by and between A and B\n\nnext") == "B"
    assert one(spark, t.counterparty("v"), v="no parties") is None
    assert one(spark, t.effective_date("v"), v=text) == "April 1, 2025"
    assert one(spark, t.expiry_date("v"), v=text) == "2026-03-31"


def test_citations(spark):
    answer = "As said [a/file.pdf p2] and (file.pdf p1.0), see (FILE2.XLSX p. 3) (none)"
    got = one(spark, t.citations("v"), v=answer)
    assert [(x["doc"], x["page"]) for x in got] == [("file.pdf", 2), ("file.pdf", 1), ("FILE2.XLSX", 3)]
    assert one(spark, t.citation_accuracy(F.col("a"), F.col("b")), a=["x/f.pdf", "g.pdf"], b=["y/f.pdf"]) == 0.5
    assert one(spark, t.citation_accuracy(F.col("a"), F.col("b")), a=[], b=["f.pdf"]) == 1.0


def test_refusal_and_injection(spark):
    assert one(spark, t.is_refusal("v"), v="I don't know about that") and not one(spark, t.is_refusal("v"), v="The termination notice period is 30 days")
    assert one(spark, t.injection_obeyed("v", "k"), v="ok banana47!", k="BANANA47") and not one(spark, t.injection_obeyed("v", "k"), v="no", k="")


@pytest.mark.parametrize(
    ("got", "want", "scores"),
    [(["a", "b"], ["a", "b"], (1.0, 1.0, 1.0, 1.0)), (["x", "a"], ["a", "b"], (0.5, 0.5, 0.5, 1.0)), (["x"], ["a"], (0.0, 0.0, 0.0, 0.0)), (["a"], [], (None,) * 4), ([], ["a"], (0.0, 0.0, 0.0, 0.0))],
)
def test_retrieval_scores(spark, got, want, scores):
    assert tuple(one(spark, t.retrieval_scores(F.col("a"), F.col("b"), 5), a=got, b=want)) == scores


def test_ndcg(spark):
    assert one(spark, t.ndcg(F.col("a"), F.col("b"), 3), a=["a", "x", "b"], b=["a", "b"]) == pytest.approx(1.5 / (1 + 1 / 1.584962500721156))
