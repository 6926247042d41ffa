import hashlib
import re

from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.llm import fim, queries


def plain(key, text, seed="1"):
    """n, form, prefix, middle, suffix, output by Python's own means."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


TEXTS = [
    None, "", " ", "a", "word", "Two words.", "é", "naïve café 12 — ok", "a\nb\r\n\tc d\x00e", "\x01", "\x02", "\x01\x02\x03\x04", "\x02\x03\x02\x04\x01\x01", "x\x02\x04y\x02\x03z", "𝒜𝒷 🙂🙂 a🙂b",
    "<P>", "an <M> inside", "<S", "S>", "< P>", "<P", "<<P", "a<S<M<", "P><S", "$1 \\1 \\$0 $", "{}[]().*+?^$|\\", "long " * 20_000, "x" * 300_000, "7" * 50_000, "\x01" * 9_000 + "end", "日本語の文章。" * 50,
]


def test_against_plain(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "no key at all"), (5, "again"), (5, "again")]
    out = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((tuple(r[c] for c in ("doc_id", "text", "n_tokens", "form", "prefix", "middle", "suffix", "output")) for r in out.collect()), key=str)
    assert got == sorted(((i, t, *plain(i, t)) for i, t in rows), key=str)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)]
    out = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), seed="7", apart=100, spm=50)
    back = fim.restored(F.col("output"), F.col("form"))
    assert out.where(back != F.coalesce("text", F.lit(""))).count() == 0 and out.where(back.isNull()).count() == 0
    assert out.where("form <> 'plain' AND concat(prefix, middle, suffix) <> text").count() == 0
    for r in out.limit(50).collect():
        assert (r["n_tokens"], r["output"]) == (plain(r["doc_id"], r["text"])[0], r["output"])


def test_columns(spark):
    df = spark.createDataFrame([(1, "some text", "p", "w", "m", "c", 4)], "ID long, body string, prefix string, whole string, marked string, Cuts string, `odd.name` int")
    out = fim.fill_in_middle(df, "id", "Body")
    assert out.columns == ["ID", "body", "whole", "marked", "Cuts", "odd.name", "n_tokens", "form", "prefix", "middle", "suffix", "output"]
    assert tuple(out.first())[:6] == (1, "some text", "w", "m", "c", 4) and tuple(out.first())[6:] == plain(1, "some text")
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_and_one_pass(spark):
    plan = queries.op12_fill_in_middle(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan) and plan.count("regexp_replace(") == 1


def test_query_against_plain(spark):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = set()
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        n, form, p, m, _, output = plain(r["doc_id"], r["text"])
        want.add((r["doc_id"], n, form, None if p is None else len(p), None if m is None else len(m), sha(output), sha(r["text"] or "")))
    out = queries.QUERIES["op12_fill_in_middle"](spark, DATA)
    assert {tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")) for r in out.collect()} == want
