import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidewater.operators import chunking, documents, expectations, relational, search
from tidewater.operators.expectations import drop, fail, warn


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    seen = Observation("seen")
    out = expectations.apply(df, [drop("has_x", "x IS NOT NULL"), warn("y_is_a", "y = 'a'")], seen)
    assert out.count() == 2 and seen.get == {"has_x": 1, "y_is_a": 2}  # a null predicate has failed
    with pytest.raises(Exception, match="expectation small failed"):
        expectations.apply(df, [fail("small", "x < 2")]).collect()
    report = expectations.report(df, "d", [drop("has_x", "x IS NOT NULL"), warn("y_is_a", "y = 'a'")])
    assert rows(report, "rule", "passed", "failed", "pass_pct") == [("has_x", 2, 1, 66.67), ("y_is_a", 1, 2, 33.33)]
    assert expectations.report(df.limit(0), "d", [warn("any", "true")]).first()["pass_pct"] is None


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "B", 9), (3, "C", 9), (None, "N", 9)], "k int, v string, w int")
    out = relational.upsert(target, source, ["k"], ["v"])
    assert sorted(map(str, rows(out.fillna(-1)))) == sorted(map(str, [(-1, "N", 1), (1, "a", 1), (2, "B", 1), (3, "C", 9)]))
    again = relational.upsert(out, source, ["k"], ["v"])
    assert again.count() == 4


def test_history_with_late_and_repeated_versions(spark):
    d = dt.date
    df = spark.createDataFrame([("p", d(2024, 3, 1), 3), ("p", d(2024, 1, 1), 1), ("p", d(2024, 2, 1), 2), ("p", d(2024, 2, 1), 2), ("q", d(2024, 1, 1), 9)], "id string, seq date, v int")
    assert rows(relational.history(df, ["id"], "seq"), "id", "v", "__START_AT", "__END_AT")[:3] == [("p", 1, d(2024, 1, 1), d(2024, 2, 1)), ("p", 2, d(2024, 2, 1), d(2024, 3, 1)), ("p", 3, d(2024, 3, 1), None)]
    assert rows(relational.current(df, ["id"], "seq", deleted=F.col("v") == 9)) == [("p", d(2024, 3, 1), 3)]


def test_fifo(spark):
    p = spark.createDataFrame([("a", "p1", "2024-01-01", 30), ("a", "p2", "2024-01-02", 50)], "account_id string, payment_id string, payment_date string, amount int")
    i = spark.createDataFrame([("a", "i1", "2024-01-01", 20), ("a", "i2", "2024-01-05", 40), ("a", "i3", "2024-01-09", 40), ("b", "i4", "2024-01-01", 5)], "account_id string, invoice_id string, due_date string, amount int")
    assert rows(relational.allocate_fifo(p, i)) == [("a", "p1", "i1", 20), ("a", "p1", "i2", 10), ("a", "p2", "i2", 30), ("a", "p2", "i3", 20)]


def test_fx_and_fuzzy(spark):
    rates = spark.createDataFrame([("2024-01-01", "EUR", 0.5)], "rate_date string, from_currency string, units_per_usd double")
    df = spark.createDataFrame([("2024-01-01", "eur", 10.0), ("2024-01-01", "USD", 3.0), ("2024-01-02", "EUR", 1.0)], "day string, currency string, amount double")
    assert [r["amount_usd"] for r in relational.to_usd(df, rates, "amount", "currency", "day").collect()] == [20.0, 3.0, None]
    a = spark.createDataFrame([(1, "acme tools", "US"), (2, "zenith", "US")], "id int, name string, country string")
    b = spark.createDataFrame([(7, "acme tool", "US"), (8, "acme tools", "DE"), (9, "zenyth", "US")], "id int, name string, country string")
    assert rows(relational.fuzzy_pairs(a, b), "l_id", "r_id", "decision") == [(1, 7, "review"), (2, 9, "review")]


def test_golden_record(spark):
    df = spark.createDataFrame([("k", 2, "erp", None), ("k", 1, None, "p1"), ("k", 1, "crm", None)], "k string, p int, name string, phone string")
    assert rows(relational.golden_record(df, "k", ["name", "phone"], F.col("p"))) == [("k", "crm", "p1", 3)]


def test_retire_and_delete(spark):
    t = spark.createDataFrame([("f", 1, True), ("g", 2, True)], "f string, k int, is_current boolean")
    assert rows(relational.retire_missing(t, spark.createDataFrame([("f",)], "f string"), "f"), "f", "is_current") == [("f", True), ("g", False)]
    staged = spark.createDataFrame([("f", 9)], "f string, k int")
    assert rows(relational.delete_within(t, staged, "f", "k"), "k") == [(2,)]


def test_chunks():
    assert chunking.chunks("") == chunking.chunks(" \n") == chunking.chunks(None) == []
    clause = "\nARTICLE {}\n" + "word " * 50
    text = "".join(clause.format(i) for i in range(8))
    plain = chunking.chunks(text, 100, 0)
    assert len(plain) > 1 and all(p.startswith("ARTICLE") for p in plain) and max(map(len, plain)) <= 400
    lapped = chunking.chunks(text, 100, 20)
    assert len(lapped) == len(plain) and lapped[0] == plain[0] and sum(map(len, lapped)) > sum(map(len, plain)) and all(b.endswith(a) for a, b in zip(plain, lapped, strict=True))
    assert "".join(chunking.chunks("x" * 1000, 10, 0)) == "x" * 1000


def test_chunk_frame(spark):
    import hashlib

    df = spark.createDataFrame([("/v/f.pdf", "a b " * 3000), ("/v/g.pdf", None)], "source_file string, text string")
    got = chunking.chunk_documents(df, "source_file").orderBy("chunk_seq").collect()
    assert [r["chunk_seq"] for r in got] == list(range(len(got))) and got[3 if len(got) > 3 else -1]["chunk_id"] == hashlib.sha256(f"/v/f.pdf:{min(3, len(got) - 1)}".encode()).hexdigest()


PARSED = [
    ('{"document":{"elements":[{"content":"One","bbox":[{"page_id":0}]},{"content":"Two","bbox":[{"page_id":1}]}]}}', [("One", 1), ("Two", 2)]),
    ('{"pages":[{"text":"P1"},{"text":"P2"}]}', [("P1", 1), ("P2", 2)]),
    ('{"text":"whole"}', [("whole", 1)]),
    ('{"other":1}', None), (None, None), ("not json", None),
]


def test_parse_shapes(spark):
    df = spark.createDataFrame([(f"f{i}", r) for i, (r, _) in enumerate(PARSED)], "source_file string, result string")
    good, bad = documents.parsed(df)
    assert {r["source_file"]: [tuple(e) for e in r["elements"]] for r in good.collect()} == {f"f{i}": w for i, (_, w) in enumerate(PARSED) if w}
    assert rows(bad, "source_file") == [("f3",), ("f4",), ("f5",)]


def test_pages(spark):
    df = spark.createDataFrame([(PARSED[0][0],)], "r string").withColumn("e", documents.elements("r")).withColumn("p", documents.page_map(F.col("e"))).withColumn("t", documents.joined_text(F.col("e")))
    got = df.select("t", documents.page_at(F.col("p"), F.lit(3)), documents.page_at(F.col("p"), F.lit(5)), documents.page_of_chunk(F.col("t"), F.lit("Two"), F.col("p")), documents.page_of_chunk(F.col("t"), F.lit("zzz"), F.col("p"))).first()
    assert tuple(got) == ("One\n\nTwo", 1, 2, 2, 1)


def test_amendments_and_merge_are_idempotent(spark):
    schema = "chunk_id string, contract_id string, source_file string, version int, is_current boolean, text string"
    gold = spark.createDataFrame([("a1", "CD-1", "a", 1, True, "old")], schema)
    silver = spark.createDataFrame([("a1", "CD-1", "a", 1, True, "new text"), ("b1", "CD-1", "b", 1, True, "amended"), ("c1", None, "c", 1, True, "no id")], schema)
    assert rows(documents.amendments(gold, silver)) == [("CD-1", 2)]
    assert documents.amendments(gold.limit(0), silver).collect() == []
    want = [("a1", 1, False, "new text"), ("b1", 2, True, "amended"), ("c1", 1, True, "no id")]
    once = documents.merge_chunks(gold, silver)
    assert rows(once, "chunk_id", "version", "is_current", "text") == want
    assert rows(documents.merge_chunks(once, silver), "chunk_id", "version", "is_current", "text") == want


def test_files_parsed_again(spark):
    schema = "chunk_id string, contract_id string, source_file string, version int, is_current boolean, text string"
    gold = spark.createDataFrame([("a1", "CD-1", "a", 2, True, "old"), ("a2", "CD-1", "a", 2, True, "gone"), ("z1", None, "z", 1, False, "retired"), ("k1", None, "k", 1, True, "not in this run")], schema)
    silver = spark.createDataFrame([("a1", "CD-1", "a", 1, True, "new"), ("a3", "CD-1", "a", 1, True, "more"), ("z2", None, "z", 1, True, "late")], schema)
    want = [("a1", 2, True, "new"), ("a3", 2, True, "more"), ("k1", 1, True, "not in this run"), ("z2", 1, False, "late")]
    for _ in range(2):
        gold = documents.merge_chunks(gold, silver)
        assert rows(gold, "chunk_id", "version", "is_current", "text") == want


def test_merge_of_a_key_that_comes_twice_fails(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    for key in (1, 2):
        with pytest.raises(Exception, match="several source rows"):
            relational.upsert(target, spark.createDataFrame([(key, "x"), (key, "y")], "k int, v string"), ["k"]).collect()


def test_history_of_ties_is_stable(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b"), (1, 7, "d")], "k int, s int, v string")
    for n in (1, 3):
        assert rows(relational.history(df.repartition(n), ["k"], "s"), "k", "v", "__START_AT", "__END_AT") == [(1, "c", 5, 7), (1, "d", 7, None)]


def test_chunk_rules():
    # a heading stays with its text; parts that fit are put together without the blank line between them
    assert chunking.chunks("One two.\n\nThree four.\n\nFive", 3, 0) == ["One two.", "Three four.", "Five"]
    assert chunking.chunks("aa\n\nbb\n\ncccccccccc", 2, 0) == ["aabb", "cccccccc", "cc"]
    # a part that is too long is cut at weaker boundaries, and its end isn't joined to what follows
    assert chunking.chunks("x\n\none two three four\n\ny", 2, 0) == ["x", "onetwo", "three", "four", "y"]
    assert chunking.chunks("\nARTICLE 1\nfirst words here\nARTICLE 2\nsecond", 7, 0) == ["ARTICLE 1\nfirst words here", "ARTICLE 2\nsecond"]
    assert chunking.chunks("First sentence here. Second one.", 5, 2) == ["First sentence here.", "here. Second one."]
    assert chunking.chunks("z" * 9, 1, 0) == ["zzzz", "zzzz", "z"]


def test_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "red apple pie"), (2, [0.6, 0.8], "green apple"), (3, [0.0, 1.0], "blue sky"), (4, [0.0, 0.0], "")], "id int, v array<float>, text string")
    assert [r["id"] for r in search.vector_top(df, [0.0, 2.0], "id", "v", 2).orderBy("rank").collect()] == [3, 2]
    assert [r["id"] for r in search.keyword_top(df, "Apple, pie", "id", "text", 3).orderBy("rank").collect()] == [1, 2]
    assert [r["id"] for r in search.hybrid_top(df, [0.0, 1.0], "apple", "id", "v", "text", 3).orderBy("rank").collect()][0] == 2
    assert search.vector_top(df, [1.0, 0.0], "id", "v", 1, F.col("id") > 1).first()["id"] == 2
    hits = spark.createDataFrame([(2, "/x/b.pdf", "1.0", "B"), (1, "/x/a.pdf", "n", "A")], "rank int, f string, p string, t string")
    assert search.context(hits, "f", "p", "t").first()["context"] == "[a.pdf p?]\nA\n\n[b.pdf p1]\nB"


def test_hybrid_search_finds_rows_without_a_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "red pie"), (2, None, "green apple"), (3, [0.0, 1.0], "blue sky")], "id int, v array<float>, text string")
    got = [(r["id"], r["score"]) for r in search.hybrid_top(df, [0.0, 1.0], "apple", "id", "v", "text", 3).orderBy("rank").collect()]
    assert got == [(2, 0.016393), (3, 0.016393), (1, 0.016129)]  # the second by its words only, without a rank among vectors
    from tidewater import more_queries

    class Tables:
        def read(self, name):
            return {"documents": df.select(F.col("id").alias("doc_id"), "text"), "embeddings": df.where("v is not null").select(F.col("id").alias("vec_id"), F.col("v").alias("embedding"), F.lit(0).alias("label"))}[name]

    assert rows(more_queries._chunks(Tables()), "doc_id") == [(1,), (2,), (3,)]


def test_hybrid_search_fuses_whole_rankings(spark):
    import math

    def best(n, other, k):
        fused = sorted(((-round(1 / (60 + i) + 1 / (60 + other[i]), 6), i) for i in range(1, n + 1)))
        return [(i, -s) for s, i in fused[:k]]

    n = 500
    # i is the rank by vector, order[i] that by words: rank 1 of one list is last of the other
    order = {i: n + 1 - i for i in range(1, n + 1)}
    for a, b in ((51, 51), (10, 400), (70, 60), (300, 61)):  # beyond 50 in one list or both
        c = next(i for i, r in order.items() if r == b)
        order[a], order[c] = b, order[a]
    df = spark.createDataFrame([(i, [math.cos(i / 400), math.sin(i / 400)], "apple " + "x " * order[i]) for i in order] + [(1000 + i, None, "pear") for i in range(n)], "id int, v array<double>, text string").repartition(7)
    for k in (1, 5, 20):
        assert [(r["id"], r["score"]) for r in search.hybrid_top(df, [1.0, 0.0], "apple", "id", "v", "text", k).orderBy("rank").collect()] == best(n, order, k)
    assert 51 in [i for i, _ in best(n, order, 5)]
    for lists, k in ((2, 1), (2, 5), (3, 10), (2, 900)):
        assert lists / (61 + search.enough(lists, k)) < 1 / (60 + k) - 1e-6
