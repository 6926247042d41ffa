import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.operators import feed, index, search, vectors
from tidewater.operators.index import ChunkIndex
from tidewater.staging import place

WORDS = "alpha beta gamma delta omega kappa sigma zebra licence term".split()


def chunks(rng, ids):
    def text():
        return None if rng.random() < 0.05 else " ".join(rng.choices(WORDS[: rng.choice([4, 10])], k=rng.randint(0, 25)))

    def vector():
        return None if rng.random() < 0.1 else [0.0] * 6 if rng.random() < 0.05 else [rng.gauss(0, 1) for _ in range(6)]

    return {f"c{i}": (f"c{i}", text(), vector(), rng.choice([True, True, False, None]), rng.choice("xy")) for i in ids}


SCHEMA = "chunk_id string, chunk_text string, embedding array<double>, is_current boolean, kind string"


def synced(spark, table):
    return ChunkIndex(spark, place(spark), attributes=("kind",), buckets=8, cells=6), feed.Consumer(spark, place(spark), table)


def same(index, df, exact=True):
    """The index's answers are those of a scan."""
    query = [0.5, -1.0, 0.25, 0.0, 2.0, -0.5]
    for only, own in ((True, df.where("is_current")), (False, df)):
        for text in ("zebra licence", "alpha", "Alpha, beta? nothing", "", "unheard"):
            assert index.keyword(text, 7, only).collect() == search.keyword_top(own, text, "chunk_id", "chunk_text", 7).collect()
        odd = F.col("kind") == "x"
        assert index.keyword("gamma zebra", 7, only, odd).collect() == search.keyword_top(own.where(odd), "gamma zebra", "chunk_id", "chunk_text", 7).collect()
        have = own.where("embedding is not null")
        assert index.similar(query, 7, only, exact=True).collect() == search.vector_top(have, query, "chunk_id", "embedding", 7).collect()
        assert index.hybrid(query, "zebra licence", 5, only, exact=True).collect() == search.hybrid_top(own, query, "zebra licence", "chunk_id", "embedding", "chunk_text", 5).collect()


def test_three_syncs_equal_one_and_a_scan(spark):
    rng = random.Random(8)
    table = feed.VersionedTable(spark, place(spark), ["chunk_id"])
    index, consumer = synced(spark, table)
    with pytest.raises(ValueError, match="never been synced"):
        index.keyword("alpha").collect()
    state = chunks(rng, range(120))
    for step in range(3):
        table.write(spark.createDataFrame(list(state.values()), SCHEMA))
        if step:  # a sync that is handed its changes again changes nothing
            index.sync(table.changes(step, step + 1), step + 1)
        consumer.poll(index.sync)
        assert index.version == step + 1
        if step < 2:
            state = {k: v for k, v in state.items() if rng.random() > 0.2}  # deletions
            state |= chunks(rng, rng.sample(range(160), 40))  # changes and new chunks
    df = spark.createDataFrame(list(state.values()), SCHEMA)
    same(index, df)
    anew, _ = synced(spark, table)
    anew.sync(table.changes(0), table.version)
    told = lambda i: sorted((tuple(r) for r in i.rows().collect()), key=str)
    assert told(index) == told(anew) and {r[0] for r in told(index)} == set(state)
    index.compact()
    assert len(index.ledger.last()["segments"]) == 1 and told(index) == told(anew)
    again = ChunkIndex(spark, index.path, attributes=("kind",), buckets=8, cells=6)  # as after a restart
    assert again.keyword("zebra", 5).collect() == search.keyword_top(df.where("is_current"), "zebra", "chunk_id", "chunk_text", 5).collect()


def test_without_vectors_or_flag(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "two three three"), (3, None)], "id long, body string").withColumn("v", F.lit(None).cast("array<float>"))
    index = ChunkIndex(spark, place(spark), "id", "body", "v", None)
    index.sync(feed.diff(None, df, ["id"]), 1)
    assert index.keyword("three", 3).collect() == search.keyword_top(df, "three", "id", "body", 3).collect()
    assert index.similar([1.0, 2.0]).collect() == [] and [r["id"] for r in index.hybrid([1.0, 2.0], "two").collect()] == [1, 2]
    index.sync(feed.diff(df, df.limit(0), ["id"]), 2)
    assert index.keyword("three").collect() == [] and index.rows().collect() == []


def test_recall_and_bytes_read(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    rows = [(i, f"w{i % 200} common", [float(x) for x in centres[i % 40] + 0.6 * rng.normal(size=24)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, body string, v array<double>")
    index = ChunkIndex(spark, place(spark), "id", "body", "v", None, cells=32)
    index.sync(feed.diff(None, df, ["id"]), 1)
    truth = {}
    for r in vectors.nearest(df.where("id % 200 = 0").select(F.col("id").alias("asked"), "v"), df, "asked", "id", "v", 10).collect():
        truth.setdefault(r["asked"], set()).add(r["id"])
    found = sum(len(truth[i] & {r["id"] for r in index.similar(rows[i][2], 10).collect()}) for i in truth)
    assert len(truth) == 20 and found >= 0.9 * 10 * len(truth)
    near, word = index.reading(vector=rows[0][2]), index.reading(text="w7")
    assert near.bytes < 0.6 * near.of and word.bytes < 0.2 * word.of
    assert index.ledger.last()["probes"] < 32


def test_nearest_for_many_questions(spark, monkeypatch):
    rng = np.random.default_rng(1)
    own = [[float(x) for x in rng.integers(-3, 4, 5)] for _ in range(300)]  # many ties, some zero
    rows = [(i, v) for i, v in enumerate(own)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [1.0]), (None, own[0]), (903, [])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    asked = df.where("id % 9 = 0 OR id >= 900").select(F.col("id").alias("q"), "v")
    unit = vectors.unit(np.array(own))
    want = []
    for q in range(0, 300, 9):
        scores = np.round(unit @ unit[q], 6) + 0.0
        want += [(q, i, float(scores[i]), n) for n, i in enumerate(sorted(range(300), key=lambda i: (-scores[i], i))[:4], 1)]
    for most in (1 << 20, 40):  # one pass, and blocks of 8 questions
        monkeypatch.setattr(vectors, "MOST_NUMBERS", most)
        assert sorted(tuple(r) for r in vectors.nearest(asked, df, "q", "id", "v", 4).collect()) == sorted(want)
    assert vectors.nearest(asked.limit(0), df, "q", "id", "v", 4).collect() == []


def test_queries_of_the_index_match_a_scan(spark):
    from tidewater import queries

    for one, other in (("index_keyword_topk", "keyword_topk"), ("index_hybrid_topk", "hybrid_topk"), ("index_vector_topk", "vector_topk")):
        assert sorted(map(tuple, queries.QUERIES[one](spark, DATA).collect())) == sorted(map(tuple, queries.QUERIES[other](spark, DATA).collect()))


def test_many_questions_hold_little_at_once():
    """The first rows of a task are candidates of every question, but only the k best of them are kept."""
    rows = np.random.default_rng(3).standard_normal((1500, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["k", "v"])
    run = vectors._best(vectors.unit(rows[:1000]), list(range(1000)), 3)
    tracemalloc.start()
    (found,) = run(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = {}
    for q, key, _ in zip(*[c.to_pylist() for c in found.columns], strict=True):
        got.setdefault(q, []).append(key)
    scores = np.round(vectors.unit(rows) @ vectors.unit(rows[:1000]).T, 6) + 0.0
    assert got == {q: sorted(range(len(rows)), key=lambda i, q=q: (-scores[i, q], i))[:3] for q in range(1000)}
    assert peak < 64 << 20


def test_words_of_a_batch_are_those_of_each_text():
    """Postings and lengths come from all texts' bytes at once; no word crosses texts, and letters beyond ASCII count as they do in lower case."""
    rng = random.Random(5)
    own = ["", "Ab1 c", "ab1", "-", "d--D d", "Kelvin İx Ångström", "ß1中2", "end", "", "x" * 300, "", *["".join(rng.choices("aB1 -éKİ\U0001f600", k=rng.randint(0, 30))) for _ in range(400)]]
    want = [[w for w in re.split("[^a-z0-9]+", t.lower()) if w] for t in own]
    flags = [rng.random() < 0.5 for _ in own]
    for start, kind in ((0, pa.string()), (7, pa.large_string())):  # a slice's buffers begin before its texts
        keys = pa.array([f"k{i}" for i in range(len(own))])
        batch = pa.RecordBatch.from_arrays([keys, pa.array(own, kind), pa.array(flags)], names=["key", "_t", "current"]).slice(start)
        (told,) = index._lengths(iter([batch]))
        assert told.to_pydict() == {"key": keys[start:].to_pylist(), "length": [len(w) for w in want[start:]], "current": flags[start:]}
        (found,) = index._postings(iter([batch]))
        got = {(t, k): m for t, ks, ms in zip(*[c.to_pylist() for c in found.columns], strict=True) for k, m in zip(ks, ms, strict=True)}
        assert got == {(w, f"k{i}"): len(ws) << 32 | ws.count(w) << 1 | flags[i] for i, ws in enumerate(want) if i >= start for w in ws}
    nothing = batch.slice(0, 0)
    assert list(index._lengths(iter([nothing]))) == [] and list(index._postings(iter([nothing]))) == []
