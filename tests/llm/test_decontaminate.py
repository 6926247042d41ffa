import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import decontaminate
from tidewater.llm.fmindex import FMIndex, Wavelet, suffix_array

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(s):
    assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=6))
def test_search_and_locate(s, patterns):
    index = FMIndex(np.array(s, np.int64), 6, sample=4)
    rows = np.zeros((len(patterns), 4), np.int64)
    for i, p in enumerate(patterns):
        rows[i, : len(p)] = p
    lo, hi = index.search(rows, np.array([len(p) for p in patterns]))
    for i, p in enumerate(patterns):
        got = sorted(index.locate(np.arange(lo[i], max(lo[i], hi[i]))).tolist())
        assert got == [k for k in range(len(s) - len(p) + 1) if s[k : k + len(p)] == p]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=50), st.integers(0, 9))
def test_wavelet_rank(s, c):
    w = Wavelet(np.array(s, np.int64), 10)
    at = np.arange(len(s) + 1)
    assert w.rank(np.full(len(at), c), at).tolist() == [s[:i].count(c) for i in at]


def brute(docs, bench, window=10):
    out = {}
    grams = {}
    for item, text in bench:
        w = WORD.findall((text or "").translate(LOW))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[i : i + window]), set()).add(item)
    for d, text in docs:
        w = WORD.findall((text or "").translate(LOW))
        hit, items = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    items |= {str(x) for x in grams[tuple(w[i : i + n])] if x is not None}
        out[d] = (len(w), sorted(hit), sorted(items))
    return out


def fixture():
    r = np.random.default_rng(3)
    words = ["Alpha", "beta", "gam-ma", "délta", "9th", "x", "zeta"]
    say = lambda n: " ".join(r.choice(words, n))
    bench = [(i, say(int(r.integers(8, 16)))) for i in range(12)] + [(50, "only four words here"), (51, ""), (52, None), (None, "nameless window of words"), (53, "Single")]
    docs = [(i, say(20) + ". " + (bench[i % 12][1] or "") + "! " + say(5)) for i in range(30)] + [(100, None), (101, ""), (102, "ONLY, four: words HERE and single"), (103, "nameless window of words")]
    return docs, bench


def test_against_brute_force(spark):
    docs, bench = fixture()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    want = brute(docs, bench)
    for options in ({}, {"block_bytes": 200}, {"shard_bytes": 300}):
        rows = decontaminate.find_contamination(d, b, **options).collect()
        assert {r["doc_id"]: (r["n_words"], sorted(r["hit_words"]), sorted(r["items"])) for r in rows} == want


def test_spans_are_removed(spark):
    docs = spark.createDataFrame([(1, "keep this. ONLY four words here, and that", "x"), (2, None, "y"), (3, "clean", "z")], "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(1, "only four words here")], "item_id long, text string")
    rows = decontaminate.remove_spans(decontaminate.find_contamination(docs, bench).select("doc_id", "text", "spans")).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {1: "keep this. , and that", 2: None, 3: "clean"}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r["n_words"], r["hit_words"]) for r in decontaminate.find_contamination(one, bench).collect()] == [(2, [])]
