import bisect
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import packing, queries
from tests.conftest import DATA


def plain_best_fit(lengths, capacity):
    """Bins of best-fit decreasing, piece by piece."""
    left: list[int] = []
    bins = 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(left, n)
        if k == len(left):
            bins += 1
            room = capacity
        else:
            room = left.pop(k)
        bisect.insort(left, room - n)
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan, bins = packing.best_fit(histogram, 24)
    assert bins == plain_best_fit(lengths, 24)
    fill = {}
    for n, lo, hi, first, offset in plan:
        for k in range(hi - lo):
            fill.setdefault(first + k, []).append((offset, n))
    assert sum(len(x) for x in fill.values()) == len(lengths)
    assert {n: sum(hi - lo for m, lo, hi, *_ in plan if m == n) for n in histogram} == histogram
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 24


def test_tightest():
    t = packing.Tightest(16)
    for x in (3, 9, 16):
        t.set(x, True)
    assert [t.at_least(x) for x in (0, 3, 4, 9, 10, 16)] == [3, 3, 9, 9, 16, 16]
    t.set(16, False)
    assert t.at_least(10) is None


@cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def check(rows, texts):
    own = tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    import zlib

    want = {}
    for d, text in texts:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want[d] = [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    got = {}
    places = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {d: sorted(x) for d, x in got.items()} == want
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    return len(places)


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows = queries.QUERIES["op4_best_fit_packing"](spark, DATA).collect()
    assert check(rows, texts) == plain_best_fit([r["length"] for r in rows], 1024)


@pytest.mark.parametrize("texts", [[], [(1, None), (2, ""), (None, "a"), (3, "<|endoftext|> " + "long " * 3000), (4, "\n" * 3000)]])
def test_edges(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS length", "2 AS offset")
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 1024, 2, queries.token_digest)
    check(out.collect(), texts)


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same")], "doc_id long, text string")
    rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN).collect()
    assert len(rows) == 2 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", " ", "\n\n", "the", " word", "'s", "12", "é", "\U0001f600", "<|", "\x00"]), max_size=12))
def test_ids_are_those_of_the_tokenizer(parts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, theirs = packing.encoder(path, public_tokenizers.PATTERN), tokenizer(path)
    assert own.encode("".join(parts), allowed_special="all") == theirs.encode("".join(parts), add_special_tokens=False).ids


def test_ranks_as_special_free_vocabulary():
    table, special = packing.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    same, has = packing.vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    assert table == same and special == {} and has == {"<|endoftext|>": 50256}


def test_many_groups_of_one_length(spark):
    pieces = spark.range(1000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "CAST(1 + id % 3 AS LONG) AS length", "7L AS ids_crc32", "'x' AS _salt", "'y' AS _bin")
    rows = packing.pack(pieces, 10, group=20).collect()
    fill = {}
    for r in rows:
        assert (r["_salt"], r["_bin"]) == ("x", "y")
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(rows) == 1000 and len(fill) == plain_best_fit([r["length"] for r in rows], 10)
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
