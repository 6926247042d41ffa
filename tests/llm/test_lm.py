import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.llm import lm, queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), "\n"]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=50))
def test_packed_keys(keys):
    own = np.array(sorted(keys), np.uint64)
    assert lm.unpack_sorted(lm.pack_sorted(own)).tolist() == own.tolist()


def test_query(spark):
    texts = {r["doc_id"]: tokens(r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_lm_scoring"](spark, DATA).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    for d, t in texts.items():
        r = rows[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(t), sum(w in c for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel_tol=1e-9)
    own = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)


def exact(texts, held, weights, orders):
    """The mixture worked out on counters."""
    grams = [Counter() for _ in range(orders + 1)]
    for d, t in texts.items():
        if not held[d]:
            s = ["START", *t]
            for k in range(1, orders + 1):
                grams[k].update(tuple(s[i : i + k]) for i in range(1 if k == 1 else 0, len(s) - k + 1))
    total, kinds, n = sum(grams[1].values()), len(grams[1]), sum(not h for h in held.values())
    out = {}
    for d, t in texts.items():
        s, score = ["START", *t], 0.0
        for i in range(1, len(s)):
            f, bucket = [1 / (kinds + 1), grams[1][(s[i],)] / max(total, 1)], 0
            for k in range(2, orders + 1):
                before = tuple(s[i - k + 1 : i]) if i - k + 1 >= 0 else None
                c = 0 if before is None else n if before == ("START",) else grams[k - 1][before]
                f.append(grams[k][(*before, s[i])] / c if c else 0.0)
                if c:
                    bucket = 64 * (k - 1) + math.frexp(c)[1]
            score += math.log10(float(np.dot(weights[bucket], f)))
        out[d] = score
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_mixture_is_exact_and_blocks_dont_matter(spark, order, monkeypatch):
    r = np.random.default_rng(order)
    rows = [(i, " ".join(r.choice(["a", "B", "c", "d", "é"], int(r.integers(0, 30)), p=[0.5, 0.2, 0.1, 0.1, 0.1]))) for i in range(40)] + [(90, None), (91, ""), (92, "unseen word")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    tables = []
    real = lm.weight_table
    monkeypatch.setattr(lm, "weight_table", lambda w, k: tables.append(real(w, k)) or tables[-1])
    held = {d: d % 4 == 0 for d, _ in rows}
    got = [{x["doc_id"]: x["score"] for x in lm.score(df, F.col("doc_id") % 4 == 0, order, **o).collect()} for o in ({}, {"block_bytes": 40, "part_keys": 5})]
    want = exact({d: tokens(t) for d, t in rows}, held, tables[0], order)
    for d in want:
        assert math.isclose(got[0][d], want[d], rel_tol=1e-9), d
        assert math.isclose(got[1][d], want[d], rel_tol=1e-9), d


def test_weights_prefer_what_predicts():
    cells = np.array([[65, lm.STEPS * -1, lm.STEPS * -6], [65, lm.NEVER, lm.STEPS * -6]])
    w = lm.learn_weights(cells, np.array([9, 1]), 2, 100)[65]
    assert abs(w.sum() - 1) < 1e-9 and (w >= 0).all() and w[1] > w[2] > 0


def test_edges(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(False)).collect() == []
    rows = lm.score(spark.createDataFrame([(1, "a b"), (None, None), (1, "a b")], "doc_id long, text string"), F.lit(True)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in rows] == [(0, 0)] * 3 and all(math.isfinite(r["score"]) for r in rows)
