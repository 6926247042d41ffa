import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import quality, recurrent, toxicity
from tidewater.llm.labelled import Sample, sample

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("operator", "label", "least"), [(toxicity, "toxic", 0.8), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, operator, label, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in operator.score(docs.select("doc_id", "text"), labels).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[r["doc_id"]], r[label]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    s, y = (np.array(x) for x in zip(*held, strict=True))
    assert auc(s, y) >= least


def test_sample_leaves_the_held_out_fold_alone(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    got = sample(docs, labels, "toxic", per_class=10)
    assert len(got.texts) == 20 and all(zlib.crc32(t.split()[1].encode()) % 4 != 2 for t in got.texts)
    assert all(int(t.split()[1]) % 2 == y for t, y in zip(got.texts, got.labels, strict=True))


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_edges(spark, operator):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "x", 1), (None, "y\n\nz", 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    label = "toxic" if operator is toxicity else "quality"
    assert [r["score"] for r in operator.score(docs, none, label).collect()] == [0.0] * 4
    data = Sample(["bad bad words here\n$$$ %%% &&&"] * 6 + ["fine words there\nand some more of them."] * 6, [1] * 6 + [0] * 6, [1.0] * 12)
    model = operator.train(data)
    rows = operator.score_with(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    assert operator.score_with(docs.limit(0), model).collect() == []
    # what stands in a block with others doesn't change a score
    texts = ["bad words", "fine words there", "", "bad\nfine\nbad"]
    together = model.score(pa.array(texts))
    assert np.allclose(together, [model.score(pa.array([t]))[0] for t in texts], atol=1e-5)


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    net = recurrent.Network(3, hidden=2, attend=2, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    features, words = r.standard_normal((5, 3)), r.integers(0, 5, (4, 6))
    real = np.ones((4, 6), bool)
    real[0, 4:] = False
    y, w = np.array([0.0, 1, 1, 0]), np.array([1.0, 2, 1, 1])
    _, g = net.gradients(features, words, real, y, w)
    for k, p in net.p.items():
        for i in list(np.ndindex(p.shape))[:4]:
            old, e = p[i], 1e-3
            p[i] = old + e
            up = net.gradients(features, words, real, y, w)[0]
            p[i] = old - e
            down = net.gradients(features, words, real, y, w)[0]
            p[i] = old
            assert abs((up - down) / (2 * e) - g[k][i]) < 2e-3, k


def test_windows_cover_the_whole_text():
    text = " ".join(f"w{i}" for i in range(101))
    words = toxicity.read_words(pa.array([text, "", "one"]))
    filled, real, owner = toxicity.windows(words, 3)
    assert set(words.number[words.row == 0]) == set(filled[owner == 0][real[owner == 0]])
    assert (owner == 1).sum() == 0 and (owner == 2).sum() == 1
    assert all((real[i] & real[i + 1]).sum() <= toxicity.WINDOW for i in range((owner == 0).sum() - 1))


def brute_marginals(e, t):
    n = len(e)
    total, good = 0.0, np.zeros(n)
    for m in range(1 << n):
        y = [m >> i & 1 for i in range(n)]
        p = np.exp(sum(e[i] * y[i] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1)))
        total += p
        good += p * np.array(y)
    return good / total, np.log(total)


def test_forward_backward():
    r = np.random.default_rng(2)
    rows = np.array([0, 0, 0, 2, 3, 3])
    lines = quality.Lines(rows, np.ones(6), np.zeros((6, 1)))
    field = quality.Field(1)
    field.p["t"] = r.standard_normal((2, 2))
    e = r.standard_normal(6)
    got, pairs, z = field.marginals(lines, e)
    want = [brute_marginals(e[rows == k], field.p["t"]) for k in (0, 2, 3)]
    assert np.allclose(got, np.concatenate([w[0] for w in want])) and np.isclose(z, sum(w[1] for w in want))
    assert np.allclose(pairs.sum(axis=(1, 2)), 1)
    assert np.allclose(pairs[:, 1, :].sum(axis=1), got[[0, 1, 4]])
