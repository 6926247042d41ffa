import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import jaccard
from tidewater.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n=5, threshold=0.8):
    sets = {}
    for d, text in rows:
        w = (text or "").translate(LOW).split()
        sets[d] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    ids = sorted(sets)
    links = {d: {o for o in ids if o != d and sets[d] and sets[o] and len(sets[d] & sets[o]) / len(sets[d] | sets[o]) >= threshold} for d in ids}
    group = {}
    for d in ids:
        if d not in group:
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = d
                    todo += links[x]
    return {d: (group[d], len(links[d]), len(sets[d])) for d in ids}


def made(seed=0):
    r = np.random.default_rng(seed)
    say = lambda n: list(r.choice([f"word{i}" for i in range(300)], n))
    rows = []
    base = [say(int(r.integers(60, 200))) for _ in range(6)]
    for i in range(60):
        w = list(base[i % 6])
        for _ in range(int(r.integers(0, 5))):
            w[int(r.integers(0, len(w)))] = "edit"
        rows.append((i * 2, " ".join(w) if i % 7 else " ".join(w).upper()))
    rows += [(1000 + i, " ".join(say(40))) for i in range(30)]
    return rows + [(2000, None), (2001, ""), (2002, "two words"), (2003, "Two  Words"), (2004, " ")]


@pytest.mark.parametrize("block", [512, 4])
def test_against_brute_force(spark, block):
    rows = made(block)
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_shingles"]) for r in got} == brute(rows)


def test_edges(spark):
    assert jaccard.link_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 2), (4, "a b c d e f", 2)], "doc_id long, text string, cls int")
    got = sorted(((r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in jaccard.link_documents(df).collect()), key=str)
    assert got == [(0, None, 0), (3, 3, 2), (3, 3, 2), (4, 3, 2)]


def test_posterior_threshold():
    assert [jaccard.least_matches(16, 0.8, 1e-6), jaccard.least_matches(160, 0.8, 1e-6)] == sorted([jaccard.least_matches(16, 0.8, 1e-6), jaccard.least_matches(160, 0.8, 1e-6)])
    # a pair at the threshold survives all looks almost surely
    r = np.random.default_rng(1)
    draws = (r.random((20000, 160)) < 0.8).cumsum(axis=1)
    gone = np.zeros(20000, bool)
    for n in range(16, 161, 16):
        gone |= draws[:, n - 1] < jaccard.least_matches(n, 0.8, 1e-6)
    assert gone.mean() < 1e-3


def test_pruning_loses_less_than_the_bands():
    import inspect
    from math import comb

    tolerance = inspect.signature(jaccard.link_documents).parameters["tolerance"].default
    step = np.array([comb(jaccard.CHUNK, m) * 0.8**m * 0.2 ** (jaccard.CHUNK - m) for m in range(jaccard.CHUNK + 1)])
    chance, lost = np.ones(1), 0.0  # of each number of matches so far, and of having been dropped
    for n in range(jaccard.CHUNK, jaccard.VALUES + 1, jaccard.CHUNK):
        chance = np.convolve(chance, step)
        least = jaccard.least_matches(n, 0.8, tolerance)
        lost += chance[:least].sum()
        chance[:least] = 0
    assert lost < (1 - 0.8**jaccard.BAND) ** (jaccard.VALUES // jaccard.BAND) and lost < 1.1e-6


def test_minhash_estimates_similarity():
    import pyarrow as pa

    a, b = [f"w{i}" for i in range(400)], [f"w{i}" for i in range(40, 440)]
    sets, bounds = jaccard.shingles(pa.array([" ".join(a), " ".join(b)]), 5)
    s = jaccard.signatures(sets, bounds)
    assert abs((s[0] == s[1]).mean() - 356 / 436) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 300), (300, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
    star = spark.createDataFrame([(5, 1000 + i) for i in range(60)] + [(1010, 3)], "u long, v long")
    assert {r["component"] for r in connected_components(star, few=0).collect()} == {3}


def test_join_with_hot_keys(spark, monkeypatch):
    from tidewater.llm import components

    monkeypatch.setattr(components, "PARTS", 4)
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [(f"k{i}", i) for i in range(30)], "k string, i int")
    keyed = rows.groupBy("k").count().where("k <> 'k7'").withColumn("x", F.upper("k"))
    for few in (0, 10**6):
        got = components.join_hot(rows, keyed, "k", "count", 80, few)
        assert got.count() == 79 and got.columns == ["k", "i", "x"] and got.where("x <> upper(k)").count() == 0


def chain(n, length=60, step=4):
    """Each text shares 0.867 of its shingles with the next, 0.75 with the one after that."""
    return [(i, " ".join(f"w{k}" for k in range(i * step, i * step + length))) for i in range(n)]


def test_work_on_a_chain_is_linear_in_candidate_pairs():
    import pyarrow as pa

    n = 20_000
    sets, bounds = jaccard.shingles(pa.array([t for _, t in chain(n)]), 5)
    values = jaccard.signatures(sets, bounds).astype(np.uint8)
    keys = jaccard.band_keys(values)
    _, rows = np.unique(keys, return_counts=True)
    compared = (rows * (rows - 1) // 2).sum()
    distinct = {(min(a, b), max(a, b)) for d in range(1, 15) for a, b in zip(range(n), range(d, n), strict=False) if (keys[a] == keys[b]).any()}
    # all pairs of the chain would be 2e8; buckets look at a pair at most once a band
    assert rows.max() < 64 and len(distinct) <= compared <= 32 * len(distinct) < 32 * 10 * n


def test_chain(spark):
    rows = chain(600)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=64).collect()}
    assert got == {i: (0, 1 if i in (0, 599) else 2) for i, _ in rows}


def test_pairs_of_several_bands_are_met_once():
    r = np.random.default_rng(5)
    values = r.integers(0, 3, (40, jaccard.VALUES)).astype(np.uint8)
    values[:, :100] = values[r.integers(0, 4, 40), :100]  # many shared bands
    keys = jaccard.band_keys(values)
    met = []
    for nth in range(keys.shape[1]):
        for key in np.unique(keys[:, nth]):
            own = np.flatnonzero(keys[:, nth] == key)
            halves = own[own % 2 == 0], own[own % 2 == 1]
            for left, right in ((halves[0], halves[0]), (halves[1], halves[1]), halves):
                i, j = jaccard._survivors(values, keys, nth, left, right, 0.0, 0.0)
                met += [(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if (keys[a] == keys[b]).any()}
    assert len(met) == len(set(met)) and set(met) == want
