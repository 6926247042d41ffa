import math

import numpy as np
import pytest

from tests.conftest import DATA
from tidewater.llm import neardup, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) of every row, by all pairs."""
    n = len(rows)

    def usable(v, label):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    fit = [usable(v, label) for _, v, label in rows]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], least.get(find(i)), rows[i][0] == least.get(find(i))) for i in range(n)), key=str)


def told(out):
    return sorted((tuple(r) for r in out.collect()), key=str)


def near(rng, v, angle):
    """A vector at the given angle from v."""
    v = v / np.linalg.norm(v)
    w = rng.normal(size=len(v))
    w -= w @ v * v
    return math.cos(angle) * v + math.sin(angle) * w / np.linalg.norm(w)


def clustered(seed, n, dim, labels):
    """Vectors alone, chains whose ends aren't linked, tight and wide groups, and copies, of several labels."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        v, label = rng.normal(size=dim), int(rng.integers(labels))
        kind = rng.integers(5)
        group = [v]
        if kind == 1:
            group += [near(rng, v, a) for a in rng.uniform(0.01, 0.25, 12)]
        elif kind == 2:
            for _ in range(15):
                group.append(near(rng, group[-1], rng.uniform(0.15, 0.2)))
        elif kind == 3:
            group += [3.0 * v, v.copy(), -v]
        elif kind == 4:
            group += [near(rng, v, 0.03) for _ in range(20)]
        out += [(label, g) for g in group]
    ids = rng.permutation(len(out))
    return [(int(i), [float(x) for x in g], label) for i, (label, g) in zip(ids, out, strict=True)]


@pytest.mark.parametrize("dim,settings", [(8, {"rows_a_cell": 8, "visits": 9.0}), (3, {"rows_a_cell": 20}), (32, {"rows_a_cell": 16, "block": 25}), (16, {})])
def test_all_links_are_found_across_cells_and_blocks(spark, dim, settings):
    rows = clustered(dim, 420, dim, 3)
    assert told(neardup.link_vectors(spark.createDataFrame(rows, SCHEMA), **settings)) == brute(rows)


def test_cells_are_used_and_borders_lose_nothing():
    rng = np.random.default_rng(3)
    x = neardup.unit(np.concatenate([near(rng, v, 0)[None] + 0.05 * rng.normal(size=(60, 24)) for v in rng.normal(size=(20, 24))]))
    centres = neardup.cells_of(x, 32, 0.98, 2.0)
    assert len(centres) > 4
    home, row, cell = neardup.homes_and_visits(x, centres, 0.98)
    assert len(row) <= 2 * len(x)
    stays = {*zip(row.tolist(), cell.tolist(), strict=True)}
    i, j = np.nonzero(x @ x.T >= 0.98)
    assert all(home[a] == home[b] or (a, home[b]) in stays or (b, home[a]) in stays for a, b in zip(i.tolist(), j.tolist(), strict=True))
    # a group of near copies isn't cut up
    tight = neardup.unit(rng.normal(size=24) + 0.01 * rng.normal(size=(500, 24)))
    assert len(neardup.merged(neardup.spherical_kmeans(tight, 16), 0.98)) == 1


def test_odd_rows(spark):
    nan, inf, tiny, huge = float("nan"), float("inf"), 1e-38, 3e38
    v = [1.0, 2.0, 0.5]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 0.0], 1), (9, [inf, 1.0, 0.0], 1), (10, [1.0, None, 0.5], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0], 1),
        (13, [x * 1e-38 for x in v], 1), (14, [x * 1e38 for x in v], 1), (15, [huge, 0.0, 0.0], 3), (16, [tiny, 0.0, 0.0], 3), (2, v, 1), (2, [5.0, -1.0, 0.0], 1), (17, [5.0, -1.0, -0.0], 1), (None, v, 1), (None, [9.0, -9.0, 1.0], 1), (None, None, None), (20, [-1.0, -2.0, -0.5], 1),
    ]
    assert told(neardup.link_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_threshold_is_met_exactly(spark):
    # cosine 0.6 with no rounding at all; links are at it, none above it
    rows = [(1, [3.0, 4.0], 0), (2, [1.0, 0.0], 0), (3, [-4.0, 3.0], 0)]
    assert told(neardup.link_vectors(spark.createDataFrame(rows, SCHEMA), 0.6)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert told(neardup.link_vectors(spark.createDataFrame(rows, SCHEMA), 0.6000000000001))[1][1] == 0


def test_other_columns_and_types(spark):
    rows = clustered(11, 60, 5, 2)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "CAST(embedding AS array<double>) AS embedding", "CAST(label AS string) AS label", "'x' AS cls", "'y' AS lab", "1 AS h1", "'z' AS n_links", "'v' AS vector", "'k' AS kept")
    want = brute(rows)
    assert told(neardup.link_vectors(df)) == want
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns and {r["vec_id"] for r in kept.collect()} == {r[0] for r in want if r[3]}
    assert neardup.link_vectors(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert told(queries.QUERIES["op13_embedding_near_dedup"](spark, DATA)) == brute(rows)
