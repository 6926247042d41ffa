import math
import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.llm import changepoints, queries


def plain_cut(values, least=7, penalty=20_000):
    """Starts and cost by trying every predecessor of every day, in whole numbers."""
    n = len(values)
    sums, squares = [0], [0]
    for x in values:
        sums.append(sums[-1] + x)
        squares.append(squares[-1] + x * x)

    def cost(i, j):
        m, s, q = j - i, sums[j] - sums[i], squares[j] - squares[i]
        return m * math.floor(1000 * math.log(1 + (m * q - s * s) // (m * m)))

    best = {0: (0, 0, ())}
    for j in range(1, n + 1):
        if ways := [(b[0] + cost(i, j) + (penalty if i else 0), b[1] + 1, (i, *b[2])) for i, b in best.items() if j - i >= least or (i == 0 and j == n)]:
            best[j] = min(ways)
    return list(best[n][2])[::-1], best[n][0]


def series(rng, n, times=1):
    level, out = 0, []
    for _ in range(n):
        if rng.random() < 0.1:
            level = rng.randint(0, 300)
        out.append((level + rng.randint(0, rng.choice([0, 1, 30]))) * times)
    return out


def test_cut_is_the_cheapest_one():
    rng = random.Random(5)
    for n in [1, 2, 6, 7, 8, 13, 14, 15, 20, 21, 22, 40, 90, 149] * 3:
        for times in (1, 10**6, 10**10):  # doubles, longs, Python's whole numbers
            values = series(rng, n, times)
            segments, cost = changepoints.cut_series(np.array(values))
            assert ([s[0] for s in segments], cost) == plain_cut(values)
            assert sum(s[4] for s in segments) + 20_000 * (len(segments) - 1) == cost
            assert [s[2] for s in segments] == [sum(values[s[0] : s[0] + s[1]]) for s in segments]


def test_ties_go_to_few_segments_then_to_early_starts():
    rng = random.Random(6)
    for penalty in (0, 1, 700):
        for _ in range(60):
            values = [rng.randint(0, 2) * rng.choice([0, 1, 1]) for _ in range(rng.randint(14, 40))]
            segments, cost = changepoints.cut_series(np.array(values), least=3, penalty=penalty)
            assert ([s[0] for s in segments], cost) == plain_cut(values, 3, penalty), values


def test_a_level_change_is_found():
    values = [10, 11] * 20 + [500, 501] * 20
    assert [s[0] for s in changepoints.cut_series(np.array(values))[0]] == [0, 40]
    assert len(changepoints.cut_series(np.array([0] * 5000 + [1]))[0]) == 1  # long and even: settled at once


def rows_of(out):
    return sorted((tuple(r[c] for c in ("k", *changepoints.COLUMNS)) for r in out.collect()), key=str)


def test_rows_become_series(spark):
    day = datetime(2024, 1, 1)
    rows = [("a", day + timedelta(days=i, hours=i % 24), i % 3) for i in range(30)] + [("a", day, 5)] * 3
    rows += [("b", day, 4), ("b", day + timedelta(days=9), 2), ("one", day, 7), (None, day, 1), (None, day + timedelta(days=3), -2), ("a", None, 9), ("a", day, None)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v int").withColumns({c: F.lit("x") for c in ("d", "series", "segment_no", "first_day", "total")})
    got = defaultdict(list)
    for r in rows_of(changepoints.change_points(df, "K", F.col("t"), F.col("v"))):
        got[r[0]].append(r[1:])
    first = (date(2024, 1, 1) - date(1970, 1, 1)).days
    assert got["b"] == [(1, first, 10, 6, 1 + (10 * 20 - 36) // 100, 10 * math.floor(1000 * math.log(2)), 1, 10 * math.floor(1000 * math.log(2)))]
    assert got["one"] == [(1, first, 1, 7, 1, 0, 1, 0)]
    assert got[None] == [(1, first, 4, -1, 1 + (4 * 5 - 1) // 16, 4 * math.floor(1000 * math.log(2)), 1, 4 * math.floor(1000 * math.log(2)))]
    totals = [i % 3 + 15 * (i == 0) for i in range(30)]
    starts, cost = plain_cut(totals)
    assert [r[1] - first for r in got["a"]] == starts and {r[7] for r in got["a"]} == {cost} and sum(r[3] for r in got["a"]) == sum(totals)


def test_empty(spark):
    out = changepoints.change_points(spark.createDataFrame([], "k long, t timestamp_ntz, v int"), "k", F.col("t"), F.col("v"))
    assert out.collect() == [] and out.columns == ["k", *changepoints.COLUMNS]


def test_query_against_plain_cuts(spark):
    days = defaultdict(lambda: defaultdict(int))
    for r in spark.read.parquet(f"{DATA}/sale_lines.parquet").collect():
        if r["flag"] == "kept" and r["quantity"] is not None and r["shipped_at"] is not None:
            days[r["vendor_id"]][r["shipped_at"].date().toordinal()] += r["quantity"]
    want = {}
    for vendor, own in days.items():
        first = min(own)
        starts, cost = plain_cut([own.get(d, 0) for d in range(first, max(own) + 1)])
        want[vendor] = [(first - date(1970, 1, 1).toordinal() + s, cost) for s in starts]
    got = defaultdict(list)
    for r in queries.QUERIES["op11_penalised_change_points"](spark, DATA).orderBy("vendor_id", "segment_no").collect():
        got[r["vendor_id"]].append((r["first_day"], r["best_cost"]))
        assert r["n_segments"] == len(want[r["vendor_id"]])
    assert got == want
