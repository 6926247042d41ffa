"""Change points of daily series: the cheapest cut into segments, as a shortest path.

The days of a series are the nodes of a graph; an edge from day i to day j is a
segment, and its weight what that segment costs, plus the penalty for the cut
before it.  No weight is negative, so Dijkstra's algorithm finds the cheapest
path, and only edges that leave a settled node are ever worked out: nodes that
cost more than the whole series does by the time it is reached have none.  The
heap is keyed by cost, then by the number of segments; of equal keys the earliest
predecessor stays.  As every edge adds a segment, all predecessors of a node are
settled before it is, and its last segment is the one that starts first.

Rows are summed up by key and day before they are shuffled by key, so a series is
as long as the calendar, however many rows its key has.  Nothing goes to the
driver, and nothing is broadcast.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbuf import tidy

MOST_LONG = (1 << 63) - 1


def _exact_type(n: int, squares: int) -> type:
    """A type in which all sums, products, quotients and keys of a series of n days with so large a sum of squares are exact."""
    if n * squares < 1 << 52 and n < 100_000:
        return np.float64
    return np.int64 if n * squares < 1 << 62 else object


def _weights(days: np.ndarray, total: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """V = 1 + floor((n*Q - S*S) / (n*n)), and n * floor(1000 * ln(V)), of segments.

    Below 2^52 the floor of a quotient of doubles is that of the exact quotient.
    """
    over, under = days * squares - total * total, days * days
    if days.dtype == np.float64:
        spread = np.floor(over / under) + 1
        return spread, np.floor(1000 * np.log(spread)) * days
    spread = over // under + 1
    logs = np.vectorize(math.log, otypes=[float])(spread) if spread.dtype == object else np.log(spread)
    return spread, np.floor(1000 * logs).astype(np.int64).astype(days.dtype) * days


def cut_series(values: np.ndarray, least: int = 7, penalty: int = 20_000) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """The segments (start, days, total, spread, cost) of the cheapest cut of a series, and what it costs with its penalties.

    A segment of n days with sum S and sum of squares Q has the spread
    V = 1 + floor((n*Q - S*S) / (n*n)) and costs n * floor(1000 * ln(V)), in exact
    whole numbers but for the logarithm.  A series shorter than ``least`` days is
    one segment.
    """
    n, exact = len(values), values.tolist()
    own = np.array(exact, _exact_type(n, sum(x * x for x in exact)))
    zero = np.zeros(1, own.dtype)
    sums, squares = np.concatenate([zero, np.cumsum(own)]), np.concatenate([zero, np.cumsum(own * own)])
    # the days at which a segment can end, in order; the last is the series' end
    stops = np.append(np.arange(least, n - least + 1), n)
    ends, end_sums, end_squares = stops.astype(own.dtype), sums[stops], squares[stops]
    last = len(stops) - 1
    unit = n + 1  # a key is cost * unit + number of segments
    best = np.full(last + 1, MOST_LONG, own.dtype)
    before = np.full(last + 1, n, np.int64)
    heap: list[tuple[int, int]] = []

    made: dict[int, tuple[int, np.ndarray]] = {}

    def edges(start: int) -> np.ndarray:
        """The weights of the edges that leave a day, to the stops that are far enough; made for `least` neighbouring days at a time, when the first of them is settled."""
        block = start // least
        if block not in made:
            if len(made) > 8:  # days are settled about in order: memory stays in proportion to the series
                del made[next(iter(made))]
            low = block * least
            from_here = slice(min(low, last), None)
            starts = np.arange(low, min(low + least, n - least + 1) if low else 1)
            made[block] = min(low, last), _weights(ends[from_here] - starts[:, None].astype(own.dtype), end_sums[from_here] - sums[starts, None], end_squares[from_here] - squares[starts, None])[1] * unit
        first, weights = made[block]
        return weights[start - block * least, min(start, last) - first :]

    def relax(start: int, key: int) -> None:
        first = min(start, last)  # the first stop that is `least` days away
        keys = edges(start) + ((penalty if start else 0) * unit + key + 1)
        # no path over a node beyond the series' best key so far is a better one
        for at in (first + (keys <= np.minimum(best[first:], best[last])).nonzero()[0]).tolist():
            new = keys[at - first]
            if new < best[at]:
                best[at], before[at] = new, start
                heapq.heappush(heap, (int(new), at))
            elif start < before[at]:
                before[at] = start

    relax(0, 0)
    while heap:
        key, at = heapq.heappop(heap)
        if at == last:
            break
        if key == best[at]:
            relax(int(stops[at]), key)
    found, at = [], last
    while True:
        start, end = int(before[at]), slice(at, at + 1)
        total = end_sums[end] - sums[start]
        spread, cost = _weights(ends[end] - start, total, end_squares[end] - squares[start])
        found.append((start, int(stops[at]) - start, int(total[0]), int(spread[0]), int(cost[0])))
        if start == 0:
            break
        at = start - least
    return found[::-1], int(best[last]) // unit


COLUMNS = ("segment_no", "first_day", "n_days", "total", "spread", "cost", "n_segments", "best_cost")


def _cut(least: int, penalty: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            series = batch.column(1)
            bounds = series.offsets.to_numpy()
            day, total = (series.values.field(i).to_numpy() for i in range(2))
            owner, rows = [], []
            for i in range(batch.num_rows):
                own = slice(bounds[i], bounds[i + 1])
                first = int(day[own].min())
                values = np.zeros(int(day[own].max()) - first + 1, np.int64)
                values[day[own] - first] = total[own]
                segments, cost = cut_series(values, least, penalty)
                owner += [i] * len(segments)
                rows += [(k, first + s[0], s[1], s[2], min(s[3], MOST_LONG), s[4], len(segments), cost) for k, s in enumerate(segments, 1)]
            if rows:
                kinds = [pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], names=[batch.schema.names[0], *COLUMNS])

    return run


def change_points(df: DataFrame, key: str, day: Column, value: Column, least: int = 7, penalty: int = 20_000) -> DataFrame:
    """One row per segment of each key's daily series: the key, segment_no (from 1), first_day (days since 1970), n_days, total, spread, cost, n_segments, best_cost.

    A series is the sum of ``value`` per ``day`` (a date or a time), from its
    key's first to its last day; days between without any row count 0.  Rows whose
    day or value is null are left out, repeated rows count each time, and rows
    without a key are a series of their own.  Values are whole numbers; negative
    ones are allowed, and a spread beyond a long is given as the greatest long.
    Ties go to the fewest segments, then to the earliest starts, compared from the
    last segment backwards.  An empty table gives an empty result; other columns
    are ignored, whatever their names, unless they are called like the key.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    name = {c.lower(): c for c in df.columns}[key.lower()]
    own = df.select(F.col(f"`{name}`").alias("k"), F.unix_date(day.cast("date")).alias("d"), value.cast("long").alias("v")).where("d is not null and v is not null")
    daily = own.groupBy("k", "d").agg(F.sum("v").alias("v"))
    series = daily.repartition(tasks, "k").groupBy("k").agg(F.collect_list(F.struct("d", "v")).alias("series"))
    kind = series.schema["k"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in COLUMNS[1:])
    out = series.mapInArrow(tidy(_cut(least, penalty)), f"k {kind}, segment_no int, {longs}")
    return out.withColumnRenamed("k", name)
