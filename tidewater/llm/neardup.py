"""Near duplicates among embeddings: spherical k-means cells, blocked cosines within cells, one vector of a group kept.

1. Rows with the same vector (and label) are one *class* from here on; what is
   compared, dealt out and linked are classes.
2. Only vectors with the same label and length are compared.  Each label large enough
   gets cells: spherical k-means, fitted on a bounded sample, gives unit centres, and
   every vector is at home in the cell whose centre is nearest.
3. No link is lost at a border.  If y is within the angle t of x and at home with
   centre b while x is at home with a, then the great sphere between a and b is within
   t of x: x.(a - b) <= sin(t) * |a - b|.  So x also visits every such cell b, and as the
   same holds for y and a, it is enough that the one with the later cell visits.
4. A cell's rows are split into blocks, and each pair of blocks is one task's work:
   one matrix product a piece.  No pairs are returned, but each class's number of
   links and the least class it is linked to through others; these make the groups.

More cells mean fewer comparisons and more visits.  Neighbouring centres that both lie
within one group of near copies would only make all of it visit both, so centres closer
than two link angles are merged; and a label gets the most cells, by halving, with which
the sample's vectors visit ``visits`` cells at most on average.  Results depend on none
of it: all links are found, whatever the cells.

Models are bounded: ``most_cells`` centres in all, for labels with at least so large a
share of the rows (two centres' worth) that there can't be more of them, and ``sample``
vectors a centre to fit them.  Other labels are one cell each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import written
from .components import connected_components, join_hot
from .jaccard import _roots
from .textbuf import tidy

#: Rows of a block, and of one matrix product.
BLOCK, PIECE = 8192, 256
#: Cosines so close to the threshold are worked out again with more digits.
CLOSE = 1e-12


def _matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors that aren't zero, with length 1; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k unit centres of unit vectors; starts are spread over the rows, and an empty cell's centre goes."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        home = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros((len(centres), x.shape[1]))
        np.add.at(sums, home, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        new = sums[size > 1e-9] / size[size > 1e-9, None]
        if new.shape == centres.shape and np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


def merged(centres: np.ndarray, threshold: float) -> np.ndarray:
    """Centres that are more than two link angles apart, the first of those that aren't."""
    most = 2 * threshold * threshold - 1  # the cosine of twice the angle
    kept: list[int] = []
    for i in range(len(centres)):
        if not kept or (centres[kept] @ centres[i]).max() < most:
            kept.append(i)
    return centres[kept]


def homes_and_visits(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home cell of unit vectors, and (row, cell) of all visits to earlier cells that links can need."""
    near = x @ centres.T
    home = np.argmax(near, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))
    slack = np.sqrt(1 - threshold * threshold) + 1e-9
    margin = near[np.arange(len(x)), home][:, None] - near
    row, cell = np.nonzero((margin <= slack * apart[home] + 1e-9) & (np.arange(len(centres)) < home[:, None]))
    return home, row, cell


def cells_of(x: np.ndarray, k: int, threshold: float, visits: float) -> np.ndarray:
    """Centres fitted on unit vectors: k of them, or the most by halving with ``visits`` a vector at most."""
    while k > 1:
        centres = merged(spherical_kmeans(x, k), threshold)
        if len(homes_and_visits(x, centres, threshold)[1]) <= visits * len(x):
            return centres
        k //= 2
    return x[:1]


def _assign(models: dict[str, np.ndarray], threshold: float):
    """(cls, lab, cell, home) of classes (cls, lab, copies, vector), a row a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), object)
            at, cell, home = [], [], []
            for lab in dict.fromkeys(labels.tolist()):
                rows = np.flatnonzero(labels == lab)
                at.append(rows)
                home.append(np.ones(len(rows), bool))
                if lab not in models:
                    cell.append(np.zeros(len(rows), np.int64))
                    continue
                own, row, other = homes_and_visits(unit(_matrix(batch.column(3).take(pa.array(rows)))), models[lab], threshold)
                cell.append(own)
                at.append(rows[row])
                cell.append(other)
                home.append(np.zeros(len(row), bool))
            if at:
                some = batch.take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays([some.column(1), pa.array(np.concatenate(cell).astype(np.int32)), pa.array(np.concatenate(home)), some.column(0), some.column(2), some.column(3)], names=["lab", "cell", "home", "cls", "copies", "vector"])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one task (lab, cell, lo, hi first), which follow one another."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
        start = 0
        for i, new in enumerate(keys):
            if new != key:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, key = [], i, new
        if start < len(keys):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _linked(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the unit vectors x and y have a cosine of at least the threshold."""
    cosines = x @ y.T
    link = cosines >= threshold
    for i, j in zip(*np.nonzero(np.abs(cosines - threshold) < CLOSE), strict=True):
        a, b = raw_x[i].astype(np.longdouble), raw_y[j].astype(np.longdouble)
        link[i, j] = float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) >= threshold
    return link


def _compare(threshold: float):
    """(cls, links, root) of the classes of each task that have links there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            # by class, so that the least index is the least class
            table = table.take(pa.array(np.argsort(table.column("cls").to_numpy(), kind="stable")))
            side, cls, copies = (table.column(c).to_numpy() for c in ("side", "cls", "copies"))
            n = len(cls)
            left, right = np.flatnonzero(side < 2), np.flatnonzero(side == 2)
            within = side[0] == 0
            if n < 2 or not within and not (len(left) and len(right)):
                continue
            raw = _matrix(table.column("vector"))
            x = unit(raw)
            others = left if within else right
            links = np.zeros(n, np.int64)
            i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for at in range(0, len(left), PIECE):
                some = left[at : at + PIECE]
                rest = others[at:] if within else others
                link = _linked(x[some], x[rest], raw[some], raw[rest], threshold)
                if within:  # each pair once
                    link[:, : len(some)] = np.triu(link[:, : len(some)], 1)
                a, b = np.nonzero(link)
                if not len(a):
                    continue
                a, b = some[a], rest[b]
                links += np.bincount(a, copies[b], n).astype(np.int64) + np.bincount(b, copies[a], n).astype(np.int64)
                root = _roots(n, a, b)
                moved = np.flatnonzero(root != np.arange(n))
                i.append(moved)
                j.append(root[moved])
            has = np.flatnonzero(links > 0)
            if len(has):
                root = _roots(n, np.concatenate(i), np.concatenate(j))
                yield pa.RecordBatch.from_arrays([pa.array(cls[has]), pa.array(links[has]), pa.array(cls[root[has]])], names=["cls", "links", "root"])

    return run


def fit_cells(classes: DataFrame, threshold: float, rows_a_cell: int, most_cells: int, sample: int, visits: float) -> dict[str, np.ndarray]:
    """The centres of every label that has cells, fitted on the executors, a label a group of bounded size."""
    per_label = classes.groupBy("lab").agg(F.count(F.lit(1)).alias("n"))
    total = per_label.agg(F.sum("n")).first()[0] or 0
    cells = F.least(F.floor(F.col("n") * most_cells / total), F.floor(F.col("n") / rows_a_cell)).cast("int") if total else F.lit(0)
    large = [(r["lab"], r["k"], r["n"]) for r in per_label.select("lab", "n", cells.alias("k")).where("k > 1").limit(most_cells).collect()]
    if not large:
        return {}
    spark = classes.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(lab, k, min(1.0, sample * k / n)) for lab, k, n in large], "lab string, k int, part double"))
    # the same rows each time, whatever the order and the partitions
    drawn = classes.join(chosen, "lab").where(F.pmod(F.xxhash64("vector", F.lit(7)), F.lit(1 << 30)) < F.col("part") * (1 << 30)).select("lab", "k", "vector")

    def fit(table: pa.Table) -> pa.Table:
        x = unit(_matrix(table.column("vector")))
        x = x[np.lexsort(x.T[::-1])]
        x = x[np.random.default_rng(1).permutation(len(x))][: 2 * sample * most_cells]
        centres = cells_of(x, int(table.column("k")[0].as_py()), threshold, visits)
        return pa.table({"lab": pa.array([table.column("lab")[0].as_py()] * len(centres)), "centre": pa.array(centres.tolist(), pa.list_(pa.float64()))})

    found: dict[str, list] = {}
    for r in drawn.groupBy("lab").applyInArrow(fit, "lab string, centre array<double>").collect():
        found.setdefault(r["lab"], []).append(r["centre"])
    return {lab: np.array(c) for lab, c in found.items() if len(c) > 1}


def link_vectors(vectors: DataFrame, threshold: float = 0.98, rows_a_cell: int = 512, most_cells: int = 1024, sample: int = 32, visits: float = 2.0, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Rows are linked if their labels are equal and not null and the cosine of their
    vectors, in double precision, is at least ``threshold`` (above 0).  ``n_links``
    is the number of other rows linked directly, ``component_id`` the least vec_id
    that links reach, and ``kept`` whether that is the row's own.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    have no links, and neither have vectors of different lengths with one another.
    A vec_id may repeat: each row is a vector, and rows with the same vector and
    label are linked.  A row without a vec_id takes part; a component's id is the
    least that isn't null.  An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", "embedding")
    fit = F.col("label").isNotNull() & (F.coalesce(F.size("embedding"), F.lit(0)) > 0)
    fit &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    lab = F.concat(F.size("embedding"), F.lit("|"), F.col("label").cast("string"))
    keyed = rows.select("vec_id", F.when(fit, lab).alias("lab"), "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    classes = keyed.where("lab is not null").groupBy("lab", "h1", "h2", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cls"), "lab", "h1", "h2", "least", "copies", F.col("embedding").alias("vector")))

    models = fit_cells(classes, threshold, rows_a_cell, most_cells, sample, visits)
    kind = classes.schema["vector"].dataType.simpleString()
    placed = classes.select("cls", "lab", "copies", "vector").mapInArrow(tidy(_assign(models, threshold)), f"lab string, cell int, home boolean, cls long, copies long, vector {kind}")
    own = F.col("home").cast("int")
    sizes = placed.groupBy("lab", "cell").agg(F.count(F.lit(1)).alias("rows"), F.ceil(F.sum(own) / block).cast("int").alias("homes"), F.ceil(F.sum(1 - own) / block).cast("int").alias("guests"))
    sizes = written(sizes.where("rows > 1"))
    total = sizes.agg(F.sum("rows")).first()[0] or 0
    dealt = join_hot(placed, sizes, ["lab", "cell"], "rows", total)
    # blocks of homes come first, then those of guests; guests aren't compared with guests
    number = F.when(F.col("home"), F.pmod(F.xxhash64("cls"), F.col("homes"))).otherwise(F.col("homes") + F.pmod(F.xxhash64("cls"), F.greatest("guests", F.lit(1)))).cast("int")
    dealt = dealt.withColumn("own", number).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("homes") - 1 + F.when(F.col("home"), F.col("guests")).otherwise(0))))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(lo == hi, 0).when(F.col("own") == lo, 1).otherwise(2)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, min(total // 4000, 50_000))
    key = ["lab", "cell", "lo", "hi"]
    dealt = dealt.select("lab", "cell", lo.alias("lo"), hi.alias("hi"), side.alias("side"), "cls", "copies", "vector").repartition(tasks, *key).sortWithinPartitions(*key)
    found = written(dealt.mapInArrow(tidy(_compare(threshold)), "cls long, links long, root long"))

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("cls").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "cls")
    grouped = classes.select("cls", "lab", "h1", "h2", "least", "copies").join(links, "cls", "left").join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    grouped = written(grouped)
    least = grouped.where("links is not null").groupBy("component").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("n"))
    linked = grouped.where("links is not null")
    named = join_hot(linked, least, "component", "n", linked.count()).unionByName(grouped.where("links is null").withColumn("first", F.col("least")))
    named = named.select(F.col("lab").alias("_lab"), F.col("h1").alias("_1"), F.col("h2").alias("_2"), "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    same = (keyed["lab"] == named["_lab"]) & (keyed["h1"] == named["_1"]) & (keyed["h2"] == named["_2"])
    out = keyed.join(named, same, "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("first", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def keep_one(vectors: DataFrame, **settings) -> DataFrame:
    """The rows of ``vectors`` that link_vectors(**settings) keeps: one of each group, the one with the least vec_id (rows that repeat it stay with it)."""
    ids = link_vectors(vectors, **settings).where("kept").select(F.col("vec_id").alias("_kept")).distinct()
    own = vectors.select([F.col(f"`{c}`") for c in vectors.columns])
    return own.join(ids, own["vec_id"].eqNullSafe(ids["_kept"]), "left_semi")
