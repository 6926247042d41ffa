"""A bounded sample of labelled documents, to fit a classifier on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows of each class are used to fit a classifier.
PER_CLASS = 1500


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(n))


@dataclass
class Sample:
    """Texts and labels (0 or 1), and how many rows of the table stand behind each row of a class."""

    texts: list[str]
    labels: list[int]
    weights: list[float]


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: int = 2, folds: int = 4, per_class: int = PER_CLASS) -> Sample:
    """Labelled texts outside the held-out fold, at most ``per_class`` of each class, picked by a hash of the id.

    Rows without an id or label are left out; of several labels of one document
    the greatest counts.  Only the picked ids are broadcast, and only picked
    texts come to the driver.
    """
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & (fold("_id", folds) != held_out))
    marked = marked.groupBy("_id").agg(F.max("_y").alias("_y"))
    counts = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    picked = None
    for y in (0, 1):
        own = marked.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = own if picked is None else picked.unionByName(own)
    docs = docs.select("doc_id", "text")
    rows = docs.join(F.broadcast(picked), docs["doc_id"] == picked["_id"]).select("_id", "_y", F.coalesce("text", F.lit("")).alias("text")).collect()
    rows = sorted({(r["_id"], r["_y"], r["text"]) for r in rows})
    have = {y: max(1, sum(r[1] == y for r in rows)) for y in (0, 1)}
    return Sample([r[2] for r in rows], [r[1] for r in rows], [counts[r[1]] / have[r[1]] for r in rows])
