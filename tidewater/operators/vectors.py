"""Cosines on Arrow batches: of one vector with all rows, and the nearest rows of many questions at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of questions' vectors that go to the tasks at once.
MOST_NUMBERS = 1 << 20
#: Scores that a task holds at once.
MOST_SCORES = 1 << 20


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors with length 1; zero vectors stay, so that their cosines are 0."""
    length = np.sqrt((vectors * vectors).sum(axis=-1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


def matrix(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, vectors as doubles) of the rows whose vector has ``width`` components, none of them null."""
    size = np.diff(column.offsets.to_numpy())
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (size == width)
    numbers = column.flatten() if column.null_count == 0 else column.filter(column.is_valid()).flatten()
    own = np.asarray(numbers.to_numpy(zero_copy_only=False), np.float64)
    sizes = size[column.is_valid().to_numpy(zero_copy_only=False)]
    if (sizes == width).all():
        vectors, rows = own.reshape(-1, width), np.flatnonzero(valid)
    else:
        vectors, rows = own[np.repeat(sizes == width, sizes)].reshape(-1, width), np.flatnonzero(valid)
    whole = ~np.isnan(vectors).any(axis=1)
    return rows[whole], vectors[whole]


def cosines(rows: DataFrame, query: list[float], key: str, vector: str, out: str = "score") -> DataFrame:
    """(key, score) of all rows whose vector is as long as ``query`` and has no null or NaN: the cosine, 0 if either vector is zero."""
    asked = unit(np.array(query, float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, own = matrix(b.column(1), len(asked))
            if len(at):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(unit(own) @ asked)], names=["k", "s"])

    some = rows.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    return some.mapInArrow(run, f"k {some.schema['k'].dataType.simpleString()}, s double").select(F.col("k").alias(key), F.col("s").alias(out))


def _best(asked: np.ndarray, names: list, k: int):
    """The k best rows of each question among a task's, best first, ties by key; scores are rounded to six digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[float, object]]] = [[] for _ in names]
        least = np.full(len(names), -np.inf)  # of the k best so far
        step = max(1, min(1024, MOST_SCORES // len(names)))
        kind = None
        for b in batches:
            kind = b.column(0).type
            at, own = matrix(b.column(1), asked.shape[1])
            for start in range(0, len(at), step):
                keys = b.column(0).take(pa.array(at[start : start + step])).to_pylist()
                scores = np.round(unit(own[start : start + step]) @ asked.T, 6) + 0.0
                floor = least
                if len(keys) > k:  # rows below the k best of these can't be among the k best of all
                    floor = np.maximum(least, np.partition(np.where(np.isnan(scores), -np.inf, scores), len(keys) - k, axis=0)[len(keys) - k])
                row, question = np.nonzero(scores >= floor)
                for i, q in zip(row.tolist(), question.tolist(), strict=True):
                    held[q].append((-float(scores[i, q]), keys[i]))
                for q in set(question.tolist()):
                    held[q].sort()
                    del held[q][k:]
                    if len(held[q]) == k:
                        least[q] = -held[q][-1][0]
        flat = [(q, key, -score) for q, found in zip(names, held, strict=True) for score, key in found]
        if flat:
            question, keys, scores = zip(*flat, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(question, pa.int64()), pa.array(keys, kind), pa.array(scores, pa.float64())], names=["q", "k", "s"])

    return run


def nearest(questions: DataFrame, rows: DataFrame, question: str, key: str, vector: str, k: int = 10) -> DataFrame:
    """(question, key, score, rank): the k rows of ``rows`` (key, vector) most similar to each of ``questions`` (question, vector).

    Questions are numbered and go to the tasks in blocks of bounded size, a pass
    over the rows for each; a task multiplies its batches with a block and keeps
    the k best, so what is shuffled is k rows a task and question, never a row a
    pair.  Scores are cosines rounded to six digits, ties go to the least key.
    Questions and rows whose vector is null, or has null components or another
    length than the questions' first, find nothing; a null key is never found.
    """
    spark = questions.sparkSession
    asked = questions.select(F.col(question).alias("q"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()) & (F.size("v") > 0))
    some = rows.select(F.col(key).alias("k"), F.col(vector).alias("v")).where("k is not null")
    kind = some.schema["k"].dataType.simpleString()
    shape = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    numbered = asked.withColumn("i", F.row_number().over(Window.orderBy("q")) - 1) if shape["n"] else None
    found = None
    block = max(1, MOST_NUMBERS // max(shape["width"] or 1, 1))
    for start in range(0, shape["n"], block):
        part = numbered.where(F.col("i").between(start, start + block - 1)).collect()
        part = [(r["i"], r["v"]) for r in part if len(r["v"]) == shape["width"]]
        own = some.mapInArrow(_best(unit(np.array([v for _, v in part])), [i for i, _ in part], k), f"q long, k {kind}, s double")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return spark.createDataFrame([], asked.schema).select("q").join(some.select("k"), F.lit(False)).select(F.col("q").alias(question), F.col("k").alias(key), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "k"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(numbered.select("i", F.col("q").alias("_q")), best["q"] == F.col("i")).select(F.col("_q").alias(question), F.col("k").alias(key), F.col("s").alias("score"), "rank")
