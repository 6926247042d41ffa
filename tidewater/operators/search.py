"""Vector, keyword and hybrid retrieval over filtered chunks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import written


def cosine(vector: Column | str, query: list[float]) -> Column:
    """Cosine similarity with a literal vector; 0 if either is zero."""
    v = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    q = F.array(*[F.lit(float(x)) for x in query])
    add = lambda a, b: a + b
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a * b), F.lit(0.0), add)
    norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), add)) * math.sqrt(sum(x * x for x in query))
    return F.when(norm > 0, dot / norm).otherwise(0.0)


def top(df: DataFrame, score: Column, key: str, k: int) -> DataFrame:
    """The k best rows with score and rank, ties by key; only k rows a task leave it."""
    best = df.withColumn("score", F.round(score, 6)).orderBy(F.desc("score"), key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))


def vector_top(chunks: DataFrame, query: list[float], key: str, vector: str, k: int = 5, where: Column | None = None) -> DataFrame:
    rows = chunks if where is None else chunks.where(where)
    return top(rows.select(key, vector), cosine(vector, query), key, k).drop(vector)


def words(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(F.col(text) if isinstance(text, str) else text), r"[^a-z0-9]+"), lambda w: w != "")


def _count(array: str, word: str) -> Column:
    return F.size(F.filter(array, lambda x: x == word))


def asked_words(query: str) -> list[str]:
    """A query's distinct words, sorted."""
    return sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})


def _counted(chunks: DataFrame, query: str, text: str, *kept: Column | str) -> tuple[DataFrame, int]:
    """``kept`` columns, length in words and counts of the query's words (their number comes second) of every row."""
    asked = asked_words(query)
    rows = chunks.select(*kept, words(F.coalesce(text, F.lit(""))).alias("_w"))
    own = [c for c in rows.columns if c != "_w"]
    return rows.select(*own, F.size("_w").alias("_n"), *[_count("_w", w).alias(f"_f{i}") for i, w in enumerate(asked)]), len(asked)


def bm25(counted: DataFrame, asked: int, rows: int | None = None, mean: float | None = None, k1: float = 1.2, b: float = 0.75) -> tuple[Column, Column]:
    """Okapi BM25 of counted rows, and whether they have any of the words.

    Document frequencies, and unless given the number of rows and their mean
    length, come from one aggregation over the counted rows.
    """
    s = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("_n").alias("mean"), *[F.sum((F.col(f"_f{i}") > 0).cast("int")).alias(f"d{i}") for i in range(asked)]).first()
    n, mean = s["n"] if rows is None else rows, s["mean"] if mean is None else mean
    score = F.lit(0.0)
    for i in range(asked):
        d = s[f"d{i}"] or 0
        idf = math.log(1 + (n - d + 0.5) / (d + 0.5))
        f = F.col(f"_f{i}")
        score = score + idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("_n") / max(mean or 0.0, 1e-9)))
    return score, F.greatest(F.lit(0), F.lit(0), *[F.col(f"_f{i}") for i in range(asked)]) > 0


def keyword_top(chunks: DataFrame, query: str, key: str, text: str, k: int = 5, where: Column | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best by Okapi BM25; the texts are read once, their counts are written."""
    counted, asked = _counted(chunks if where is None else chunks.where(where), query, text, key)
    counted = written(counted)
    score, hit = bm25(counted, asked, k1=k1, b=b)
    return top(counted.where(hit), score, key, k).select(key, "score", "rank")


def fuse(lists: list[DataFrame], key: str, k: int = 5, c: int = 60) -> DataFrame:
    """Reciprocal rank fusion of ranked lists: each adds 1 / (c + rank)."""
    every = None
    for one in lists:
        own = one.select(key, (1.0 / (c + F.col("rank"))).alias("_s"))
        every = own if every is None else every.unionByName(own)
    return top(every.groupBy(key).agg(F.sum("_s").alias("_s")), F.col("_s"), key, k).drop("_s")


def enough(lists: int, k: int, c: int = 60) -> int:
    """How deep to read ranked lists so that no row unread in all of them can be among the k best of their fusion.

    The k best of any list have 1 / (c + k) at least, a row below depth d of all
    lists less than lists / (c + d); the gap covers rounding to six digits.
    """
    gap = 1 / (c + k) - 1e-6
    return max(k, math.ceil(lists / gap) - c) if gap > 0 else (1 << 31) - 1


def ranks_among(scored: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(key, rank) among all rows of ``scored`` (key, score) of those that ``wanted`` has.

    No row is shuffled: each counts how many wanted rows are before it, and of
    that there is a histogram.
    """
    place = F.struct((F.lit(0.0) - F.col("score")).alias("s"), F.col(key).alias("k"))
    marks = scored.join(F.broadcast(wanted), key, "left_semi").agg(F.array_sort(F.collect_list(place)).alias("_m"))
    told = scored.select(place.alias("_p")).crossJoin(F.broadcast(marks)).select(F.size(F.filter("_m", lambda m: m < F.col("_p"))).alias("_at")).groupBy("_at").count()
    rank = told.select("_at", F.sum("count").over(Window.orderBy("_at")).alias("rank"))
    return marks.select(F.posexplode("_m").alias("_at", "_p")).join(rank, "_at").select(F.col("_p.k").alias(key), "rank")


def hybrid_top(chunks: DataFrame, vector_query: list[float], text_query: str, key: str, vector: str, text: str, k: int = 5, where: Column | None = None) -> DataFrame:
    """The k best by fusion of both whole rankings; rows without a vector are ranked by keywords only.  ``key`` is unique.

    Only the best of either ranking can be among them (:func:`enough`); these
    are fused with the ranks they have among all rows, however deep.
    """
    similar = F.when(F.col(vector).isNotNull(), F.round(cosine(vector, vector_query), 6)).alias("_v")
    counted, asked = _counted(chunks if where is None else chunks.where(where), text_query, text, key, similar)
    counted = written(counted)
    score, hit = bm25(counted, asked)
    lists = [counted.where("_v is not null").select(key, F.col("_v").alias("score")), counted.where(hit).select(key, F.round(score, 6).alias("score"))]
    wanted = None
    for one in lists:
        own = one.orderBy(F.desc("score"), key).limit(enough(len(lists), k)).select(key)
        wanted = own if wanted is None else wanted.unionByName(own)
    wanted = written(wanted.distinct())
    return fuse([ranks_among(one, wanted, key) for one in lists], key, k)


def context(hits: DataFrame, file: str, page: str, text: str) -> DataFrame:
    """One text for a prompt: ``[file pN]`` and the chunk, best first; a page that isn't a number shows as ?."""
    label = F.concat(F.lit("["), F.element_at(F.split(file, "/"), -1), F.lit(" p"), F.coalesce(F.col(page).try_cast("double").cast("int").cast("string"), F.lit("?")), F.lit("]\n"), F.col(text))
    ranked = F.array_sort(F.collect_list(F.struct("rank", label.alias("t"))))
    return hits.agg(F.array_join(F.transform(ranked, lambda x: x["t"]), "\n\n").alias("context"))
