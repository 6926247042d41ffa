"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept,
and returns a DataFrame; all but the last return the columns of ``documents``.
Stages that change a text set ``n_chars`` to its new length.  Rows without a
doc_id pass all filters; a text that loses everything stays as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, jaccard, packing, suffix, toxicity
from tidewater.llm.queries import token_digest
from tidewater.shipping import ship
from tidewater.staging import drop, mark, written
from tidewater.llm.tables import table

#: Documents with at least this toxicity go.
TOXIC = 0.3


def _aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but doc_id and text under names that no operator uses, and the way back to their names and order.

    On the way back ``n_chars`` becomes the length of the text.
    """
    names = {c: c if c in ("doc_id", "text") else f"_aside_{i}" for i, c in enumerate(docs.columns)}

    def back(out: DataFrame) -> DataFrame:
        size = F.when(F.col("text").isNull(), F.col(names["n_chars"])).otherwise(F.char_length("text").cast("long")) if "n_chars" in names else None
        return out.select(*[(size if c == "n_chars" else F.col(n)).alias(c) for c, n in names.items()])

    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    ship(spark)
    own, back = _aside(docs)
    return back(toxicity.score(own, table(spark, sf_dir, "labels")).where(F.col("score") < TOXIC))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group that links of similarity 0.8 or more connect; of repeated rows, one."""
    ship(spark)
    own, back = _aside(docs)
    linked = jaccard.link_documents(own)
    first = linked.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    kept = own.join(first.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return back(kept.unionByName(own.where(F.col("doc_id").isNull())))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters of any 100 bytes that also start earlier in the corpus."""
    ship(spark)
    own, back = _aside(docs)
    out = suffix.remove_repeats(own, 100, characters=True)
    return back(out.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))))


def drop_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of words that are inside an occurrence of a benchmark window."""
    ship(spark)
    own, back = _aside(docs)
    found = decontaminate.find_contamination(own, table(spark, sf_dir, "benchmark"))
    return back(decontaminate.remove_spans(found.select(*own.columns, "spans")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 1024 tokens."""
    import public_tokenizers

    ship(spark)
    out = packing.pack_documents(docs, public_tokenizers.path(vocabulary), public_tokenizers.PATTERN, 1024, 2, token_digest)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("benchmark_decontamination", drop_contamination),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the first stage (a trained network); tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next; what a stage has written on its way goes when its result is there."""
    docs, before = table(spark, sf_dir, "documents"), mark()
    for _, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        steps = mark()
        docs = written(out)
        drop(spark, before, steps)  # the steps and the stage before
        before = steps
    return STAGES[-1][1](spark, docs, sf_dir)
