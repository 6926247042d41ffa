"""Operators on tables with columns that bear names they use themselves."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, html, jaccard, lm, media, packing, quality, suffix, toxicity, urlrules
from tidewater.llm.labelled import Sample

NAMES = (
    "score spans kept removed n_bytes items hit_words n_words class_id cls label _y _id _runs _doc _salt _host _of _cut _inside component signature length offset sequence_id host path rule verdict pattern "
    "media declared payload carved feature main_text doc lo hi a c at dup covered kinds nth one band task side copies held block docs tokens vocabulary answers piece start ids ids_crc32 url_ good_lines"
).split()
DATA = Sample(["bad words here"] * 4 + ["fine words there"] * 4, [1] * 4 + [0] * 4, [1.0] * 8)


def wide(df):
    return df.select("*", *[F.lit(f"v{i}").alias(c) for i, c in enumerate(NAMES)])


@pytest.fixture(scope="module")
def docs(spark):
    return wide(spark.createDataFrame([(1, "some words here " * 20), (2, "some words here " * 20), (3, None), (None, "")], "doc_id long, text string"))


@pytest.mark.parametrize(
    "operator",
    [
        suffix.remove_repeats,
        jaccard.link_documents,
        lambda d: lm.score(d, F.col("doc_id") == 1),
        lambda d: decontaminate.find_contamination(d, d.select(F.col("doc_id").alias("item_id"), "text", "spans")),
        lambda d: packing.pack_documents(d, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN),
        lambda d: media.sniff_column(media.store_texts(d)),
        lambda d: toxicity.score_with(d, toxicity.train(DATA)),
        lambda d: quality.score_with(d, quality.train(DATA)),
        lambda d: quality.mark_lines(d, quality.train(DATA)),
    ],
)
def test_documents(docs, operator):
    out = operator(docs)
    assert len(out.collect()) >= 4 and len(set(out.columns)) == len(out.columns)


def test_columns_of_the_user_stay_with_their_values(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "mine", "two")], "doc_id long, text string, _tw_note string, hits string").withColumns({"names": F.lit("three"), "hits_": F.lit("four")})
    items = spark.createDataFrame([("x", "a b"), ("y", "c d"), ("z", "e f f")], "item_id string, text string")
    for options in ({}, {"block_bytes": 4}):
        row = decontaminate.find_contamination(docs, items, 2, **options).first()
        assert (row["_tw_note"], row["hits"], row["names"], row["hits_"]) == ("mine", "two", "three", "four")
        assert (row["items"], row["hit_words"]) == (["x", "y", "z"], [0, 1, 2, 3, 4, 5]) and [tuple(s) for s in row["spans"]] == [(0, 11)]


def test_labels(spark, docs):
    labels = wide(spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int"))
    assert toxicity.score(docs, labels).count() == 4


@pytest.mark.parametrize("most", [1 << 19, -1])
def test_pages(spark, most):
    pages = wide(spark.createDataFrame([(1, "http://a.example/x", "<p>t</p>"), (2, None, None)], "page_id long, url string, html string"))
    assert {r["page_id"]: r["main_text"] for r in html.extract(pages, most_broadcast=most).collect()} == {1: "t", 2: ""}
    assert [r["verdict"] for r in urlrules.judge_urls(pages, ["/x"], []).collect()] == ["block", "allow"]
