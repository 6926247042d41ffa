import corpus_pipeline
from tests.conftest import DATA
from tidewater.llm import queries


def test_stages_are_named_and_ordered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_filters_keep_columns_and_clean_documents(spark):
    own = [(i, " ".join(f"{c}{i}" for c in "abcdefghijklmnopqrstuvwxyz")) for i in range(10)]
    rows = [*own, (20, own[3][1]), (21, None), (None, "no id"), (22, "")]
    for _, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, docs(spark, rows), DATA)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = {r["doc_id"]: r for r in got.collect()}
        assert all(kept[i]["text"] == t and kept[i]["n_chars"] == len(t) for i, t in own)
        assert None in kept and kept[21]["text"] is None
    near = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark, rows), DATA).collect()}
    assert near == {*range(10), 21, 22, None}


def test_repeats_and_contamination_go(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    got = {r["doc_id"]: r for r in corpus_pipeline.drop_repeats(spark, docs(spark, [(1, "first " + passage), (2, passage + " second")]), DATA).collect()}
    assert got[1]["text"] == "first " + passage and got[2]["text"] == " second" and got[2]["n_chars"] == 7
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first()["text"]
    got = corpus_pipeline.drop_contamination(spark, docs(spark, [(1, "start " + item + " end"), (2, "clean")]), DATA).collect()
    assert [r["text"].split()[0] for r in got] == ["start", "clean"] and item not in got[0]["text"] and got[0]["text"].rstrip().endswith("end")


CLASHING = "score spans kept removed n_bytes items hit_words n_words class_id cls label _y _id _runs _doc _salt component signature length offset sequence_id host".split()


def test_stages_keep_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    own = docs(spark, [(i, " ".join(f"{c}{i}" for c in "abcdefghijklmnopqrstuvwxyz")) for i in range(8)] + [(9, None), (None, "")])
    wide = own.select("*", *[F.lit(f"v{k}").alias(c) for k, c in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, wide, DATA)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == wide.columns, name
            assert {r["spans"] for r in got.collect()} == {"v1"} and {r["score"] for r in got.collect()} == {"v0"}, name
        else:
            assert got.count() == 10


def test_run_is_its_stages(spark):
    at = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, DATA).cache()
    rows = corpus_pipeline.run(spark, DATA).drop("sequence_id", "offset")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, at.drop("sequence_id", "offset").collect()))


def test_empty_tables(spark):
    empty = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).collect() == []


def test_queries_are_registered():
    assert [n for n in queries.QUERIES if not n.startswith("op")] == [] and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))
