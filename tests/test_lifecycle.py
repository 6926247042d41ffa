from pyspark.sql import functions as F

from tidewater.operators import lifecycle
from tidewater.operators.lifecycle import MERGE, NONE, PARSE, PARSE_AGAIN, PURGE, RESTORE, RETIRE, SYNC
from tidewater.staging import place

LISTED, SILVER, FAILED = "source_file string, content_hash string", "source_file string, content_hash string, chunk_id string, text_hash string", "source_file string, content_hash string"
GOLD, INDEX = "source_file string, chunk_id string, text_hash string, contract_id string, version int, is_current boolean", "source_file string, chunk_id string, text_hash string, is_current boolean"


def test_every_state_has_its_action(spark):
    """E1 to E10, and what lies between them, as one table."""
    cases = {  # file: listed hash, parsed hash, silver chunks, failed hash, gold (chunks, contract, version, current), index (chunks, current)
        "e1_new": ("h1", None, "", None, None, None, (PARSE, "new file")),
        "e1_parsed": ("h1", "h1", "ab", None, None, None, (MERGE, "chunks not in gold")),
        "e2_same": ("h1", "h1", "ab", None, ("ab", None, 1, True), ("ab", True), (NONE, None)),
        "e3_changed": ("h2", "h1", "ab", None, ("ab", None, 1, True), ("ab", True), (PARSE_AGAIN, "content changed")),
        "e4_old": ("h1", "h1", "ab", None, ("ab", "K1", 1, True), ("ab", True), (RETIRE, "superseded")),
        "e4_new": ("h1", "h1", "ab", None, ("ab", "K1", 2, True), ("ab", True), (NONE, None)),
        "e5_gone": (None, "h1", "ab", None, ("ab", None, 1, True), ("ab", True), (RETIRE, "file is gone")),
        "e5_done": (None, "h1", "ab", None, ("ab", None, 1, False), ("ab", False), (NONE, None)),
        "e6_shrunk": ("h1", "h1", "a", None, ("ab", None, 1, True), ("ab", True), (PURGE, "chunks no longer in the file")),
        "e7_dead": ("h1", None, "", "h1", None, None, (NONE, "dead letter")),
        "e7_dead_now": ("h2", "h1", "ab", "h2", ("ab", None, 1, True), ("ab", True), (RETIRE, "new content can't be parsed")),
        "e7_mended": ("h3", None, "", "h2", None, None, (PARSE_AGAIN, "content changed")),
        "e8_index_late": ("h1", "h1", "ab", None, ("ab", "K2", 1, False), ("ab", True), (SYNC, "index differs from gold")),
        "e8_new": ("h1", "h1", "ab", None, ("ab", "K2", 2, True), ("ab", True), (NONE, None)),
        "e9_text": ("h1", "h1", "aB", None, ("ab", None, 1, True), ("ab", True), (MERGE, "chunks not in gold")),
        "e10_not_indexed": ("h1", "h1", "ab", None, ("ab", None, 1, True), None, (SYNC, "index differs from gold")),
        "e10_only_index": (None, None, "", None, None, ("ab", True), (SYNC, "index differs from gold")),
        "back": ("h1", "h1", "ab", None, ("ab", None, 1, False), ("ab", False), (RESTORE, "file is back")),
    }
    listed, silver, failed, gold, index, want = [], [], [], [], [], {}
    for file, (now, parsed, own, bad, merged, found, action) in cases.items():
        chunk = lambda c, file=file: (f"{file}-{c.lower()}", c)
        listed += [(file, now)] if now else []
        silver += [(file, parsed, *chunk(c)) for c in own]
        failed += [(file, bad)] if bad else []
        gold += [(file, *chunk(c), *merged[1:]) for c in merged[0]] if merged else []
        index += [(file, *chunk(c), found[1]) for c in found[0]] if found else []
        want[file] = action
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((listed, LISTED), (silver, SILVER), (failed, FAILED), (gold, GOLD), (index, INDEX))]
    assert {r["source_file"]: (r["action"], r["reason"]) for r in lifecycle.reconcile(*frames).collect()} == want
    assert lifecycle.reconcile(*[f.limit(0) for f in frames]).collect() == []


def parse(files):
    """Chunks between bars; a text that begins with ! can't be parsed; the part before a colon is the contract."""
    ok = files.where(~F.col("body").startswith("!"))
    parts = ok.select("source_file", F.when(F.contains("body", F.lit(":")), F.split_part("body", F.lit(":"), F.lit(1))).alias("contract_id"), F.posexplode(F.split(F.element_at(F.split("body", ":"), -1), r"\|")).alias("chunk_seq", "chunk_text"))
    chunks = parts.withColumn("chunk_id", F.sha2(F.concat_ws(":", "source_file", "chunk_seq"), 256))
    return chunks, files.where(F.col("body").startswith("!")).select("source_file", F.lit("no text").alias("error"))


def test_runs_converge_and_the_index_tells_the_truth(spark):
    life = lifecycle.Lifecycle(spark, place(spark), parse)
    folder: dict[str, str] = {}

    def run() -> dict[str, int]:
        rows = [(f, b) for f, b in folder.items()]
        listing = spark.createDataFrame(rows, "source_file string, body string").withColumn("content_hash", F.sha2("body", 256))
        needed = life.run(listing)
        assert {r["action"] for r in life.states(listing).collect()} <= {NONE}  # nothing is left to do
        assert set(life.run(listing)) <= {NONE}
        return needed

    def found(word: str) -> set[str]:
        rows = life.index.keyword(word, 9).join(life.gold.read(), "chunk_id").collect()
        return {r["source_file"] for r in rows}

    folder |= {"one.pdf": "red|green", "two.pdf": "K7:blue|yellow", "bad.pdf": "!"}
    assert run() == {PARSE: 3} and found("blue") == {"two.pdf"} and found("green") == {"one.pdf"}  # E1, E7
    assert life.failures.read().count() == 1
    folder["one.pdf"] = "red|purple|black"  # E3, E9
    assert run()[PARSE_AGAIN] == 1 and found("green") == set() and found("purple") == found("black") == {"one.pdf"}
    folder["one.pdf"] = "red"  # E6
    run()
    assert found("black") == set() and life.index.rows().where("source_file = 'one.pdf'").count() == 1
    folder["three.pdf"] = "K7:white"  # E4, E8
    run()
    assert found("blue") == set() and found("white") == {"three.pdf"}
    assert {(r["source_file"], r["version"]) for r in life.gold.read().where("contract_id = 'K7'").collect()} == {("two.pdf", 1), ("three.pdf", 2)}
    body = folder.pop("one.pdf")  # E5
    assert run()[RETIRE] == 1 and found("red") == set() and life.gold.read().where("source_file = 'one.pdf'").count() == 1
    folder["one.pdf"] = body  # back again
    assert run()[RESTORE] == 1 and found("red") == {"one.pdf"}
    folder["one.pdf"] = "!broken"  # its old text may not be served
    run()
    assert found("red") == set()
    folder["bad.pdf"] = "mended"
    assert run()[PARSE_AGAIN] == 1 and found("mended") == {"bad.pdf"}
    assert life.runs.last()["needed"].keys() <= {NONE}
