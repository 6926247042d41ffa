import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.relational import history
from tidewater.streaming.flows import HistoryTable

SCHEMA = "id string, seq int, v string"


def told(table, *columns):
    return sorted((tuple(r[c] for c in (*columns, "__START_AT", "__END_AT")) for r in table.read().collect()), key=str)


def batch(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_two_streams_feed_one_table(spark, tmp_path):
    """Each has a checkpoint of its own and starts at batch 0; neither loses a row, and neither counts a batch twice."""
    for name, rows in (("one", [("a", 1, "x"), ("a", 3, "z")]), ("two", [("b", 1, "q"), ("a", 2, "y")])):
        batch(spark, *rows).write.parquet(str(tmp_path / name))
    follow = lambda t, name: t.follow(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / name)), str(tmp_path / f"mark-{name}"))
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=4)
    follow(table, "one")
    follow(table, "two")
    want = [("a", "x", 1, 2), ("a", "y", 2, 3), ("a", "z", 3, None), ("b", "q", 1, None)]
    assert told(table, "id", "v") == want
    again = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=4)
    for name in ("one", "two"):
        again.apply(batch(spark, ("c", 9, "replayed")), 0, str(tmp_path / f"mark-{name}"))
    assert told(again, "id", "v") == want
    with pytest.raises(ValueError, match="several streams"):
        again.apply(batch(spark, ("c", 9, "whose?")), 0)


def test_other_buckets_are_refused(spark, tmp_path):
    HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=4).apply(batch(spark, ("a", 1, "x")))
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=8)


@pytest.mark.parametrize("most", [1, 3, 100])
def test_any_cut_into_batches_gives_the_same_versions(spark, tmp_path, most):
    """Late, repeated, contradicting and null keys and sequences, compacted after every batch, now and then, or never."""
    rng = random.Random(most)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, 4, 5, None]), rng.choice("xyz")) for _ in range(60)]
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=3, most=most)
    for start in range(0, 60, 10):
        table.apply(batch(spark, *rows[start : start + 10]), start)
    one = history(batch(spark, *rows), ["id"], "seq")
    want = sorted((tuple(r[c] for c in ("id", "v", "__START_AT", "__END_AT")) for r in one.collect()), key=str)
    assert told(table, "id", "v") == want
    assert len([r for r in want if r[3] is None]) == len({r[0] for r in rows})  # one open version a key
    table.compact()
    assert told(table, "id", "v") == want and told(HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=3), "id", "v") == want


def test_columns_that_come_later_and_wider_types(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=2)
    table.apply(batch(spark, ("a", 1, "x")))
    table.compact()
    table.apply(batch(spark, ("a", 5_000_000_000, "y", 1.5), ("b", 2, "z", None), schema="id string, seq long, v string, extra double"))
    want = [("a", "x", None, 1, 5_000_000_000), ("a", "y", 1.5, 5_000_000_000, None), ("b", "z", None, 2, None)]
    assert told(table, "id", "v", "extra") == want
    table.apply(batch(spark, ("b", 1, "w")))  # the old columns again
    table.compact()
    assert told(table, "id", "v", "extra") == [*want[:2], ("b", "w", None, 1, 2), ("b", "z", None, 2, None)]


def test_a_table_of_keys_only(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", 1)], "id string, seq int")
    assert sorted((r["id"], r["__START_AT"], r["__END_AT"]) for r in history(rows, ["id"], "seq").fillna(0).collect()) == [("a", 1, 2), ("a", 2, 0), ("b", 1, 0)]
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq")
    table.apply(rows)
    assert told(table, "id") == [("a", 1, 2), ("a", 2, None), ("b", 1, None)]


def test_what_is_replaced_goes(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=1, most=2)
    assert table.read() is None
    folders = lambda: {d for d in os.listdir(tmp_path / "t") if d[:2] in ("d=", "v=") and any(f.endswith(".parquet") for _, _, fs in os.walk(tmp_path / "t" / d) for f in fs)}
    for i in range(6):
        table.apply(batch(spark, ("a", i, "x")))
    table.vacuum()
    assert len(folders()) == 1 and told(table, "id")[-1] == ("a", 5, None)
    assert table.read().where(F.col("__END_AT").isNull()).count() == 1
