import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import feed
from tidewater.staging import place


def told(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_diff_names_every_change(spark):
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (4, "d", 4.0), (None, "n", 0.0)], "id int, s string, x double")
    after = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (3, None, 3.5), (5, "e", 5.0), (None, "N", 0.0)], "id int, s string, x double")
    want = [(2, "b", None, "update_before"), (2, None, None, "update_after"), (3, None, 3.0, "update_before"), (3, None, 3.5, "update_after"), (4, "d", 4.0, "delete"), (5, "e", 5.0, "insert"), (None, "n", 0.0, "update_before"), (None, "N", 0.0, "update_after")]
    assert told(feed.diff(before, after, ["id"]), "id", "s", "x", "_change") == sorted(want, key=str)
    assert told(feed.diff(None, after, ["id"], 7), "id", "_change", "_version") == sorted([(i, "insert", 7) for i in (1, 2, 3, 5, None)], key=str)
    assert feed.diff(after, after, ["id"]).collect() == []


def test_nulls_in_other_places_and_new_columns_are_changes(spark):
    before = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "id int, a string, b string")
    swapped = spark.createDataFrame([(1, None, "x"), (2, "y", "z")], "id int, a string, b string")
    assert told(feed.diff(before, swapped, ["id"]), "id", "a", "_change") == sorted([(1, "x", "update_before"), (1, None, "update_after")], key=str)
    wider = before.withColumn("c", F.when(F.col("id") == 1, F.create_map(F.lit("k"), F.lit(1))))
    assert told(feed.diff(before, wider, ["id"]), "id", "_change") == [(1, "update_after"), (1, "update_before")]


def test_a_repeated_key_fails(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, s string")
    with pytest.raises(Exception, match="several rows of one version"):
        feed.diff(twice.limit(0), twice, ["id"]).collect()


def test_feeds_lead_from_version_to_version(spark):
    rng = random.Random(4)
    table = feed.VersionedTable(spark, place(spark), ["id"])
    states, now = [], {}
    for _ in range(4):
        for _ in range(12):
            k = rng.randint(0, 15)
            if rng.random() < 0.3:
                now.pop(k, None)
            else:
                now[k] = rng.choice(["p", "q", None, ""])
        states.append(dict(now))
        table.write(spark.createDataFrame(list(now.items()), "id int, v string"))
    assert table.version == 4 and told(table.read(2), "id", "v") == sorted(states[1].items(), key=str)
    for since in range(5):
        base = table.read(since) if since else None
        assert told(feed.apply_feed(base, table.changes(since), ["id"]), "id", "v") == sorted(states[3].items(), key=str)
    step = table.read(1)
    every = table.changes(1, each=True)
    for n in (2, 3, 4):
        step = feed.apply_feed(step, every.where(F.col("_version") == n), ["id"])
        assert told(step, "id", "v") == sorted(states[n - 1].items(), key=str)
    table.vacuum(3)
    assert told(table.read(), "id", "v") == sorted(states[3].items(), key=str)
    with pytest.raises(ValueError, match="no version 2"):
        table.read(2)


def test_consumer_sees_each_change_once(spark):
    table, seen = feed.VersionedTable(spark, place(spark), ["id"]), []
    path = place(spark)
    take = lambda f, v: seen.append((v, told(f, "id", "_change")))
    one = feed.Consumer(spark, path, table)
    assert one.poll(take) == 0 and seen == []
    table.write(spark.createDataFrame([(1, "a")], "id int, s string"))
    table.write(spark.createDataFrame([(1, "b"), (2, "c")], "id int, s string"))
    one.poll(take)
    with pytest.raises(RuntimeError):
        table.write(spark.createDataFrame([(2, "c")], "id int, s string"))

        def fail(_feed, _version):
            raise RuntimeError

        one.poll(fail)
    again = feed.Consumer(spark, path, table)  # as after a restart
    again.poll(take)
    again.poll(take)
    assert seen == [(2, [(1, "insert"), (2, "insert")]), (3, [(1, "delete")])]


def test_many_changes_go_to_their_rows_by_place(spark, monkeypatch):
    """However many keys changed, whole rows are not shuffled: the same feed, without a sort-merge join."""
    n = 70_000  # more than one mark has in a file
    base = spark.range(n).selectExpr("nullif(id, 5) AS id", "concat('t', id % 7) AS v", "id AS _metadata")
    table = feed.VersionedTable(spark, place(spark), ["id"])
    table.write(base.coalesce(1))
    table.write(base.where("id IS NULL OR id % 10 <> 3").withColumn("v", F.expr("CASE WHEN id % 2 = 0 THEN concat(v, '!') WHEN id IS NULL THEN 'n' ELSE v END")).unionByName(spark.range(n, n + 9).selectExpr("id", "'new' AS v", "id AS _metadata")).repartition(3))
    want = told(table.changes(1), "id", "v", "_metadata", "_change")
    assert len(want) > 2 * 35_000
    monkeypatch.setattr(feed, "FEW", 0)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = table.changes(1)
        assert told(many, "id", "v", "_metadata", "_change") == want
        assert "SortMergeJoin" not in many._jdf.queryExecution().toString()
        monkeypatch.setattr(feed, "MARKS", 0)
        assert told(table.changes(1), "id", "v", "_metadata", "_change") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
