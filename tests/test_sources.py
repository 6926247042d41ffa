import datetime as dt
import os
import time

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructField, StructType

from tidewater.sources import files, jdbc, sinks
from tidewater.streaming import flows

SCHEMA = StructType([StructField("id", IntegerType()), StructField("amount", DoubleType()), StructField("day", DateType())])


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ingest_once_with_rescue_and_late_files(spark, tmp_path):
    src, out, mark = str(tmp_path / "erp/orders"), str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda schema=SCHEMA: flows.ingest(spark, src, schema, "erp", mark, out)
    put(f"{src}/dt=2024-01-01/a.csv", "id,amount,day\n1,2.5,2024-01-01\nx,3,2024-13-01\n")
    run()
    run()
    rows = {r["_rescued_data"]: (r["id"], r["amount"], r["day"]) for r in spark.read.parquet(out).collect()}
    assert rows == {None: (1, 2.5, dt.date(2024, 1, 1)), '{"id":"x","day":"2024-13-01"}': (None, 3.0, None)}
    put(f"{src}/dt=2024-01-01/a.csv", "id,amount,day\n9,9,2024-01-01\n")  # overwritten in place: not read again
    put(f"{src}/dt=2023-12-31/late.csv", "id,amount,day\n7,1,2023-12-31\n")
    run()
    assert sorted(r["id"] or 0 for r in spark.read.parquet(out).collect()) == [0, 1, 7]
    clean, quarantine = flows.split_rescued(spark.read.parquet(out))
    assert (clean.count(), quarantine.count()) == (2, 1)


def test_new_columns(spark, tmp_path):
    put(str(tmp_path / "a.csv"), "id,extra\n1,hello\n")
    schema = files.evolved(StructType.fromDDL("id int"), files.header_of(spark, str(tmp_path)))
    assert schema.fieldNames() == ["id", "extra"]
    raw = spark.read.schema(files.as_strings(schema)).option("header", True).csv(str(tmp_path))
    assert files.conform(raw, StructType.fromDDL("id int")).first()["_rescued_data"] == '{"extra":"hello"}'


def test_overwritten_snapshots_are_read_again(spark, tmp_path):
    src = str(tmp_path / "ref")
    put(f"{src}/x.csv", "id,amount,day\n1,1,2024-01-01\n")
    rows, ledger = files.snapshot(spark, src, SCHEMA, None)
    assert rows.count() == 1
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    assert files.snapshot(spark, src, SCHEMA, ledger)[0].count() == 0
    time.sleep(1.1)
    put(f"{src}/x.csv", "id,amount,day\n2,1,2024-01-01\n3,1,2024-01-01\n")
    assert sorted(r["id"] for r in files.snapshot(spark, src, SCHEMA, ledger)[0].collect()) == [2, 3]


def test_crosswalk(spark, tmp_path):
    path = str(tmp_path / "x.json")
    assert files.crosswalk(spark, path).collect() == []
    put(path, '{"meta": {},\n "accounts": {"k1": {"crm_account_id": "A1", "erp_customer_id": "C1"}, "k2": {"crm_account_id": "A2", "in_erp": false}}}')
    assert [tuple(r) for r in files.crosswalk(spark, path).collect()] == [("A1", "C1")]


def test_binary_stream_and_listing(spark, tmp_path):
    for n in ("a.pdf", "b.PDF", "c.txt"):
        put(str(tmp_path / "in" / n), n)
    flows.drain(files.binary_stream(spark, str(tmp_path / "in")), str(tmp_path / "mark"), str(tmp_path / "out"))
    assert sorted(bytes(r["content"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [b"a.pdf", b"b.PDF"]
    assert files.listing(spark, str(tmp_path / "in")).count() == 3


def test_jdbc(spark):
    url = {"url": "jdbc:derby:memory:crm;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(20).selectExpr("cast(id as int) AS id", "id * 2 AS v").write.format("jdbc").options(**url).option("dbtable", "accounts").mode("overwrite").save()
    df = jdbc.bronze_table(spark, "accounts", url)
    assert df.count() == 20 and df.first()["_source"] == "jdbc"
    assert jdbc.read_table(spark, "accounts", url, "id", (0, 20), 4).rdd.getNumPartitions() == 4


def test_history_by_stream(spark, tmp_path):
    table = flows.HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq")
    batch = lambda *rows: spark.createDataFrame(list(rows), "id string, seq int, v string")
    table.apply(batch(("a", 1, "x"), ("a", 3, "z"), ("b", 1, "q")))
    table.apply(batch(("a", 2, "y")))  # late
    table.apply(batch(("a", 2, "y")))  # replayed
    got = sorted((r["id"], r["__START_AT"], r["__END_AT"] or 0, r["v"]) for r in table.read().collect())
    assert got == [("a", 1, 2, "x"), ("a", 2, 3, "y"), ("a", 3, 0, "z"), ("b", 1, 0, "q")]
    batch(("c", 1, "n")).write.parquet(str(tmp_path / "s"))
    table.follow(spark.readStream.schema("id string, seq int, v string").parquet(str(tmp_path / "s")), str(tmp_path / "mark"))
    assert table.read().count() == 5


def test_history_outlives_its_driver(spark, tmp_path):
    new = lambda: flows.HistoryTable(spark, str(tmp_path / "t"), ["id"], "seq", buckets=4)
    put = lambda name, *rows: spark.createDataFrame(list(rows), "id string, seq int, v string").write.parquet(str(tmp_path / "s" / name))
    stream = lambda: spark.readStream.schema("id string, seq int, v string").option("recursiveFileLookup", True).parquet(str(tmp_path / "s"))
    state = lambda t: sorted((r["id"], r["__START_AT"], r["__END_AT"] or 0, r["v"]) for r in t.read().collect())
    put("1", ("a", 1, "x"), ("b", 1, "q"))
    new().follow(stream(), str(tmp_path / "mark"))
    put("2", ("a", 3, "z"))
    put("3", ("a", 2, "y"), ("a", 2, "y"))
    again = new()
    again.follow(stream(), str(tmp_path / "mark"))
    want = [("a", 1, 2, "x"), ("a", 2, 3, "y"), ("a", 3, 0, "z"), ("b", 1, 0, "q")]
    assert state(new()) == want
    replay = spark.createDataFrame([("b", 0, "replayed")], "id string, seq int, v string")
    again.apply(replay, 0)
    assert state(new()) == want
    # a record that its writer didn't finish is passed over
    os.makedirs(tmp_path / "t" / "_ledger", exist_ok=True)
    (tmp_path / "t" / "_ledger" / f"{99:020d}.json").write_text('{"batch": 7, "pla')
    assert state(new()) == want
    again.refresh(stream(), str(tmp_path / "mark"))
    assert state(new()) == want
    live = flows.current_stream(stream(), flows.HistoryTable(spark, str(tmp_path / "t1"), ["id"], "seq"), str(tmp_path / "mark1"), F.col("v") == "q", ("seq",))
    assert [tuple(r) for r in live.collect()] == [("a", "z")]


def test_full_refresh_of_a_drained_table(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "s"))
    stream = lambda: spark.readStream.schema("id long").parquet(str(tmp_path / "s"))
    for _ in range(2):
        flows.refill(spark, stream(), str(tmp_path / "mark"), str(tmp_path / "out"))
    flows.drain(stream(), str(tmp_path / "mark"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_stream_static_join_doesnt_multiply(spark, tmp_path):
    spark.createDataFrame([("p1", "d1"), ("p2", "d9")], "p string, division string").write.parquet(str(tmp_path / "s"))
    static = spark.createDataFrame([("d1", "c1"), ("d1", "c2")], "division string, category string")
    stream = spark.readStream.schema("p string, division string").parquet(str(tmp_path / "s"))
    flows.drain(flows.enrich(stream, static, "division"), str(tmp_path / "mark"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sessions_and_windows(spark, tmp_path):
    t = dt.datetime
    spark.createDataFrame([(1, "view", t(2024, 1, 1, 0, 0)), (1, "view", t(2024, 1, 1, 0, 10)), (1, "view", t(2024, 1, 1, 2, 0)), (2, "click", t(2024, 1, 1, 0, 5))], "user_id int, event_type string, ts timestamp_ntz").write.parquet(str(tmp_path / "s"))
    stream = lambda: spark.readStream.schema("user_id int, event_type string, ts timestamp_ntz").parquet(str(tmp_path / "s"))
    for name, df in (("w", flows.windowed_counts(stream())), ("n", flows.sessions(stream()))):
        df.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["event_type"], r["count"]) for r in spark.table("w").collect()) == [("click", 1), ("view", 1), ("view", 2)]
    assert sorted((r["user_id"], r["events"]) for r in spark.table("n").collect()) == [(1, 1), (1, 2), (2, 1)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", "", 1), ("2024-01-02", "b", 2)], "dt string, s string, n int")
    sinks.write_dated(df, str(tmp_path / "csv"))
    assert sorted(p for p in os.listdir(tmp_path / "csv") if p.startswith("dt=")) == ["dt=2024-01-01", "dt=2024-01-02"]
    assert sinks.nulls_for_empty(df).first()["s"] is None
    place = sinks.rewrite(spark, str(tmp_path / "t"), df)
    again = sinks.rewrite(spark, str(tmp_path / "t"), spark.read.parquet(place).where("n = 1"))
    assert spark.read.parquet(place).count() == 2 and spark.read.parquet(again).count() == 1
