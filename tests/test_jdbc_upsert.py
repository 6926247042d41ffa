import os

import pytest
from pyspark.sql import functions as F

from tidewater.sources import jdbc

URL = {"url": "jdbc:derby:memory:upserts;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module", autouse=True)
def accounts(spark):
    def make(s):
        s.executeUpdate("CREATE TABLE accounts (id INT NOT NULL PRIMARY KEY, name VARCHAR(40), amount DOUBLE, updated_at TIMESTAMP)")
        s.executeUpdate("INSERT INTO accounts VALUES (1, 'one', 1.0, NULL), (2, 'two', 2.0, NULL)")

    jdbc._transaction(spark, URL, make)


def told(spark):
    return sorted((tuple(r)[:3], r[3] is not None) for r in jdbc.read_table(spark, "accounts", URL).collect())


def tables(spark):
    def names(s):
        found, out = s.getConnection().getMetaData().getTables(None, "APP", None, None), set()
        while found.next():
            out.add(found.getString("TABLE_NAME").lower())
        return out

    return jdbc._transaction(spark, URL, names)


def test_a_batch_counts_once_though_its_task_failed_first(spark, tmp_path):
    rows = spark.createDataFrame([(2, "", 2.5, "x"), (3, "three", None, "y"), (4, "four", 4.0, "z")], "ID int, name string, amount double, extra string")
    mark = str(tmp_path / "failed")

    @F.udf("double")
    def once(v):
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("lost on purpose")
        return v

    before = told(spark)
    with pytest.raises(Exception, match="lost on purpose"):
        jdbc.upsert(rows.repartition(3).withColumn("amount", once("amount")), "accounts", URL, ["id"], "crm", 0, stamp="updated_at")
    assert told(spark) == before
    assert jdbc.upsert(rows.repartition(3).withColumn("amount", once("amount")), "accounts", URL, ["id"], "crm", 0, stamp="updated_at")
    want = [((1, "one", 1.0), False), ((2, None, 2.5), True), ((3, "three", None), True), ((4, "four", 4.0), True)]
    assert told(spark) == want
    # the same batch again, and an older one, change nothing; another stream has numbers of its own
    changed = rows.withColumn("name", F.lit("other"))
    assert not jdbc.upsert(changed, "accounts", URL, ["id"], "crm", 0) and told(spark) == want
    assert jdbc.upsert(changed.where("ID = 3"), "accounts", URL, ["id"], "erp", 0)
    assert [r for r in told(spark) if r[0][0] == 3] == [((3, "other", None), True)]
    assert tables(spark) == {"accounts", jdbc.LEDGER}


def test_a_driver_lost_before_the_merge_is_made_good(spark, monkeypatch):
    rows = spark.createDataFrame([(7, "seven", 7.0)], "id int, name string, amount double")
    with monkeypatch.context() as m:
        m.setattr(jdbc, "upsert_statement", lambda *_: "NOT SQL")
        with pytest.raises(Exception):
            jdbc.upsert(rows, "accounts", URL, ["id"], "late", 5)
    assert "accounts_in_late" in tables(spark) and 7 not in {r[0][0] for r in told(spark)}
    assert jdbc.upsert(rows.union(rows).distinct(), "accounts", URL, ["id"], "late", 5) and 7 in {r[0][0] for r in told(spark)}
    assert jdbc.upsert(rows.limit(0), "accounts", URL, ["id"], "late", 6) and not jdbc.upsert(rows, "accounts", URL, ["id"], "late", 6)


def test_null_or_repeated_keys_fail_whole(spark):
    before = told(spark)
    for bad in ([(8, "a", 1.0), (8, "b", 1.0)], [(None, "a", 1.0), (9, "b", 1.0)]):
        with pytest.raises(Exception, match="null or repeated key"):
            jdbc.upsert(spark.createDataFrame(bad, "id int, name string, amount double"), "accounts", URL, ["id"], "bad", 1)
    assert told(spark) == before
    with pytest.raises(ValueError, match="keys"):
        jdbc.upsert(spark.createDataFrame([("x",)], "name string"), "accounts", URL, ["id"], "bad", 1)
    with pytest.raises(ValueError, match="name"):
        jdbc.upsert(spark.createDataFrame([(1,)], "id int"), "accounts", URL, ["id"], "it's", 1)


def test_statements():
    assert jdbc.upsert_statement("t", "s", ["k", "v"], ["k"], "on_conflict", "at") == "INSERT INTO t (k, v, at) SELECT k, v, CURRENT_TIMESTAMP FROM s ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v, at = CURRENT_TIMESTAMP"
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"], "on_conflict") == "INSERT INTO t (k) SELECT k FROM s ON CONFLICT (k) DO NOTHING"
    assert jdbc.upsert_statement("t", "s", ["k"], ["k"]) == "MERGE INTO t t USING s s ON t.k = s.k WHEN NOT MATCHED THEN INSERT (k) VALUES (s.k)"
