"""Tables of a relational database."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, table: str, options: dict[str, str], split_by: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A table snapshot; filters and columns are pushed down.  With ``split_by`` and its bounds it is read by ``parts`` connections instead of one."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split_by and bounds:
        reader = reader.options(partitionColumn=split_by, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def bronze_table(spark: SparkSession, table: str, options: dict[str, str], **split) -> DataFrame:
    """The snapshot with its audit columns."""
    return read_table(spark, table, options, **split).withColumns({"_ingested_at": F.current_timestamp(), "_source_system": F.lit("crm"), "_source": F.lit("jdbc")})


def upsert_statement(table: str, staged: str, columns: list[str], keys: list[str], dialect: str = "merge", stamp: str | None = None) -> str:
    """One statement that merges a staged table, which has a row a key, into a table: standard MERGE, or ``on_conflict`` for databases that have that."""
    rest = [c for c in columns if c not in keys]
    now = [f"{stamp} = CURRENT_TIMESTAMP"] if stamp else []
    names, values = ", ".join([*columns, *([stamp] if stamp else [])]), [*columns, *(["CURRENT_TIMESTAMP"] if stamp else [])]
    if dialect == "on_conflict":
        sets = ", ".join([*[f"{c} = EXCLUDED.{c}" for c in rest], *now])
        return f"INSERT INTO {table} ({names}) SELECT {', '.join(values)} FROM {staged} ON CONFLICT ({', '.join(keys)}) DO " + (f"UPDATE SET {sets}" if sets else "NOTHING")
    sets = ", ".join([*[f"{c} = s.{c}" for c in rest], *now])
    own = ", ".join(v if v == "CURRENT_TIMESTAMP" else f"s.{v}" for v in values)
    return f"MERGE INTO {table} t USING {staged} s ON {' AND '.join(f't.{k} = s.{k}' for k in keys)}" + (f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else "") + f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({own})"


def _transaction(spark: SparkSession, options: dict[str, str], work):
    """``work(statement)`` in one transaction on a connection of the driver's."""
    jvm = spark._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    at = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in options:
            at.setProperty(k, options[k])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], at)
    try:
        connection.setAutoCommit(False)
        out = work(connection.createStatement())
        connection.commit()
        return out
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


#: The database's own ledger of batches.
LEDGER = "batches_seen"


def _last(statement, stream: str) -> int:
    found = statement.executeQuery(f"SELECT batch FROM {LEDGER} WHERE stream = '{stream}'")
    return found.getLong(1) if found.next() else -1


def upsert(df: DataFrame, table: str, options: dict[str, str], keys: list[str], stream: str, batch_id: int, dialect: str = "merge", stamp: str | None = None) -> bool:
    """Merge ``df`` into a database's table, each batch of a stream exactly once; returns whether this one was still to do.

    Partitions write to a staging table of the stream's, as often as tasks are
    tried.  Then one transaction merges what is distinct there and notes the batch:
    a batch that comes again, or whose driver was lost on the way, changes nothing
    twice.  Only columns that the table has are taken, empty texts as nulls.  A null
    or repeated key makes the batch fail, and nothing is merged.  ``stream`` is a
    name of letters, digits and underscores.
    """
    if not re.fullmatch(r"\w{1,60}", stream):
        raise ValueError(f"not a stream's name: {stream}")
    spark = df.sparkSession
    have = {c.lower(): c for c in read_table(spark, table, options).columns}
    own = [c for c in df.columns if c.lower() in have and c.lower() != (stamp or "").lower()]
    if missing := [k for k in keys if k.lower() not in {c.lower() for c in own}]:
        raise ValueError(f"no column for the keys {missing}")
    columns, keys = [have[c.lower()] for c in own], [have[k.lower()] for k in keys]
    staged = f"{table}_in_{stream}"

    def prepare(s) -> int:
        tables, there = s.getConnection().getMetaData().getTables(None, None, None, None), set()
        while tables.next():
            there.add(tables.getString("TABLE_NAME").lower())
        if LEDGER not in there:
            s.executeUpdate(f"CREATE TABLE {LEDGER} (stream VARCHAR(60) NOT NULL PRIMARY KEY, batch BIGINT NOT NULL)")
        for old in (staged, f"{staged}_once"):  # left by a driver that was lost
            if old.lower() in there:
                s.executeUpdate(f"DROP TABLE {old}")
        last = _last(s, stream)
        for name in (staged, f"{staged}_once") if last < batch_id else ():
            s.executeUpdate(f"CREATE TABLE {name} AS SELECT {', '.join(columns)} FROM {table} WITH NO DATA")
        return last

    if _transaction(spark, options, prepare) >= batch_id:
        return False
    # a null text goes as an empty one, which is no value here: some drivers can't bind a null to a VARCHAR
    texts = {b for a, b in zip(own, columns, strict=True) if df.schema[a].dataType.simpleString() == "string"}
    rows = df.select(*[(F.coalesce(F.col(f"`{a}`"), F.lit("")) if b in texts else F.col(f"`{a}`")).alias(b) for a, b in zip(own, columns, strict=True)])
    counted = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    wrong = F.col("_n") > 1
    for k in keys:
        wrong |= F.col(k).isNull() | (F.col(k).cast("string") == "")
    bad = F.raise_error(F.concat(F.lit("a null or repeated key: "), F.to_json(F.struct(*keys)))).cast("boolean")
    counted.where(F.when(wrong, bad).otherwise(True)).drop("_n").write.format("jdbc").options(**options).option("dbtable", staged).mode("append").save()

    def merge(s) -> bool:
        if _last(s, stream) >= batch_id:
            return False
        values = ", ".join(f"NULLIF({c}, '')" if c in texts else c for c in columns)
        s.executeUpdate(f"INSERT INTO {staged}_once SELECT DISTINCT {values} FROM {staged}")
        s.executeUpdate(upsert_statement(table, f"{staged}_once", columns, keys, dialect, stamp))
        if s.executeUpdate(f"UPDATE {LEDGER} SET batch = {int(batch_id)} WHERE stream = '{stream}'") == 0:
            s.executeUpdate(f"INSERT INTO {LEDGER} VALUES ('{stream}', {int(batch_id)})")
        for name in (staged, f"{staged}_once"):
            s.executeUpdate(f"DROP TABLE {name}")
        return True

    return _transaction(spark, options, merge)
