"""Versioned tables and their change feeds: what was inserted, updated and deleted between two versions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.sinks import Ledger, delete_folder
from ..staging import written

CHANGE, VERSION = "_change", "_version"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"
#: So many changed keys can be sent to all tasks, or so many marks of 4 kB, each for 32,768 rows of a file.
FEW, MARKS = 200_000, 16_384


def quoted(columns: Iterable[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def row_hashes(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of the columns; nulls count, as does which column a value is in."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()}
    own = [F.to_json(F.struct(c)) if n in maps else c for n, c in zip(columns, quoted(columns), strict=True)]
    marks = [c.isNull() for c in own]
    return [F.xxhash64(*own, *marks).alias("_h1"), F.xxhash64(F.lit(1), *own, *marks).alias("_h2")]


def _placed(df: DataFrame) -> DataFrame:
    """``df``, read from Parquet files, with each row's place: its file's hash, and its number there."""
    at = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(at["file_path"]).alias("_place_file"), at["row_index"].alias("_place_row"))


def _marks(changed: DataFrame, side: int) -> DataFrame:
    """(_file, _block, _kind, _bits): for each kind of change and 32,768 rows of a file on one side, a bit for each row that has it."""
    at = changed.select("_kind", F.col(f"_place_file_{side}").alias("_file"), (F.col(f"_place_row_{side}") + 1).alias("_number"))  # bitmaps count from 1
    return at.groupBy("_file", F.bitmap_bucket_number("_number").alias("_block"), "_kind").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_bits"))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows whose bit is set, with the kind of their change; a row has one kind at most."""
    number = F.col("_place_row") + 1
    bit = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    same = (F.col("_place_file") == F.col("_file")) & (F.bitmap_bucket_number(number) == F.col("_block"))
    return rows.join(F.broadcast(marks), same).where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)


def diff(before: DataFrame | None, after: DataFrame, keys: list[str], version: int | None = None, placed: bool = False) -> DataFrame:
    """The change feed from ``before`` to ``after``: the columns of ``after`` with ``_change`` and, if given, ``_version``.

    A key that only ``after`` has is an insert, one that only ``before`` has a
    delete (with the row that went), and a key whose rows differ in any column
    gives the row before and the row after.  Null keys meet each other.  Rows are
    compared by two 64-bit hashes: keys and hashes are shuffled at once, which says
    what changed.  Up to FEW changed keys go to the rows, which then stay where they
    are.  Of more, rows that are ``placed``, which is to say read from Parquet files as
    they are, get up to MARKS marks, a bit a row; others are joined by shuffling.  A
    column that ``before`` lacks counts as null there, one that ``after`` lacks isn't compared.  A key must be unique in either
    version; a repeated one makes the feed fail when it runs.  Without ``before``
    every row is an insert.
    """
    told = [F.lit(version).cast("long").alias(VERSION)] if version is not None else []
    if before is None:
        return after.select("*", F.lit(INSERT).alias(CHANGE), *told)
    kinds = {f.name: f.dataType for f in after.schema.fields}
    have = set(before.columns)
    place = ["_place_file", "_place_row"] if placed else []
    before, after, columns = *((_placed(before), _placed(after)) if placed else (before, after)), after.columns
    before = before.select(*place, *[F.col(f"`{n}`").cast(t).alias(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in kinds.items()])
    rest = [c for c in columns if c not in keys]

    def hashed(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.struct(*quoted(keys)).alias("_k"), F.lit(side).alias("_side"), *place, *row_hashes(df, rest))

    several = F.raise_error(F.concat(F.lit("several rows of one version for the key "), F.to_json("_k")))
    own = lambda side, h: F.max(F.when(F.col("_side") == side, F.col(h)))
    count = lambda side: F.count_if(F.col("_side") == side)
    both = hashed(before, 0).unionByName(hashed(after, 1)).groupBy("_k").agg(count(0).alias("_n0"), count(1).alias("_n1"), *[own(s, h).alias(f"{h}_{s}") for s in (0, 1) for h in ("_h1", "_h2", *place)])
    kind = F.when((F.col("_n0") > 1) | (F.col("_n1") > 1), several).when(F.col("_n0") == 0, INSERT).when(F.col("_n1") == 0, DELETE).when((F.col("_h1_0") != F.col("_h1_1")) | (F.col("_h2_0") != F.col("_h2_1")), "update")
    changed = written(both.select("_k", kind.alias("_kind"), *[f"{p}_{s}" for s in (0, 1) for p in place]).where("_kind is not null"))
    few = changed.count() <= FEW
    if few:
        changed = F.broadcast(changed)
    sides = ((before, {"update": BEFORE, DELETE: DELETE}), (after, {"update": AFTER, INSERT: INSERT}))
    out = None
    for side, (df, names) in enumerate(sides):
        mine = changed.where(F.col("_kind").isin(*names))
        same = [df[k].eqNullSafe(F.col(f"_k.{k}")) for k in keys]
        marks = written(_marks(mine, side)) if placed and not few else None
        found = df.join(mine, same) if marks is None or marks.count() > MARKS else _marked(df, marks)
        rows = found.select(*quoted(columns), F.when(F.col("_kind") == "update", F.lit(names["update"])).otherwise(F.col("_kind")).alias(CHANGE), *told)
        out = rows if out is None else out.unionByName(rows)
    return out


def apply_feed(base: DataFrame | None, feed: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` after the changes of a feed between two versions, which has a key at most once after its change."""
    rows = feed.where(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE, VERSION)
    if base is None:
        return rows
    touched = feed.select(*[c.alias(f"_k{i}") for i, c in enumerate(quoted(keys))]).distinct()
    kept = base.join(touched, [base[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


class VersionedTable:
    """A table of which every version stays readable, numbered from 1, with the change feed between any two.

    A ledger says where each version is, so a version takes effect at once or not
    at all; ``vacuum`` deletes the files of old ones.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    def _versions(self) -> dict[str, str]:
        return self.ledger.last().get("versions", {})

    @property
    def version(self) -> int:
        """The latest version's number; 0 if there is none."""
        return max(map(int, self._versions()), default=0)

    def write(self, df: DataFrame) -> int:
        """The next version, and its number; ``df`` may read earlier ones."""
        place = f"{self.path}/v={uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(place)
        versions = self._versions()
        number = max(map(int, versions), default=0) + 1
        schemas = self.ledger.last().get("schemas", {}) | {str(number): df.schema.json()}
        self.ledger.put({"versions": versions | {str(number): place}, "schemas": schemas})
        return number

    def read(self, version: int | None = None) -> DataFrame:
        state = self.ledger.last()
        number = str(self.version if version is None else version)
        if number not in state.get("versions", {}):
            raise ValueError(f"{self.path} has no version {number}")
        return self.spark.read.schema(StructType.fromJson(json.loads(state["schemas"][number]))).parquet(state["versions"][number])

    def changes(self, since: int, until: int | None = None, each: bool = False) -> DataFrame:
        """The feed from one version to a later one (0: from nothing): the net changes, or with ``each`` those of every version on the way."""
        until = self.version if until is None else until
        if each:
            steps = [n for n in sorted(map(int, self._versions())) if since <= n <= until]
            steps = [since, *[n for n in steps if n > since]]
            feeds = [diff(self.read(a) if a else None, self.read(b), self.keys, b, placed=True) for a, b in zip(steps, steps[1:], strict=False)]
            out = feeds[0] if feeds else diff(self.read(until), self.read(until), self.keys, until)
            for f in feeds[1:]:
                out = out.unionByName(f, allowMissingColumns=True)
            return out
        return diff(self.read(since) if since else None, self.read(until), self.keys, until, placed=True)

    def vacuum(self, keep: int) -> None:
        """Delete all versions before number ``keep``."""
        state = self.ledger.last()
        old = {n: p for n, p in state.get("versions", {}).items() if int(n) < keep}
        self.ledger.put({k: {n: x for n, x in state[k].items() if n not in old} for k in ("versions", "schemas")})
        for place in old.values():
            delete_folder(self.spark, place)


class Consumer:
    """A reader of a table's changes that keeps the version it has seen, so that each change reaches it once."""

    def __init__(self, spark: SparkSession, path: str, table: VersionedTable):
        self.table, self.ledger = table, Ledger(spark, path)

    @property
    def seen(self) -> int:
        return self.ledger.last().get("seen", 0)

    def poll(self, take) -> int:
        """Hand the net changes since the version seen to ``take(feed, version)``, then note the new one; returns it.

        The feed is worked out each time that ``take`` runs something on it.  If
        ``take`` fails nothing is noted, and the next poll gives the same changes
        again, so it should change nothing when it gets a version twice.
        """
        last, seen = self.table.version, self.seen
        if last > seen:
            take(self.table.changes(seen, last), last)
            self.ledger.put({"seen": last})
        return last
