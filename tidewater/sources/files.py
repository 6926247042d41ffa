"""File sources: incremental CSV, snapshots that may be overwritten, rescued data, binary files, crosswalk JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued_data"


def landing(root: str, system: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{system}/{entity}"


def as_strings(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def conform(raw: DataFrame, schema: StructType) -> DataFrame:
    """Columns cast to the declared types; what can't be cast, and columns that aren't declared, go to ``_rescued_data`` as JSON (null if there is nothing)."""
    declared = {f.name: f.dataType for f in schema.fields}
    misfit = {n: F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), F.col(n)) for n, t in declared.items() if n in raw.columns}
    extra = {n: F.col(n).cast("string") for n in raw.columns if n not in declared and not n.startswith("_") and n != "dt"}
    odd = {**misfit, **extra}
    rescued = F.to_json(F.struct(*[c.alias(n) for n, c in odd.items()])) if odd else F.lit(None).cast("string")
    typed = [F.col(n).try_cast(t).alias(n) if n in raw.columns else F.lit(None).cast(t).alias(n) for n, t in declared.items()]
    kept = [c for c in raw.columns if c.startswith("_") or c == "dt"]
    return raw.select(*typed, F.when(rescued != "{}", rescued).alias(RESCUED), *kept)


def with_audit(df: DataFrame, system: str, batch_id: str | None = None) -> DataFrame:
    """``df`` with the columns that say when, whence and in which batch a row came."""
    batch = F.lit(batch_id) if batch_id else F.date_format(F.current_date(), "yyyy-MM-dd")
    rescued = {} if RESCUED in df.columns else {RESCUED: F.lit(None).cast("string")}
    return df.withColumns(rescued | {"_ingested_at": F.current_timestamp(), "_batch_id": batch, "_source_system": F.lit(system)})


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Columns of a CSV file or folder, by its header; no row is read."""
    return spark.read.option("header", True).option("recursiveFileLookup", True).csv(path).columns


def csv_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New CSV files below ``path``, once each; a file that is overwritten in place isn't read again.  Undeclared columns must be in ``schema`` to be read; see :func:`evolved`."""
    reader = spark.readStream.schema(as_strings(schema)).option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path).withColumn("_source_file", F.col("_metadata.file_path"))


def evolved(schema: StructType, columns: list[str]) -> StructType:
    """The stored schema with columns not seen before, as strings, at its end."""
    known = set(schema.fieldNames())
    return StructType([*schema.fields, *[StructField(c, StringType()) for c in columns if c not in known]])


def snapshot(spark: SparkSession, path: str, schema: StructType, ledger: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows of files whose (path, modification time) isn't in the ledger, and those files' ledger rows; so an overwritten snapshot is read again."""
    listed = listing(spark, path).select(F.col("path").alias("_source_file"), F.col("modificationTime").alias("_modified"))
    fresh = listed if ledger is None else listed.join(ledger, ["_source_file", "_modified"], "left_anti")
    paths = [r["_source_file"] for r in fresh.collect()]  # names of files that landed since the last run
    reader = spark.read.schema(as_strings(schema)).option("header", True)
    raw = reader.csv(paths) if paths else spark.createDataFrame([], as_strings(schema))
    raw = raw.withColumn("_source_file", F.col("_metadata.file_path") if paths else F.lit(None).cast("string"))
    return conform(raw, schema), fresh


def binary_stream(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """Files as (path, modificationTime, length, content), those there already and new ones."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime", "length")


CROSSWALK = "meta struct<generated:string>, accounts map<string,struct<company_name:string,crm_account_id:string,erp_customer_id:string,country:string,in_erp:boolean>>"


def crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """(crm_account_id, erp_customer_id) of a crosswalk document; a missing file is an empty crosswalk."""
    try:
        doc = spark.read.option("multiLine", True).schema(CROSSWALK).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "crm_account_id string, erp_customer_id string")
    return doc.select(F.explode("accounts").alias("key", "a")).select("a.crm_account_id", "a.erp_customer_id").where("crm_account_id IS NOT NULL AND erp_customer_id IS NOT NULL")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
