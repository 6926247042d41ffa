"""Parsed documents: elements of parse results, pages, dead letters, versions of contracts, and merging of chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contract_id, contract_type, counterparty, effective_date, expiry_date, mask_pii
from .relational import delete_within, update_where, upsert

RESULT = "struct<document:struct<elements:array<struct<content:string,bbox:array<struct<page_id:int>>>>>,pages:array<struct<page_number:int,text:string,content:string>>,text:string>"


def elements(result: Column | str) -> Column:
    """Array of (text, page) of a parse result in JSON: its elements, else its pages, else its text; null for any other shape."""
    r = F.from_json(F.col(result) if isinstance(result, str) else result, RESULT)
    from_elements = F.transform(r["document"]["elements"], lambda e: F.struct(e["content"].alias("text"), (F.coalesce(F.get(e["bbox"], F.lit(0))["page_id"], F.lit(0)) + 1).alias("page")))
    from_pages = F.transform(r["pages"], lambda p, i: F.struct(F.coalesce(p["text"], p["content"]).alias("text"), F.coalesce(p["page_number"], i + 1).alias("page")))
    from_text = F.when(r["text"].isNotNull(), F.array(F.struct(r["text"].alias("text"), F.lit(1).alias("page"))))
    usable = [F.when(F.size(F.filter(x, lambda e: F.length(F.trim(F.coalesce(e["text"], F.lit("")))) > 0)) > 0, F.filter(x, lambda e: F.length(F.trim(F.coalesce(e["text"], F.lit("")))) > 0)) for x in (from_elements, from_pages, from_text)]
    return F.coalesce(*usable)


def joined_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda e: e["text"]), "\n\n")


def page_map(found: Column) -> Column:
    """(start, page) of each element in the joined text; two line feeds lie between elements."""
    zero = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<start:int,page:int>>").alias("at"))
    step = lambda a, e: F.struct((a["next"] + F.char_length(e["text"]) + 2).alias("next"), F.concat(a["at"], F.array(F.struct(a["next"].alias("start"), e["page"].cast("int").alias("page")))).alias("at"))
    return F.aggregate(found, zero, step, lambda a: a["at"])


def page_at(pages: Column, offset: Column) -> Column:
    """The page of a character offset; 1 without pages."""
    before = F.filter(pages, lambda p: p["start"] <= offset)
    return F.coalesce(F.element_at(F.when(F.size(before) > 0, before), -1)["page"], F.get(pages, F.lit(0))["page"], F.lit(1))


def page_of_chunk(text: Column, chunk: Column, pages: Column, probe: int = 80) -> Column:
    """The page of a chunk's middle: 80 characters from there are looked up in the text, else its last 80; what can't be found is on the first page."""
    half = F.floor(F.char_length(chunk) / 2).cast("int")
    middle, tail = F.instr(text, F.substring(chunk, half + 1, F.lit(probe))), F.instr(text, F.right(chunk, F.lit(probe)))
    return page_at(pages, F.when(middle > 0, middle - 1).when(tail > 0, tail - 1).otherwise(0))


def parsed(files: DataFrame, result: str = "result") -> tuple[DataFrame, DataFrame]:
    """Files with ``elements``, and dead letters (source_file, error): no file is lost."""
    out = files.withColumn("elements", elements(result))
    bad = out.where("elements IS NULL").select("source_file", F.left(F.concat(F.lit("no text in parse result: "), F.coalesce(result, F.lit("null"))), F.lit(1000)).alias("error"))
    return out.where("elements IS NOT NULL"), bad


def contract_metadata(df: DataFrame, file: str = "source_file", text: str = "text") -> DataFrame:
    """``df`` with contract_id, counterparty, contract_type, effective_date and expiry_date, taken from the raw text, and the text masked."""
    return df.withColumns({"contract_id": contract_id(file, text), "counterparty": counterparty(text), "contract_type": contract_type(file, text), "effective_date": effective_date(text), "expiry_date": expiry_date(text)}).withColumn(text, mask_pii(text))


def unprocessed(files: DataFrame, done: DataFrame, failed: DataFrame, key: str = "source_file") -> DataFrame:
    """Files that neither gave chunks nor failed before."""
    return files.join(done.select(key).union(failed.select(key)).distinct(), key, "left_anti")


def amendments(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """(contract_id, new_version) of contracts that are known and come in from a file not seen with them; both frames have contract_id and source_file, ``current`` also version."""
    fresh = incoming.where("contract_id IS NOT NULL").select("contract_id", "source_file").distinct().join(current.where("contract_id IS NOT NULL").select("contract_id", "source_file").distinct(), ["contract_id", "source_file"], "left_anti")
    known = current.where("contract_id IS NOT NULL").groupBy("contract_id").agg((F.max(F.coalesce("version", F.lit(1))) + 1).alias("new_version"))
    return known.join(fresh.select("contract_id").distinct(), "contract_id", "left_semi")


def merge_chunks(gold: DataFrame, silver: DataFrame) -> DataFrame:
    """Gold chunks after a run: amended contracts' old chunks are retired, chunks of new files come in with the contract's new version, and a known file that was parsed again has just the chunks of its new parse, in the version it had.

    Staging just the files that gold hasn't seen keeps a second run from bringing
    retired versions back.
    """
    bump = amendments(gold, silver)  # retired files count as seen
    new_files = silver.join(gold.select("source_file").distinct(), "source_file", "left_anti")
    staged = new_files.join(bump, "contract_id", "left").withColumn("version", F.coalesce("new_version", "version", F.lit(1))).withColumn("is_current", F.lit(True)).select(*gold.columns)
    retired = update_where(gold.join(bump.withColumnRenamed("contract_id", "_c"), gold["contract_id"] == F.col("_c"), "left"), F.col("new_version").isNotNull(), is_current=F.lit(False)).select(*gold.columns)
    # a known file's chunks keep its version and state, also those that its last parse didn't have
    state = retired.groupBy("source_file").agg(F.max(F.coalesce("version", F.lit(1))).alias("_version"), F.max("is_current").alias("_current"))
    known = silver.join(state, "source_file").withColumn("version", F.col("_version")).withColumn("is_current", F.col("_current"))
    columns = [c for c in gold.columns if c in known.columns]
    kept = delete_within(retired, known, "source_file", "chunk_id")
    refresh = [c for c in columns if c not in ("chunk_id", "version", "is_current")]
    refreshed = upsert(kept, known.select(*columns), ["chunk_id"], refresh)
    return upsert(refreshed, staged, ["chunk_id"])


def changed_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files whose content hash is new: (source_file, content_hash) not in ``seen``."""
    return files.join(seen.select("source_file", "content_hash"), ["source_file", "content_hash"], "left_anti")
