"""Registered queries over what is kept up in steps: search indexes, change feeds, file states and histories, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .more_queries import ORACLES as SCANS
from .more_queries import QUERY_TEXT, QUERY_VECTOR
from .operators import lifecycle, vectors
from .operators.feed import Consumer, VersionedTable
from .operators.index import ChunkIndex
from .operators.relational import latest
from .plans.registry import Context
from .staging import place
from .streaming import flows


def _index(ctx: Context) -> ChunkIndex:
    """An index of all documents with the vectors of their number, after three syncs: half-written texts, missing and withdrawn documents come first."""
    docs = ctx.read("documents").select("doc_id", "text", "lang").join(ctx.read("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label"), "doc_id", "left")
    table = VersionedTable(ctx.spark, place(ctx.spark), ["doc_id"])
    index = ChunkIndex(ctx.spark, place(ctx.spark), "doc_id", "text", "embedding", None, ("label",))
    consumer = Consumer(ctx.spark, place(ctx.spark), table)
    half = F.when(F.col("lang") == "de", F.left("text", F.char_length("text") / 2)).otherwise(F.col("text"))
    for version in (docs.where("lang <> 'fr'").withColumn("text", half), docs.where("lang <> 'es'"), docs):
        table.write(version)
        consumer.poll(index.sync)
        table.vacuum(consumer.seen)  # only the version that the next feed starts from is needed
    return index


def index_keyword_topk(ctx: Context) -> DataFrame:
    return _index(ctx).keyword(QUERY_TEXT, 10)


def index_hybrid_topk(ctx: Context) -> DataFrame:
    return _index(ctx).hybrid(QUERY_VECTOR, QUERY_TEXT, 5, exact=True)


def _vector_index(ctx: Context) -> ChunkIndex:
    rows = ctx.read("embeddings").select("vec_id", "embedding", "label", F.lit(None).cast("string").alias("text"), F.lit("insert").alias("_change"))
    index = ChunkIndex(ctx.spark, place(ctx.spark), "vec_id", "text", "embedding", None, ("label",))
    index.sync(rows, 1)
    return index


def index_vector_topk(ctx: Context) -> DataFrame:
    return _vector_index(ctx).similar(QUERY_VECTOR, 10, where=F.col("label") < 5, exact=True)


def nearest_neighbours(ctx: Context) -> DataFrame:
    """The ten vectors nearest to each whose number is divisible by 100, among all."""
    rows = ctx.read("embeddings").select("vec_id", "embedding")
    asked = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("asked"), "embedding")
    return vectors.nearest(asked, rows, "asked", "vec_id", "embedding", 10)


def _clients_at(ctx: Context, day: str) -> DataFrame:
    """Each client's row after all changes before a day; those whose last change is a deletion are left out."""
    changes = ctx.read("client_changes").where(F.col("valid_at") < F.lit(day).cast("timestamp_ntz"))
    last = latest(changes, ["client_id"], F.desc("seq"), F.desc("change_id"))
    return last.where("op <> 'D'").select("client_id", "seq", "source", "segment", "city", "balance")


def change_feed_clients(ctx: Context) -> DataFrame:
    """What changed in the clients' table in March and April, from two stored versions."""
    table = VersionedTable(ctx.spark, place(ctx.spark), ["client_id"])
    for day in ("2024-03-01", "2024-05-01"):
        table.write(_clients_at(ctx, day).drop("seq"))
    return table.changes(1, 2).select("client_id", "source", "segment", "city", "balance", F.col("_change").alias("change"), F.col("_version").alias("version"))


def file_actions(ctx: Context) -> DataFrame:
    """Clients' records as files: the folder as of May, parsed as of April, merged as of March, indexed as of February.

    A record is a contract of its client's master, in the version of its last
    change; partners' records of May can't be parsed.
    """
    master = ctx.read("clients").select("client_id", F.col("master_id").cast("string").alias("contract_id"))

    def at(day: str) -> DataFrame:
        text = F.concat_ws("|", "segment", "city", "balance")
        return _clients_at(ctx, day).join(master, "client_id", "left").select(F.col("client_id").cast("string").alias("source_file"), "source", "contract_id", F.col("seq").cast("int").alias("version"), F.sha2(text, 256).alias("content_hash"))

    def chunks(day: str) -> DataFrame:
        """One chunk a file, and a second one for those from the web before April."""
        files = at(day)
        n = F.when((F.col("source") == "web") & F.lit(day < "2024-04-01"), 2).otherwise(1)
        each = files.withColumn("n", F.explode(F.sequence(F.lit(1), n)))
        return each.select("source_file", "content_hash", "contract_id", "version", F.concat_ws("-", "source_file", "n").alias("chunk_id"), F.col("content_hash").alias("text_hash"), F.lit(True).alias("is_current"))

    listing = at("2024-05-01")
    failures = listing.where("source = 'partner'")
    return lifecycle.reconcile(listing, chunks("2024-04-01"), failures, chunks("2024-03-01"), chunks("2024-02-01"))


def _stream_of(ctx: Context, table: str) -> DataFrame:
    """A given table as a stream; a pattern, so that it may be one file or a folder of them."""
    static = ctx.read(table)
    at = static.select("_metadata.file_path").head()
    if at is None:
        raise ValueError(f"{table} has no rows to follow")
    return ctx.spark.readStream.schema(static.schema).parquet(at[0].split(f"/{table}.parquet")[0] + f"/{table}.parque[t]")


def history_clients(ctx: Context) -> DataFrame:
    """All versions of all clients, kept by two streams with checkpoints of their own: deletions, and everything else."""
    table = flows.HistoryTable(ctx.spark, place(ctx.spark), ["client_id"], "seq", buckets=16)
    for deletions in (True, False):
        table.follow(_stream_of(ctx, "client_changes").where((F.col("op") == "D") == deletions), place(ctx.spark))
    return table.read().select("client_id", "change_id", "op", "segment", "city", "balance", F.col("__START_AT").alias("start_at"), F.col("__END_AT").alias("end_at"))


def stream_enriched_sales(ctx: Context) -> DataFrame:
    """Sales with their client's segment and nation, joined as they stream in and drained to a table."""
    static, at = ctx.read("clients").select("client_id", "segment", "nation_id"), place(ctx.spark)
    stream = _stream_of(ctx, "sales").select("sale_id", "client_id", "status", "total")
    flows.drain(flows.enrich(stream, static, "client_id"), f"{at}/_mark", f"{at}/rows")
    return ctx.spark.read.parquet(f"{at}/rows").select("sale_id", "client_id", "status", "total", "segment", "nation_id")


BUILDS = {f.__name__: f for f in (stream_enriched_sales, index_keyword_topk, index_hybrid_topk, index_vector_topk, nearest_neighbours, change_feed_clients, file_actions, history_clients)}


def _clients(day: str) -> str:
    return f"""(SELECT client_id, seq, source, segment, city, balance FROM (SELECT * FROM client_changes WHERE valid_at < TIMESTAMP '{day}'
  QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY seq DESC, change_id DESC) = 1) WHERE op <> 'D')"""


_FILES = """SELECT c.client_id::VARCHAR AS f, c.source, master_id::VARCHAR AS k, seq::INT AS v, sha256(concat_ws('|', c.segment, c.city, c.balance::DOUBLE)) AS h FROM {0} c LEFT JOIN clients USING (client_id)"""

ORACLES = {
    "stream_enriched_sales": "SELECT sale_id, s.client_id, status, total, segment, nation_id FROM sales s LEFT JOIN clients c ON c.client_id = s.client_id",
    "index_keyword_topk": SCANS["keyword_topk"],
    "index_hybrid_topk": SCANS["hybrid_topk"],
    "index_vector_topk": SCANS["vector_topk"],
    "nearest_neighbours": """SELECT asked, vec_id, score, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id)::INT AS rank
FROM (SELECT a.vec_id AS asked, b.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0) QUALIFY rank <= 10""",
    "change_feed_clients": f"""WITH b AS {_clients("2024-03-01")}, a AS {_clients("2024-05-01")},
j AS (SELECT coalesce(b.client_id, a.client_id) AS client_id, b, a, CASE WHEN b.client_id IS NULL THEN 'insert' WHEN a.client_id IS NULL THEN 'delete'
  WHEN (b.source, b.segment, b.city, b.balance) IS DISTINCT FROM (a.source, a.segment, a.city, a.balance) THEN 'update' END AS kind FROM b FULL JOIN a ON a.client_id IS NOT DISTINCT FROM b.client_id)
SELECT client_id, b.source AS source, b.segment AS segment, b.city AS city, b.balance AS balance, CASE kind WHEN 'update' THEN 'update_before' ELSE kind END AS change, 2::BIGINT AS version FROM j WHERE kind IN ('update', 'delete')
UNION ALL SELECT client_id, a.source, a.segment, a.city, a.balance, CASE kind WHEN 'update' THEN 'update_after' ELSE kind END, 2 FROM j WHERE kind IN ('update', 'insert')""",
    "file_actions": f"""WITH l AS ({_FILES.format(_clients("2024-05-01"))}), s AS ({_FILES.format(_clients("2024-04-01"))}), g AS ({_FILES.format(_clients("2024-03-01"))}), i AS ({_FILES.format(_clients("2024-02-01"))}),
k AS (SELECT k, max(v) AS latest FROM g WHERE k IS NOT NULL GROUP BY k),
f AS (SELECT f FROM l UNION SELECT f FROM s UNION SELECT f FROM g UNION SELECT f FROM i),
w AS (SELECT f, l.h AS listed, s.h AS parsed, l.source = 'partner' AS dead, g.h AS gold, i.h AS idx, coalesce(g.v < k.latest, false) AS superseded,
  CASE WHEN g.source = 'web' THEN 2 ELSE 1 END AS gold_chunks, CASE WHEN i.source = 'web' THEN 2 ELSE 1 END AS idx_chunks
  FROM f LEFT JOIN l USING (f) LEFT JOIN s USING (f) LEFT JOIN g USING (f) LEFT JOIN i USING (f) LEFT JOIN k ON k.k = g.k),
r AS (SELECT f, CASE WHEN listed IS NULL AND gold IS NOT NULL THEN 1
  WHEN listed IS NOT NULL AND listed IS DISTINCT FROM parsed AND dead AND gold IS NOT NULL THEN 2
  WHEN listed IS NOT NULL AND listed IS DISTINCT FROM parsed AND NOT dead AND parsed IS NOT NULL THEN 3
  WHEN listed IS NOT NULL AND listed IS DISTINCT FROM parsed AND NOT dead THEN 4
  WHEN listed = parsed AND parsed IS DISTINCT FROM gold THEN 5
  WHEN listed = parsed AND gold_chunks = 2 THEN 6
  WHEN listed = parsed AND superseded THEN 7
  WHEN gold IS DISTINCT FROM idx OR (gold IS NOT NULL AND gold_chunks <> idx_chunks) THEN 9
  WHEN listed IS NOT NULL AND listed IS DISTINCT FROM parsed AND dead THEN 10 END AS n FROM w)
SELECT f AS source_file, CASE WHEN n IN (1, 2, 7) THEN 'retire' WHEN n = 3 THEN 'parse_again' WHEN n = 4 THEN 'parse' WHEN n = 5 THEN 'merge' WHEN n = 6 THEN 'purge' WHEN n = 9 THEN 'sync' ELSE 'none' END AS action,
  CASE n WHEN 1 THEN 'file is gone' WHEN 2 THEN 'new content can''t be parsed' WHEN 3 THEN 'content changed' WHEN 4 THEN 'new file' WHEN 5 THEN 'chunks not in gold' WHEN 6 THEN 'chunks no longer in the file'
    WHEN 7 THEN 'superseded' WHEN 9 THEN 'index differs from gold' WHEN 10 THEN 'dead letter' END AS reason FROM r""",
    "history_clients": """SELECT client_id, change_id, op, segment, city, balance, seq AS start_at, lead(seq) OVER (PARTITION BY client_id ORDER BY seq) AS end_at
FROM (SELECT * FROM client_changes QUALIFY row_number() OVER (PARTITION BY client_id, seq ORDER BY change_id DESC NULLS LAST) = 1)""",
}
