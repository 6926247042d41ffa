"""The registered queries ``opN_<name>``: thin digests of what the operators return."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from . import changepoints, decontaminate, fim, html, jaccard, labelled, lm, media, neardup, packing, quality, suffix, toxicity, urlrules
from .tables import table


#: The directory rules of the url query: verdict and host/path.
DIRECTORIES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Its pattern rules, for urls that no directory rule fits.
PATTERNS = ["||cheap-pills.", "||spam-farm.", "/casino/", "/adserver/", "&utm_campaign=spam^", "||tracker.*/pixel/", "@@||example.net/help/"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urlrules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), PATTERNS, DIRECTORIES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 100)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def token_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack_documents(docs, public_tokenizers.path(vocabulary), public_tokenizers.PATTERN, 1024, 2, token_digest)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), labelled.fold("doc_id", 10) == 0)


def _judged(out: DataFrame, least: float) -> DataFrame:
    return out.select("doc_id", (labelled.fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")), 0.7)


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.sniff_column(media.store_texts(table(spark, sf_dir, "documents").select("doc_id", "text")))
    size = F.octet_length("payload").cast("long")
    return media.corrected(out).select("doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -32)")).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", "type")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")), 0.3)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.size("hit_words").cast("long")
    return out.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def op11_penalised_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = table(spark, sf_dir, "sale_lines").where("flag = 'kept'").select("vendor_id", "quantity", "shipped_at")
    return changepoints.change_points(taken, "vendor_id", F.col("shipped_at"), F.col("quantity"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    chars = [F.char_length(c).cast("long").alias(f"{c}_chars") for c in ("prefix", "middle")]
    return out.select("doc_id", F.col("n_tokens").alias("n"), "form", *chars, F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_vectors(table(spark, sf_dir, "embeddings"))


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    q.__name__: _shipped(q)
    for q in (
        op1_url_filter,
        op2_suffix_array_dedup,
        op3_html_extraction,
        op4_best_fit_packing,
        op5_ngram_jaccard_join,
        op6_lm_scoring,
        op7_quality_classifier,
        op8_media_columns,
        op9_toxicity,
        op10_benchmark_decontamination,
        op11_penalised_change_points,
        op12_fill_in_middle,
        op13_embedding_near_dedup,
    )
}

_RULE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{h}/{p}'" for h, p in sorted((r.split("/", 1) for _, r in DIRECTORIES), key=lambda x: -len("/".join(x)))
) + " END"
_BLOCKED = r"^[^:]*://(?:[^/?#]*\.)?(?:cheap-pills|spam-farm)\.|/casino/|/adserver/|&utm_campaign=spam(?:[^a-z0-9_.%-]|$)|^[^:]*://(?:[^/?#]*\.)?tracker\..*/pixel/"
_ALLOWED = r"^[^:]*://(?:[^/?#]*\.)?example\.net/help/"
_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": f"""
WITH u AS (SELECT page_id, lower(coalesce(url, '')) AS url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), {_CAPITALS}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, {_RULE} AS rule FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({", ".join(f"'{r}'" for v, r in DIRECTORIES if v == "allow")}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(url, '{_BLOCKED}') AND NOT regexp_matches(url, '{_ALLOWED}') THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
    "op2_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS p FROM d WHERE length(h) >= 200)),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
f AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM r),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM f) GROUP BY doc_id, k),
gone AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM runs
  UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(length(h)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op5_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_CAPITALS}), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y, c = nx.n AND c = ny.n AS same FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 10 * c >= 8 * (nx.n + ny.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN l ON l.x = r.y),
groups AS (SELECT x, min(y) AS class_id FROM reach GROUP BY 1),
links AS (SELECT x, count(*) AS n_links, count(*) FILTER (same) AS n_copies FROM l GROUP BY 1)
SELECT w.doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 0) AS n_copies, coalesce(n.n, 0) AS n_shingles
FROM w JOIN groups g ON g.x = w.doc_id LEFT JOIN links k ON k.x = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op10_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p USING (n, gram)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    # best[j + 1] holds, of the best cut of the first j days, its cost, number of segments and last segment's start; -1 where none can end
    "op11_penalised_change_points": """
WITH RECURSIVE daily AS (SELECT vendor_id, datediff('day', DATE '1970-01-01', shipped_at::DATE) AS d, sum(quantity)::HUGEINT AS q
  FROM sale_lines WHERE flag = 'kept' AND quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL),
spans AS (SELECT vendor_id, min(d) AS a, max(d) AS b FROM daily GROUP BY vendor_id),
days AS (SELECT vendor_id, unnest(generate_series(a, b)) AS d FROM spans),
sums AS (SELECT t.vendor_id, t.d, sum(coalesce(q, 0)) OVER w AS s, sum(coalesce(q * q, 0)) OVER w AS r
  FROM days t LEFT JOIN daily x ON x.vendor_id IS NOT DISTINCT FROM t.vendor_id AND x.d = t.d WINDOW w AS (PARTITION BY t.vendor_id ORDER BY t.d ROWS UNBOUNDED PRECEDING)),
series AS (SELECT vendor_id, min(d) AS a, count(*) AS n, list_prepend(0::HUGEINT, list(s::HUGEINT ORDER BY d)) AS s, list_prepend(0::HUGEINT, list(r::HUGEINT ORDER BY d)) AS r FROM sums GROUP BY vendor_id),
cut AS (
  SELECT vendor_id, a, n, s, r, 0::BIGINT AS j, [{'c': 0::HUGEINT, 'k': 0::BIGINT, 'i': 0::BIGINT}] AS best FROM series
  UNION ALL
  SELECT vendor_id, a, n, s, r, j + 1, list_append(best, CASE WHEN j + 1 = n OR (j + 1 >= 7 AND n - j - 1 >= 7) THEN list_min(list_transform(
    list_filter(generate_series(0, j), lambda i: best[i + 1].c >= 0 AND (j + 1 - i >= 7 OR (i = 0 AND j + 1 = n))),
    lambda i: {'c': best[i + 1].c + CASE WHEN i > 0 THEN 20000 ELSE 0 END + ((j + 1 - i) * floor(1000 * ln((1 + ((j + 1 - i) * (r[j + 2] - r[i + 1]) - (s[j + 2] - s[i + 1]) * (s[j + 2] - s[i + 1])) // ((j + 1 - i) * (j + 1 - i)))::DOUBLE))::BIGINT)::HUGEINT,
      'k': best[i + 1].k + 1, 'i': i})) ELSE {'c': (-1)::HUGEINT, 'k': 0::BIGINT, 'i': 0::BIGINT} END)
  FROM cut WHERE j < n),
whole AS (SELECT vendor_id, a, s, r, n, best, best[n + 1].c AS best_cost, best[n + 1].k AS n_segments FROM cut WHERE j = n),
back AS (
  SELECT *, n AS e, best[n + 1].i AS i, n_segments AS segment_no FROM whole
  UNION ALL
  SELECT * EXCLUDE (e, i, segment_no), i, best[i + 1].i, segment_no - 1 FROM back WHERE i > 0),
pieces AS (SELECT *, (e - i)::HUGEINT AS m, s[e + 1] - s[i + 1] AS t, r[e + 1] - r[i + 1] AS q FROM back),
told AS (SELECT *, (1 + (m * q - t * t) // (m * m))::BIGINT AS v FROM pieces)
SELECT vendor_id, segment_no::INT AS segment_no, (a + i)::BIGINT AS first_day, m::BIGINT AS n_days, t::BIGINT AS total, v AS spread,
  (m * floor(1000 * ln(v::DOUBLE))::BIGINT)::BIGINT AS cost, n_segments::BIGINT AS n_segments, best_cost::BIGINT AS best_cost FROM told""",
    "op12_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM d),
c AS (SELECT *, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, form, len(u) AS n, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || x || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""",
    "op13_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN l ON l.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN least ON least.x = vec_id LEFT JOIN n ON n.x = vec_id""",
}
