"""The queries of the corpus operators and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, embedding_dedup, html_extract, language_id, line_dedup, lm_scoring, ngram_join, periodic_runs, sentencepiece_codec, token_alignment, token_files, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_common_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.similar(_table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.col("_severity").alias("severity"), F.col("_grade").alias("grade"), F.col("_toxic").alias("toxic"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.flag(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_class_id").alias("class_id"), F.col("_group_id").alias("group_id"), F.col("_n_links").alias("n_links"), F.col("_kept").alias("kept"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, check=True)
    return coded.select("doc_id", F.size("_ids").alias("n_ids"), F.col("_ids").alias("ids"), F.col("_exact").alias("decodes_exactly"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_extract.extract(pages)
    return texts.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scoring.fit_and_score(docs)
    return scored.select("doc_id", F.col("_n_tokens").alias("n_tokens"), F.col("_log_likelihood").alias("log_likelihood"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.predict(docs, language_id.fit(docs))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = warc.archive_folder(pages)
    index = warc.build_index(warc.write_archives(pages, folder))
    read = warc.read_captures(index, folder, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    flagged = decontaminate.flag(docs, _table(spark, sf_dir, "benchmark"))
    return flagged.select("doc_id", (F.size("_items") > 0).alias("contaminated"), F.col("_items").alias("item_ids"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.new_folder(spark)
    token_files.write(docs, folder, token_files.train(docs))
    return token_files.read(spark, folder, ids=False)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find(docs, repeat=lambda row, n: periodic_runs.planted(row["doc_id"], n))
    return found.select(
        "doc_id", F.col("_n_runs").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"), F.col("_runs_sha256").alias("runs_sha256"), F.col("_collapsed_sha256").alias("collapsed_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")])


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_html_extract": op5_html_extract,
    "op6_decontaminate": op6_decontaminate,
    "op7_language_id": op7_language_id,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_files": op11_token_files,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op1_embedding_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT DISTINCT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(r.low, e.vec_id) AS component_id, e.vec_id = coalesce(r.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON e.vec_id = n.a
LEFT JOIN (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id) r ON e.vec_id = r.vec_id
""",
    "op9_warc": """
WITH rows AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), keyed AS (
  SELECT page_id, url, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM rows
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM keyed
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to, url
FROM firsts
""",
    "op10_line_dedup": r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY doc_id
""",
}
