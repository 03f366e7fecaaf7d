"""Downloads over documents: filters, content store, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import extension, url_host, url_problem
from tidemark.operators import downloads
from tidemark.operators.downloads import DownloadFilters
from tidemark.plans.pipelines import DownloadPass, download_pass
from tidemark.plans.registry import AS_OF, SNAPSHOT, Tables, key_text, query
from tidemark.session import scratch_path
from tidemark.sources import files

# Stands in for the hosts files may be fetched from.
ALLOWED_DOMAINS = ["example.com", "example.org"]


def attachments(t: Tables) -> DataFrame:
    """Labelled documents as known attachments."""
    labelled = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    return labelled.select(
        key_text("doc_id").alias("id"),
        F.concat_ws(".", key_text("doc_id"), F.upper("lang")).alias("file_name"),
        F.col("n_chars").alias("file_size"),
        F.lit("").alias("original_url"),
        F.lit("").alias("local_file_path"),
        F.lit("pending").alias("download_status"),
        F.lit(None).cast("string").alias("hash"),
        F.lit(None).cast("string").alias("download_error"),
    )


def queue(t: Tables) -> DataFrame:
    """Every document is queued; src1 failed before and src2 is done."""
    status = (
        F.when(F.col("source") == "src1", "failed")
        .when(F.col("source") == "src2", "done")
        .otherwise("pending")
    )
    return t.documents.select(
        key_text("doc_id").alias("attachment_id"),
        F.col("source").alias("parent_type"),
        key_text("doc_id").alias("parent_id"),
        status.alias("status"),
        F.when(F.col("source") == "src1", 1).otherwise(0).alias("attempt_count"),
        F.when(F.col("source") == "src1", "HTTP 500").alias("last_error"),
        F.lit(SNAPSHOT).alias("map_snapshot_id"),
        F.lit("2024-01-01T00:00:00Z").alias("updated_at"),
    )


@query(
    "download_selection",
    """
    SELECT CAST(d.doc_id AS VARCHAR) AS attachment_id, source AS parent_type
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    WHERE source <> 'src2' AND lang IN ('en', 'de') AND n_chars BETWEEN 200 AND 5000
    """,
)
def download_selection(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    work = queue(t).where("status in ('pending', 'failed')")
    filters = DownloadFilters(file_types=[".EN", "de"], min_size=200, max_size=5000)
    chosen = downloads.filter_work(downloads.with_metadata(work, attachments(t)), filters)
    return chosen.select("attachment_id", "parent_type")


@query(
    "download_selection_by_parent",
    """
    SELECT CAST(doc_id AS VARCHAR) AS attachment_id, source AS parent_type
    FROM documents WHERE source IN ('src3', 'src4')
    """,
)
def download_selection_by_parent(spark: SparkSession, folder: str) -> DataFrame:
    """Without a file filter, items lacking metadata stay selected."""
    t = Tables(spark, folder)
    work = downloads.with_metadata(queue(t), attachments(t))
    chosen = downloads.filter_work(work, DownloadFilters(parent_types=["SRC3", "Src4"]))
    return chosen.select("attachment_id", "parent_type")


def _download(spark: SparkSession, folder: str) -> DownloadPass:
    """Contents are at hand for all but Spanish documents."""
    t = Tables(spark, folder)
    contents = t.documents.where("lang <> 'es'").select(
        key_text("doc_id").alias("id"), F.col("text").cast("binary").alias("content")
    )
    return download_pass(queue(t), attachments(t), contents, AS_OF, 50.0, resume=True)


DOWNLOAD_SQL = """
  SELECT d.*, l.doc_id IS NOT NULL AS known, source <> 'src2' AS worked,
         l.doc_id IS NOT NULL AND lang <> 'es' AS ok
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


@query(
    "download_pass",
    f"""
    SELECT CAST(doc_id AS VARCHAR) AS attachment_id,
           CASE WHEN NOT worked OR ok THEN 'done' ELSE 'failed' END AS status,
           CAST(CASE WHEN source = 'src1' THEN 1 ELSE 0 END
                + CASE WHEN worked AND NOT ok THEN 1 ELSE 0 END AS INTEGER) AS attempt_count,
           CASE WHEN NOT worked OR ok THEN NULL WHEN known THEN 'No content: ' || doc_id
                ELSE 'Attachment not found: ' || doc_id END AS last_error
    FROM ({DOWNLOAD_SQL})
    """,
)
def download_pass_queue(spark: SparkSession, folder: str) -> DataFrame:
    result = _download(spark, folder).queue
    return result.select("attachment_id", "status", "attempt_count", "last_error")


@query(
    "download_pass_attachments",
    f"""
    SELECT CAST(doc_id AS VARCHAR) AS id,
           CASE WHEN NOT worked THEN 'pending' WHEN ok THEN 'completed' ELSE 'failed' END AS download_status,
           CASE WHEN worked AND ok THEN sha256(text) END AS hash,
           CASE WHEN worked AND ok THEN sha256(text) || '.' || upper(lang) ELSE '' END AS local_file_path
    FROM ({DOWNLOAD_SQL}) WHERE known
    """,
)
def download_pass_attachments(spark: SparkSession, folder: str) -> DataFrame:
    result = _download(spark, folder).attachments
    return result.select("id", "download_status", "hash", "local_file_path")


@query(
    "download_report",
    f"""
    SELECT count(*) AS total_attachments, count(*) FILTER (ok) AS downloaded,
           count(*) FILTER (NOT ok) AS failed,
           CAST(coalesce(sum(octet_length(encode(text))) FILTER (ok), 0) AS BIGINT) AS total_bytes,
           round(count(*) FILTER (ok) * 100.0 / count(*), 2)::DOUBLE AS success_rate,
           round(coalesce(sum(octet_length(encode(text))) FILTER (ok), 0) / 50.0, 2)::DOUBLE AS bytes_per_second,
           round(count(*) FILTER (ok) / 50.0, 2)::DOUBLE AS files_per_second,
           round(50.0 / count(*) FILTER (ok), 2)::DOUBLE AS seconds_per_file
    FROM ({DOWNLOAD_SQL}) WHERE worked
    """,
)
def download_report(spark: SparkSession, folder: str) -> DataFrame:
    return _download(spark, folder).summary


@query(
    "content_dedup",
    """
    SELECT sha256(text) AS hash, min(doc_id) AS keeper, count(*) AS copies,
           CAST(sum(n_chars) - max(n_chars) AS BIGINT) AS bytes_saved
    FROM documents GROUP BY 1
    """,
)
def content_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = Tables(spark, folder).documents
    named = docs.select(
        "doc_id", "n_chars", "text", F.concat_ws(".", key_text("doc_id"), F.col("lang")).alias("file_name")
    )
    return downloads.dedup_by_hash(downloads.store_contents(named, "text"), "doc_id", "n_chars")


@query(
    "stored_names",
    """
    SELECT doc_id, sha256(text) || CASE WHEN source = 'src0' THEN '.bin' ELSE '.' || lang END AS stored_name
    FROM documents
    """,
)
def stored_names(spark: SparkSession, folder: str) -> DataFrame:
    docs = Tables(spark, folder).documents
    name = F.when(F.col("source") == "src0", key_text("doc_id")).otherwise(
        F.concat_ws(".", key_text("doc_id"), F.col("lang"))
    )
    stored = downloads.store_contents(docs.select("doc_id", "text", name.alias("file_name")), "text")
    return stored.select("doc_id", "stored_name")


@query(
    "hashed_files",
    """
    SELECT source, octet_length(encode(body)) AS length, sha256(body) AS hash
    FROM (SELECT source, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS body FROM documents GROUP BY 1)
    """,
)
def hashed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Texts written as one file per source; the larger files are hashed block by block."""
    path, docs = scratch_path(spark, "files"), Tables(spark, folder).documents
    lines = docs.select("source", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    in_files = lines.repartition("source").sortWithinPartitions("source", "doc_id")
    in_files.select("source", "text").write.partitionBy("source").text(path)
    found = files.hashed_files(spark, path, "*.txt", large=100_000, block=4096)
    return found.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "length", "hash")


HOST_SQL = "lower(regexp_extract(url, '^[^:/?#]*://([^/?#:]*)', 1))"


@query(
    "url_validation",
    f"""
    SELECT page_id, {HOST_SQL} AS host,
           CASE WHEN url NOT LIKE 'https:%' THEN 'scheme'
                WHEN NOT regexp_matches({HOST_SQL}, '(^|\\.)example\\.(com|org)$') THEN 'domain'
                ELSE '' END AS problem,
           CASE WHEN contains(url, '.') THEN lower(regexp_extract(url, '\\.([^.]*)$', 1)) ELSE '' END AS extension
    FROM pages
    """,
)
def url_validation(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return Tables(spark, folder).pages.select(
        "page_id",
        url_host(url).alias("host"),
        url_problem(url, ALLOWED_DOMAINS).alias("problem"),
        extension(url).alias("extension"),
    )


@query(
    "url_problem_counts",
    f"""
    SELECT CASE WHEN url NOT LIKE 'https:%' THEN 'scheme'
                WHEN NOT regexp_matches({HOST_SQL}, '(^|\\.)example\\.(com|org)$') THEN 'domain'
                ELSE '' END AS problem, count(*) AS n
    FROM pages GROUP BY 1
    """,
)
def url_problem_counts(spark: SparkSession, folder: str) -> DataFrame:
    problem = url_problem(F.col("url"), ALLOWED_DOMAINS)
    return Tables(spark, folder).pages.groupBy(problem.alias("problem")).agg(
        F.count(F.lit(1)).alias("n")
    )
