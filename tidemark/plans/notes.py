"""Conversation turns as notes, documents as attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import notes
from tidemark.operators.mapping import map_attachments, map_notes, split_mapped
from tidemark.operators.merge import upsert
from tidemark.plans.packing import attachment_nodes, note_nodes, turn_id
from tidemark.plans.pipelines import reject_counts
from tidemark.plans.registry import Tables, json_of, key_text, pack, query
from tidemark.sources.pages import child_nodes

TURN_ID = "conv_id || '-' || turn"


@query(
    "map_notes",
    f"""
    SELECT {TURN_ID} AS id, CASE role WHEN 'user' THEN 'client' ELSE 'job' END AS entity_type,
           CAST(CASE role WHEN 'user' THEN conv_id ELSE turn END AS VARCHAR) AS entity_id,
           text AS message, '2024-01-05T10:00:00Z' AS created_at, '' AS updated_at
    FROM conversations WHERE role <> 'system'
    """,
)
def map_notes_query(spark: SparkSession, folder: str) -> DataFrame:
    return split_mapped(map_notes(note_nodes(Tables(spark, folder)))).accepted


@query(
    "map_notes_lenient",
    f"""
    SELECT {TURN_ID} AS id,
           CASE role WHEN 'user' THEN 'client' WHEN 'system' THEN 'ORPHANED' ELSE 'job' END AS entity_type,
           CASE role WHEN 'user' THEN CAST(conv_id AS VARCHAR) WHEN 'system' THEN 'UNKNOWN'
                ELSE CAST(turn AS VARCHAR) END AS entity_id
    FROM conversations
    """,
)
def map_notes_lenient(spark: SparkSession, folder: str) -> DataFrame:
    mapped = map_notes(note_nodes(Tables(spark, folder)), lenient=True)
    return mapped.select("id", "entity_type", "entity_id")


@query(
    "map_attachments",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, 'client_' || doc_id || '_note_1' AS note_id,
           CASE WHEN source <> 'src5' THEN doc_id || '.' || lang END AS file_name,
           source AS content_type, '' AS original_url,
           CASE WHEN source = 'src5' THEN ''
                ELSE './attachments/client_' || doc_id || '_note_1/' || doc_id || '.' || lang END AS local_file_path,
           CASE WHEN source = 'src7' THEN 0 ELSE n_chars END AS file_size,
           '2024-01-05T10:00:00Z' AS created_at, 'pending' AS download_status
    FROM documents WHERE lang <> 'fr' AND source <> 'src3'
    """,
)
def map_attachments_query(spark: SparkSession, folder: str) -> DataFrame:
    mapped = map_attachments(attachment_nodes(Tables(spark, folder)))
    return split_mapped(mapped).accepted.drop("hash", "downloaded_at", "download_error")


@query(
    "attachment_rejects",
    """
    SELECT 'attachment' AS entity_type,
           CASE WHEN source = 'src3' THEN 'missing id' ELSE 'missing note id' END AS reason, count(*) AS n
    FROM documents WHERE lang = 'fr' OR source = 'src3' GROUP BY 2
    """,
)
def attachment_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return reject_counts(map_attachments(attachment_nodes(Tables(spark, folder))), "attachment")


@query(
    "inline_attachments",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, source AS parent,
           CASE WHEN lang = 'fr' THEN 'ORPHANED' ELSE 'client_' || doc_id || '_note_1' END AS note_id,
           CASE WHEN source = 'src5' THEN ''
                WHEN lang = 'fr' THEN './attachments/ORPHANED/' || source || '/' || doc_id || '.fr'
                ELSE './attachments/client_' || doc_id || '_note_1/' || doc_id || '.' || lang END AS local_file_path,
           lang = 'fr' AS orphaned
    FROM documents WHERE source <> 'src3'
    """,
)
def inline_attachments(spark: SparkSession, folder: str) -> DataFrame:
    """Attachments without a note are kept under their parent."""
    nodes = attachment_nodes(Tables(spark, folder)).withColumnsRenamed(
        {"source": "parent", "node": "child"}
    )
    accepted = notes.inline_attachments(nodes, "parent").accepted
    return accepted.select("id", "parent", "note_id", "local_file_path", "orphaned")


ORPHANS = """
  SELECT 'client' AS entity_type, source AS entity_id, count(*) AS attachments_saved_orphaned,
         'orphaned_data_preserved' AS issue_type, './attachments/ORPHANED/' || source || '/' AS review_path
  FROM documents WHERE source <> 'src3' AND lang = 'fr' GROUP BY source
"""


@query("orphan_issues", ORPHANS)
def orphan_issues(spark: SparkSession, folder: str) -> DataFrame:
    nodes = attachment_nodes(Tables(spark, folder)).withColumnsRenamed(
        {"source": "parent", "node": "child"}
    )
    return notes.orphan_issues(notes.inline_attachments(nodes, "parent").accepted, "client", "parent")


@query(
    "issue_summary",
    f"""
    SELECT count(*) AS entities_with_issues, CAST(sum(attachments_saved_orphaned) AS BIGINT) AS attachments_orphaned
    FROM ({ORPHANS})
    """,
)
def issue_summary(spark: SparkSession, folder: str) -> DataFrame:
    return notes.issue_summary(orphan_issues(spark, folder))


def _conversation_pages(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Conversations as parents: turns below 4 come inline, later ones in further pages.

    A page carries one turn and one empty edge, so no conversation is gathered.
    """
    node = F.struct(turn_id().alias("id"), F.col("text").alias("message"), F.col("role").alias("role"))
    kind = "struct<node: struct<id: string, message: string, role: string>>"
    edges = F.array(
        F.struct(node.alias("node")).cast(kind), F.struct(F.lit(None).alias("node")).cast(kind)
    )
    inline = pack(
        t.conversations.where("turn < 4"),
        json_of(F.struct(edges.alias("edges")).alias("notes")),
        key_text("conv_id").alias("id"),
    )
    later = t.conversations.where("turn >= 4").select(
        key_text("conv_id").alias("id"),
        F.try_variant_get(F.parse_json(F.to_json(edges)), "$", "array<variant>").alias("edges"),
    )
    return inline, later


@query(
    "child_nodes",
    f"SELECT CAST(conv_id AS VARCHAR) AS parent, {TURN_ID} AS id FROM conversations",
)
def child_nodes_query(spark: SparkSession, folder: str) -> DataFrame:
    first, later = _conversation_pages(Tables(spark, folder))
    children = child_nodes(first, "notes", "id", later)
    return children.select(
        F.col("id").alias("parent"), F.try_variant_get("child", "$.id", "string").alias("id")
    )


@query(
    "inline_notes",
    f"""
    SELECT {TURN_ID} AS id, 'client' AS entity_type, CAST(conv_id AS VARCHAR) AS entity_id,
           text AS message, FALSE AS orphaned
    FROM conversations
    """,
)
def inline_notes(spark: SparkSession, folder: str) -> DataFrame:
    first, later = _conversation_pages(Tables(spark, folder))
    mapped = notes.inline_notes(child_nodes(first, "notes", "id", later), "client", "id")
    return mapped.select("id", "entity_type", "entity_id", "message", "orphaned")


@query(
    "inline_notes_of_users",
    f"""
    SELECT {TURN_ID} AS id, 'ORPHANED' AS entity_type, 'UNKNOWN' AS entity_id, TRUE AS orphaned
    FROM conversations
    """,
)
def inline_notes_of_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users are no parents of notes: their notes are kept as orphans."""
    first, later = _conversation_pages(Tables(spark, folder))
    mapped = notes.inline_notes(child_nodes(first, "notes", "id", later), "user", "id")
    return mapped.select("id", "entity_type", "entity_id", "orphaned")


@query(
    "collect_references",
    f"""
    SELECT {TURN_ID} AS note_id, 'client' AS entity_type, CAST(conv_id AS VARCHAR) AS entity_id
    FROM conversations
    """,
)
def collect_references(spark: SparkSession, folder: str) -> DataFrame:
    """References of every turn, those of later pages included."""
    first, later = _conversation_pages(Tables(spark, folder))
    return notes.collect_references(first, "client", continuation=later)


def _references(t: Tables) -> DataFrame:
    """Every turn is referenced from a job and, when the user speaks, from a client too."""
    turns = t.conversations
    job = turns.select(
        turn_id().alias("note_id"), F.lit("job").alias("entity_type"), key_text("conv_id").alias("entity_id")
    )
    client = turns.where("role = 'user'").select(
        turn_id().alias("note_id"),
        F.lit("client").alias("entity_type"),
        key_text("conv_id").alias("entity_id"),
    )
    blank = turns.where("role = 'system'").select(
        turn_id().alias("note_id"), F.lit("").alias("entity_type"), F.lit("x").alias("entity_id")
    )
    return job.unionByName(client).unionByName(blank)


@query(
    "deferred_notes",
    f"""
    SELECT {TURN_ID} AS id, 'client' AS entity_type, CAST(conv_id AS VARCHAR) AS entity_id, text AS message
    FROM conversations WHERE role = 'user' AND turn > 0
    UNION ALL SELECT {TURN_ID}, 'client', CAST(conv_id AS VARCHAR), text
    FROM conversations WHERE role = 'user' AND turn > 0
    UNION ALL SELECT {TURN_ID}, 'job', CAST(conv_id AS VARCHAR), text
    FROM conversations WHERE role <> 'user' AND turn > 0
    """,
)
def deferred_notes(spark: SparkSession, folder: str) -> DataFrame:
    """First turns are stored already. A node's own client outranks a given job."""
    t = Tables(spark, folder)
    stored = t.conversations.where("turn = 0").select(turn_id().alias("id"))
    pending = notes.pending_references(_references(t), stored)
    mapped = notes.deferred_notes(pending, note_nodes(t).select("note_id", "node"))
    return split_mapped(mapped).accepted.select("id", "entity_type", "entity_id", "message")


@query(
    "deferred_notes_stored",
    f"""
    SELECT {TURN_ID} AS id, CASE WHEN turn = 0 THEN 'old' WHEN role = 'user' THEN 'client' ELSE 'job' END AS entity_type
    FROM conversations
    """,
)
def deferred_notes_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The note table after the pass: one row per note, however often it was referenced."""
    t = Tables(spark, folder)
    stored = t.conversations.where("turn = 0").select(
        turn_id().alias("id"), F.lit("old").alias("entity_type")
    )
    pending = notes.pending_references(_references(t), stored)
    mapped = notes.deferred_notes(pending, note_nodes(t).select("note_id", "node"))
    accepted = split_mapped(mapped).accepted
    return upsert(stored, accepted, ["id"], ["entity_type", "entity_id"])


@query(
    "note_attachments",
    f"""
    SELECT {TURN_ID} || '-file' AS id, {TURN_ID} AS note_id,
           './attachments/' || {TURN_ID} || '/turn.txt' AS local_file_path
    FROM conversations WHERE role = 'user'
    """,
)
def note_attachments(spark: SparkSession, folder: str) -> DataFrame:
    """Notes of users list one file and one empty edge."""
    file = F.struct(
        F.concat(turn_id(), F.lit("-file")).alias("id"), F.lit("turn.txt").alias("fileName")
    )
    kind = "struct<node: struct<id: string, fileName: string>>"
    edges = F.array(
        F.struct(file.alias("node")).cast(kind), F.struct(F.lit(None).alias("node")).cast(kind)
    )
    text = json_of(
        F.when(F.col("role") == "user", F.struct(edges.alias("edges"))).alias("attachments")
    )
    nodes = pack(Tables(spark, folder).conversations, text, turn_id().alias("note_id"))
    mapped = notes.note_attachments(nodes)
    return split_mapped(mapped).accepted.select("id", "note_id", "local_file_path")


def _role_references(t: Tables) -> DataFrame:
    return t.conversations.select(key_text("conv_id").alias("note_id"), F.col("role").alias("entity_type"))


@query(
    "refs_rollup",
    "SELECT role AS entity_type, count(*) AS n FROM conversations GROUP BY ROLLUP (role)",
)
def refs_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return notes.reference_summary(_role_references(Tables(spark, folder)))


@query(
    "refs_by_type_distinct",
    "SELECT role AS entity_type, count(DISTINCT conv_id) AS notes FROM conversations GROUP BY 1",
)
def refs_by_type_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return notes.notes_per_type(_role_references(Tables(spark, folder)))


@query("unique_refs", "SELECT DISTINCT CAST(conv_id AS VARCHAR) AS note_id FROM conversations")
def unique_refs(spark: SparkSession, folder: str) -> DataFrame:
    return notes.unique_notes(_role_references(Tables(spark, folder)))
