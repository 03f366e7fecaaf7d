"""Whole passes: map, extract, download, load in dependency order.

What several outputs of a pass share is staged: written once to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import content_hash, stored_name
from tidemark.operators import downloads, inventory, queues, validate
from tidemark.operators.downloads import DownloadFilters
from tidemark.operators.mapping import REJECT_REASON, map_entities, split_mapped
from tidemark.operators.merge import latest_per_key, patch, upsert
from tidemark.operators.notes import inline_attachments
from tidemark.operators.specs import LOAD_ORDER, EntitySpec
from tidemark.session import has_file, move, remove, stage
from tidemark.sources.pages import child_nodes
from tidemark.sources.records import Record


class MapPass(NamedTuple):
    snapshot: DataFrame
    inventory: DataFrame
    density: DataFrame
    hotspots: DataFrame


def map_pass(
    spark: SparkSession,
    nodes: Mapping[str, tuple[EntitySpec, DataFrame]],
    snapshot_id: str,
    as_of: str,
    label: str | None = None,
) -> MapPass:
    """Inventory of every kind with its density and hotspots."""
    rows = inventory.combine(
        [
            inventory.inventory_of_nodes(frame, spec, snapshot_id, as_of, total=True)
            for spec, frame in nodes.values()
        ]
    )
    types = [spec.root for spec, _ in nodes.values()]
    return MapPass(
        inventory.snapshot_row(spark, snapshot_id, as_of, types, label),
        rows.drop(inventory.TOTAL),
        inventory.density(rows, types=types),
        inventory.hotspots(rows),
    )


# Connection of a node that lists its files.
ATTACHMENTS = "noteAttachments"


class ExtractPass(NamedTuple):
    queue: DataFrame
    stored: DataFrame
    outcomes: DataFrame
    summary: DataFrame
    discrepancies: DataFrame
    attachments: DataFrame | None = None
    attachment_queue: DataFrame | None = None


def extract_pass(
    snapshot_inventory: DataFrame,
    queue: DataFrame,
    stored: DataFrame,
    nodes: DataFrame,
    spec: EntitySpec,
    as_of: str,
    types: Sequence[str] | None = None,
    snapshot_id: str | None = None,
    snapshots: DataFrame | None = None,
    attachments: DataFrame | None = None,
    attachment_queue: DataFrame | None = None,
) -> ExtractPass:
    """Queue the inventory, map the nodes of queued work, store them, settle the queue.

    `nodes` has entity_id, a sequence column `seq` and the node; only the newest node
    of each queued id is mapped, and mapped once. The pass works on one snapshot: rows of
    others stay as they are. With `snapshots`, an unknown snapshot and kinds it does not
    hold are refused. With `attachments` and `attachment_queue`, files listed in accepted
    nodes are stored as metadata and queued for download.
    """
    if snapshots is not None and snapshot_id is not None:
        types = inventory.snapshot_kinds(snapshots, snapshot_id, types)
    snapshot_inventory = inventory.of_snapshot(snapshot_inventory, snapshot_id)
    if types is not None:
        snapshot_inventory = snapshot_inventory.where(F.col("entity_type").isin(list(types)))
    queued = queues.queue_from_inventory(queue, snapshot_inventory, as_of)
    work = queues.select_work(queued, types=types, snapshot_id=snapshot_id)
    work = work.where(F.col("entity_type") == spec.root)
    wanted = nodes.join(work.select("entity_id").distinct(), "entity_id", "left_semi")
    newest = latest_per_key(wanted, ["entity_id"], ["seq"])
    mapped = stage(map_entities(newest, spec, keep=["entity_id", "seq"]), "mapped")
    outcomes = stage(queues.extract_outcomes(work, mapped, "entity_id"), "outcomes")
    settled = stage(
        queues.apply_results(queued, outcomes, queues.EXTRACT_KEY, as_of), "queue"
    )
    accepted = split_mapped(mapped).accepted
    if attachments is not None and attachment_queue is not None:
        parents = newest.join(accepted.select("entity_id"), "entity_id", "left_semi")
        files = inline_attachments(child_nodes(parents, ATTACHMENTS, "entity_id"), "entity_id").accepted
        files = stage(files, "attachments")
        attachments = upsert(attachments, files.drop("entity_id", "orphaned"), ["id"], ["note_id"])
        attachment_queue = queues.queue_attachments(
            attachment_queue, files, snapshot_id or "", as_of, spec.root
        )
    return ExtractPass(
        settled,
        upsert(stored, accepted.drop("entity_id"), ["id"], ["seq"]),
        outcomes,
        queues.status_matrix(settled, snapshot_id=snapshot_id),
        validate.completeness(snapshot_inventory, settled, snapshot_id=snapshot_id),
        attachments,
        attachment_queue,
    )


class DownloadPass(NamedTuple):
    queue: DataFrame
    attachments: DataFrame
    results: DataFrame
    summary: DataFrame


def download_pass(
    queue: DataFrame,
    attachments: DataFrame,
    contents: DataFrame,
    as_of: str,
    seconds: float,
    resume: bool = False,
    filters: DownloadFilters | None = None,
) -> DownloadPass:
    """Select work, hash the contents at hand, settle queue and attachment rows.

    `contents` has id and content, one row per attachment; fetching them is not part
    of the pass. Contents are hashed where they are read: only hashes and sizes are
    joined. Items without metadata or content fail and may be retried.
    """
    work = queues.select_work(queue, resume)
    work = downloads.with_metadata(work, attachments)
    work = downloads.filter_work(work, filters or DownloadFilters())
    files = contents.select(
        F.col("id").alias("attachment_id"),
        content_hash(F.col("content")).alias("hash"),
        F.octet_length("content").cast("bigint").alias("bytes"),
    )
    # One join decides all items: those without metadata, without content, and the rest.
    loaded = work.join(files, "attachment_id", "left")
    success = F.col("found") & F.col("hash").isNotNull()
    error = F.when(~F.col("found"), F.concat(F.lit("Attachment not found: "), F.col("attachment_id"))).when(
        ~success, F.concat(F.lit("No content: "), F.col("attachment_id"))
    )
    outcome = loaded.select(
        "attachment_id",
        "map_snapshot_id",
        success.alias("success"),
        error.alias("error"),
        F.when(success, F.col("bytes")).otherwise(F.lit(0)).cast("bigint").alias("bytes"),
        F.when(success, F.col("hash")).alias("hash"),
        F.when(success, stored_name(F.col("hash"), F.col("file_name"))).alias("stored_name"),
        "found",
    )
    results = stage(outcome, "downloads")
    changes = results.where("found").select(
        F.col("attachment_id").alias("id"),
        F.when(F.col("success"), "completed").otherwise("failed").alias("download_status"),
        "hash",
        F.col("stored_name").alias("local_file_path"),
        F.col("error").alias("download_error"),
    )
    results = results.drop("found")
    return DownloadPass(
        queues.apply_results(queue, results, queues.ATTACHMENT_KEY, as_of),
        patch(
            attachments,
            changes,
            ["id"],
            ["download_status", "hash", "local_file_path", "download_error"],
        ),
        results,
        downloads.download_summary(results, seconds),
    )


def load_in_order(
    loaders: Mapping[str, Callable[[], None]], order: Sequence[str] = tuple(LOAD_ORDER)
) -> dict[str, str]:
    """Run one loader per kind, parents first; a failing kind does not stop the others.

    Returns kind -> blank or the error. Kinds outside `order` are refused.
    """
    unknown = sorted(set(loaders) - set(order))
    if unknown:
        raise ValueError(f"no load order for {unknown}")
    outcome: dict[str, str] = {}
    for kind in order:
        if kind not in loaders:
            continue
        try:
            loaders[kind]()
            outcome[kind] = ""
        except Exception as error:  # a kind's failure is part of the result
            outcome[kind] = str(error)
    return outcome


RUN_SCHEMA = (
    "table_name string, status string, delivered bigint, stored bigint, refused bigint, error string, updated_at string"
)
PENDING, RUNNING, COMPLETED, FAILED = "pending", "in_progress", "completed", "failed"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of a table. The old one is moved aside before and
    removed after, so that a crash at any point leaves one whole table (see `recover`)."""
    aside = f"{path}.old"
    remove(spark, aside)
    if has_file(spark, path, ""):
        move(spark, path, aside)
    move(spark, staged, path)
    remove(spark, aside)


def recover(spark: SparkSession, staged: str, path: str) -> None:
    """After a crash inside `publish`: the staged table where it is whole, else the old one."""
    if has_file(spark, path, ""):
        return
    if has_file(spark, staged, "_SUCCESS"):
        move(spark, staged, path)
    elif has_file(spark, f"{path}.old", ""):
        move(spark, f"{path}.old", path)


def run_state(spark: SparkSession, target: str, run_id: str, tables: Sequence[str]) -> DataFrame:
    """One row per table of a run, at any time while it runs; tables not begun are pending."""
    records = {t: _run_record(spark, target, run_id, t).values() for t in tables}
    rows = [tuple(r or (t, PENDING, 0, 0, 0, "", None)) for t, r in records.items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def _run_record(spark: SparkSession, target: str, run_id: str, table: str) -> Record:
    return Record(spark, f"{target}/_runs/{run_id}/{table}", RUN_SCHEMA)


def migrate(
    spark: SparkSession,
    mapped: Mapping[str, Callable[[], DataFrame]],
    target: str,
    seq: Sequence[str],
    run_id: str = "run",
    clock: Callable[[], str] = lambda: "",
    order: Sequence[str] = tuple(LOAD_ORDER),
) -> DataFrame:
    """A whole run: every table's mapped rows upserted by id below `target`, parents first.

    `mapped` gives per table the mapped rows with their reject reasons and the columns `seq`,
    which say which of several rows of an id is the newest; they are not stored. A table that
    fails keeps what was stored and does not stop the others. The run keeps a record per
    table that is written when it begins and when it ends. Called again with the same
    `run_id`, a run leaves out what it has completed and goes on with the rest; a table that
    was stopped halfway starts anew from the table stored before. One summary row per table:
    rows delivered, rows stored afterwards, rows refused, and the error, blank if none.
    """

    def loader(name: str) -> Callable[[], None]:
        record = _run_record(spark, target, run_id, name)
        path, staged = f"{target}/{name}", f"{target}/_staged/{name}"

        def load() -> None:
            known = record.values()
            if known and known[1] == COMPLETED:
                return
            recover(spark, staged, path)
            record.put(name, RUNNING, 0, 0, 0, "", clock())
            rows = stage(mapped[name](), f"mapped-{name}")
            accepted = split_mapped(rows).accepted
            columns = [c for c in accepted.columns if c not in seq]
            there = has_file(spark, path, "")
            # No row without a table: as a limit of none, it costs no join with the new rows.
            stored = spark.read.parquet(path) if there else accepted.select(*columns).limit(0)
            upsert(stored, accepted, ["id"], seq).write.mode("overwrite").parquet(staged)
            publish(spark, staged, path)
            # One column is read here, and Parquet's own row counts below.
            counts = rows.agg(F.count(F.lit(1)), F.count(REJECT_REASON)).first()
            record.put(name, COMPLETED, counts[0], spark.read.parquet(path).count(), counts[1], "", clock())
            for file in rows.inputFiles()[:1]:
                remove(spark, file.rsplit("/", 1)[0])

        def run() -> None:
            try:
                load()
            except Exception as error:  # a table's failure is part of the record
                record.put(name, FAILED, 0, 0, 0, str(error), clock())
                raise

        return run

    load_in_order({name: loader(name) for name in mapped}, order)
    state = run_state(spark, target, run_id, list(mapped))
    return state.select("table_name", "delivered", "stored", "refused", "error")


def reject_counts(mapped: DataFrame, kind: str) -> DataFrame:
    """Refused nodes per reason."""
    return (
        split_mapped(mapped)
        .rejects.groupBy(F.col(REJECT_REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(kind).alias("entity_type"), "reason", "n")
    )
