import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, costlog, downloads, inventory, mapping, merge, notes, queues, ranking, validate
from tidemark.operators.downloads import DownloadFilters
from tidemark.operators.merge import Reference
from tidemark.operators.specs import SPECS
from tidemark.operators.validate import ForeignKey


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_upsert_last_writer_wins_and_resets_missing_columns(spark):
    base = spark.createDataFrame([("a", "x", "h1"), ("b", "y", "h2")], "id string, name string, hash string")
    batch = spark.createDataFrame([("a", "n1", 1), ("a", "n2", 2), ("c", "n3", 1)], "id string, name string, seq int")
    assert rows(merge.upsert(base, batch, ["id"], ["seq"])) == [
        ("a", "n2", None),
        ("b", "y", "h2"),
        ("c", "n3", None),
    ]
    with_default = merge.upsert(base, batch, ["id"], ["seq"], {"hash": "none"})
    assert ("a", "n2", "none") in rows(with_default)


def test_patch_keeps_what_the_change_lacks(spark):
    base = spark.createDataFrame([("a", "x", "h1")], "id string, name string, hash string")
    change = spark.createDataFrame([("a", None, "h2")], "id string, name string, hash string")
    assert rows(merge.patch(base, change, ["id"], ["name", "hash"])) == [("a", "x", "h2")]
    assert rows(merge.update_rows(base, change, ["id"])) == [("a", None, "h2")]


def test_insert_or_ignore_keeps_status(spark):
    schema = "entity_type string, entity_id string, map_snapshot_id string"
    snapshot = spark.createDataFrame([("clients", "1", "s"), ("clients", "2", "s")], schema)
    empty = spark.createDataFrame([], queues.EXTRACT_SCHEMA)
    first = queues.queue_from_inventory(empty, snapshot, "t1")
    done = first.withColumn("status", F.when(F.col("entity_id") == "1", "done").otherwise("pending"))
    again = queues.queue_from_inventory(done, snapshot, "t2")
    assert rows(again.select("entity_id", "status", "updated_at")) == [("1", "done", "t1"), ("2", "pending", "t1")]


def test_cascade_and_set_null(spark):
    tables = {
        "clients": spark.createDataFrame([("c1",), ("c2",)], "id string"),
        "jobs": spark.createDataFrame([("j1", "c1"), ("j2", "c2")], "id string, client_id string"),
        "expenses": spark.createDataFrame([("e1", "j1"), ("e2", "j2")], "id string, job_id string"),
        "requests": spark.createDataFrame([("r1", "j1")], "id string, job_id string"),
    }
    doomed = spark.createDataFrame([("c1",)], "id string")
    after = merge.delete_with_references(
        tables,
        "clients",
        doomed,
        "id",
        [
            Reference("jobs", "client_id", "clients"),
            Reference("expenses", "job_id", "jobs"),
            Reference("requests", "job_id", "jobs", action="set_null"),
        ],
    )
    assert rows(after["jobs"]) == [("j2", "c2")]
    assert rows(after["expenses"]) == [("e2", "j2")]
    assert rows(after["requests"]) == [("r1", None)]


def test_hotspots_and_density(spark):
    def inv(id_, n, a, kind="clients"):
        return (kind, id_, json.dumps({"notes": n, "attachments": a}))

    frame = spark.createDataFrame(
        [inv("1", 50, 25), inv("2", 10, 5), inv("3", 100, 50), inv("4", 15, 0)],
        "entity_type string, entity_id string, estimated_relations_json string",
    )
    top = inventory.hotspots(frame, 3).select("entity_id", "total_relations", "rank")
    assert sorted(rows(top), key=lambda r: r[2]) == [("3", 150, 1), ("1", 75, 2), ("2", 15, 3)]
    assert "WindowGroupLimit" in plan(top)
    some = spark.createDataFrame(
        [inv("1", 10, 5), inv("2", 20, 10), inv("3", 0, 0)], frame.schema
    )
    assert rows(inventory.density(some)) == [("clients", 3, 15.0, 30, 2)]


def test_new_since_last_snapshot(spark):
    schema = "entity_type string, entity_id string, updated_at string"
    old = spark.createDataFrame([("clients", f"clients_{i}", "t") for i in range(5)], schema)
    new = spark.createDataFrame([("clients", f"clients_{i}", "t") for i in range(8)], schema)
    got = [r[1] for r in rows(inventory.new_since(old, new))]
    assert got == ["clients_5", "clients_6", "clients_7"]


def test_sparse_inventory_leaves_absent_relations_out(nodes):
    frame = nodes(
        '{"id": "1", "createdAt": "t", "notes": {"totalCount": 4}}', '{"id": "2", "noteAttachments": null}'
    )
    found = inventory.inventory_of_nodes(frame, SPECS["visit"], "s", "now")
    got = rows(found.select("entity_id", "updated_at", "estimated_relations_json"))
    assert got == [("1", "t", '{"notes":4}'), ("2", None, "{}")]


def test_queue_transitions(spark):
    queue = spark.createDataFrame(
        [("k", "1", "pending", 0, None, "s", "t0"), ("k", "2", "failed", 1, "old", "s", "t0"), ("k", "3", "done", 0, None, "s", "t0")],
        queues.EXTRACT_SCHEMA,
    )
    results = spark.createDataFrame(
        [("k", "1", "s", False, None), ("k", "2", "s", True, None)],
        "entity_type string, entity_id string, map_snapshot_id string, success boolean, error string",
    )
    after = queues.apply_results(queue, results, queues.EXTRACT_KEY, "t1")
    assert rows(after.select("entity_id", "status", "attempt_count", "last_error", "updated_at")) == [
        ("1", "failed", 1, "Unknown error", "t1"),
        ("2", "done", 1, None, "t1"),
        ("3", "done", 0, None, "t0"),
    ]


def test_foreign_keys_count_blanks_and_hot_values(spark):
    jobs = spark.createDataFrame([("",)] * 500 + [("c1",), ("c9",), (None,)], "client_id string")
    tables = {"jobs": jobs, "clients": spark.createDataFrame([("c1",)], "id string")}
    rule = [ForeignKey("jobs", "client_id", "clients"), ForeignKey("absent", "x", "clients")]
    assert rows(validate.foreign_key_orphans(tables, rule)) == [("jobs", "client_id", "clients.id", 501)]
    assert rows(validate.foreign_key_orphans(tables, rule, True))[0][3] == 1


def test_polymorphic_case(spark):
    frame = spark.createDataFrame([("client", "1"), ("client", "9"), ("Client", "9")], "entity_type string, entity_id string")
    parents = {"Client": spark.createDataFrame([("1",)], "id string")}
    assert rows(validate.polymorphic_orphans(frame, parents)) == [("client", 2)]
    assert rows(validate.polymorphic_orphans(frame, parents, strict_case=True)) == [("Client", 1)]


def test_failure_severity_is_strictly_below_a_tenth(spark):
    frame = spark.createDataFrame([(1, 10), (1, 11)], "f bigint, e bigint")
    got = [r[0] for r in frame.select(validate.failure_severity(F.col("f"), F.col("e"))).collect()]
    assert got == ["error", "warning"]


def test_filters_validate_and_handle_unknown_sizes(spark):
    with pytest.raises(ValueError):
        DownloadFilters(min_size=-1)
    with pytest.raises(ValueError):
        DownloadFilters(min_size=5, max_size=1)
    work = spark.createDataFrame(
        [("1", "clients", "a.PDF", 10, True), ("2", "clients", None, None, False), ("3", "jobs", "b.txt", None, True)],
        "attachment_id string, parent_type string, file_name string, file_size bigint, found boolean",
    )

    def kept(**limits):
        return [r[0] for r in rows(downloads.filter_work(work, DownloadFilters(**limits)))]

    assert kept() == ["1", "2", "3"]
    assert kept(file_types=[".pdf"]) == ["1"]
    assert kept(max_size=100) == ["1"]
    assert kept(parent_types=["CLIENTS"]) == ["1", "2"]


def test_note_parent_precedence_and_lenient_mapping(nodes):
    frame = nodes(
        '{"id": "n1", "client": {"id": "c"}, "job": {"id": "j"}}', '{"id": "n2"}', '{"message": "x", "job": {}}'
    )
    strict = mapping.map_notes(frame)
    assert rows(strict.select("entity_type", "entity_id", "reject_reason")) == [
        ("client", "c", None),
        ("job", "", "missing id"),
        (None, None, "missing parent"),
    ]
    lenient = mapping.map_notes(frame, lenient=True)
    assert rows(lenient.select("id", "entity_type", "entity_id")) == [
        ("ORPHANED_NOTE_MISSING_ID", "job", "UNKNOWN"),
        ("n1", "client", "c"),
        ("n2", "ORPHANED", "UNKNOWN"),
    ]


def test_orphaned_attachment_path(spark):
    frame = spark.createDataFrame([("j/5", '{"id": "a", "fileName": "f.pdf", "fileSize": 2.5}')], "parent string, t string")
    kids = frame.select("parent", F.parse_json("t").alias("child"))
    got = notes.inline_attachments(kids, "parent").accepted
    assert rows(got.select("local_file_path", "file_size", "orphaned")) == [
        ("./attachments/ORPHANED/j/5/f.pdf", 0, True)
    ]
    assert rows(notes.orphan_issues(got, "job", "parent"))[0][4] == "./attachments/ORPHANED/5/"


def test_quote_refuses_text_amounts_and_null_relation_id_is_text(nodes):
    quote = nodes('{"id": "q", "client": {"id": "c"}, "amounts": {"total": "1.0"}}')
    assert mapping.map_entities(quote, SPECS["quote"]).first().reject_reason == "amount is not a number"
    job = nodes('{"id": "j", "client": {"id": null}}')
    assert mapping.map_entities(job, SPECS["job"]).first().client_id == "None"


def test_running_totals_against_brute_force_with_a_hot_key(spark):
    random.seed(1)
    data = [(0 if random.random() < 0.4 else random.randrange(1, 20), i // 3, i, random.randrange(9)) for i in range(4000)]
    frame = spark.createDataFrame(data, "k int, t int, id int, x int")
    got = ranking.running_totals(frame, ["k"], ["t", "id"], {"total": F.col("x").cast("bigint")})
    seen, want = defaultdict(int), {}
    for k, t, i, x in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        seen[k] += x
        want[i] = seen[k]
    assert {r.id: r.total for r in got.collect()} == want


def test_moving_average_against_fold(spark):
    random.seed(2)
    data = [("a", i, random.random()) for i in range(900)] + [("b", 0, 3.0)] + [("c", i, 0.0 if i < 2 else 5.0) for i in range(4)]
    frame = spark.createDataFrame(data, "k string, t int, x double")
    want = {}
    for k, _, x in data:
        avg = want.get(k, 0.0)
        want[k] = x if avg == 0 else 0.1 * x + 0.9 * avg
    got = {r.k: r.moving_average for r in ranking.moving_average(frame, ["k"], ["t"], "x").collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_cost_statistics_of_an_empty_log_are_zero(spark):
    empty = spark.createDataFrame(
        [], "id int, requested_cost bigint, actual_cost bigint, maximum_available bigint, currently_available bigint, restore_rate bigint"
    )
    assert set(costlog.cost_statistics(empty).first()) == {0}
    assert costlog.throttle_statistics(empty, ["id"]).first().queries_with_throttle_data == 0


def test_coverage_counts_extras_as_queried(spark):
    report = audit.coverage(
        audit.field_list(spark, {"T": ["a", "b", "c"]}), audit.field_list(spark, {"T": ["a", "x"]})
    ).first()
    assert (report.missing, report.extra, report.coverage_percent) == (2, 1, 66.7)


def test_inventory_is_partitioned_by_snapshot_and_kind(spark, tmp_path):
    schema = "entity_type string, entity_id string, map_snapshot_id string"
    frame = spark.createDataFrame([("clients", "1", "s1"), ("jobs", "2", "s1"), ("jobs", "3", "s2")], schema)
    inventory.write_inventory(frame, str(tmp_path / "inv"))
    one = spark.read.parquet(str(tmp_path / "inv")).where("map_snapshot_id = 's2' and entity_type = 'jobs'")
    assert [r.entity_id for r in one.collect()] == ["3"]
    kept = merge.prune_snapshot({"inv": frame}, "s1")["inv"]
    assert rows(kept) == [("jobs", "3", "s2")]


def test_default_snapshot_label_and_missing_types(spark):
    row = inventory.snapshot_row(spark, "id1", "2024-02-01T03:04:05+00:00", ["clients", "jobs"]).first()
    assert (row.label, row.entities_included) == ("map-20240201-030405", '["clients","jobs"]')
    assert inventory.missing_types(["jobs", "users"], ["clients", "jobs"]) == ["users"]


def test_a_hot_key_is_split_in_a_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        queue = spark.range(0, 60000, 1, 8).select(hot.alias("attachment_id"), F.rand(1).alias("x"))
        known = spark.range(200).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.lit("f.pdf").alias("file_name"),
            F.lit(1).alias("file_size"),
            F.lit("").alias("original_url"),
        )
        found = downloads.with_metadata(queue, known)
        assert sum(r.found for r in found.collect()) == 30000 + 100
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("alpha", [0.1, 0.01, 0.001, 1.0])
def test_moving_average_counts_every_row(spark, alpha):
    rng = random.Random(8)
    data = [("a", i, 1000.0 if i == 3 else 0.0 if i < 3 else rng.random()) for i in range(3000)]
    data += [("b", 1, 5.0), ("c", 1, 0.0), ("c", 2, None), ("d", 1, None)]
    want = {}
    for key, _, x in data:
        if x is not None:
            average = want.get(key, 0.0)
            want[key] = x if average == 0 else alpha * x + (1 - alpha) * average
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, i int, x double").repartition(7)
    got = {r.k: r.moving_average for r in ranking.moving_average(df, ["k"], ["i"], "x", alpha).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_top_rows_of_a_hot_key(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("v")).repartition(9)
    got = ranking.top_per_key(df, ["k"], [F.col("v").desc()], 100)
    assert sorted((r.rank, r.v) for r in got.collect()) == [(i + 1, 4999 - i) for i in range(100)]


def test_a_pass_keeps_to_its_snapshot(spark):
    key = "entity_type string, entity_id string, map_snapshot_id string"
    found = spark.createDataFrame([("jobs", str(i), s) for i in range(4) for s in ("s1", "s2")], key)
    queue = queues.queue_from_inventory(
        spark.createDataFrame([], queues.EXTRACT_SCHEMA), inventory.of_snapshot(found, "s1"), "t"
    ).withColumn("status", F.lit("done"))
    assert validate.completeness(found, queue, snapshot_id="s1").count() == 0
    missing = validate.completeness(found, queue, snapshot_id="s2").collect()
    assert [(r.type, r.difference) for r in missing] == [("entity_count_mismatch", 4)]
    assert validate.completeness(found, queue).count() == 1
    both = queues.queue_from_inventory(queue, found, "t")
    assert queues.select_work(both, types=["jobs"], snapshot_id="s2").count() == 4
    assert queues.select_work(both, types=["visits"]).count() == 0
    assert rows(queues.status_matrix(both, snapshot_id="s2")) == [("jobs", 4, 0, 0, 0, 4)]
    snapshots = spark.createDataFrame([("s1", '["jobs", "users"]')], "id string, entities_included string")
    assert inventory.snapshot_kinds(snapshots, "s1") == ["jobs", "users"]
    with pytest.raises(ValueError):
        inventory.snapshot_kinds(snapshots, "s1", ["jobs", "visits"])
    with pytest.raises(ValueError):
        inventory.snapshot_kinds(snapshots, "s9")


def test_writing_an_inventory_again_replaces_it(spark, tmp_path):
    schema = "entity_type string, entity_id string, discovered_at string, map_snapshot_id string"
    path = str(tmp_path / "inventory")
    frame = lambda *r: spark.createDataFrame(r, schema)
    inventory.write_inventory(frame(("jobs", "1", "t1", "s"), ("jobs", "2", "t1", "s"), ("users", "1", "t1", "s")), path)
    inventory.write_inventory(frame(("jobs", "2", "t2", "s"), ("jobs", "3", "t2", "s"), ("jobs", "1", "t2", "r")), path)
    got = spark.read.parquet(path).select("map_snapshot_id", "entity_type", F.col("entity_id").cast("string"), "discovered_at")
    assert rows(got) == [
        ("r", "jobs", "1", "t2"),
        ("s", "jobs", "1", "t1"),
        ("s", "jobs", "2", "t2"),
        ("s", "jobs", "3", "t2"),
        ("s", "users", "1", "t1"),
    ]


def test_density_of_an_empty_kind(spark):
    frame = spark.createDataFrame([("jobs", "1", '{"notes": 2}', "s")], "entity_type string, entity_id string, estimated_relations_json string, map_snapshot_id string")
    assert rows(inventory.density(frame, "s", ["jobs", "users"])) == [("jobs", 1, 2.0, 2, 1), ("users", 0, 0.0, 0, 0)]


def test_coverage_is_of_queried_kinds(spark):
    available = audit.field_list(spark, {"jobs": ["id", "title"], "users": ["id"]})
    queried = audit.field_list(spark, {"jobs": ["id", "title"]})
    report = audit.coverage(available, queried)
    assert rows(report) == [("jobs", 2, 2, 0, 0, 100.0)]
    assert audit.coverage_totals(report).first().avg_coverage == 100.0


def test_issues_count_skipped_notes(spark):
    files = spark.createDataFrame([("p1", True), ("p1", False), ("p2", True)], "parent string, orphaned boolean")
    skipped = spark.createDataFrame([("p1",), ("p3",), ("p3",)], "parent string")
    issues = notes.orphan_issues(files, "client", "parent", skipped)
    assert rows(notes.issue_summary(issues)) == [(3, 2, 3)]


def test_snapshot_by_id_or_label(spark):
    from tidemark.sources.tables import snapshot_named

    snapshots = spark.createDataFrame([("s1", "s2"), ("s2", "first"), ("s3", "first")], "id string, label string")
    assert [r.id for r in snapshot_named(snapshots, "s2").collect()] == ["s2"]
    assert [r.id for r in snapshot_named(snapshots, "first").collect()] == ["s2"]
    assert snapshot_named(snapshots, "none").count() == 0


def test_scans_are_dealt_only_where_asked(spark):
    from tidemark.sources.tables import SCAN_PARTITIONS, dealt

    scan = spark.range(10).coalesce(1)
    assert dealt(scan) is scan
    spark.conf.set(SCAN_PARTITIONS, "3")
    assert dealt(scan).rdd.getNumPartitions() == 3
    spark.conf.unset(SCAN_PARTITIONS)


def test_known_and_new_keys(spark):
    base = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    wanted = spark.createDataFrame([("a", 1), ("c", 2)], "id string, n int")
    assert rows(merge.existing_keys(base, wanted, ["id"])) == [("a", 1)]
    assert rows(merge.new_rows(base, wanted, ["id"])) == [("c", 2)]
    assert rows(merge.with_known(base, wanted, ["id"], "known")) == [("a", 1, True), ("c", 2, False)]
