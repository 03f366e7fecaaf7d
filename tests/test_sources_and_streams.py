import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans.pipelines import load_in_order
from tidemark.session import folders_in, release, scratch_path, stage
from tidemark.sources import files, introspection, pages
from tidemark.streaming import feed, rates


def page(number, ids, total):
    edges = [{"node": {"id": i, "v": number}} for i in ids] + [{"node": None}]
    body = {"totalCount": total, "edges": edges, "pageInfo": {"hasNextPage": False, "endCursor": None}}
    cost = {"requestedQueryCost": 9, "actualQueryCost": 3, "throttleStatus": {"restoreRate": 500}}
    return json.dumps({"page": number, "data": {"clients": body}, "extensions": {"cost": cost}})


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def test_pages_keep_arrival_order_and_drop_null_nodes(spark, tmp_path):
    write(tmp_path / "in", "a.json", page(1, ["a", "b"], 3), page(2, ["c"], 99))
    read = pages.read_pages(spark, str(tmp_path / "in"), "clients")
    found = pages.nodes_of(read).select("page", "pos", F.try_variant_get("node", "$.id", "string"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    totals = pages.page_totals(read).first()
    assert (totals.announced, totals.pages) == (3, 2)
    costs = pages.cost_envelopes(read, F.lit("clients(first: 7)")).first()
    assert (costs.query_type, costs.batch_size, costs.actual_cost, costs.maximum_available) == ("clients", 7, 3, None)


def test_feed_resumes_from_its_checkpoint(spark, tmp_path):
    source, target, cursor = (str(tmp_path / n) for n in ("in", "out", "cursor"))

    def run():
        stream = feed.page_stream(spark, source, "clients", files_per_batch=1)

        def prepare(df):
            return df.select(
                F.try_variant_get("node", "$.id", "string").alias("id"),
                F.try_variant_get("node", "$.v", "bigint").alias("v"),
                "page",
                "pos",
            )

        feed.upsert_stream(stream, target, cursor, ["id"], ["page", "pos"], prepare).awaitTermination()
        state = feed.current_state(spark, target, ["id"], ["page", "pos"])
        return sorted((r.id, r.v) for r in state.collect())

    write(tmp_path / "in", "a.json", page(1, ["a", "b"], 3))
    assert run() == [("a", 1), ("b", 1)]
    write(tmp_path / "in", "b.json", page(2, ["b", "c"], 3))
    assert run() == [("a", 1), ("b", 2), ("c", 2)]
    assert run() == [("a", 1), ("b", 2), ("c", 2)]
    feed.compact(spark, target, ["id"], ["page", "pos"])
    assert run() == [("a", 1), ("b", 2), ("c", 2)]
    write(tmp_path / "in", "c.json", page(3, ["c"], 3))
    assert run() == [("a", 1), ("b", 2), ("c", 3)]


def test_feeds_that_share_a_target_keep_their_rows(spark, tmp_path):
    target = str(tmp_path / "out")

    def run(name, rows):
        source = str(tmp_path / name)
        spark.createDataFrame(rows, "id string, v int").coalesce(1).write.mode("append").parquet(source)
        stream = feed.table_stream(spark, source, spark.read.parquet(source).schema)
        feed.upsert_stream(stream, target, str(tmp_path / f"{name}-cursor"), ["id"], ["v"]).awaitTermination()

    run("first", [("a", 1), ("b", 1)])
    run("second", [("b", 2), ("c", 1)])
    state = feed.current_state(spark, target, ["id"], ["v"])
    assert sorted((r.id, r.v) for r in state.collect()) == [("a", 1), ("b", 2), ("c", 1)]


def test_late_rows_are_counted(spark, tmp_path):
    source, target, cursor = (str(tmp_path / n) for n in ("in", "out", "cursor"))
    for time in ("2024-01-05 10:00:00", "2024-01-01 10:10:00", "2024-01-05 10:30:00", "2024-01-01 10:20:00"):
        row = spark.createDataFrame([(time, "x")], "ts string, kind string")
        row.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    stream = feed.table_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    rates.count_stream(stream, target, cursor, "ts", ["kind"], "1 hour").awaitTermination()
    assert sorted(r.requests for r in rates.rate_per_window(spark, target, ["kind"]).collect()) == [2, 2]


def test_new_only_stream_keeps_the_first(spark, tmp_path):
    source, target, cursor = (str(tmp_path / n) for n in ("in", "out", "cursor"))

    def run(rows):
        spark.createDataFrame(rows, "id string, v int").coalesce(1).write.mode("append").parquet(source)
        stream = feed.table_stream(spark, source, spark.read.parquet(source).schema)
        feed.new_only_stream(stream, target, cursor, ["id"], ["v"]).awaitTermination()
        return sorted((r.id, r.v) for r in spark.read.parquet(target).collect())

    assert run([("a", 2), ("a", 1)]) == [("a", 1)]
    assert run([("a", 9), ("b", 5)]) == [("a", 1), ("b", 5)]
    feed.compact(spark, target, ["id"], ["v"])
    cursor = str(tmp_path / "another")
    assert run([("c", 1)]) == [("a", 1), ("b", 5), ("c", 1)]


def test_field_inventory_round_trip(spark, tmp_path):
    wrapped = {"kind": "NON_NULL", "ofType": {"kind": "LIST", "ofType": {"kind": "SCALAR", "name": "ID"}}}
    document = {
        "results": {
            "Client": {"kind": "OBJECT", "fields": [{"name": "ids", "type": wrapped}]},
            "State": {"kind": "ENUM"},
        }
    }
    (tmp_path / "schema.json").write_text(json.dumps(document))
    fields = introspection.field_inventory(introspection.read_introspection(spark, str(tmp_path / "schema.json")))
    introspection.write_field_inventory(fields, str(tmp_path / "csv"))
    back = introspection.read_field_inventory(spark, str(tmp_path / "csv"))
    assert [tuple(r) for r in back.collect()] == [("Client", "ids", "[ID]!", "ID", "No", "OBJECT")]


def test_hashed_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"abc")
    row = files.hashed_files(spark, str(tmp_path), "*.txt").first()
    digest = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert (row.length, row.stored_name) == (3, f"{digest}.txt")


def test_load_order_goes_on_after_a_failure():
    ran = []

    def fails():
        raise RuntimeError("broken")

    got = load_in_order({"jobs": lambda: ran.append("jobs"), "users": fails, "clients": lambda: ran.append("clients")})
    assert ran == ["clients", "jobs"]
    assert got == {"users": "broken", "clients": "", "jobs": ""}


class FakeContext:
    applicationId = "fake"

    def __init__(self, master):
        self.master, self.folder = master, None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    conf = {}

    def __init__(self, master):
        self.sparkContext = FakeContext(master)


def test_release_removes_scratch_tables(spark):
    staged = stage(spark.range(3), "kept")
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert folders_in(spark, path.rsplit("/", 1)[0])
    release(spark)
    assert not any(f.endswith(path.rsplit("/", 1)[1]) for f in folders_in(spark, path.rsplit("/", 1)[0]))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    local = FakeSession("local[2]")
    first, second = scratch_path(local, "x"), scratch_path(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        scratch_path(FakeSession("yarn"), "x")
