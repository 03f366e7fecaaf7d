"""Tables that grow by batches: folding, the key index, outcomes, counts, records, runs."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import inventory, snapshots
from tidemark.plans import pipelines
from tidemark.session import absolute, folders_in, has_file, move, remove
from tidemark.sources import files, keydirectory
from tidemark.sources.records import Record
from tidemark.streaming import batches, feed, outcomes, rates
from tidemark.streaming.keyindex import KeyIndex

PAIR = "id long, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(spark, target, folder, values, schema=PAIR):
    batches.write_batch(spark.createDataFrame(values, schema), target, folder)


def total(frame):
    return frame.groupBy("id").agg(F.sum("v").cast("int").alias("v"))


def test_folded_batches_count_once_even_when_replayed(spark, tmp_path):
    target = str(tmp_path / "t")
    for batch in range(3):
        put(spark, target, ("a", batch), [(1, 1), (2, batch)])
    want = rows(total(batches.read_live(spark, target)))
    batches.fold(spark, target, total)
    assert rows(total(batches.read_live(spark, target))) == want
    put(spark, target, ("a", 2), [(1, 1), (2, 2)])  # the last batch again
    assert rows(total(batches.read_live(spark, target))) == want
    put(spark, target, ("a", 3), [(1, 5)])
    batches.fold(spark, target, total)
    batches.fold(spark, target, total)
    assert rows(total(batches.read_live(spark, target))) == [(1, 8), (2, 3)]
    assert len(batches.live_folders(spark, target)) == 1


def test_a_fold_that_stops_halfway_shows_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    for batch in range(3):
        put(spark, target, ("a", batch), [(batch, 1)])
    want = rows(total(batches.read_live(spark, target)))

    def stops(folder, frame):
        raise OSError("lost")

    with pytest.raises(OSError):
        batches.fold(spark, target, total, before=stops)
    assert len(batches.all_folders(spark, target)) == 4
    assert rows(total(batches.read_live(spark, target))) == want
    batches.fold(spark, target, total)
    assert rows(total(batches.read_live(spark, target))) == want


def test_key_index_against_a_set(spark, tmp_path):
    target, seen = str(tmp_path / "t"), set()
    index = KeyIndex(spark, target, spark.createDataFrame([], "id long, part string").schema, buckets=8, runs=3)
    pick = random.Random(4)
    for batch in range(10):
        ids = [(pick.randrange(150), pick.choice(["x", None])) for _ in range(40)]
        frame = spark.createDataFrame([*ids, (None, None)], "id long, part string")
        new = index.unseen(frame.distinct(), but=("f", batch))
        assert set(map(tuple, new.collect())) == {*ids, (None, None)} - seen
        index.add(frame, ("f", batch))
        seen |= {*ids, (None, None)}
        index.tidy(but=("f", batch))
    assert len(index.runs()) <= 6


def test_work_of_a_batch_does_not_grow_with_what_is_stored(spark, tmp_path):
    """Twenty batches of new keys: the keys read stay a small share of a batch."""
    target = str(tmp_path / "t")
    index = KeyIndex(spark, target, spark.createDataFrame([], "id long").schema, buckets=4)
    read, runs = [], []
    for batch in range(20):
        frame = spark.range(batch * 500, (batch + 1) * 500).select(F.xxhash64("id").alias("id"))
        parts = index.candidates(frame, ("f", batch))
        read.append(sum(n for _, _, n in parts))
        runs.append(len(index.runs()))
        assert index.unseen(frame, but=("f", batch)).count() == 500
        index.add(frame, ("f", batch))
        index.tidy(but=("f", batch))
    assert max(runs) <= 2 * 8 + 1
    assert sum(read[10:]) / 10 < 2500 and max(read) < 5000  # 9,500 keys are stored at the end
    known = spark.range(500).select(F.xxhash64("id").alias("id"))
    assert index.unseen(known).count() == 0


def test_an_index_keeps_the_buckets_it_was_made_with(spark, tmp_path):
    target, schema = str(tmp_path / "t"), spark.createDataFrame([], "id long").schema
    KeyIndex(spark, target, schema, buckets=3).add(spark.range(50), ("f", 0))
    assert KeyIndex(spark, target, schema, buckets=64).unseen(spark.range(60)).count() == 10
    put(spark, target, ("g", 0), [(55, 1)])
    assert KeyIndex.of(spark, target, ["id"]).unseen(spark.range(60)).count() == 10


def test_a_replayed_batch_writes_the_same_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    put(spark, target, ("before", 0), [(1, 0)])
    source, cursor = str(tmp_path / "in"), str(tmp_path / "cursor")
    schema = spark.createDataFrame([], PAIR).schema

    def run():
        stream = feed.table_stream(spark, source, schema)
        feed.new_only_stream(stream, target, cursor, ["id"], ["v"]).awaitTermination()
        return rows(batches.read_live(spark, target).select("id", "v"))

    for number, values in enumerate([[(1, 9), (2, 1)], [(2, 5), (3, 1)]]):
        spark.createDataFrame(values, PAIR).coalesce(1).write.mode("append").parquet(source)
        got = run()
    assert got == [(1, 0), (2, 1), (3, 1)]
    # The commit of the last batch is lost: it runs again.
    for name in ("1", ".1.crc"):
        (tmp_path / "cursor" / "commits" / name).unlink()
    assert run() == got


def test_feeds_are_named_by_place_not_by_spelling(spark, tmp_path):
    assert feed.feed_of(spark, str(tmp_path)) == feed.feed_of(spark, f"file:{tmp_path}/")
    assert absolute(spark, f"file://{tmp_path}") == absolute(spark, str(tmp_path))


QUEUE = "id string, status string, attempt_count int, last_error string, updated_at string"
FACT = "id string, n int, kind string, error string, at string"


def folded_queue(queue, facts, as_of, ttl):
    """The same by a loop over outcomes in order."""
    out = []
    for id_, status, attempts, error, at in queue:
        for _, _, kind, text, when in sorted({f for f in facts if f[0] == id_}, key=lambda f: f[1]):
            at = when
            if kind == "claimed":
                status = "in_progress"
            elif kind == "succeeded":
                status, error = "done", None
            else:
                status, error, attempts = "failed", text or "Unknown error", attempts + 1
        if status == "in_progress" and any(f[0] == id_ for f in facts) and int(as_of[8:10]) - int(at[8:10]) > ttl:
            status = "pending"
        out.append((id_, status, attempts, error, at))
    return sorted(out, key=repr)


def test_outcomes_in_any_order_and_twice(spark, tmp_path):
    pick = random.Random(3)
    queue = [(f"q{i}", "pending", 0, None, "2024-01-01T00:00:00Z") for i in range(12)]
    facts = [
        (f"q{pick.randrange(14)}", n, pick.choice(["claimed", "succeeded", "failed"]), pick.choice(["boom", None]),
         f"2024-01-{pick.randrange(1, 28):02d}T00:00:00Z")
        for n in range(60)
    ]
    source, target, cursor = (str(tmp_path / n) for n in ("in", "t", "cursor"))
    frame, schema = spark.createDataFrame(queue, QUEUE), spark.createDataFrame([], FACT).schema
    assert rows(outcomes.queue_state(spark, target, frame, ["id"], ["n"], "2024-01-28")) == sorted(queue, key=repr)
    pick.shuffle(facts)
    for part in (facts[:25], facts[25:45], facts[10:30], facts[45:]):  # some arrive twice
        spark.createDataFrame(part, FACT).coalesce(1).write.mode("append").parquet(source)
    stream = feed.table_stream(spark, source, schema, files_per_batch=1)
    outcomes.outcome_stream(stream, target, cursor, ["id"], ["n"]).awaitTermination()
    as_of = "2024-01-28T00:00:00Z"
    want = folded_queue(queue, facts, as_of, 10)

    def state():
        return rows(outcomes.queue_state(spark, target, frame, ["id"], ["n"], as_of, 10 * 86400))

    assert state() == want
    outcomes.fold_outcomes(spark, target, ["id"], ["n"])
    assert state() == want


def test_counts_are_added_up_and_rolled_up(spark, tmp_path):
    source, target, cursor = (str(tmp_path / n) for n in ("in", "t", "cursor"))
    times = [f"2024-01-01 {h:02d}:{m:02d}:00" for h in range(3) for m in (1, 1, 7, 59)]
    for part in (times[::2], times[1::2]):
        frame = spark.createDataFrame([(t, "x") for t in part], "ts string, kind string")
        frame.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
    stream = feed.table_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    rates.count_stream(stream, target, cursor, "ts", ["kind"], "1 minute").awaitTermination()
    minutes = rows(rates.rate_per_window(spark, target, ["kind"]))
    assert len(minutes) == 9 and sum(r[2] for r in minutes) == 12
    rates.fold_counts(spark, target, ["kind"])
    assert rows(rates.rate_per_window(spark, target, ["kind"])) == minutes
    rates.fold_counts(spark, target, ["kind"], "1 hour")
    assert [r[2] for r in rows(rates.rate_per_window(spark, target, ["kind"]))] == [4, 4, 4]
    for name in ("1", ".1.crc"):
        (tmp_path / "cursor" / "commits" / name).unlink()
    stream = feed.table_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    rates.count_stream(stream, target, cursor, "ts", ["kind"], "1 minute").awaitTermination()
    assert [r[2] for r in rows(rates.rate_per_window(spark, target, ["kind"], "1 hour"))] == [4, 4, 4]


def test_feed_record_is_readable_while_the_feed_runs(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "t")
    for part in ([(1, 1), (2, 1)], [(3, 1)], [(3, 2), (4, 1)]):
        spark.createDataFrame(part, PAIR).coalesce(1).write.mode("append").parquet(source)
    record = feed.FeedRecord(spark, str(tmp_path / "r"), "requests", target, lambda: "now")
    seen = []

    def after(batch_id):
        record.batch_done(batch_id)
        seen.append(tuple(record.read().first())[1:4])

    assert record.read().count() == 0
    stream = feed.table_stream(spark, source, spark.createDataFrame([], PAIR).schema, files_per_batch=1)
    query = feed.new_only_stream(stream, target, str(tmp_path / "c"), ["id"], ["v"], after)
    query.awaitTermination()
    record.finished(query)
    assert [s[0] for s in seen] == ["0", "1", "2"] and {s[2] for s in seen} == {"in_progress"}
    assert seen[-1][1] == 4
    assert tuple(record.read().first())[1:4] == (None, 4, "completed")


def test_record_ignores_a_version_that_is_not_whole(spark, tmp_path):
    record = Record(spark, str(tmp_path / "r"), "a int")
    for value in range(4):
        record.put(value)
    (tmp_path / "r" / "_000000000009").write_text("[")  # a writer that stopped halfway
    assert record.values() == [3] and record.read().first()["a"] == 3
    assert len(list((tmp_path / "r").glob("0*.json"))) == 2


MAPPED = "id string, name string, seq int, reject_reason string"


def test_run_goes_on_where_it_stopped(spark, tmp_path):
    target, calls = str(tmp_path / "run"), []

    def gives(name, values):
        def build():
            calls.append(name)
            return spark.createDataFrame(values, MAPPED)

        return build

    def fails():
        calls.append("fails")
        raise OSError("no source")

    users = gives("users", [("1", "old", 1, None), ("1", "new", 2, None), ("2", "x", 1, None), (None, "y", 1, "missing id")])
    first = pipelines.migrate(spark, {"users": users, "clients": fails}, target, ["seq"])
    assert rows(first) == [("clients", 0, 0, 0, "no source"), ("users", 4, 2, 1, "")]
    state = pipelines.run_state(spark, target, "run", ["users", "clients", "jobs"])
    assert dict((r.table_name, r.status) for r in state.collect()) == {
        "users": "completed", "clients": "failed", "jobs": "pending"
    }
    again = pipelines.migrate(spark, {"users": users, "clients": gives("clients", [("7", "c", 1, None)])}, target, ["seq"])
    assert rows(again) == [("clients", 1, 1, 0, ""), ("users", 4, 2, 1, "")]
    assert calls == ["users", "fails", "clients"]
    assert rows(spark.read.parquet(f"{target}/users")) == [("1", "new"), ("2", "x")]
    more = gives("users", [("2", "z", 5, None), ("3", "w", 1, None)])
    pipelines.migrate(spark, {"users": more}, target, ["seq"], "second run")
    assert rows(spark.read.parquet(f"{target}/users")) == [("1", "new"), ("2", "z"), ("3", "w")]


@pytest.mark.parametrize("stopped", ["before", "between", "after"])
def test_a_table_survives_a_stop_while_it_is_published(spark, tmp_path, stopped):
    path, staged = str(tmp_path / "users"), str(tmp_path / "_staged")
    spark.createDataFrame([("1", "old")], "id string, name string").write.parquet(path)
    spark.createDataFrame([("1", "new")], "id string, name string").write.parquet(staged)
    if stopped != "before":
        move(spark, path, f"{path}.old")
    if stopped == "after":
        move(spark, staged, path)
    pipelines.recover(spark, staged, path)
    assert rows(spark.read.parquet(path)) == [("1", "old" if stopped == "before" else "new")]
    if has_file(spark, staged, "_SUCCESS"):
        pipelines.publish(spark, staged, path)
    assert rows(spark.read.parquet(path)) == [("1", "new")]


def test_the_old_table_comes_back_where_nothing_was_staged(spark, tmp_path):
    path = str(tmp_path / "users")
    spark.createDataFrame([("1",)], "id string").write.parquet(f"{path}.old")
    pipelines.recover(spark, str(tmp_path / "none"), path)
    assert spark.read.parquet(path).count() == 1


def files_read(df):
    """Files that the scans of a frame open, by their own count."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


RECORD = "entity_type string, entity_id string, map_snapshot_id string, updated_at string"


def test_unchanged_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "s")
    old = [("clients", str(i), "a", "2024-01-01") for i in range(400)] + [("jobs", None, "a", None)]
    new = [(k, i, "b", "2024-02-01" if i == "7" else t) for k, i, _, t in old if i != "9"] + [("jobs", "x", "b", None)]
    for name, values in (("a", old), ("b", new)):
        snapshots.write_snapshot(spark.createDataFrame(values, RECORD), path, name, buckets=32)
    changed = snapshots.changed_buckets(spark, path, "a", "b")
    assert 1 <= len(changed) <= 3
    diff = snapshots.stored_diff(spark, path, "a", "b")
    assert {(r.entity_id, r.change) for r in diff.collect()} == {("7", "changed"), ("9", "deleted"), ("x", "new")}
    for name in ("a", "b"):
        read = snapshots.read_snapshot(spark, path, name, changed)
        assert files_read(read) == len(changed) < files_read(snapshots.read_snapshot(spark, path, name))
    snapshots.write_snapshot(spark.createDataFrame(old, RECORD), path, "a", buckets=32)
    assert snapshots.changed_buckets(spark, path, "a", "a") == []
    assert snapshots.stored_diff(spark, path, "a", "a").count() == 0


def test_snapshots_of_other_bucket_counts_and_half_written_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    frame = spark.createDataFrame([("c", str(i), "a", "2024") for i in range(20)], RECORD)
    snapshots.write_snapshot(frame, path, "a", buckets=4)
    snapshots.write_snapshot(frame.withColumn("map_snapshot_id", F.lit("b")).limit(19), path, "b", buckets=8)
    assert snapshots.stored_diff(spark, path, "a", "b").count() == 1
    remove(spark, f"{path}/_digests/map_snapshot_id=b")
    assert snapshots.stored_snapshots(spark, path) == ["a"]
    with pytest.raises(ValueError):
        snapshots.stored_diff(spark, path, "a", "b")


def test_an_inventory_write_reads_its_own_partitions(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "i"), []
    schema = RECORD + ", discovered_at string"

    def write(snapshot, kind, when):
        frame = spark.createDataFrame([(kind, str(i), snapshot, None, when) for i in range(5)], schema)
        inventory.write_inventory(frame, path)

    write("a", "clients", "1")
    write("a", "jobs", "1")
    real = inventory.upsert
    monkeypatch.setattr(inventory, "upsert", lambda base, *rest: seen.append(files_read(base)) or real(base, *rest))
    write("a", "clients", "2")
    clients = list((tmp_path / "i" / "map_snapshot_id=a" / "entity_type=clients").glob("*.parquet"))
    jobs = list((tmp_path / "i" / "map_snapshot_id=a" / "entity_type=jobs").glob("*.parquet"))
    assert jobs and 0 < seen[0] <= len(clients) + 4
    stored = spark.read.parquet(path)
    assert rows(stored.groupBy("entity_type", "discovered_at").count()) == [("clients", "2", 5), ("jobs", "1", 5)]


def test_pages_read_the_files_that_hold_them(spark, tmp_path):
    path = str(tmp_path / "k")
    pick = random.Random(1)
    ids = pick.sample(range(100_000), 900)
    frame = spark.createDataFrame([(i, i % 7) for i in ids] + [(None, 1)], PAIR)
    keydirectory.write_in_order(frame, path, "id", files=30)
    after, got = None, []
    while True:
        files_read = keydirectory.files_of_page(spark, path, frame.schema, "id", after, 50)
        page = keydirectory.page_in_order(spark, path, frame.schema, "id", after, 50).collect()
        if not page:
            break
        assert len(files_read) <= 5
        got += [r["id"] for r in page]
        after = got[-1]
    assert got == sorted(ids)
    keydirectory.write_in_order(frame.limit(0), path, "id")
    assert keydirectory.page_in_order(spark, path, frame.schema, "id", None, 5).count() == 0


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    import hashlib

    contents = {f"{n}.bin": bytes(random.Random(n).randbytes(n)) for n in (1, 4095, 4096, 100_000)}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r for r in files.hashed_files(spark, str(tmp_path), "*.bin", 4095, 1024).collect()}
    assert {n: r.hash for n, r in got.items()} == {n: hashlib.sha256(d).hexdigest() for n, d in contents.items()}
    assert {n: r.length for n, r in got.items()} == {n: len(d) for n, d in contents.items()}
    whole = files.hashed_files(spark, str(tmp_path), "*.bin")
    assert rows(whole) == sorted((tuple(r) for r in got.values()), key=repr)
