"""What moves and what is read: ranks, averages, totals, keys, reports."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.functions.values import Node
from tidemark.operators import downloads, inventory, ranking, reports, validate
from tidemark.operators.downloads import DownloadFilters
from tidemark.operators.mapping import map_entities, split_mapped
from tidemark.operators.specs import SPECS
from tidemark.operators.validate import ForeignKey


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffled(df):
    """Rows written by each exchange of a frame, once it has run."""
    df.collect()
    counts, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange":
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                counts.append(metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return counts


def test_a_task_hands_over_n_rows_of_a_hot_key(spark):
    frame = spark.range(80_000).select(F.lit("hot").alias("key"), F.xxhash64("id").alias("v")).repartition(8)
    top = ranking.top_per_key(frame, ["key"], [F.col("v").desc()], 100)
    written = shuffled(top)
    assert top.count() == 100
    # The repartition that deals the input out, then at most n rows per task in either step.
    assert sorted(written)[-1] == 80_000 and all(w <= 8 * 100 for w in sorted(written)[:-1])


@pytest.mark.parametrize("alpha", [0.01, 0.1, 0.9, 0.999, 1.0])
def test_average_of_a_log_in_parts(spark, alpha):
    pick = random.Random(5)
    log = []
    for key in ("a", "b", "zeros", None):
        n = 3000 if key == "a" else 300
        for at in range(n):
            x = 0.0 if key == "zeros" or at < 20 else pick.uniform(-5, 50)
            log.append((key, at, x if pick.random() > 0.02 else None))
    want, started = {}, defaultdict(bool)
    for key, _, x in log:
        if x is None:
            continue
        old = want.get(key, 0.0)
        want[key] = alpha * x + (1 - alpha) * old if started[key] else x
        started[key] |= x != 0
    pick.shuffle(log)
    frame = spark.createDataFrame(log, "key string, at int, x double").repartition(6)
    whole = {r.key: r.moving_average for r in ranking.moving_average(frame, ["key"], ["at"], "x", alpha).collect()}
    assert whole == pytest.approx(want, rel=1e-9, abs=1e-12)
    stored = None
    for low, high in ((0, 10), (10, 150), (150, 151), (151, 9999)):
        part = ranking.average_folds(frame.where((F.col("at") >= low) & (F.col("at") < high)), ["key"], ["at"], "x", alpha)
        stored = part if stored is None else ranking.continued_folds(stored, part, ["key"], alpha)
    parts = {r.key: r.moving_average for r in ranking.average_of(stored, ["key"], alpha).collect()}
    assert parts == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_average_moves_rows_once(spark):
    """Rows go to their range; behind that only sums of stretches move."""
    frame = spark.range(50_000).select((F.col("id") % 3).alias("key"), "id", F.rand(1).alias("x"))
    written = sorted(shuffled(ranking.moving_average(frame, ["key"], ["id"], "x")))
    assert written[-1] == 50_000 and sum(written[:-1]) < 2500


def test_running_totals_go_on(spark):
    pick = random.Random(6)
    log = [(pick.choice("abc"), at, pick.randrange(10)) for at in range(400)]
    frame = spark.createDataFrame(log, "key string, at int, x int")
    totals = {"sum_x": F.col("x").cast("bigint"), "n": F.lit(1).cast("bigint")}
    want = rows(ranking.running_totals(frame, ["key"], ["at"], totals))
    got, start = [], None
    for low, high in ((0, 100), (100, 101), (101, 400)):
        part = frame.where((F.col("at") >= low) & (F.col("at") < high))
        got += rows(ranking.running_totals(part, ["key"], ["at"], totals, start))
        start = ranking.totals_at_end(part, ["key"], totals, start)
    assert sorted(got, key=repr) == want


def orphans(tables, rules):
    out = []
    for r in rules:
        keys = {row[r.parent_key] for row in tables[r.parent]}
        out.append((r.child, r.column, f"{r.parent}.{r.parent_key}", sum(row[r.column] is not None and row[r.column] not in keys for row in tables[r.child])))
    return sorted(out)


def test_keys_of_all_rules_in_one_grouping(spark):
    pick = random.Random(7)
    tables = {
        "a": [{"id": i, "b_id": pick.choice([None, i, 99]), "self_id": pick.choice([0, 1, 77])} for i in range(40)],
        "b": [{"id": pick.randrange(20), "a_id": 7 if i % 2 else pick.randrange(60), "c_id": i} for i in range(300)],
        "c": [{"id": i * 3, "a_id": None} for i in range(30)],
    }
    rules = [
        ForeignKey("a", "b_id", "b"), ForeignKey("a", "self_id", "a"), ForeignKey("b", "a_id", "a"),
        ForeignKey("b", "c_id", "c"), ForeignKey("c", "a_id", "a"), ForeignKey("c", "id", "b", "c_id"),
        ForeignKey("x", "id", "a"),
    ]
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in t], ", ".join(f"{c} long" for c in t[0])) for n, t in tables.items()}
    got = validate.foreign_key_orphans(frames, rules)
    assert rows(got) == orphans(tables, rules[:-1])
    text = {n: df.select([F.col(c).cast("string") for c in df.columns]) if n == "b" else df for n, df in frames.items()}
    assert rows(validate.foreign_key_orphans(text, rules)) == orphans(tables, rules[:-1])


def test_key_checks_scan_a_table_once(spark, tmp_path):
    frames = {}
    for name in ("a", "b"):
        spark.range(100).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y")).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    rules = [ForeignKey("a", "x", "b"), ForeignKey("a", "y", "b"), ForeignKey("b", "x", "a"), ForeignKey("b", "y", "b")]
    assert plan(validate.foreign_key_orphans(frames, rules)).count("FileScan") == 2


def test_mapped_against_extracted_with_two_exchanges(spark, tmp_path):
    schema = "entity_type string, entity_id string, map_snapshot_id string"
    inv_rows = [("c", "1", "s"), ("c", "1", "t"), ("c", "2", "s"), ("j", "1", "s"), ("j", "1", "s")]
    queue_rows = [("c", "1", "s", "done"), ("c", "1", "t", "failed"), ("c", "9", "s", "done"), ("j", "1", "s", "pending"), ("c", "2", "t", "done")]
    for name, values, kind in (("i", inv_rows, schema), ("q", queue_rows, schema + ", status string")):
        spark.createDataFrame(values, kind).write.parquet(str(tmp_path / name))
    inv, queue = spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "q"))
    every = validate.mapped_versus_extracted(inv, queue)
    assert rows(every) == [("c", 2, 1, 1), ("j", 1, 0, 0)]
    one = validate.mapped_versus_extracted(inv, queue, "s")
    assert rows(one) == [("c", 2, 1, 0), ("j", 1, 0, 0)]
    for frame in (every, one):
        assert plan(frame).count("Exchange hashpartitioning") <= 2 and "Join" not in plan(frame)
    assert "Join" not in plan(validate.completeness(inv, queue))


def test_amounts_that_no_cents_hold_are_refused(nodes):
    texts = ['"1e30"', "1e30", "-1e30", '"1,5"', "12.345", '"abc"', "null", "9.2e16", "92233720368547758.08", '"1e999"', "true"]
    frame = nodes(*[f'{{"id": "{i}", "balance": {t}}}' for i, t in enumerate(texts)])
    mapped = split_mapped(map_entities(frame, SPECS["client"]))
    refused = {r.id: r.reject_reason for r in mapped.rejects.select("id", "reject_reason").collect()}
    assert refused == dict.fromkeys(["0", "1", "2", "8", "9"], "amount out of range")
    kept = {r.id: r.balance_cents for r in mapped.accepted.collect()}
    assert kept == {"3": 1500, "4": 1234, "5": 0, "6": 0, "7": 9_200_000_000_000_000_000, "10": 100}
    node = Node("node")
    beyond = node.select(frame, [], {"b": money.beyond_cents(node, "balance")}).collect()
    assert [r.b for r in beyond] == [t in ('"1e30"', "1e30", "-1e30", "92233720368547758.08", '"1e999"') for t in texts]


def test_top_parents_and_largest(spark):
    parents = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, name string")
    children = spark.createDataFrame([(k, i) for i, n in enumerate([3, 0, 7, 3, 1]) for k in range(n)] + [(0, 99), (1, None)], "k long, parent long")
    top = reports.top_parents(parents, children, "id", "parent", 4)
    assert [tuple(r) for r in top.collect()] == [(2, "p2", 7), (0, "p0", 3), (3, "p3", 3), (4, "p4", 1)]
    assert reports.top_parents(parents, children.limit(0), "id", "parent", 2).collect()[0]["children"] == 0
    texts = spark.createDataFrame([(1, "aaa"), (2, None), (3, "bbb"), (4, "c")], "id long, text string")
    big = reports.largest(texts, F.length("text"), ["id"], 3)
    assert [(r.id, r.size) for r in big.collect()] == [(1, 3), (3, 3), (4, 1)]
    assert "TakeOrderedAndProject" in plan(big)


def test_pending_of_wanted_parents(spark):
    pending = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "id long, note long")
    notes = spark.createDataFrame([(10, "Client"), (10, "client"), (20, "Job")], "note_id long, kind string")

    def found(*kinds):
        return rows(downloads.pending_of_parents(pending, notes, "note", "note_id", F.col("kind"), DownloadFilters(parent_types=kinds)).select("id"))

    assert found() == [(1,), (2,), (3,)] and found("CLIENT") == [(1,)] and found("job", "client") == [(1,), (2,)]


def test_kinds_missing_from_many_snapshots(spark):
    snapshots = spark.createDataFrame([("a", '["x","y"]'), ("b", "[]"), ("c", None)], "id string, entities_included string")
    asked = spark.createDataFrame([("x",), ("z",), ("x",)], "entity_type string")
    assert rows(inventory.kinds_missing(snapshots, asked)) == [("a", "z"), ("b", "x"), ("b", "z"), ("c", "x"), ("c", "z")]
    assert inventory.kinds_missing(snapshots, asked.limit(0)).count() == 0


def test_a_map_pass_tells_of_kinds_without_records(spark):
    from tidemark.plans.pipelines import map_pass

    empty = spark.createDataFrame([], "text string").select(F.parse_json("text").alias("node"))
    full = spark.createDataFrame([('{"id": "1"}',)], "text string").select(F.parse_json("text").alias("node"))
    done = map_pass(spark, {"client": (SPECS["client"], full), "user": (SPECS["user"], empty)}, "s", "2024-01-01")
    assert rows(done.density) == [("clients", 1, 0.0, 0, 0), ("users", 0, 0.0, 0, 0)]


def one_file(spark, folder, name, df):
    df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def parts(spark, n):
    return spark.range(n).select(
        F.col("id").alias("p_partkey"), F.lit("SMALL TIN").alias("p_type"), (F.col("id") % 20).cast("int").alias("p_size")
    )


def lines(spark, n):
    return spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"),
        F.element_at(F.array(F.lit("R"), F.lit("A"), F.lit("N")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"), F.lit(0.01).alias("l_discount"), F.lit(2.0).alias("l_quantity"),
        F.lit(10.5).alias("l_extendedprice"), F.to_timestamp(F.lit("1996-05-01")).alias("l_shipdate"),
    )


def test_one_row_group_of_parts_is_worked_on_by_all_cores(spark, tmp_path):
    from tidemark.plans.audits import field_inventory

    one_file(spark, tmp_path, "part", parts(spark, 400))
    fields = field_inventory(spark, str(tmp_path))
    busy = fields.select(F.spark_partition_id().alias("p")).distinct().count()
    assert busy >= spark.sparkContext.defaultParallelism
    assert fields.count() == 3 * 9 * 20 and {r.full_type for r in fields.collect()} == {"ID", "[SMALL TIN]!", "[" * 6 + "SMALL TIN" + "]!" * 6}


def test_odd_levels_of_types(spark):
    from tidemark.functions import typenames

    cases = {
        '{"kind": 3, "name": {"a": 1}}': ('{"a":1}', '{"a":1}'),
        '{"kind": "LIST", "ofType": "text"}': ("[Unknown]", "Unknown"),
        '{"kind": "LIST", "ofType": null, "name": ""}': ("[Unknown]", "Unknown"),
        '{"kind": "LIST", "name": "\\"ofType\\"", "ofType": {"name": "A"}}': ("[A]", '"ofType"'),
        '[{"kind": "LIST"}]': ("Unknown", "Unknown"),
        '"text"': ("Unknown", "Unknown"),
    }
    frame = spark.createDataFrame([(c,) for c in cases], "t string").select("t", F.parse_json("t").alias("v"))
    got = frame.select("t", typenames.type_text(F.col("v")), typenames.base_type(F.col("v"))).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == cases


def test_a_field_list_is_worked_out_once(spark, tmp_path):
    from tidemark.sources import introspection

    asked = spark.sparkContext.accumulator(0)

    def said(n):
        asked.add(1)
        return f"t{n}"

    named = F.udf(said, "string").asNondeterministic()
    fields = spark.range(60).repartition(3).select(
        named("id").alias("Type"), F.lit("f").alias("Field"), *[F.lit("x").alias(c) for c in ("GraphQL Type", "Base Type", "Nullable", "Kind")]
    )
    introspection.write_field_inventory(fields, str(tmp_path / "csv"))
    assert asked.value == 60
    back = introspection.read_field_inventory(spark, str(tmp_path / "csv"))
    assert sorted(r.Type for r in back.collect()) == sorted(f"t{n}" for n in range(60))


def test_nodes_of_one_row_group_are_mapped_by_all_cores(spark, tmp_path):
    from tidemark.plans import packing
    from tidemark.plans.registry import Tables
    from tidemark.sources.tables import SCAN_PARTITIONS, spread

    one_file(spark, tmp_path, "lineitem", lines(spark, 400))
    cores = spark.sparkContext.defaultParallelism
    for pack in (packing.visit_nodes, packing.expense_nodes):
        nodes = pack(Tables(spark, str(tmp_path)))
        assert nodes.count() == 400
        assert nodes.select(F.spark_partition_id().alias("p")).distinct().count() >= cores
    many = spark.range(100).repartition(2 * cores)
    assert spread(many) is many
    spark.conf.set(SCAN_PARTITIONS, "3")
    assert spread(many).rdd.getNumPartitions() == 3
    spark.conf.unset(SCAN_PARTITIONS)


def test_the_first_load_of_a_table_joins_nothing(spark, tmp_path, monkeypatch):
    from tidemark.plans import pipelines

    planned = []

    def noted(*given):
        out = real(*given)
        planned.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    real = pipelines.upsert
    monkeypatch.setattr(pipelines, "upsert", noted)
    mapped = spark.createDataFrame([("1", "a", 1, None), ("1", "b", 2, None), (None, "c", 1, None), ("3", "d", 1, "refused")], "id string, name string, seq int, reject_reason string")
    for run in ("first", "second"):
        state = pipelines.migrate(spark, {"users": lambda: mapped}, str(tmp_path / "load"), ["seq"], run)
        stored = rows(spark.read.parquet(str(tmp_path / "load" / "users")))
        if run == "first":
            assert tuple(state.first()) == ("users", 4, 2, 1, "") and stored == rows(spark.createDataFrame([("1", "b"), (None, "c")], "id string, name string"))
    assert "Join" not in planned[0] and "Join" in planned[1]


def test_feeds_of_outcomes_read_many_files_at_a_time(spark, tmp_path, monkeypatch):
    from tidemark.plans import streams
    from tidemark.streaming import outcomes

    one_file(spark, tmp_path, "lineitem", lines(spark, 2000))
    one_file(spark, tmp_path, "orders", spark.range(2100).select(F.col("id").alias("o_orderkey")))
    asked, real = [], streams.feed.table_stream

    def noted(session, path, schema, files_per_batch):
        asked.append((len(session.read.schema(schema).parquet(path).inputFiles()), files_per_batch))
        return real(session, path, schema, files_per_batch=files_per_batch)

    monkeypatch.setattr(streams.feed, "table_stream", noted)
    state = streams.stream_queue_state(spark, str(tmp_path))
    cores = spark.sparkContext.defaultParallelism
    assert asked == [(5 * cores, cores)] * 2
    # What two folds left is one row per fact already: nothing is ranked again.
    assert "Window" not in plan(state)
    counted = {r.status: r.n for r in state.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counted == {"failed": 667, "done": 667, "in_progress": 666, "pending": 100}


def test_the_total_of_relations_needs_no_map(spark, nodes):
    texts = ['{"id": "1", "notes": {"totalCount": 2}, "noteAttachments": {"totalCount": "3"}}', '{"id": "2", "notes": null}', '{"id": "3", "notes": 5, "noteAttachments": {"totalCount": "x"}}', '{"id": "4", "notes": []}', "null"]
    for kind, spec in SPECS.items():
        plain = inventory.inventory_of_nodes(nodes(*texts), spec, "s", "now")
        told = inventory.inventory_of_nodes(nodes(*texts), spec, "s", "now", total=True)
        assert rows(inventory.with_total(plain)) == rows(told.select(*inventory.with_total(plain).columns)), kind
        assert "map_from_entries" not in plan(inventory.hotspots(told).select("entity_id", "total_relations"))
