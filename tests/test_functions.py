import pytest
from pyspark.sql import functions as F

from tidemark.functions import contacts, costs, files, jsontext, money, records, timestamps, typenames
from tidemark.functions.values import Node, float_text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2023-11-15T14:30:00Z", "2023-11-15T14:30:00+00:00"),
        ("2023-11-15T14:30:00-05:00", "2023-11-15T14:30:00-05:00"),
        ("2023-11-15T14:30:00.5Z", "2023-11-15T14:30:00.500000+00:00"),
        ("2023-11-15T14:30:00.000Z", "2023-11-15T14:30:00+00:00"),
        ("2023-11-15T14:30:00.1234567", "2023-11-15T14:30:00.123456"),
        ("2023-11-15 14:30", "2023-11-15T14:30:00"),
        ("2023-11-15T14", "2023-11-15T14:00:00"),
        ("2023-11-15", "2023-11-15T00:00:00"),
        ("2023-11-15T14:30:00-00:00", "2023-11-15T14:30:00+00:00"),
        ("2023-11-15T14:30:00+0530", "2023-11-15T14:30:00+05:30"),
        ("2023-13-15T14:30:00Z", "2023-13-15T14:30:00Z"),
        ("2023-11-15T25:30:00Z", "2023-11-15T25:30:00Z"),
        (None, ""),
        ("", ""),
        ("not-a-date", "not-a-date"),
        ("20231115T143000Z", "2023-11-15T14:30:00+00:00"),
        ("20231115T1430+0530", "2023-11-15T14:30:00+05:30"),
        ("20231115", "2023-11-15T00:00:00"),
        ("20231315", "20231315"),
        ("2023-W46-3", "2023-11-15T00:00:00"),
        ("2023W463T14:30:00Z", "2023-11-15T14:30:00+00:00"),
        ("2020-W53", "2020-12-28T00:00:00"),
        ("2023-W53-1", "2023-W53-1"),
        ("2023-W00", "2023-W00"),
        ("20231115143000", "20231115143000"),
    ],
)
def test_iso_normalized(spark, given, expected):
    assert one(spark, timestamps.iso_normalized, given) == expected


def test_iso_passthrough(spark):
    assert one(spark, timestamps.iso_passthrough, None) == ""
    assert one(spark, timestamps.iso_passthrough, "x") == "x"


def test_cents_policies(spark):
    assert one(spark, money.cents_truncated, 19.99, "double") == 1998
    assert one(spark, money.cents_rounded, 19.99, "double") == 1999
    assert one(spark, money.cents_rounded, 0.005, "double") == 0
    assert one(spark, money.cents_rounded, 0.015, "double") == 2
    assert one(spark, money.cents_truncated_text, "1,234.56") == 123456
    assert one(spark, money.cents_truncated_text, "abc") == 0
    assert one(spark, money.cents_truncated, None, "double") == 0


@pytest.mark.parametrize(
    "value", [0.0, 25.5, 25.0, 1e7, 12345678.9, 1e15, 1e16, 1.5e22, 0.0001, 5e-05, 1e-10, 2.5e300]
)
def test_float_text_is_shortest(spark, value):
    assert one(spark, float_text, value, "double") == repr(value)


@pytest.mark.parametrize(
    "listed, primary, additional",
    [
        ([("s", False), ("p", True)], "p", ["s"]),
        ([("a", False), ("b", False)], "a", ["b"]),
        ([("", True), ("v", False)], "v", []),
        ([("a", False), ("b", True), ("a", False), ("b", False)], "b", ["a", "a"]),
        ([], "", []),
    ],
)
def test_contacts(nodes, listed, primary, additional):
    import json

    text = json.dumps({"emails": [{"address": a, "primary": p} for a, p in listed]})
    node = Node("node")
    array = contacts.contact_array(node, "emails", "address")
    columns = {
        "primary": contacts.primary_value(array, "address"),
        "more": contacts.additional_values(array, "address"),
    }
    row = node.select(nodes(text), [], columns).first()
    assert (row.primary, row.more) == (primary, additional)


def test_absent_null_and_text(nodes):
    frame = nodes('{"a": null, "f": 25.0, "b": true, "i": 7, "s": ""}')
    node = Node("node")
    columns = {
        "absent": node.text("zz"),
        "null": node.text("a"),
        "blank": node.text_or_blank("a"),
        "none": node.stringified("a", "x"),
        "flag_none": node.flag_text("a", False),
        "flag_absent": node.flag_text("zz", True),
        "float": node.stringified("f", ""),
        "bool": node.stringified("b", ""),
        "whole": node.whole_number("f"),
        "strict": node.strict_integer("f"),
        "int": node.strict_integer("i"),
        "truthy": F.array(*[node.truthy(p) for p in ("a", "f", "b", "i", "s", "zz")]),
    }
    row = node.select(frame, [], columns).first().asDict()
    assert row == {
        "absent": "",
        "null": None,
        "blank": "",
        "none": "None",
        "flag_none": "none",
        "flag_absent": "true",
        "float": "25.0",
        "bool": "True",
        "whole": 25,
        "strict": 0,
        "int": 7,
        "truthy": [False, True, True, True, False, False],
    }


@pytest.mark.parametrize(
    "url, problem",
    [
        ("https://files.example.com/a", ""),
        ("https://example.com:8443/a", ""),
        ("https://user@EXAMPLE.com/a", ""),
        ("http://example.com/a", "scheme"),
        ("https://notexample.com/a", "domain"),
        ("https://example.com.evil.net/", "domain"),
        ("https:///a", "no_host"),
        ("", "empty"),
        (None, "empty"),
    ],
)
def test_url_problem(spark, url, problem):
    assert one(spark, lambda u: files.url_problem(u, ["example.com"]), url) == problem


@pytest.mark.parametrize(
    "name, suffix",
    [("a.PDF", ".PDF"), ("a.tar.gz", ".gz"), (".profile", ".bin"), ("plain", ".bin"), (None, ".bin"), ("a.", ".bin")],
)
def test_storage_suffix(spark, name, suffix):
    assert one(spark, files.storage_suffix, name) == suffix


def test_error_class(spark):
    assert one(spark, files.error_class, "x" * 60 + "\nmore") == "x" * 50
    assert one(spark, files.error_class, "") == "Unknown"
    assert one(spark, files.error_class, None) == "Unknown"


@pytest.mark.parametrize(
    "note, parent",
    [
        ("client_12_note_1", ("clients", "12")),
        ("property_9_note_1", ("propertys", "9")),
        ("abc", ("jobs", "abc")),
    ],
)
def test_parent_of_note(spark, note, parent):
    row = spark.createDataFrame([(note,)], "v string").select(
        *records.parent_of_note(F.col("v"), F.lit("jobs"))
    ).first()
    assert tuple(row) == parent


def test_request_texts(spark):
    assert one(spark, records.request_entity, "query { invoices(first: 20, after: $c) {") == "invoices"
    assert one(spark, records.request_entity, "query { node(id: 1) { quotes } }") == "quotes"
    assert one(spark, records.request_entity, "query { account }") == "unknown"
    assert one(spark, records.request_batch_size, "x(first: 20)") == 20
    assert one(spark, records.request_batch_size, "x") == 30


@pytest.mark.parametrize(
    "requested, available, expected",
    [(9000, 100, (40, "high_cost")), (100, 100, (25, "low_capacity")), (100, 9000, (50, None)), (None, None, (50, None))],
)
def test_page_size_advice(spark, requested, available, expected):
    frame = spark.createDataFrame([(requested, available)], "r bigint, a bigint")
    assert tuple(frame.select(*costs.page_size_advice(F.lit(50), F.col("r"), F.col("a"))).first()) == expected


def test_cooldown(spark):
    frame = spark.createDataFrame([(1500, 500, None), (500, 500, 10), (10, 0, 0)], "r bigint, a bigint, s bigint")
    got = [r[0] for r in frame.select(costs.cooldown_seconds(F.col("r"), F.col("a"), F.col("s"))).collect()]
    assert got == [3.0, None, None]


def test_wrapped_types(spark):
    def wrapped(depth):
        value = '{"kind": "SCALAR", "name": "Tag"}'
        for _ in range(depth):
            value = '{"ofType": {"kind": "LIST", "ofType": %s, "name": null}, "kind": "NON_NULL"}' % value
        return value

    cases = {
        wrapped(0): ("Tag", "Tag", True),
        wrapped(1): ("[Tag]!", "Tag", False),
        wrapped(6): ("[" * 6 + "Tag" + "]!" * 6, "Tag", False),
        wrapped(40): ("[" * 40 + "Tag" + "]!" * 40, "Tag", False),
        '{"kind": "LIST"}': ("[Unknown]", "Unknown", True),
        "null": ("Unknown", "Unknown", True),
        None: ("Unknown", "Unknown", True),
    }
    frame = spark.createDataFrame([(c,) for c in cases], "t string").select("t", F.parse_json("t").alias("v"))
    got = frame.select(
        "t", typenames.type_text(F.col("v")), typenames.base_type(F.col("v")), typenames.is_nullable(F.col("v"))
    )
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == cases


def test_json_text(spark):
    assert one(spark, lambda v: jsontext.total_of_counts(jsontext.count_map(v)), '{"a": 2, "b": 3}') == 5
    assert one(spark, lambda v: jsontext.total_of_counts(jsontext.count_map(v)), "{}") == 0
    assert one(spark, lambda v: jsontext.count_at(v, "n"), '{"n": 12}') == 12


@pytest.mark.parametrize(
    ("text", "cents"),
    [("12d", 0), ("7f", 0), ("1_000", 100000), ("1,234.5", 123450), (" 3 ", 300), ("1__0", 0), ("_1", 0), ("1e2", 10000), ("nan", 0), ("", 0)],
)
def test_cents_of_texts(spark, text, cents):
    assert one(spark, money.cents_truncated_text, text) == cents


def test_labels_of_missing_parts(spark):
    frame = spark.createDataFrame([(None, "Doe")], "first string, last string")
    nothing = F.lit(None).cast("string")
    row = frame.select(
        records.display_id(F.lit("client"), nothing, F.col("first"), F.col("last")),
        records.display_id(F.lit("invoice"), nothing, nothing, nothing),
        records.display_id(F.lit("visit"), F.lit("7"), nothing, nothing),
    ).first()
    assert tuple(row) == ("Client: None Doe", "Invoice #None", "Visit #7")


def test_the_fields_of_a_node_are_read_at_once(spark, nodes):
    from tidemark.functions.values import variant_at
    from tidemark.operators.mapping import map_entities
    from tidemark.operators.specs import SPECS

    frame = nodes(
        '{"a": 1, "b": {"c": null, "d": {"e": "x"}}, "l": [{"n": {"id": 7}}, 5], "A": 3, "p": {"id": "q"}, "m": [1, 2]}',
        '{"b": null, "l": [], "p": null}', '{"b": "t", "l": {"n": 1}, "p": {}, "m": [null]}',
        '{"b": {"d": 3, "D": 4}, "l": [null], "p": [1]}', "[1, 2]", '"s"', "null", "{}", None,
    )
    paths = ["a", "B.x", "b.c", "b.d.e", "b.d", "l[0].n.id", "l[0].n", "l[1]", "p", "p.id", "p.id.z", "m", "m[0]", "x.y.z"]
    reader = Node("node")
    for path in paths:
        reader.value(path)
    read = reader.fields(frame, []).select(*[F.to_json(F.col(f"`node.{p}`")) for p in paths])
    alone = frame.select(*[F.to_json(variant_at(F.col("node"), p)) for p in paths])
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in alone.collect()]
    # A path that a node lacks is not looked for: that costs an exception each time.
    for kind in ("visit", "expense", "job"):
        plan = map_entities(frame, SPECS[kind])._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("AS node.:below#") == 1 and ", $.id" not in plan and ", $.title" not in plan


def test_texts_are_read_out_of_what_is_no_number(spark, nodes):
    frame = nodes('{"v": "1,234.5"}', '{"v": 7}', '{"v": 2.5}', '{"v": true}', '{"v": null}', '{"v": [1]}', "{}", '{"v": ""}', '{"v": "1e17"}')
    reader = Node("node")
    columns = {
        "words": reader.words("v"), "cents": money.node_cents_truncated(reader, "v"),
        "beyond": money.beyond_cents(reader, "v"), "filled": reader.truthy("v"), "lacks": reader.lacks("v"),
    }
    assert [tuple(r) for r in reader.select(frame, [], columns).collect()] == [
        ("1,234.5", 123450, False, True, False), (None, 700, False, True, False), (None, 250, False, True, False),
        (None, 100, False, True, False), (None, 0, False, False, False), (None, 0, False, True, False),
        (None, 0, False, False, True), ("", 0, False, False, True), ("1e17", 0, True, True, False),
    ]
