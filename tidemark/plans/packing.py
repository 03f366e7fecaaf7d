"""The given tables packed into the JSON nodes a feed would deliver.

Every node is built from its own row (plus counts aggregated per key), so packing
never gathers a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import Tables, epoch_seconds, iso_text, json_of, key_text, pack
from tidemark.sources.tables import spread


def quoted(column: str | Column) -> Column:
    """A JSON string literal."""
    listed = F.to_json(F.array(F.col(column) if isinstance(column, str) else column))
    return F.regexp_replace(listed, r"^\[|\]$", "")


def ref(column: Column, condition: Column | None = None) -> Column:
    """Relation object `{id}`, JSON null where the condition fails."""
    relation = F.struct(key_text(column).alias("id"))
    return relation if condition is None else F.when(condition, relation)


def total(column: str) -> Column:
    return F.struct(F.coalesce(F.col(column), F.lit(0).cast("bigint")).alias("totalCount"))


def light_customers(t: Tables) -> DataFrame:
    """Light nodes: customers with the totals of their orders as relations."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_failed"),
        F.max("o_orderdate").alias("last_order"),
    )
    text = json_of(
        key_text("c_custkey").alias("id"),
        iso_text("last_order").alias("updatedAt"),
        total("n_orders").alias("notes"),
        total("n_failed").alias("noteAttachments"),
    )
    joined = t.customer.select("c_custkey", "c_mktsegment").join(per_customer, "c_custkey", "left")
    return pack(joined, text, "c_mktsegment")


def light_orders(t: Tables) -> DataFrame:
    """Light nodes: orders with their line item totals; no notes, so those are zero."""
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    text = json_of(
        key_text("o_orderkey").alias("id"),
        iso_text("o_orderdate").alias("updatedAt"),
        total("n_lines").alias("lineItems"),
    )
    joined = t.orders.select("o_orderkey", "o_orderdate").join(per_order, "o_orderkey", "left")
    return pack(joined, text)


def client_nodes(t: Tables) -> DataFrame:
    name = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    owing = F.col("c_acctbal") < 0
    segment = F.lower("c_mktsegment")
    emails = F.array(
        F.struct(F.concat(name, F.lit("@mail.test")).alias("address"), F.lit(False).alias("primary")),
        F.struct(F.concat(segment, F.lit("@desk.test")).alias("address"), (~owing).alias("primary")),
        F.struct(F.lit("").alias("address"), F.lit(True).alias("primary")),
        F.struct(F.concat(name, F.lit("@mail.test")).alias("address"), F.lit(None).cast("boolean").alias("primary")),
    )
    phones = F.array(
        F.struct(F.lit("").alias("number"), F.lit(True).alias("primary")),
        F.struct(key_text("c_nationkey").alias("number"), F.lit(False).alias("primary")),
    )
    text = json_of(
        F.when((F.col("c_mktsegment") != "HOUSEHOLD") | ~owing, key_text("c_custkey")).alias("id"),
        F.col("c_name").alias("firstName"),
        F.when(~owing, F.lit("Ltd")).alias("lastName"),
        emails.alias("emails"),
        phones.alias("phones"),
        F.col("c_acctbal").alias("balance"),
        owing.alias("isArchivable"),
        (F.col("c_nationkey") % F.lit(5)).alias("isCompany"),
        F.struct(F.col("c_mktsegment").alias("city"), F.lit(None).cast("string").alias("street")).alias(
            "billingAddress"
        ),
        F.lit("2024-01-05T10:00:00Z").alias("createdAt"),
    )
    return pack(spread(t.customer), text)


def _order_lines() -> Column:
    node = F.struct(
        F.col("o_orderpriority").alias("description"),
        F.col("o_custkey").alias("quantity"),
    )
    edge = "struct<node: struct<description: string, quantity: bigint>>"
    return F.struct(
        F.array(F.struct(node.alias("node")).cast(edge), F.struct(F.lit(None).alias("node")).cast(edge)).alias(
            "edges"
        )
    )


def invoice_nodes(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    amounts = F.struct(
        F.col("o_totalprice").alias("total"),
        F.format_number("o_totalprice", 2).alias("subtotal"),
        F.lit(None).cast("double").alias("taxAmount"),
        F.lit("n/a").alias("discountAmount"),
    )
    text = json_of(
        key_text("o_orderkey").alias("id"),
        ref(F.col("o_custkey"), ~urgent).alias("client"),
        F.concat(F.lit("INV-"), key_text("o_orderkey")).alias("invoiceNumber"),
        amounts.alias("amounts"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("invoiceNet"),
        F.col("o_orderstatus").alias("invoiceStatus"),
        iso_text("o_orderdate").alias("issuedDate"),
        iso_text("o_orderdate").alias("dueDate"),
        F.lit(None).cast("string").alias("message"),
        _order_lines().alias("lineItems"),
    )
    return pack(spread(t.orders), text)


def quote_nodes(t: Tables) -> DataFrame:
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    price = key_text("o_totalprice")
    amount = F.when(low, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(price)
    place = (
        F.when(status == "P", F.concat(F.lit('{"id":"'), key_text("o_custkey"), F.lit('"}')))
        .when(status == "F", F.lit("null"))
        .otherwise(F.lit("{}"))
    )
    text = F.format_string(
        '{"id":"%s","client":{"id":"%s"},"property":%s,"quoteNumber":"Q-%s","title":null,'
        '"amounts":{"total":%s,"subtotal":null},"message":%s,"quoteStatus":null,'
        '"sentAt":"%s","createdAt":null}',
        key_text("o_orderkey"),
        key_text("o_custkey"),
        place,
        key_text("o_orderkey"),
        amount,
        quoted("o_orderpriority"),
        iso_text("o_orderdate"),
    )
    return pack(spread(t.orders), text)


def job_nodes(t: Tables) -> DataFrame:
    text = json_of(
        key_text("o_orderkey").alias("id"),
        ref(F.col("o_custkey")).alias("client"),
        ref(F.col("o_custkey"), F.col("o_orderstatus") == "P").alias("property"),
        F.concat(F.lit("J-"), key_text("o_orderkey")).alias("jobNumber"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") != "F", F.lit("call first")).alias("instructions"),
        F.col("o_orderstatus").alias("jobStatus"),
        iso_text("o_orderdate").alias("startAt"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("endAt"),
        F.lit("soon").alias("completedAt"),
        F.format_number("o_totalprice", 2).alias("total"),
        F.lit(None).cast("string").alias("jobType"),
        F.col("o_totalprice").alias("invoicedTotal"),
    )
    return pack(spread(t.orders), text)


def property_nodes(t: Tables) -> DataFrame:
    owing = F.col("c_acctbal") < 0
    address = F.struct(
        F.col("c_name").alias("street1"),
        F.lit(None).cast("string").alias("street2"),
        F.col("c_mktsegment").alias("city"),
        F.struct(
            F.col("c_acctbal").alias("latitude"), F.lit(None).cast("double").alias("longitude")
        ).alias("coordinates"),
    )
    rate = F.struct(F.lit("t1").alias("id"), F.lit("VAT").alias("name"), F.col("c_nationkey").alias("rate"))
    text = json_of(
        key_text("c_custkey").alias("id"),
        ref(F.col("c_custkey"), ~owing).alias("client"),
        F.col("c_name").alias("name"),
        address.alias("address"),
        F.when(F.col("c_mktsegment") != "BUILDING", rate).alias("taxRate"),
        F.col("c_mktsegment").alias("isBillingAddress"),
        F.col("c_nationkey").alias("routingOrder"),
        F.lit("2024-01-05T10:00:00.250-05:00").alias("createdAt"),
    )
    return pack(spread(t.customer), text)


def request_nodes(t: Tables) -> DataFrame:
    text = json_of(
        key_text("event_id").alias("id"),
        ref(F.col("user_id"), F.col("event_type") != "error").alias("client"),
        F.col("event_type").alias("title"),
        F.lit("web").alias("source"),
        F.lit(None).cast("string").alias("requestStatus"),
        iso_text("ts").alias("createdAt"),
    )
    return pack(spread(t.events), text)


def user_nodes(t: Tables) -> DataFrame:
    text = json_of(
        key_text("s_suppkey").alias("id"),
        F.struct(F.col("s_name").alias("first")).alias("name"),
        F.struct(F.concat(key_text("s_suppkey"), F.lit("@s.test")).alias("raw")).alias("email"),
        F.when(F.col("s_acctbal") >= 5000, F.lit(True)).alias("isAccountAdmin"),
        (F.col("s_acctbal") < 0).alias("isAccountOwner"),
        F.lit("active").alias("status"),
        F.col("s_nationkey").alias("availableForScheduling"),
        F.lit("2024-01-05").alias("lastLoginAt"),
    )
    return pack(spread(t.supplier), text)


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def expense_nodes(t: Tables) -> DataFrame:
    text = json_of(
        line_id().alias("id"),
        ref(F.col("l_orderkey"), F.col("l_returnflag") != "R").alias("linkedJob"),
        F.col("l_returnflag").alias("title"),
        F.col("l_extendedprice").alias("total"),
        iso_text("l_shipdate").alias("date"),
        ref(F.col("l_suppkey")).alias("enteredBy"),
    )
    return pack(spread(t.lineitem), text)


def visit_nodes(t: Tables) -> DataFrame:
    user_edge = F.struct(F.struct(key_text("l_suppkey").alias("id")).alias("node"))
    users = F.struct(
        F.when(F.col("l_returnflag") == "A", F.array(user_edge))
        .otherwise(F.array().cast("array<struct<node: struct<id: string>>>"))
        .alias("edges")
    )
    text = json_of(
        line_id().alias("id"),
        ref(F.col("l_orderkey")).alias("job"),
        ref(F.col("l_suppkey"), F.col("l_linestatus") == "F").alias("client"),
        users.alias("assignedUsers"),
        F.col("l_returnflag").alias("title"),
        (F.col("l_discount") > 0.05).alias("allDay"),
        (F.col("l_quantity") + 0.5).alias("duration"),
        F.lit("yes").alias("clientConfirmed"),
        F.struct(key_text("l_suppkey").alias("id")).alias("completedBy"),
        iso_text("l_shipdate").alias("startAt"),
    )
    return pack(spread(t.lineitem), text)


def timesheet_nodes(t: Tables) -> DataFrame:
    text = json_of(
        key_text("event_id").alias("id"),
        ref(F.col("user_id"), F.col("event_type") != "error").alias("user"),
        F.col("event_type").alias("label"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("labourRate"),
        F.col("value").alias("finalDuration"),
        F.col("props").alias("visitDurationTotal"),
        F.when(F.col("event_type") != "view", F.col("value") > 50).alias("approved"),
        iso_text("ts").alias("startAt"),
    )
    return pack(spread(t.events), text)


def product_nodes(t: Tables) -> DataFrame:
    plain = F.col("p_size") > 25
    category = F.when(plain, quoted("p_type")).otherwise(
        F.concat(F.lit('{"name":'), quoted("p_brand"), F.lit("}"))
    )
    text = F.format_string(
        '{"id":"%s","name":%s,"category":%s,"defaultUnitCost":%s,"markup":%s,'
        '"durationMinutes":%s,"taxable":%s,"onlineBookingSortOrder":"%s"}',
        key_text("p_partkey"),
        quoted("p_name"),
        category,
        key_text("p_retailprice"),
        F.when(plain, key_text("p_size")).otherwise(F.concat(key_text("p_size"), F.lit(".0"))),
        key_text("p_size"),
        F.when(plain, F.lit("true")).otherwise(F.lit("null")),
        key_text("p_size"),
    )
    return pack(spread(t.part), text)


def tax_rate_nodes(t: Tables) -> DataFrame:
    text = json_of(key_text("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return pack(spread(t.nation), text)


def turn_id() -> Column:
    return F.concat_ws("-", "conv_id", "turn")


def note_nodes(t: Tables) -> DataFrame:
    """Turns as notes: users hang on a client and a job, assistants on a job, systems on nothing."""
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    text = json_of(
        turn_id().alias("id"),
        F.col("text").alias("message"),
        ref(F.col("conv_id"), user).alias("client"),
        ref(F.col("turn"), user | assistant).alias("job"),
        F.lit("2024-01-05T10:00:00Z").alias("createdAt"),
    )
    return pack(t.conversations, text, turn_id().alias("note_id"), "conv_id", "turn", "role")


def attachment_nodes(t: Tables) -> DataFrame:
    """Documents as files; French ones have no note, src7 sizes are fractions."""
    note = F.struct(F.concat(F.lit("client_"), key_text("doc_id"), F.lit("_note_1")).alias("id"))
    size = F.when(
        F.col("source") == "src7", F.concat(key_text("n_chars"), F.lit(".5"))
    ).otherwise(key_text("n_chars"))
    text = json_of(
        F.when(F.col("source") != "src3", key_text("doc_id")).alias("id"),
        F.when(F.col("lang") != "fr", note).alias("note"),
        F.when(
            F.col("source") != "src5", F.concat_ws(".", key_text("doc_id"), F.col("lang"))
        ).alias("fileName"),
        F.col("source").alias("contentType"),
        F.lit("2024-01-05T10:00:00Z").alias("createdAt"),
    )
    open_text = F.regexp_replace(text, r"\}$", "")
    with_size = F.concat(open_text, F.lit(',"fileSize":'), size, F.lit("}"))
    return pack(t.documents, with_size, "doc_id", "source")


def event_pages(t: Tables, size: int = 100) -> DataFrame:
    """Events as feed pages of `size` nodes; a page holds consecutive ids, so it is bounded."""
    node = F.struct(
        key_text("event_id").alias("id"),
        F.struct(key_text("user_id").alias("id")).alias("client"),
        F.col("event_type").alias("title"),
        iso_text("ts").alias("createdAt"),
        F.col("value").alias("value"),
    )
    k = F.get_json_object("props", "$.k").cast("bigint")
    row = F.struct(
        F.col("event_id").alias("cursor_id"), F.struct(F.lit(None).cast("string").alias("cursor"), node.alias("node")).alias("edge")
    )
    totals = t.events.agg(F.count(F.lit(1))).scalar()
    pages = (
        t.events.withColumn("k", k)
        .groupBy(F.floor(F.col("event_id") / size).alias("page"))
        .agg(
            F.array_sort(F.collect_list(row)).alias("rows"),
            F.sum("k").alias("cost"),
            F.max("event_id").alias("last_id"),
        )
    )
    throttle = F.struct(
        F.lit(10000).alias("maximumAvailable"),
        (F.lit(10000) - F.col("cost")).alias("currentlyAvailable"),
        F.lit(500).alias("restoreRate"),
    )
    cost = F.struct(
        F.col("cost").alias("requestedQueryCost"),
        F.when(F.col("cost") > size * 45, F.floor(F.col("cost") / 10)).alias("actualQueryCost"),
        throttle.alias("throttleStatus"),
    )
    connection = F.struct(
        totals.alias("totalCount"),
        F.transform("rows", lambda r: r["edge"]).alias("edges"),
        F.struct(
            (F.col("last_id") + 1 < totals).alias("hasNextPage"),
            key_text("last_id").alias("endCursor"),
        ).alias("pageInfo"),
    )
    return pages.select(
        "page",
        F.struct(connection.alias("requests")).alias("data"),
        F.struct(cost.alias("cost")).alias("extensions"),
    )


def cost_log(t: Tables, keep: Sequence[Column] = ()) -> DataFrame:
    """Events read as a request cost log; clicks lack capacity, views lack a restore rate."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("query_type"),
        epoch_seconds("ts").alias("at_s"),
        (k * 100).alias("requested_cost"),
        F.floor(F.col("value") * 10).cast("bigint").alias("actual_cost"),
        F.when(F.col("event_type") != "click", F.lit(10000).cast("bigint")).alias("maximum_available"),
        (F.lit(10000) - k * 101).cast("bigint").alias("currently_available"),
        F.when(F.col("event_type") != "view", F.lit(500).cast("bigint")).alias("restore_rate"),
        *keep,
    )
