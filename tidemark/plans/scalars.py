"""Single-column rules over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.contacts import first_trimmed
from tidemark.functions.jsontext import parsed_or
from tidemark.functions.money import cents_rounded, cents_truncated, cents_truncated_text
from tidemark.functions.records import display_id, parent_of_note
from tidemark.functions.timestamps import iso_normalized, iso_passthrough
from tidemark.functions.values import float_text
from tidemark.plans.registry import Tables, key_text, query


@query(
    "cents_truncated",
    """
    SELECT c_custkey, CAST(trunc(c_acctbal * 100) AS BIGINT) AS cents,
           CAST(trunc(c_acctbal * 100) AS BIGINT) AS cents_from_text
    FROM customer
    """,
)
def cents_truncated_query(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).customer.select(
        "c_custkey",
        cents_truncated(F.col("c_acctbal")).alias("cents"),
        cents_truncated_text(F.format_number("c_acctbal", 2)).alias("cents_from_text"),
    )


@query(
    "cents_rounded",
    """
    SELECT p_partkey, CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS cents,
           CAST(round_even(p_retailprice / 8 * 100, 0) AS BIGINT) AS eighth
    FROM part
    """,
)
def cents_rounded_query(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).part.select(
        "p_partkey",
        cents_rounded(F.col("p_retailprice")).alias("cents"),
        cents_rounded(F.col("p_retailprice") / 8).alias("eighth"),
    )


@query(
    "cents_policies_differ",
    """
    SELECT count(*) FILTER (trunc(c_acctbal * 100) <> round_even(c_acctbal * 100, 0)) AS n FROM customer
    """,
)
def cents_policies_differ(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return Tables(spark, folder).customer.agg(
        F.count_if(cents_truncated(balance) != cents_rounded(balance)).alias("n")
    )


@query(
    "iso_timestamps",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
             WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:00') || '-05:00'
             WHEN 'error' THEN strftime(ts, '%d/%m/%Y')
             WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT00:00:00') ELSE '' END AS normalized,
           CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
             WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M') || '-0500'
             WHEN 'error' THEN strftime(ts, '%d/%m/%Y')
             WHEN 'signup' THEN strftime(ts, '%Y-%m-%d') ELSE '' END AS passed
    FROM events
    """,
)
def iso_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Zulu with fraction, short form with offset, no timestamp at all, date only, NULL."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "view", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("-0500")))
        .when(kind == "error", F.date_format("ts", "dd/MM/yyyy"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
    )
    return Tables(spark, folder).events.select(
        "event_id",
        iso_normalized(text).alias("normalized"),
        iso_passthrough(text).alias("passed"),
    )


@query(
    "float_texts",
    "SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS plain FROM orders",
)
def float_texts(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).orders.select(
        "o_orderkey", float_text(F.col("o_totalprice")).alias("plain")
    )


@query(
    "display_ids",
    """
    SELECT 'Client: ' || c_name || CASE WHEN c_acctbal < 0 THEN ' None' ELSE '' END AS label,
           CAST(c_custkey AS VARCHAR) AS id FROM customer
    UNION ALL SELECT CASE o_orderstatus WHEN 'P' THEN 'Invoice #' || o_orderkey WHEN 'F' THEN 'Job #' || o_orderkey
                     ELSE 'Timesheet_Entry' END, CAST(o_orderkey AS VARCHAR) FROM orders
    """,
)
def display_ids(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    nothing = F.lit(None).cast("string")
    status = F.col("o_orderstatus")
    kind = F.when(status == "P", "invoice").when(status == "F", "job").otherwise("timesheet_entry")
    clients = t.customer.select(
        display_id(F.lit("client"), nothing, F.col("c_name"), F.when(F.col("c_acctbal") >= 0, F.lit(""))).alias("label"),
        key_text("c_custkey").alias("id"),
    )
    numbered = t.orders.select(
        display_id(kind, key_text("o_orderkey"), nothing, nothing).alias("label"),
        key_text("o_orderkey").alias("id"),
    )
    return clients.unionByName(numbered)


@query(
    "note_parents",
    """
    SELECT conv_id, turn, CASE role WHEN 'system' THEN 'unknown' ELSE role || 's' END AS parent_type,
           CASE role WHEN 'system' THEN 'plain' ELSE CAST(conv_id AS VARCHAR) END AS parent_id
    FROM conversations
    """,
)
def note_parents(spark: SparkSession, folder: str) -> DataFrame:
    note = F.when(F.col("role") == "system", F.lit("plain")).otherwise(
        F.concat_ws("_", "role", "conv_id", F.lit("note"), "turn")
    )
    parent_type, parent_id = parent_of_note(note, F.lit("unknown"))
    return Tables(spark, folder).conversations.select(
        "conv_id", "turn", parent_type.alias("parent_type"), parent_id.alias("parent_id")
    )


@query(
    "first_contacts",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_name END AS contact
    FROM customer
    """,
)
def first_contacts(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    listed = F.array(F.lit(""), F.lit("   "), name, F.lower("c_mktsegment"))
    return Tables(spark, folder).customer.select("c_custkey", first_trimmed(listed).alias("contact"))


@query(
    "json_or_default",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN CAST(-1 AS BIGINT) WHEN 'view' THEN CAST(-1 AS BIGINT)
                     ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k
    FROM events
    """,
)
def json_or_default(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks carry blank text and views broken JSON; both fall back."""
    kind = F.col("event_type")
    text = F.when(kind == "click", F.lit("")).when(kind == "view", F.lit("{k:")).otherwise(F.col("props"))
    fallback = F.create_map(F.lit("k"), F.lit(-1).cast("bigint"))
    return Tables(spark, folder).events.select(
        "event_id", parsed_or(text, "map<string,bigint>", fallback)["k"].alias("k")
    )
