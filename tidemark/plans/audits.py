"""Field audits of the given tables' schemas against the data that is read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.plans.registry import ORACLES, Tables, key_text, query
from tidemark.session import scratch_path
from tidemark.sources import introspection
from tidemark.sources.tables import spread

# A read list that leaves some columns out and asks for some that do not exist.
READ_FIELDS = {
    "customer": ["c_custkey", "c_name", "c_acctbal", "c_phone"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "part": ["p_partkey", "p_name"],
}
PRIORITY = {"customer": ["c_mktsegment", "c_name"], "part": ["p_retailprice", "p_size"]}


# The columns of all given tables; only three of them are read.
TABLE_FIELDS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _available(t: Tables) -> DataFrame:
    """Fields that hold data: one row per column with its number of filled rows, by scan."""
    frames = []
    for name in TABLE_FIELDS:
        df = getattr(t, name)
        counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
        pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in df.columns])
        frames.append(counted.select(F.lit(name).alias("entity"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, frames).where("filled > 0")


FIELDS_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS entity, '{column}' AS field FROM {table} HAVING count({column}) > 0"
    for table, columns in TABLE_FIELDS.items()
    for column in columns
)
READ_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{table}', '{column}')" for table, columns in READ_FIELDS.items() for column in columns
) + ") AS v(entity, field)"
DIFF_SQL = f"""
  SELECT coalesce(a.entity, q.entity) AS entity, coalesce(a.field, q.field) AS field,
         CASE WHEN q.field IS NULL THEN 'missing' WHEN a.field IS NULL THEN 'extra' ELSE 'both' END AS side
  FROM ({FIELDS_SQL}) a FULL JOIN ({READ_SQL}) q ON a.entity = q.entity AND a.field = q.field
"""
COVERAGE_SQL = f"""
  SELECT entity, count(*) FILTER (side <> 'extra') AS total_available,
         count(*) FILTER (side <> 'missing') AS total_queried, count(*) FILTER (side = 'missing') AS missing,
         count(*) FILTER (side = 'extra') AS extra,
         round(count(*) FILTER (side <> 'missing') * 100.0::DOUBLE / count(*) FILTER (side <> 'extra'), 1) AS coverage_percent
  FROM ({DIFF_SQL}) WHERE entity IN (SELECT entity FROM ({READ_SQL})) GROUP BY 1
"""


@query("schema_differences", DIFF_SQL)
def schema_differences(spark: SparkSession, folder: str) -> DataFrame:
    queried = audit.field_list(spark, READ_FIELDS)
    return audit.field_differences(_available(Tables(spark, folder)), queried)


@query("schema_coverage", COVERAGE_SQL)
def schema_coverage(spark: SparkSession, folder: str) -> DataFrame:
    queried = audit.field_list(spark, READ_FIELDS)
    return audit.coverage(_available(Tables(spark, folder)), queried)


@query(
    "coverage_totals",
    f"""
    SELECT round(avg(coverage_percent), 6) AS avg_coverage, CAST(sum(missing) AS BIGINT) AS total_missing,
           CAST(sum(extra) AS BIGINT) AS total_extra FROM ({COVERAGE_SQL})
    """,
)
def coverage_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = audit.coverage_totals(schema_coverage(spark, folder))
    return totals.withColumn("avg_coverage", F.round("avg_coverage", 6))


PRIORITY_SQL = ", ".join(f"('{table}', '{column}')" for table, names in PRIORITY.items() for column in names)


@query(
    "priority_missing",
    f"""
    SELECT entity, field FROM ({DIFF_SQL}) SEMI JOIN (VALUES {PRIORITY_SQL}) AS p(entity, field) USING (entity, field)
    WHERE side = 'missing'
    """,
)
def priority_missing(spark: SparkSession, folder: str) -> DataFrame:
    differences = schema_differences(spark, folder)
    return audit.priority_missing(differences, audit.field_list(spark, PRIORITY))


WRAPS = "[" * 6, "]!" * 6


def _documents_of_types(t: Tables) -> DataFrame:
    """Introspection entries from data: each part is a type with a plain field, a wrapped
    one and one that is wrapped twelve levels deep."""
    leaf = F.concat(F.lit('{"kind": "SCALAR", "name": '), F.to_json(F.struct(F.col("p_type").alias("x"))), F.lit("}"))
    leaf = F.regexp_replace(leaf, r'\{"x":("[^"]*")\}', "$1")
    wrap = lambda kind, inner: F.concat(F.lit(f'{{"kind": "{kind}", "name": null, "ofType": '), inner, F.lit("}"))
    once = wrap("NON_NULL", wrap("LIST", leaf))
    deep = leaf
    for _ in range(6):
        deep = wrap("NON_NULL", wrap("LIST", deep))
    kind = F.when(F.col("p_size") > 10, "OBJECT").when(F.col("p_size") > 5, "ENUM").otherwise("UNION")
    field = lambda name, kind_of: F.concat(F.lit(f'{{"name": "{name}", "type": '), kind_of, F.lit("}"))
    fields = F.concat_ws(", ", field("id", F.lit('{"kind": "SCALAR", "name": "ID"}')), field("sizes", once), field("deep", deep))
    entry = F.concat(F.lit('{"kind": "'), kind, F.lit('", "fields": ['), fields, F.lit("]}"))
    return spread(t.part).select(key_text("p_partkey").alias("type_name"), entry.alias("body"))


def _entries_of_types(t: Tables) -> DataFrame:
    """The documents parsed once each: a filter on the exploded entry stays behind the parse
    and does not sink to the scan, where all rows may be in one task."""
    entry = F.from_json("body", introspection.type_entry_schema())
    return _documents_of_types(t).select("type_name", F.explode(F.array(entry)).alias("entry"))


@query(
    "field_inventory",
    f"""
    SELECT CAST(p_partkey AS VARCHAR) AS type_name, 'id' AS field, 'ID' AS full_type, 'ID' AS base_type, 'Yes' AS nullable
    FROM part WHERE p_size > 10
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'sizes', '[' || p_type || ']!', p_type, 'No' FROM part WHERE p_size > 10
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'deep', '{WRAPS[0]}' || p_type || '{WRAPS[1]}', p_type, 'No' FROM part WHERE p_size > 10
    """,
)
def field_inventory(spark: SparkSession, folder: str) -> DataFrame:
    entries = _entries_of_types(Tables(spark, folder))
    fields = introspection.field_inventory(entries.select("type_name", "entry.kind", "entry.fields"))
    return _report(fields)


def _report(fields: DataFrame) -> DataFrame:
    return fields.select(
        F.col("Type").alias("type_name"),
        F.col("Field").alias("field"),
        F.col("GraphQL Type").alias("full_type"),
        F.col("Base Type").alias("base_type"),
        F.col("Nullable").alias("nullable"),
    )


@query("field_csv", ORACLES["field_inventory"])
def field_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The field report written as CSV in its order and read back."""
    path = scratch_path(spark, "fields")
    entries = _entries_of_types(Tables(spark, folder))
    fields = introspection.field_inventory(entries.select("type_name", "entry.kind", "entry.fields"))
    introspection.write_field_inventory(fields, path)
    return _report(introspection.read_field_inventory(spark, path))


@query(
    "kind_statistics",
    """
    SELECT CASE WHEN p_size > 10 THEN 'OBJECT' WHEN p_size > 5 THEN 'ENUM' ELSE 'UNION' END AS kind, count(*) AS types
    FROM part GROUP BY 1
    """,
)
def kind_statistics(spark: SparkSession, folder: str) -> DataFrame:
    types = _documents_of_types(Tables(spark, folder)).select(F.get_json_object("body", "$.kind").alias("kind"))
    return audit.kind_statistics(types)
