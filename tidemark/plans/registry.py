"""Name -> query, and name -> the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-02-01T00:00:00+00:00"
SNAPSHOT = "snapshot-1"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """The given tables by attribute: Tables(spark, folder).orders."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)


def key_text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def iso_text(column: str | Column) -> Column:
    """Timestamp as `yyyy-MM-ddTHH:mm:ssZ` text, the way the feed carries it."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def time_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def epoch_seconds(column: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def json_of(*fields: Column) -> Column:
    """JSON text of a struct; NULL fields become JSON null, not absent keys."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def pack(df: DataFrame, text: Column, *keep: str | Column) -> DataFrame:
    """Rows as nodes: `keep` and the node parsed from its JSON text.

    The node is exploded from a one-element list, as from a page's edges; that keeps
    filters on mapped columns from sinking below the parse and parsing again.
    """
    texts = df.select(*keep, text.alias("_json"))
    kept = [c for c in texts.columns if c != "_json"]
    return texts.select(*kept, F.explode(F.array(F.parse_json("_json"))).alias("node"))
