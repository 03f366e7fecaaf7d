"""Money to integer cents. Two policies exist side by side and differ on some rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import Node


# Digits with single underscores between them, a point, an exponent; no type suffix.
NUMBER = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"


# From here on a 64-bit number of cents cannot hold an amount.
TOO_LARGE = 2.0**63 / 100


def cents_truncated(amount: Column) -> Column:
    """amount*100 cut toward zero; invalid and missing give 0, as does what no cents can hold
    (see `beyond_cents`)."""
    return F.coalesce((amount.try_cast("double") * 100).try_cast("bigint"), F.lit(0))


def _number_in(text: Column) -> Column:
    """Text of a number without thousands commas and underscores; NULL for other text."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    return F.when(plain.rlike(NUMBER), F.replace(plain, F.lit("_"), F.lit("")))


def cents_truncated_text(amount: Column) -> Column:
    """The same for text, which may hold thousands commas and underscores."""
    return cents_truncated(_number_in(amount))


def too_large(amount: Column) -> Column:
    """Infinite, or so large that its cents are no 64-bit number."""
    value = amount.try_cast("double")
    return F.coalesce((F.abs(value) >= TOO_LARGE) & ~F.isnan(value), F.lit(False))


def cents_rounded(amount: Column) -> Column:
    """amount*100 rounded half to even; missing gives 0."""
    scaled = F.bround(amount.try_cast("double") * 100)
    return F.coalesce(scaled.try_cast("bigint"), F.lit(0))


def node_cents_truncated(node: Node, path: str) -> Column:
    number = node.number(path)
    return F.when(number.isNotNull(), cents_truncated(number)).otherwise(
        cents_truncated_text(node.no_number(path))
    )


def node_cents_rounded(node: Node, path: str) -> Column:
    return cents_rounded(node.number(path))


def not_a_number(node: Node, path: str) -> Column:
    """Present, not null and not a number: the rounding policy refuses such a node."""
    kind = node.kind(path)
    return kind.isNotNull() & (kind != "VOID") & node.number(path).isNull()


def beyond_cents(node: Node, path: str) -> Column:
    """An amount, as number or text, that no cents can hold: such a node is refused."""
    number = node.number(path)
    return F.when(number.isNotNull(), too_large(number)).otherwise(too_large(_number_in(node.no_number(path))))
