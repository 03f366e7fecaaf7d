"""Reading loosely typed JSON nodes held as VARIANT.

A VARIANT keeps the difference between a key that is absent and one that is
present with JSON null; the mapping rules treat the two differently.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON texts of the values that count as false in a condition.
FALSY_JSON = ["null", "false", "0", "0.0", "-0.0", '""', "{}", "[]"]


def variant_at(value: Column, path: str) -> Column:
    """The value at `path`: NULL when absent, variant null when JSON null."""
    return F.try_variant_get(value, f"$.{path}", "variant")


# Paths of plain keys and places in lists, and their steps.
PLAIN_PATH = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*|\[\d{1,9}\])*", re.ASCII)
STEP = re.compile(r"\w+|\[\d+\]", re.ASCII)


class _Paths:
    """Paths that are asked for below a value, as a tree of steps."""

    def __init__(self) -> None:
        self.asked = False
        self.below: dict[str, _Paths] = {}

    def add(self, path: str) -> bool:
        """False for a path that one type cannot hold together with the others."""
        if not PLAIN_PATH.fullmatch(path):
            return False
        at, steps = self, STEP.findall(path)
        for step in steps:
            others = [other for other in at.below if other != step]
            if any("[" in step + other or step.lower() == other.lower() for other in others):
                return False
            if step not in at.below:
                break
            at = at.below[step]
        at = self
        for step in steps:
            at = at.below.setdefault(step, _Paths())
        at.asked = True
        return True

    def inside(self) -> str:
        """The type that holds what lies below this value."""
        kinds = {step: "variant" if paths.asked else paths.inside() for step, paths in self.below.items()}
        if any("[" in step for step in kinds):
            return f"array<{next(iter(kinds.values()))}>"
        return f"struct<{','.join(f'`{step}`: {kind}' for step, kind in kinds.items())}>"

    def found(self, held: Column, path: str = "") -> Iterator[tuple[str, Column, _Paths]]:
        """Path, value and what lies below it, for every value that `held` has as it is."""
        for step, paths in self.below.items():
            at_list = "[" in step
            value = F.get(held, F.lit(int(step[1:-1]))) if at_list else held.getField(step)
            here = f"{path}{'' if at_list or not path else '.'}{step}"
            if paths.asked:
                yield here, value, paths
            else:
                yield from paths.found(value, here)


def truthy(value: Column) -> Column:
    """False for absent, null, false, zero and empty text, list or object."""
    return F.coalesce(~F.to_json(value).isin(FALSY_JSON), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def float_text(value: Column) -> Column:
    """Shortest text of a double with fixed notation from 1e-4 up to 1e16."""
    plain = value.cast("string")
    digits = value.try_cast("decimal(38,20)").cast("string")
    fixed = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    signed = F.regexp_replace(F.regexp_replace(plain, r"(\.0)?E(\d)", "e+$2"), r"(\.0)?E", "e")
    scientific = F.regexp_replace(signed, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(~F.contains(plain, F.lit("E")), plain)
        .when((F.abs(value) >= 1e-4) & (F.abs(value) < 1e16), fixed)
        .otherwise(scientific)
    )


class Node:
    """Reads fields of a node column and remembers which ones.

    Rules ask for fields by path and get column references; `select` then pulls all
    asked fields out of the node at once, converts each once, and applies the rules to the
    converted columns. Without that, every rule would walk the node again, and every path
    that a node lacks would cost an exception.
    """

    def __init__(self, column: str) -> None:
        self._column = column
        self._values: dict[str, str] = {}
        self._typed: dict[str, Column] = {}
        self._some: dict[str, tuple[str, Column]] = {}

    def value(self, path: str) -> Column:
        """VARIANT at `path`: NULL when absent, variant null when JSON null."""
        name = f"{self._column}.{path}"
        self._values.setdefault(path, name)
        return F.col(f"`{name}`")

    def typed(self, path: str, kind: str) -> Column:
        """The value as `kind`; NULL when absent, null or not convertible."""
        name = f"{self._column}.{path}:{kind}"
        self._typed.setdefault(name, F.try_variant_get(self.value(path), "$", kind).alias(name))
        return F.col(f"`{name}`")

    def kind(self, path: str) -> Column:
        """BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, STRING, OBJECT<..>, ARRAY<..> or VOID."""
        name = f"{self._column}.{path}:kind"
        self._typed.setdefault(name, F.schema_of_variant(self.value(path)).alias(name))
        return F.col(f"`{name}`")

    def fields(self, df: DataFrame, through: Sequence[str]) -> DataFrame:
        """Columns passed `through` plus every field asked for so far."""
        root = _Paths()
        alone = [path for path in self._values if not root.add(path)]
        read = [variant_at(F.col(self._column), path).alias(self._values[path]) for path in alone]
        rows, kept = df, list(through)
        # Values below one that is asked for itself are read out of that one, in the next round.
        layer = {"": (F.col(self._column), root)} if root.below else {}
        if not layer:
            rows = rows.select(*kept, *read)
        while layer:
            held = {path: f"{self._column}.{path}:below" for path in layer}
            below = [F.try_variant_get(value, "$", paths.inside()).alias(held[path]) for path, (value, paths) in layer.items()]
            rows = rows.select(*kept, *read, *below)
            kept += [f"`{self._values[path]}`" for path in alone]
            found = [f for path, (_, paths) in layer.items() for f in paths.found(F.col(f"`{held[path]}`"), path)]
            rows = rows.select(*kept, *[value.alias(self._values[path]) for path, value, _ in found])
            kept += [f"`{self._values[path]}`" for path, _, _ in found]
            layer = {path: (F.col(f"`{self._values[path]}`"), paths) for path, _, paths in found if paths.below}
            alone, read = [], []
        rows = rows.select("*", *self._typed.values())
        some = []
        for name, (path, needed) in self._some.items():
            known = f"{self._column}.{path}:string"
            text = F.col(f"`{known}`") if known in self._typed else F.try_variant_get(self.value(path), "$", "string")
            some.append(F.when(needed, text).alias(name))
        return rows.select("*", *some)

    def select(
        self,
        df: DataFrame,
        keep: Sequence[str],
        columns: Mapping[str, Column],
        carry: Sequence[str] = (),
    ) -> DataFrame:
        """`keep` and the rule columns built from this node's fields.

        Rules may use `carry` columns of `df` too; those are not put out.
        """
        rows = self.fields(df, list(dict.fromkeys([*keep, *carry])))
        return rows.select(*keep, *[column.alias(name) for name, column in columns.items()])

    def number(self, path: str) -> Column:
        """The value as double when it is a number; texts are not tried."""
        name = f"{self._column}.{path}:number"
        if name not in self._typed:
            value = self.value(path)
            kind = F.schema_of_variant(value)
            numeric = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN")
            self._typed[name] = F.when(numeric, F.try_variant_get(value, "$", "double")).alias(name)
        return F.col(f"`{name}`")

    def is_object(self, path: str) -> Column:
        return F.coalesce(self.kind(path).startswith("OBJECT"), F.lit(False))

    def is_fraction(self, path: str) -> Column:
        kind = self.kind(path)
        return kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")

    def truthy(self, path: str) -> Column:
        """The rule of `truthy`, decided on the kind where that is cheaper."""
        filled = (
            F.when(self.kind(path) == "STRING", self.words(path) != "")
            .when(self.number(path).isNotNull(), self.number(path) != 0)
            .otherwise(truthy(self.value(path)))
        )
        return F.coalesce(filled, F.lit(False))

    def string(self, path: str) -> Column:
        return self.typed(path, "string")

    def _string_if(self, path: str, rule: str, needed: Column) -> Column:
        """The string of the values that need it; the others are not converted."""
        name = f"{self._column}.{path}:{rule}"
        self.value(path)
        self._some.setdefault(name, (path, needed))
        return F.col(f"`{name}`")

    def words(self, path: str) -> Column:
        """The text at `path`; NULL for anything that is no text."""
        return self._string_if(path, "words", self.kind(path) == "STRING")

    def no_number(self, path: str) -> Column:
        """The value as string; NULL for a number."""
        return self._string_if(path, "no number", self.number(path).isNull())

    def text(self, path: str, absent: str | None = "") -> Column:
        """Text at `path`; `absent` only when the key is missing, NULL for JSON null."""
        return F.when(self.value(path).isNull(), F.lit(absent)).otherwise(self.string(path))

    def text_or_blank(self, path: str) -> Column:
        """Text at `path`; blank when the key is missing or JSON null."""
        return F.coalesce(self.string(path), F.lit(""))

    def flag01(self, path: str) -> Column:
        return F.when(self.truthy(path), 1).otherwise(0).cast("int")

    def stringified(self, path: str, absent: str) -> Column:
        """What stringifying a loosely typed value gives: None, True, 25.0, 7, text."""
        kind = self.kind(path)
        return (
            F.when(kind.isNull(), F.lit(absent))
            .when(kind == "STRING", self.string(path))
            .when(kind == "VOID", F.lit("None"))
            .when(kind == "BOOLEAN", F.initcap(self.string(path)))
            .when(self.is_fraction(path), float_text(self.number(path)))
            .otherwise(self.string(path))
        )

    def flag_text(self, path: str, absent: bool) -> Column:
        """true/false as text; JSON null gives `none`."""
        kind = self.kind(path)
        return (
            F.when(kind.isNull(), F.lit(str(absent).lower()))
            .when(kind == "VOID", F.lit("none"))
            .otherwise(F.lower(self.string(path)))
        )

    def relation_id(self, path: str, key: str = "id") -> Column:
        """Foreign key out of a relation object; blank when there is no relation."""
        return self.stringified(f"{path}.{key}", "")

    def lacks(self, path: str) -> Column:
        """Absent or blank text; JSON null stringifies to a text and is not blank."""
        kind = self.kind(path)
        return kind.isNull() | ((kind == "STRING") & (self.words(path) == ""))

    def whole_number(self, path: str) -> Column:
        """Numbers cut to whole; anything else gives 0."""
        return F.coalesce(self.number(path).try_cast("bigint"), F.lit(0))

    def strict_integer(self, path: str) -> Column:
        """Integers as they are; fractions and anything else give 0."""
        whole = self.kind(path).isin("BIGINT", "BOOLEAN")
        return F.coalesce(F.when(whole, self.typed(path, "bigint")), F.lit(0))
