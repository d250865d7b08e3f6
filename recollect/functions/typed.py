"""Metadata whose values keep their types: maps of variants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARIANT_MAP = "map<string,variant>"


def is_typed(df: DataFrame, column: str) -> bool:
    """Whether a map column holds variants."""
    kind = df.schema[column].dataType
    return isinstance(kind, T.MapType) and isinstance(kind.valueType, T.VariantType)


def no_values() -> Column:
    return F.create_map().cast(VARIANT_MAP)


def from_json(text: Column) -> Column:
    """The fields of a JSON object, each with its own type; null where it is none."""
    return F.from_json(text, VARIANT_MAP)


def typed_map(values: Mapping[str, Column | str | int | float | bool | None]) -> Column:
    """A map of columns and plain values; numbers stay numbers, nulls are left out."""
    cells = []
    for name, value in values.items():
        column = value if isinstance(value, Column) else F.lit(value)
        cells += [F.lit(name), column.cast("variant")]
    if not cells:
        return no_values()
    return F.map_filter(F.create_map(*cells), lambda _, v: v.isNotNull())


def merge_typed(base: Column, winner: Column) -> Column:
    """Union of two maps; on a shared key the second one wins. Nulls count as empty."""
    base, winner = F.coalesce(base, no_values()), F.coalesce(winner, no_values())
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(winner, k)), winner)


def value_of(values: Column, name: str, kind: str) -> Column:
    """A value as ``kind``; null where it is missing or cannot be read as one."""
    return F.try_variant_get(values[name], "$", kind)


def as_strings(values: Column) -> Column:
    """The values as a map of strings, as older readers know them: strings plain, all else as JSON."""
    def text(_, v):
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))

    return F.transform_values(values, text)


def result_values(session: Column, source: Column, score: Column, stored: Column) -> Column:
    """The map of a search result: session, source and the score as a number, under the
    stored values, which replace those of the same name."""
    return merge_typed(typed_map({"session_id": session, "source": source, "score": score}), stored)
