"""Column functions on metadata maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.create_map().cast(STRING_MAP)


def literal_map(values: Mapping[str, str] | None) -> Column:
    if not values:
        return empty_map()
    cells = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*cells).cast(STRING_MAP)


def merge_maps(base: Column, winner: Column) -> Column:
    """Union of two maps; on a shared key the second one wins. Nulls count as empty."""
    base, winner = F.coalesce(base, empty_map()), F.coalesce(winner, empty_map())
    return F.map_concat(
        F.map_filter(base, lambda k, _: ~F.map_contains_key(winner, k)), winner
    )
