"""Row predicates."""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_start(value: Column) -> Column:
    """Does the JSON text hold a ``start`` object?  JSON null counts as absent, {} as present."""
    return F.get_json_object(value, "$.start").isNotNull()


def bool_query(must: Iterable[Column] = (), filters: Iterable[Column] = ()) -> Column:
    """AND of all clauses; without any clause everything matches."""
    return reduce(lambda a, b: a & b, [*must, *filters], F.lit(True))


def term_in_array(objects: Column, field: str, value: Any) -> Column:
    """Is some object's field exactly ``value``?"""
    return F.exists(objects, lambda o: o[field] == F.lit(value))


def bin_values(value: Column, splits: Iterable[float]) -> Column:
    """Index of the band ``[splits[i], splits[i+1])`` of a value; the last band includes its end.

    NULL outside of the splits.
    """
    edges = list(splits)
    last = len(edges) - 2
    band = F.when(value == edges[-1], last)
    for i in range(len(edges) - 1):
        band = band.when((value >= edges[i]) & (value < edges[i + 1]), i)
    return band.cast("int")
