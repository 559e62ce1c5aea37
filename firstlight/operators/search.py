"""Document search: boolean filter, sort, page, highlight."""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.functions.predicates import bool_query
from firstlight.functions.text import highlight
from firstlight.operators.pages import Sort
from firstlight.operators.pages import sort_columns as _order


def search(
    df: DataFrame,
    must: Iterable[Column] = (),
    filters: Iterable[Column] = (),
    sort: Sort = (),
    offset: int = 0,
    size: int = 20,
    highlights: Mapping[str, str] | None = None,
) -> DataFrame:
    """Hits of a boolean query, sorted, from ``offset``, ``size`` of them.

    End ``sort`` with a unique column: pages are repeatable only then.
    ``highlights`` maps a field to the query text marked in ``<field>_hl``,
    on the page's rows only.
    """
    page = df.filter(bool_query(must, filters)).orderBy(*_order(sort)).offset(offset).limit(size)
    for field, query in (highlights or {}).items():
        page = page.withColumn(f"{field}_hl", highlight(F.col(field), query))
    return page


def paginate(df: DataFrame, sort: Sort, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) of ``size`` rows of any frame; deep ones are for :func:`firstlight.operators.pages.ranged_page`."""
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    return df.orderBy(*_order(sort)).offset((page - 1) * size).limit(size)


def page_of_row(start: int, length: int) -> int:
    """Page number of a grid's row offset."""
    return start // length + 1


def search_after(df: DataFrame, sort: Sort, last: Sequence[Any] | None, size: int) -> DataFrame:
    """The ``size`` rows after the row with sort values ``last``; the first rows when None.

    Deep pages cost the same as the first one: the position is a filter, not
    a count of skipped rows.
    """
    if last is not None:
        steps = []
        for i, ((c, way), value) in enumerate(zip(sort, last)):
            same = [F.col(k).eqNullSafe(F.lit(v)) for (k, _), v in zip(sort[:i], last[:i])]
            col = F.col(c)
            if value is None:
                continue  # NULLs are last: nothing follows them in this column
            beyond = col < F.lit(value) if way == "desc" else col > F.lit(value)
            steps.append(reduce(lambda a, b: a & b, same, beyond | col.isNull()))
        df = df.filter(reduce(lambda a, b: a | b, steps, F.lit(False)))
    return df.orderBy(*_order(sort)).limit(size)
