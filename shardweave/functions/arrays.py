"""Small helpers for higher-order array expressions and for arrays inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    A column mentioned inside a lambda is otherwise inlined there and computed again
    for every array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows ``[first, past)`` whose lengths sum up to at most ``most``; a longer row is alone."""
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < len(ends):
        before = int(ends[first]) - int(lengths[first])
        past = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield first, past
        first = past
