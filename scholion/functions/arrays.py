"""Array helpers built from Spark's higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    A column used inside a lambda may otherwise be inlined by the optimizer and
    evaluated once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_made(items: str | Column) -> Column:
    """The array for ``explode``. Below a plain column the optimizer adds a test of its size and pushes it
    to where the column is made, so that the whole expression behind it would be evaluated twice."""
    return F.slice(items, F.lit(1), F.size(items))


def compact_set(items: Column) -> Column:
    """Distinct values in first-seen order without nulls."""
    return F.array_distinct(F.array_compact(items))


def dedup_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """First item per key, in order."""
    return let(
        items,
        lambda xs: F.when(F.size(xs) < 2, F.filter(xs, lambda x: key(x).isNotNull())).otherwise(let(
            F.transform(xs, key),
            lambda keys: F.filter(xs, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1),
        )),
    )


def dedup_ignore_case(texts: Column) -> Column:
    return dedup_by(texts, F.lower)


def overlaps(left: Column, right: Column) -> Column:
    """arrays_overlap that is false, not null, on empty or null-free inputs."""
    return F.coalesce(F.arrays_overlap(left, right), F.lit(False))


def sorted_set(nested: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(nested)))


def span(items: Column, start: Column, end: Column) -> Column:
    """Elements start..end, both zero-based and inclusive."""
    return F.slice(items, start + 1, F.greatest(end - start + 1, F.lit(0)))


def sort_by(items: Column, field: str) -> Column:
    """Structs in order of one field; the others need not be comparable."""
    return F.array_sort(items, lambda a, b: F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0))
