"""Array functions that keep per-row folds inside the row, so that no shuffle or window is needed for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Arrays of at most this many numbers are folded as they are.
SHORT = 64


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _fold(numbers: Column, start: Column) -> Column:
    """start, start + n0, start + n0 + n1, ... for all but the last sum."""
    none = F.array().cast("array<bigint>")
    step = lambda s, n: F.struct((s["total"] + n).alias("total"), F.array_append(s["out"], s["total"]).alias("out"))
    return F.aggregate(numbers, F.struct(start.cast("long").alias("total"), none.alias("out")), step)["out"]


def sums_before(numbers: Column) -> Column:
    """For each number of an array of bigint the sum of those before it.

    An appended array is copied, so a plain fold would take n^2 steps; folding pieces of sqrt(n) numbers and then their totals takes n^1.5.
    """

    def of(values: Column) -> Column:
        piece = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
        pieces = bound(piece, lambda k: F.transform(F.sequence(F.lit(0), F.size(values) - 1, k), lambda i: F.slice(values, i + 1, k)))

        def folded(parts: Column) -> Column:
            totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda s, n: s + n))
            return bound(_fold(totals, F.lit(0)), lambda starts: F.flatten(F.transform(parts, lambda p, j: _fold(p, F.get(starts, j)))))

        return F.when(F.size(values) <= SHORT, _fold(values, F.lit(0))).otherwise(bound(pieces, folded))

    return bound(numbers.cast("array<bigint>"), of)
