"""Running sums and maxima of an array column in time that stays near its length.

Appending to an array copies it, so one fold over n values takes time in n squared. Here values are folded in blocks of about the square root of n and the
blocks' own results in a second fold.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold(values: Column, merge, start: Column) -> Column:
    """The running results of one fold, each value's own included."""
    step = lambda acc, x: F.struct(
        merge(acc["last"], x).alias("last"), F.array_append(acc["all"], merge(acc["last"], x)).alias("all"))
    return F.aggregate(values, F.struct(start.alias("last"), F.array().cast("array<int>").alias("all")), step, lambda acc: acc["all"])


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, merge, start: Column) -> Column:
    def whole(array: Column) -> Column:
        side = F.greatest(F.ceil(F.sqrt(F.size(array))).cast("int"), F.lit(1))
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(array) / side).cast("int") - 1, F.lit(0))), lambda k: F.slice(array, k * side + 1, side))
        return _bound(F.transform(blocks, lambda b: _fold(b, merge, start)), joined)

    def joined(inner: Column) -> Column:
        lasts = F.transform(inner, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), start))
        before = F.concat(F.array(start), _fold(lasts, merge, start))
        return _bound(before, lambda held: F.flatten(F.transform(inner, lambda b, k: F.transform(b, lambda x: merge(F.get(held, k), x)))))

    return _bound(values, whole)


def running_sum(values: Column) -> Column:
    """Of an array of whole numbers, the sum up to and with each; an empty array gives an empty one."""
    return _running(values, lambda a, b: a + b, F.lit(0))


def running_max(values: Column) -> Column:
    """The same with the largest, or 0."""
    return _running(values, F.greatest, F.lit(0))
