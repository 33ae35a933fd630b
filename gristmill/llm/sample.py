"""Bounded samples of rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are sorted for each one that is taken, on average.
SPARE = 4


def key_hash(key: Column) -> Column:
    """A hash that depends on the key alone, in either order of arrival."""
    return F.md5(key.cast("string").cast("binary"))


def lowest_hashes(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows with the lowest hash ``__h`` of their key.

    Only rows with a hash below a bound, about ``SPARE`` for each that is taken,
    are sorted; so what tasks send to the driver doesn't grow with their number.
    """
    hashed = rows.withColumn("__h", key_hash(F.col(key)))
    n = rows.count()
    if n > SPARE * most:
        bound = format(int(SPARE * most / n * (1 << 48)), "012x")
        hashed = hashed.where(F.col("__h") < bound)
    return hashed.orderBy("__h", key).limit(most)
