"""Keep an expensive column from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value``, marked so that the optimizer does not copy its expression.

    A filter on a derived column is normally rewritten in terms of the scan, so a chain of
    text rules is evaluated again inside the filter, and a chain of chains grows without
    bound. A column that depends on the partition id is never copied: the filter stays
    above it and reads the finished value. Pruning of unused columns is not affected, and
    repeated parts inside ``value`` are still computed once. Filters that can run before
    the text rules belong before them.
    """
    zero = F.least(F.spark_partition_id(), F.lit(0))
    return F.array(value)[zero]


def apart(columns: dict[str, Column]) -> dict[str, Column]:
    """``columns``, each as ``once`` makes it, in a projection that Spark does not fuse with others.

    Of fused projections Spark makes one method. The JVM does not compile methods of more than 8000 bytes,
    and long rules together are longer than that, so they would be interpreted for every row. A projection
    of its own is cut into short methods. What keeps it from being fused is a function over a list,
    here one of no consequence beside the rules.
    """
    below = F.filter(F.array(F.spark_partition_id()), lambda number: number < 0)
    first = next(iter(columns))
    return {name: F.array(value)[F.size(below)] if name == first else once(value) for name, value in columns.items()}
