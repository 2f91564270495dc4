"""Compute an expensive column once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """The same value, in a form that the optimizer does not copy into the filters above it.

    A filter on a column derived from a long text would otherwise be pushed below the projection
    with the whole text pipeline written out at every use, and run it again for each. Expressions
    that depend on the row number are left where they are; the condition here is always true.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)
