"""Arrays and maps on their way to rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def each(c) -> Column:
    """The array or map to hand to ``explode``; NULL when it is empty.

    A bare column under ``explode`` makes the optimizer add a "not empty" filter. That
    filter is moved down to the scan, where the expression behind the column (cleaning or
    parsing of whole texts) would be computed once more for the filter alone.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.size(c) > 0, c)
