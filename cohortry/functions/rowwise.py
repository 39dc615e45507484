"""Row-wise reductions over a family of columns; no shuffle, no UDF."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count_true(cols: Sequence[str], test: Callable[[Column], Column]) -> Column:
    """In how many of the columns the test holds; an unknown test counts as no."""
    return reduce(lambda a, b: a + b, [F.coalesce(test(F.col(c)), F.lit(False)).cast("int") for c in cols])


def row_any(cols: Sequence[str], test: Callable[[Column], Column]) -> Column:
    return row_count_true(cols, test) >= 1


def row_max(cols: Sequence[str]) -> Column:
    """Largest value, NULLs skipped; NULL when all are NULL."""
    return F.greatest(*cols) if len(cols) > 1 else F.col(cols[0])
