"""Column → column recodes. NULL rules are explicit; nothing here needs a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = object()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _value(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def in_set(col: Column | str, values: Sequence[Any]) -> Column:
    """Membership that is never NULL."""
    return F.coalesce(_col(col).isin(*values), F.lit(False))


def case_when(*branches: tuple[Column, Any], otherwise: Any = None) -> Column:
    """First true condition wins; without a match (or a default) the result is NULL."""
    (cond, value), *rest = branches
    chain = reduce(lambda acc, b: acc.when(b[0], _value(b[1])), rest, F.when(cond, _value(value)))
    return chain if otherwise is None else chain.otherwise(_value(otherwise))


def recode_map(col: Column | str, mapping: Mapping[Any, Any], default: Any = KEEP, missing: Any = None) -> Column:
    """Value → value. Unlisted values keep themselves, or take ``default`` (None → NULL); NULL takes ``missing``."""
    c = _col(col)
    chain = F.when(c.isNull(), _value(missing))
    for old, new in mapping.items():
        chain = chain.when(c == _value(old), _value(new))
    return chain.otherwise(c if default is KEEP else _value(default))


def band(col: Column | str, cuts: Sequence[float], labels: Sequence[str | None]) -> Column:
    """Half-open bands ``[cut, next cut)``; one label more than cuts; a NULL label leaves the band NULL."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("band needs len(cuts) + 1 labels")
    c = _col(col)
    chain = F.when(c.isNull(), F.lit(None))
    for cut, label in zip(cuts, labels):
        chain = chain.when(c < F.lit(cut), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def conditional_assign(col: Column | str, cond: Column, value: Any) -> Column:
    """Overwrite where the condition is true; an unknown condition leaves the value."""
    return F.when(cond, _value(value)).otherwise(_col(col))


def values_to_null(col: Column | str, *sentinels: Any) -> Column:
    c = _col(col)
    return F.when(~in_set(c, sentinels), c)


def fill_null(col: Column | str, value: Any) -> Column:
    return F.coalesce(_col(col), _value(value))


def above(col: Column | str, cut: float) -> Column:
    return _col(col) > F.lit(cut)


def flag_product(flags: Sequence[tuple[Column, str]], sep: str = " + ", none: str = "None", only: str = "only") -> Column:
    """Name the combination of true flags: all joined, a single one followed by ``only``, or ``none``."""
    on = [F.coalesce(flag, F.lit(False)) for flag, _ in flags]
    names = F.array_compact(F.array(*[F.when(f, F.lit(label)) for f, (_, label) in zip(on, flags)]))
    return (
        F.when(F.size(names) == 0, F.lit(none))
        .when(F.size(names) == 1, F.concat(names[0], F.lit(f" {only}")))
        .otherwise(F.array_join(names, sep))
    )


def true_count(flags: Sequence[Column]) -> Column:
    """How many of the flags are true; NULL counts as false."""
    return reduce(lambda a, b: a + b, [F.coalesce(f, F.lit(False)).cast("int") for f in flags])


def pairs_to_lookup(spark: SparkSession, pairs: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(pairs.items()), "`from` string, `to` string")
