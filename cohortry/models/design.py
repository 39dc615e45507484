"""Model terms and their design columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.levels import relevel


@dataclass(frozen=True)
class Factor:
    """A category with ordered levels; ``base`` is a level, a 1-based position, or ``"last"``."""

    column: str
    levels: tuple
    base: object = 1

    def reference(self) -> object:
        """The base as one of the levels."""
        names = [str(v) for v in self.levels]
        position = isinstance(self.base, int) and not isinstance(self.base, bool)
        return self.levels[names.index(relevel(names, self.base if position else str(self.base))[0])]

    def design(self) -> list[tuple[str, Column]]:
        base = self.reference()
        return [
            (f"{self.column}={level}", (F.col(self.column) == F.lit(level)).cast("double"))
            for level in self.levels
            if level != base
        ]

    def known(self) -> Column:
        return F.coalesce(F.col(self.column).isin(*self.levels), F.lit(False))


@dataclass(frozen=True)
class Number:
    column: str

    def design(self) -> list[tuple[str, Column]]:
        return [(self.column, F.col(self.column).cast("double"))]

    def known(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~F.isnan(c.cast("double"))


Term = Factor | Number


def design_columns(terms: Sequence[Term]) -> list[tuple[str, Column]]:
    return [pair for t in terms for pair in t.design()]


def complete(terms: Sequence[Term]) -> Column:
    """No term is missing (or outside its levels)."""
    return reduce(lambda a, b: a & b, [t.known() for t in terms], F.lit(True))


def design_matrix(df: DataFrame, terms: Sequence[Term], keep: Sequence[str] = ()) -> DataFrame:
    """Complete rows only: kept columns, then one column per number and per non-reference level."""
    return df.filter(complete(terms)).select(*keep, *[c.alias(n) for n, c in design_columns(terms)])


def sparse_levels(df: DataFrame, outcome: Column, factors: Sequence[Factor], below: int = 5) -> DataFrame:
    """Levels with fewer than ``below`` rows on either side of the outcome: look before fitting."""
    wide = df.agg(
        *[
            F.count_if((F.col(f.column) == F.lit(v)) & (outcome if side else ~outcome)).alias(f"{i}_{j}_{side}")
            for i, f in enumerate(factors)
            for j, v in enumerate(f.levels)
            for side in (0, 1)
        ]
    )
    rows = [
        F.struct(
            F.lit(f.column).alias("variable"),
            F.lit(str(v)).alias("level"),
            F.col(f"{i}_{j}_1").alias("n_yes"),
            F.col(f"{i}_{j}_0").alias("n_no"),
        )
        for i, f in enumerate(factors)
        for j, v in enumerate(f.levels)
    ]
    return wide.select(F.inline(F.array(*rows))).filter(F.least("n_yes", "n_no") < below)
