"""Outcome contrasts and grids of sub-cohort models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry.models.design import Term
from cohortry.models.mixed import Cell

# Transferred against all others, against admitted only, against discharged only.
CONTRASTS = ("all", "admitted", "discharged")


def contrast(name: str, outcome: str = "outcome") -> Column:
    """The rows of a contrast; an unknown outcome is in none."""
    o = F.col(outcome)
    return {"all": o.isNotNull(), "admitted": o != "dc home", "discharged": o != "admitted"}[name]


def cross(
    strata: Mapping[str, Column],
    cohorts: Mapping[str, Column | None],
    contrasts: Sequence[str] = CONTRASTS,
    models: Mapping[str, tuple[Term, ...] | None] | None = None,
    outcome: str = "outcome",
) -> list[Cell]:
    """All combinations of stratum, sub-cohort, contrast and model, named ``stratum|cohort|contrast|model``."""
    in_contrast = {k: contrast(k, outcome) for k in contrasts}
    return [
        Cell(f"{s}|{c}|{k}|{m}", (in_stratum, in_contrast[k], *([] if in_cohort is None else [in_cohort])), terms)
        for s, in_stratum in strata.items()
        for c, in_cohort in cohorts.items()
        for k in contrasts
        for m, terms in (models or {"adjusted": None}).items()
    ]
