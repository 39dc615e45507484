"""Importing this module registers every query."""

from catalogue import coding, cohorts, loads, rates, reference, scalars, storage, study, surface, tables  # noqa: F401
