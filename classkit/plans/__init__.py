"""Registered queries, each with its SQL twin where SQL can say it."""

from classkit.plans import inputs, models, neighbours, scoring, tables  # noqa: F401
from classkit.plans.registry import ORACLES, QUERIES  # noqa: F401
