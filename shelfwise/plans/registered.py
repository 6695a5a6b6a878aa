"""All registered queries."""

from shelfwise.plans import (  # noqa: F401
    analytics, candidates, columns, files, ids, joins, recommenders, search, sequences, streams,
)
from shelfwise.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
