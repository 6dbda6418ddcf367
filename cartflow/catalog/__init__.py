"""Every operator as a named query over the supplied tables, with its oracle where SQL can say it."""

from cartflow.catalog import (aggregates, columns, evaluation, features, joins, models,  # noqa: F401
                              monitoring, profile, sampling, scalars, sources, streams,
                              training, windows)
from cartflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
