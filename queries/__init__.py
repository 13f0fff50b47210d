"""Registered queries: each runs one operator over the whole given tables, most with equivalent SQL."""

from queries import (  # noqa: F401
    attached, cubes, nested, streams,
    categories, cleaning, entities, evaluation, features, forecasting, growing, handling, hardening, mixedtimes, outliers, rows, scaling, spelling,
    stages,
)
from queries.registry import ORACLES, QUERIES  # noqa: F401
