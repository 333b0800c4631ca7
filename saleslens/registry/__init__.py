"""Named queries over the tables, each with the SQL that must give the same rows."""

from . import aggregates, business, campaigns, checks, forecasts, joins, projections, scans, series  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
