"""All registered queries, by name, and the SQL of those that have an equivalent."""

from metframe.plans.catalog import batches, blending, charting, feeds, forecasting, ordered, streams
from metframe.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "batches", "blending", "charting", "feeds", "forecasting", "ordered", "streams"]
