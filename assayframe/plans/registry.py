"""Imports every query module, so that the catalog is complete."""

from . import column_queries, matrix_queries, read_queries, source_queries, study_queries
from .catalog import ORACLES, QUERIES
from .matrix_queries import flagship

__all__ = ["ORACLES", "QUERIES", "column_queries", "flagship", "matrix_queries", "read_queries", "source_queries", "study_queries"]
