"""Registered queries over the given tables."""

from . import comparison, files, intervals, peaksets, reporting, sequences, syntax  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
