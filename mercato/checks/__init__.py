"""Registered queries over the supplied tables and their SQL counterparts."""

from mercato.checks import documents, explore, inputs, layout, quality, ranges, reports, retail, stems  # noqa: F401
from mercato.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
