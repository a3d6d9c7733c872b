"""Queries over the reference's operators, and their SQL twins."""

from cadenza.queries import curation, evaluation, frames, quality  # noqa: F401 - they register themselves
from cadenza.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
