"""Queries over the given tables, each with the SQL that must agree with it."""

from . import (  # noqa: F401
    days,
    drift,
    feed,
    files,
    increments,
    keyed,
    nested,
    pipeline,
    quality,
    stats,
    stored,
    streams,
)
from .registry import CHECKS

__all__ = ["CHECKS"]
