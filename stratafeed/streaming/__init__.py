"""Bounded Structured Streaming runs into keyed tables."""

from .incremental import (
    clean_batch,
    drain,
    finish,
    run_incremental,
    start,
    start_incremental,
)

__all__ = [
    "clean_batch",
    "drain",
    "finish",
    "run_incremental",
    "start",
    "start_incremental",
]
