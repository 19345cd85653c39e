"""Column-level helpers: text to typed values, row quality."""

from .quality import conform, mark_valid, split_valid
from .text import as_day, normalise_iso, strict_day, valid_date_text

__all__ = [
    "as_day",
    "conform",
    "mark_valid",
    "normalise_iso",
    "split_valid",
    "strict_day",
    "valid_date_text",
]
