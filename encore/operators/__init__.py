"""Reusable relational operators: trailing-window statistics and ranking."""

from .ranking import row_number, row_number_window, top_n
from .trailing import trailing_stats

__all__ = ["trailing_stats", "row_number", "row_number_window", "top_n"]
