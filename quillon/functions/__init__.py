"""Scalar functions over columns: geography, currency, calendar, null-aware arithmetic."""
