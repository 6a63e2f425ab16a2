"""Reusable DataFrame operators (cleaning, aggregation, lookups, quality)."""
