"""Composite plans: the table builds, the analyses and the proof queries."""
