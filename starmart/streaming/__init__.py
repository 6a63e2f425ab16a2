"""Streaming: the monthly refresh as an available-now Structured Streaming job."""
