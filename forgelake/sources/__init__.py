"""Inputs: the raw JSON archive, written tables (with lookback) and the driver fixture mapping."""
