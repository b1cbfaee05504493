"""Parquet table writes: layout, partition overwrite, append and keyed merge."""
