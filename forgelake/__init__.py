"""forgelake: developer-activity analytics on Spark.

Layers: ``sources`` (raw archive, tables, driver fixture) -> ``operators``
(staging, bronze, silver, gold, reports) -> ``sinks`` (Parquet layout and
keyed merges), orchestrated by ``plans`` (asset DAG, pipeline, checks).
"""

__version__ = "0.1.0"
