"""The medallion DAG: each asset's spec, upstream tables and builder.

Two runners share it: :class:`Layers` (lazy DataFrames over staging inputs,
for queries and tests) and :mod:`forgelake.plans.pipeline` (materialised
tables with keyed merges and checks, for production runs).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from forgelake import specs
from forgelake.operators import bronze, gold, silver
from forgelake.session import scratch_path
from forgelake.specs import TableSpec


@dataclass(frozen=True)
class Asset:
    spec: TableSpec
    deps: tuple[str, ...]
    build: Callable[..., DataFrame]  # (*dep frames, ingested_at=...) -> DataFrame

    @property
    def name(self) -> str:
        return self.spec.name


ASSETS: dict[str, Asset] = {
    a.name: a
    for a in (
        Asset(specs.BRONZE_EVENTS, ("staging_events",), bronze.bronze_events),
        Asset(specs.BRONZE_COMMITS, ("staging_commits", "bronze_events"), bronze.bronze_commits),
        Asset(specs.BRONZE_PRODUCTIVITY, ("staging_productivity", "bronze_events"), bronze.bronze_productivity),
        Asset(
            specs.SILVER_DEVELOPER_ACTIVITY,
            ("bronze_commits", "bronze_productivity", "bronze_events"),
            silver.developer_activity,
        ),
        Asset(specs.SILVER_REPO_SUMMARY, ("silver_developer_activity",), silver.repo_summary),
        Asset(specs.DEVELOPER_PRODUCTIVITY_MONTHLY, ("silver_developer_activity",), gold.developer_productivity_monthly),
        Asset(specs.REPO_HEALTH_SCORECARD, ("silver_repo_summary",), gold.repo_health_scorecard),
        Asset(specs.COMMIT_STATS_BY_DAY, ("silver_developer_activity",), gold.commit_stats_by_day),
        Asset(specs.ACTIVITY_BY_DAY, ("silver_developer_activity",), gold.activity_by_day),
    )
}

STAGING_NAMES = ("staging_events", "staging_commits", "staging_productivity")


def topological_order(targets: Iterable[str] | None = None) -> list[str]:
    """Assets needed for ``targets`` (default: all), upstream first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name in STAGING_NAMES:
            return
        for d in ASSETS[name].deps:
            visit(d)
        order.append(name)

    for t in targets or ASSETS:
        visit(t)
    return order


def waves() -> list[list[str]]:
    """Assets grouped by DAG depth (staging inputs are depth 0)."""
    depth: dict[str, int] = {n: 0 for n in STAGING_NAMES}
    for name in topological_order():
        depth[name] = 1 + max(depth[d] for d in ASSETS[name].deps)
    levels = sorted({depth[n] for n in ASSETS})
    return [[n for n in ASSETS if depth[n] == lvl] for lvl in levels]


def consumers(name: str) -> int:
    return sum(name in a.deps for a in ASSETS.values())


class Layers:
    """Lazily built medallion tables over three staging DataFrames.

    Each table is built once per instance.  Tables named in ``materialize``
    are written to the scratch folder and read back, which cuts the lineage
    where one table feeds several others (``"shared"`` = every table with
    more than one consumer); everything else stays one Catalyst plan.
    """

    def __init__(
        self,
        spark: SparkSession,
        staging: dict[str, DataFrame],
        *,
        materialize: Iterable[str] | str = "shared",
        ingested_at: Column | None = None,
    ) -> None:
        self.spark = spark
        self._frames = dict(staging)
        if materialize == "shared":
            materialize = [n for n in ASSETS if consumers(n) > 1]
        elif materialize == "all":
            materialize = list(ASSETS)
        self._materialize = set(materialize)
        self._ingested_at = ingested_at

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            asset = ASSETS[name]
            inputs = [self.table(d) for d in asset.deps]
            df = asset.build(*inputs, ingested_at=self._ingested_at)
            if name in self._materialize:
                path = scratch_path(self.spark, f"layer-{name}")
                df.write.mode("errorifexists").parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self._frames[name] = df
        return self._frames[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)
