"""Run configuration: where the zones live and how tables are named and written."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class LakeConfig:
    """One lakehouse location.

    ``base_path`` must be storage every executor can reach. ``as_of`` pins the audit clock and
    ``kpi_date`` so a rerun gives the same values; left empty, Spark's own clock is used.
    """

    base_path: str
    database: str = "default"
    table_format: str = "parquet"
    batch_id: str | None = None
    as_of: datetime | None = None
    null_policy: str = "reject"

    def zone(self, layer: str, name: str = "") -> str:
        return "/".join(p for p in (self.base_path.rstrip("/"), layer, name) if p)

    def raw(self, source: str) -> str:
        return self.zone("raw", source)

    def checkpoint(self, name: str) -> str:
        return self.zone("checkpoints", name)

    def table(self, layer: str, name: str) -> str:
        return f"{self.database}.{layer}_{name}"

    def now(self) -> Column:
        if self.as_of is None:
            return F.current_timestamp()
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp")

    def today(self) -> Column:
        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of.date().isoformat()).cast("date")
