"""Building Gold from Silver: which table needs which, and a run that records how each went."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators import bitemporal, equity, features, macro
from timeloom.sources.store import Warehouse

Inputs = dict[str, DataFrame]

#: table: (inputs, build). Inputs are Silver or earlier Gold tables, read from where they were written.
GOLD: dict[str, tuple[tuple[str, ...], Callable[[Inputs], DataFrame]]] = {
    "gold.latest_observation": (("silver.observations",), lambda t: bitemporal.latest_observation(t["silver.observations"])),
    "gold.point_in_time": (("silver.observations",), lambda t: bitemporal.point_in_time(t["silver.observations"])),
    "gold.revision_stats": (("silver.observations",), lambda t: bitemporal.revision_stats(t["silver.observations"])),
    "gold.feature_transforms": (("gold.latest_observation",), lambda t: features.feature_transforms(t["gold.latest_observation"])),
    "gold.macro_feature_daily": (("gold.latest_observation",), lambda t: features.daily_matrix(t["gold.latest_observation"])),
    "gold.series_zscore_rolling": (("gold.latest_observation",), lambda t: features.zscore_rolling(t["gold.latest_observation"])),
    "gold.sparkline": (("gold.latest_observation",), lambda t: macro.sparkline(t["gold.latest_observation"])),
    "gold.equity_return_daily": (("gold.latest_observation",), lambda t: equity.returns(_closes(t["gold.latest_observation"]))),
}


def _closes(latest: DataFrame) -> DataFrame:
    rows = latest.filter("series_id like '%:close'")
    return rows.select(F.substring_index("series_id", ":", 1).alias("ticker"), "observation_date", F.col("value").alias("close"))


@dataclass
class Run:
    """How each table's build ended: seconds, or what went wrong."""

    seconds: dict[str, float] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    @property
    def verdict(self) -> str:
        return "failed" if not self.seconds else "partial" if self.failed else "ok"


def waves(tables: dict[str, tuple]) -> list[list[str]]:
    """Tables in order, those that don't need one another together."""
    done, out = set(), []
    while len(done) < len(tables):
        ready = [t for t, (needs, _) in tables.items() if t not in done and all(n in done or n not in tables for n in needs)]
        if not ready:
            raise ValueError("tables need each other in a circle")
        out.append(ready)
        done |= set(ready)
    return out


def build_gold(spark: SparkSession, warehouse: Warehouse, parallel: int = 4) -> Run:
    """Builds every table; independent ones at the same time. A table whose input failed fails as well."""
    run = Run()

    def one(name: str) -> None:
        needs, build = GOLD[name]
        began = time.monotonic()
        try:
            lost = [n for n in needs if n in run.failed]
            if lost:
                raise RuntimeError(f"needs {', '.join(lost)}")
            warehouse.overwrite(name, build({n: warehouse.read(n) for n in needs}))
            run.seconds[name] = time.monotonic() - began
        except Exception as e:  # one table's failure is a result of the run, not its end
            run.failed[name] = str(e)[:500]

    for wave in waves(GOLD):
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(one, wave))
    return run
