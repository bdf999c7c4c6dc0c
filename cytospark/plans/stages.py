"""Stage results kept under a run key (M2): a stage's output is written once and reused; refreshing
one stage refreshes every later stage unless that stage says otherwise."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from cytospark.session import checkpoint_dir, drop_path, path_exists, write_marker


class StageStore:
    """``store.run(name, fn)`` returns the stored result of stage ``name`` or computes, writes and
    returns it.  ``refresh`` names stages to recompute; the cascade marks all later stages too."""

    def __init__(self, spark: SparkSession, run_key: str, order: Sequence[str], root: str | None = None,
                 refresh: Sequence[str] = (), keep: Sequence[str] = ()):
        self.spark, self.order = spark, list(order)
        self.root = (root or f"{checkpoint_dir(spark).rstrip('/')}/stages").rstrip("/") + f"/{run_key}"
        first = min((self.order.index(s) for s in refresh if s in self.order), default=None)
        self.stale = set() if first is None else {s for s in self.order[first:] if s not in keep or s in refresh}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        """Whether the stage was finished: its marker is written after the data."""
        return path_exists(self.spark, f"{self.path(name)}.done")

    def run(self, name: str, fn: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.stale and self.exists(name):
            return self.spark.read.parquet(self.path(name))
        drop_path(self.spark, f"{self.path(name)}.done")
        fn().write.mode("overwrite").parquet(self.path(name))
        write_marker(self.spark, f"{self.path(name)}.done", name)
        self.stale.discard(name)
        return self.spark.read.parquet(self.path(name))
