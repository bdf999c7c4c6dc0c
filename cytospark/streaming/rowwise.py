"""Row-wise operators on Structured Streaming sources.

Transforms (C1, C2), compensation with a given per-sample inverse, labels from given cutoffs (D7),
gates with literal bounds (E1) and event phenotypes / definition gates (F4, F10 without the merge)
are plain column expressions, so the same functions run on ``spark.readStream`` DataFrames.  Steps
that need whole-sample statistics (quantile gates, cut-point search, clustering) are batch-only.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cytospark.operators import gating, labels, transform


def label_and_gate(df: DataFrame, cutoffs: Mapping[str, Sequence[float]], strategy=None, b: float | None = None,
                   channels: Sequence[str] | None = None) -> DataFrame:
    """arcsinh (when ``b`` is given) → labels from fixed cutoffs → literal-bound gate.  Works on
    batch and streaming DataFrames alike."""
    out = transform.arcsinh(df, b, channels=channels) if b is not None else df
    out = labels.label_events(out, cutoffs)
    return gating.gate(out, strategy) if strategy else out


def start_stream(spark: SparkSession, path: str, schema: StructType, cutoffs: Mapping[str, Sequence[float]],
                 checkpoint: str, sink: str = "memory", name: str = "cytospark_events", strategy=None,
                 b: float | None = None, fmt: str = "parquet", available_now: bool = True):
    """Start a file-source stream through ``label_and_gate``; the checkpoint makes it restartable."""
    src = spark.readStream.schema(schema).format(fmt).load(path)
    w = label_and_gate(src, cutoffs, strategy, b).writeStream.option("checkpointLocation", checkpoint)
    w = w.format(sink).queryName(name) if sink == "memory" else w.format(sink).option("path", name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
