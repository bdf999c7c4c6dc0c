"""Compositions of the operators: augment (D8), stage checkpoints (M2) and the whole pipeline (M1)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.functions.expr import EXCLUDED_CHANNELS_RE, channels_of, transformable
from cytospark.operators import cutpoints, labels, transform


def augment(df: DataFrame, b: float | None = 1 / 150, channels: Sequence[str] | None = None, bins: int = 4,
            zero_threshold: float = 0.90, max_sample: int | None = None, seed: int = 666, remove_outliers: bool = False,
            outlier_kw: dict | None = None, exclude_re: str | None = EXCLUDED_CHANNELS_RE,
            by: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Outlier segments (optional) → arcsinh → cutoffs per (sample, channel) → labels (D8).

    Returns ``(labelled events, cutoffs)``; channels matching ``exclude_re`` are neither transformed
    nor labelled."""
    chans = transformable(channels if channels is not None else channels_of(df), exclude_re)
    if remove_outliers:
        from cytospark.operators.outliers import remove_outlier_segments
        df = remove_outlier_segments(df, chans, **(outlier_kw or {}))
    t = transform.arcsinh(df, b, channels=chans, exclude_re=exclude_re)
    cuts = cutpoints.find_cutoffs(t, chans, bins, zero_threshold, max_sample, seed, by=by)
    return labels.label_events(t, cuts, chans, by), cuts
