"""Ordinal labels from cutoffs (D7).

Label i = number of cutoffs ≤ x (left-closed): ``-`` below c1, ``d`` in [c1, c2), ``+`` in [c2, c3),
``++`` from c3.  Labels go into sibling columns ``<channel>__pm`` of the same row.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.functions.expr import LEVELS, label_from_array, label_from_cuts, pm
from cytospark.functions.plan import checked_side


def cutoffs_wide(cutoffs: DataFrame, channels: Sequence[str], by: str = "sample_id") -> DataFrame:
    """Long cutoffs ``(sample_id, channel, cut_no, cutoff)`` → one row per sample with an
    ``array<double>`` of sorted cutoffs per channel (NULL when the channel has none)."""
    aggs = []
    for ch in channels:
        arr = F.array_sort(F.collect_list(F.when(F.col("channel") == ch, F.col("cutoff"))))
        aggs.append(F.when(F.size(arr) > 0, arr).alias(f"_cuts__{ch}"))
    return cutoffs.groupBy(by).agg(*aggs)


def label_events(df: DataFrame, cutoffs, channels: Sequence[str] | None = None, by: str = "sample_id",
                 levels: Sequence[str] = LEVELS) -> DataFrame:
    """Add ``<channel>__pm`` label columns.

    ``cutoffs`` is either a dict ``{channel: [c1, c2, c3]}`` applied to every sample (a pure
    projection, streaming-safe) or a long DataFrame ``(sample_id, channel, cut_no, cutoff)``.  The
    DataFrame form is pivoted to one row per sample and joined by sample (broadcast after its size is
    measured).  Channels without cutoffs get NULL labels.
    """
    if isinstance(cutoffs, Mapping):
        chans = list(channels) if channels is not None else list(cutoffs)
        return df.withColumns({pm(ch): label_from_cuts(F.col(ch), cutoffs.get(ch), levels) for ch in chans})
    if channels is None:
        channels = [r[0] for r in cutoffs.select("channel").distinct().collect()]  # channel names only
    wide = checked_side(cutoffs_wide(cutoffs, channels, by))
    j = df.join(wide, by, "left")
    return j.withColumns({pm(ch): label_from_array(F.col(ch), F.col(f"_cuts__{ch}"), levels) for ch in channels}) \
        .drop(*[f"_cuts__{ch}" for ch in channels])
