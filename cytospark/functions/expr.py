"""Column expressions shared by the operators.  All are built-in Spark expressions (whole-stage codegen,
usable on streaming DataFrames)."""
from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ordinal intensity labels in rank order, and the merged labels with their members,
# in the order the summaries list them.
LEVELS = ["-", "d", "+", "++"]
MERGED_LABELS = {
    "-/d": ["-", "d"],
    "+/++": ["+", "++"],
    "d/+": ["d", "+"],
    "all": ["-", "d", "+", "++"],
}
# Merged labels used by the report tables.
REPORT_MERGED_LABELS = {"-/d": ["-", "d"], "+/++": ["+", "++"]}
# Channels that are never transformed or labelled by default (case-insensitive).
EXCLUDED_CHANNELS_RE = r"time|event_length"
PM_SUFFIX = "__pm"


def pm(channel: str) -> str:
    """Name of the label column that shadows ``channel``."""
    return channel + PM_SUFFIX


def q(name: str) -> str:
    """Back-quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def channels_of(df: DataFrame, exclude: Iterable[str] = ("sample_id", "event_id")) -> list[str]:
    """Numeric channel columns of an event DataFrame (label and id columns left out)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and not f.name.endswith(PM_SUFFIX)
            and f.dataType.typeName() in ("double", "float", "integer", "long", "short", "decimal")]


def transformable(channels: Sequence[str], exclude_re: str | None = EXCLUDED_CHANNELS_RE) -> list[str]:
    if not exclude_re:
        return list(channels)
    rx = re.compile(exclude_re, re.IGNORECASE)
    return [c for c in channels if not rx.search(c)]


def asinh_col(y: Column) -> Column:
    """asinh(y) in a form exact for large |y| and tiny y (the builtin overflows at -1e8)."""
    ay = F.abs(y)
    return F.signum(y) * F.log1p(ay + y * y / (F.lit(1.0) + F.sqrt(y * y + F.lit(1.0))))


def arcsinh_col(x: Column, b: float, a: float = 1.0, c: float = 0.0) -> Column:
    """``asinh(a + b*x) + c``."""
    return asinh_col(F.lit(float(a)) + F.lit(float(b)) * x) + F.lit(float(c))


def rev_arcsinh_col(x: Column, a: float = 1.0, b: float = 1.0, c: float = 0.0) -> Column:
    """Inverse of ``arcsinh_col``: ``(sinh(x - c) - a) / b``."""
    return (F.sinh(x - F.lit(float(c))) - F.lit(float(a))) / F.lit(float(b))


def label_from_cuts(x: Column, cuts: Sequence[float] | None, levels: Sequence[str] = LEVELS) -> Column:
    """Ordinal label for fixed cutoffs: label i = number of cutoffs <= x (left-closed)."""
    if not cuts:
        return F.lit(None).cast("string")
    cuts = sorted(float(c) for c in cuts)
    e = None
    for i, c in enumerate(cuts):
        cond = x < F.lit(c)
        e = F.when(cond, F.lit(levels[i])) if e is None else e.when(cond, F.lit(levels[i]))
    e = e.when(x.isNotNull(), F.lit(levels[len(cuts)]))
    return e


def label_from_array(x: Column, cuts: Column, levels: Sequence[str] = LEVELS) -> Column:
    """Ordinal label for per-row cutoffs held in an ``array<double>`` column (NULL array → NULL label)."""
    lv = F.array(*[F.lit(v) for v in levels])
    n = F.size(F.filter(cuts, lambda c: c <= x))
    return F.when(x.isNull() | cuts.isNull() | (F.size(cuts) == 0), F.lit(None).cast("string")) \
        .otherwise(F.element_at(lv, n + 1))


def label_case_sql(channel: str, cuts: Sequence[float], levels: Sequence[str] = LEVELS) -> str:
    """SQL twin of ``label_from_cuts``."""
    parts = [f"WHEN {channel} IS NULL THEN NULL"]
    for i, c in enumerate(sorted(cuts)):
        parts.append(f"WHEN {channel} < {float(c)!r} THEN '{levels[i]}'")
    return f"CASE {' '.join(parts)} ELSE '{levels[len(cuts)]}' END"


def cluster_sort_key(c: Column) -> list[Column]:
    """Sort order for cluster ids: numeric when the id parses as a number, else text."""
    return [c.cast("double").isNull(), c.cast("double"), c]
