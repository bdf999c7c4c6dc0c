"""Join-side helpers: broadcast only what has been measured."""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# A side of at most this many bytes is broadcast.
BROADCAST_MAX_BYTES = 128 << 20


def _width(name: str, kind: DataType) -> Column:
    """Bytes that a column of a row takes, nearly; nested values by their number times their members' width."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        return F.coalesce(F.size(c), F.lit(0)) * _flat(kind.elementType) + 16
    if isinstance(kind, MapType):
        return F.coalesce(F.size(c), F.lit(0)) * (_flat(kind.keyType) + _flat(kind.valueType)) + 16
    return F.lit(_flat(kind))


def _flat(kind: DataType) -> int:
    if isinstance(kind, StructType):
        return 8 + sum(_flat(f.dataType) for f in kind.fields)
    return 32 if isinstance(kind, (StringType, BinaryType, ArrayType, MapType)) else 8


def checked_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Compute a derived (per-group) table once, measure it, and mark it for broadcast only when its rows
    take at most ``max_bytes``; otherwise it is released and joins by shuffle like any table.

    The table is persisted (memory and disk) rather than written: its lineage is short, so a lost
    block is simply recomputed."""
    m = df.persist(StorageLevel.MEMORY_AND_DISK)
    width = F.lit(16)
    for f in m.schema.fields:
        width = width + _width(f.name, f.dataType)
    n = m.agg(F.sum(width).alias("b")).first()["b"] or 0
    if n <= max_bytes:
        return F.broadcast(m)
    m.unpersist()
    return df


def literal_side(df: DataFrame) -> DataFrame:
    """Broadcast a table built from driver literals (its size is that of the literal list)."""
    return F.broadcast(df)
