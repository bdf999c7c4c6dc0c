"""Helpers shared by the training-data operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only when it was measured to hold at most this many bytes.
BROADCAST_MAX_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken, name: str) -> str:
    """``name``, with underscores appended until no column of ``taken`` has it (case-insensitive)."""
    seen = {c.lower() for c in taken}
    while name.lower() in seen:
        name += "_"
    return name


def bytes_of(df: DataFrame, text_col: str | Column | None = None, per_row: int = 32) -> int:
    """Size of a narrow table: ``per_row`` bytes a row plus the bytes of one text column."""
    text = F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)) if text_col is not None else F.lit(0)
    return df.agg((F.count(F.lit(1)) * per_row + text).alias("b")).first()["b"]


def small_side(df: DataFrame, text_col: str | Column | None = None, per_row: int = 32,
               max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """``df``, marked for broadcast if its measured size allows and for a shuffle join if not (Spark, which
    goes by the size of files, might broadcast it), and whether it is to be broadcast.  ``df`` should be
    cheap to read again (a cut table)."""
    if bytes_of(df, text_col, per_row) <= max_bytes:
        return F.broadcast(df), True
    return df.hint("merge"), False


def salted_join(left: DataFrame, right: DataFrame, key: str, salt_by: Column, salts: int = 32) -> DataFrame:
    """Left join on ``key`` that spreads each key of ``left`` over ``salts`` tasks; ``right`` (one row
    a key) is repeated ``salts`` times, which Spark leaves out of its size: it is never broadcast."""
    s = fresh(left.columns + right.columns, "_salt")
    left = left.withColumn(s, F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = right.withColumn(s, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [key, s], "left").drop(s)


# A key with more than this share of all rows is joined by broadcast; there are at most as many such keys as its inverse.
HOT_SHARE = 1 / 1000


def join_classes(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join of many rows with one row a key, where one key may hold a third of ``left``.  ``right[rows]`` counts
    the key's rows in ``left``: those few keys that hold more than ``HOT_SHARE`` of all (at least 10 000 rows) are
    broadcast, at most 1 000 rows of ``right``; the others are joined by shuffle.  Both sides are read twice and should
    be tables."""
    total = right.agg(F.sum(rows).alias("n")).first()["n"] or 0
    limit = max(10_000, int(total * HOT_SHARE))
    hot = F.broadcast(right.where(F.col(rows) > limit).drop(rows))
    plain = left.join(hot.select(key), key, "left_anti").join(right.where(F.col(rows) <= limit).drop(rows), key)
    return plain.unionByName(left.join(hot, key))
