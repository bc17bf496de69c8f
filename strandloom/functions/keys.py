"""Joins of wide rows with few keys that shuffle only the rows that can match, and column names that nothing else has.

Keys are hashed into a bitmap of ``BITS`` (or ``size``) bits, kept as at most a 64th as many rows of 64 bits, so its broadcast has one size bound
whatever the number of keys. More keys than bits only mean that more rows take the way through the join; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no frame has a column of that name in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def marked(df: DataFrame, key: str, keys: DataFrame, name: str, size: int = BITS) -> DataFrame:
    """df with boolean ``name``: whether ``key`` may be among ``keys`` (one column); false is certain. Null keys are false."""
    word, bits = fresh("word", df), fresh("bits", df)
    k = F.col(keys.columns[0])
    bitmap = keys.where(k.isNotNull()).select(_place(k, size).alias("p")).groupBy(F.floor(F.col("p") / 64).alias(word)).agg(F.bit_or(_bit(F.col("p"))).alias(bits))
    place = _place(F.col(key), size)
    hit = F.col(key).isNotNull() & (F.coalesce(F.col(bits), F.lit(0).cast("long")).bitwiseAND(_bit(place)) != 0)
    return df.withColumn(word, F.floor(place / 64)).join(F.broadcast(bitmap), word, "left").withColumn(name, hit).drop(word, bits)


def matching(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of df whose ``key`` is among ``keys`` (one column, distinct or not)."""
    m, k = fresh("marked", df), fresh("key", df)
    few = keys.select(F.col(keys.columns[0]).alias(k)).distinct()
    maybe = marked(df, key, few, m).where(m).drop(m)
    return maybe.join(few, F.col(key) == F.col(k), "left_semi")


def without(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of df whose ``key`` is not among ``keys``; null keys stay."""
    m, k = fresh("marked", df), fresh("key", df)
    few = keys.select(F.col(keys.columns[0]).alias(k)).distinct()
    all_ = marked(df, key, few, m)
    maybe = all_.where(m).drop(m).join(few, F.col(key) == F.col(k), "left_anti")
    return all_.where(~F.col(m)).drop(m).union(maybe)
