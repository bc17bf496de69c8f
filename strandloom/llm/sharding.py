"""Rendezvous hashing of stable keys over weighted shards, in DataFrame expressions only.

Every (key, shard) pair has a hash u in (0, 1); a key goes to the shard with the largest -weight / ln(u). A new shard
takes the keys whose score it tops and moves no other. Places inside a shard come from counts of fixed-size groups
(shard, bucket of the key), their running sums, and a rank inside each group, so no shard meets in one task; rows that
are equal in every column used are counted before the shuffle and unfolded again.

Null keys are a key like any other. Null texts count as empty. Repeated rows get neighbouring slots. Extra columns are
ignored by ``shards``; ``assign`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions.scratch import table

#: Groups of a shard for the running sums; their number bounds the broadcast table (shards * GROUPS rows).
GROUPS = 1024


def _score(key: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u); u from 52 bits of md5 of key and shard, never 0 or 1."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(key, F.lit("\\N")), F.lit(str(shard))).cast("binary")), 1, 13), 16, 10).cast("double")
    return F.lit(-float(weight)) / F.log((bits + 0.5) / F.lit(2.0**52))


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The shard of a string key; weights: shard number to positive weight."""
    best = F.array_max(F.array(*[F.struct(_score(key, s, w).alias("score"), F.lit(-s).alias("s")) for s, w in sorted(weights.items())]))
    return (-best["s"]).cast("int")


def assign(df: DataFrame, key: str, weights: dict[int, float], column: str = "shard") -> DataFrame:
    return df.withColumn(column, rendezvous(F.col(key).cast("string"), weights))


def write_shards(df: DataFrame, path: str, column: str = "shard") -> None:
    """One folder per shard."""
    df.write.partitionBy(column).parquet(path)


def shards(docs: DataFrame, weights: dict[int, float], grown: dict[int, float]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = F.col("doc_id").cast("string")
    same = table(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "sizes")
    same = same.withColumn("shard", rendezvous(key, weights)).withColumn("grown_shard", rendezvous(key, grown)).withColumn("g", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(GROUPS)))
    same = table(same, "shards")
    groups = same.groupBy("shard", "g").agg(F.sum("n").alias("m"))
    starts = groups.withColumn("start", F.sum("m").over(Window.partitionBy("shard").orderBy("g")) - F.col("m")).drop("m")
    inside = F.sum("n").over(Window.partitionBy("shard", "g").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    placed = same.withColumn("inside", inside).join(F.broadcast(starts), ["shard", "g"])
    first = F.col("start") + F.col("inside")
    return placed.withColumn("slot", F.explode(F.sequence(first, first + F.col("n") - 1))).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    eight = {s: 1.0 for s in range(8)}
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), eight, eight | {8: 1.0})
