"""Writers: FASTA, matrices, parts, shards by taxon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.table import numbered


def fasta_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit(">"), F.col("id").cast("string"), F.lit("\n"), "seq").alias("value"))


def write_fasta(df: DataFrame, path: str) -> None:
    fasta_lines(df).write.text(path)


def split_fasta_n(df: DataFrame, order: list[str], n: int | None = None, k: int | None = None) -> DataFrame:
    """``part``: n near-equal parts, or parts of k records, in order."""
    d = numbered(df, order, "line")
    if k:
        return d.withColumn("part", F.ceil(F.col("line") / k).cast("long")).drop("line")
    total = df.agg(F.count("*").alias("total"))
    d = d.crossJoin(F.broadcast(total))
    # the first (total mod n) parts hold one more, as ntile does
    big, rest = F.floor(F.col("total") / n) + 1, F.col("total") % n
    i = F.col("line") - 1
    part = F.when(i < big * rest, F.floor(i / big)).otherwise(rest + F.floor((i - big * rest) / F.greatest(big - 1, F.lit(1))))
    return d.withColumn("part", (part + 1).cast("long")).drop("line", "total")


def wide_matrix(long: DataFrame, samples: list[str]) -> DataFrame:
    return long.groupBy("id").pivot("sample", sorted(samples)).agg(F.sum("value")).na.fill(0)


def write_matrix(long: DataFrame, samples: list[str], path: str) -> None:
    wide_matrix(long, samples).write.option("sep", "\t").option("header", True).csv(path)


def shard_by_taxon(df: DataFrame, taxa: DataFrame, pad: bool = False) -> DataFrame:
    """``taxon`` by the id's prefix (``all`` for unknown ones), optionally XX at both ends of the sequence; write with partitionBy."""
    d = df.withColumn("prefix", F.regexp_extract("id", r"^(\w+)-", 1)).join(F.broadcast(taxa), "prefix", "left").withColumn("taxon", F.coalesce("taxon", F.lit("all")))
    return d.withColumn("seq", F.concat(F.lit("XX"), "seq", F.lit("XX"))) if pad else d
