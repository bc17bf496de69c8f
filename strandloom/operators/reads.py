"""Collapsed reads and their statistics: (sample, seq, n)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.seq import letters, normalised, reverse_complement


def collapse_reads(df: DataFrame) -> DataFrame:
    """Equal reads of a sample as one row with their number."""
    return df.groupBy("sample", "seq").agg(F.count("*").alias("n"))


def reads_per_sample(df: DataFrame, col: str = "read_id") -> DataFrame:
    """Ids SAMPLE_IDX_xN to reads and unique reads per sample; malformed ids are counted under an empty sample."""
    form = r"^(.*)_(\d+)_x(\d+)$"
    parts = df.select(F.regexp_extract(col, form, 1).alias("sample"), F.regexp_extract(col, form, 3).alias("n"))
    ok = F.col("n") != ""
    return parts.groupBy("sample").agg(F.sum(F.when(ok, F.col("n").cast("long")).otherwise(0)).alias("reads"), F.count_if(ok).alias("uniq"), F.count_if(~ok).alias("bad"))


def expand_multiplicity(df: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))


def length_distribution(df: DataFrame, lo: int = 18, hi: int = 35) -> DataFrame:
    """Reads by length, every length from lo to hi, with percent of those in range."""
    spark = df.sparkSession
    by = df.where(F.length("seq").between(lo, hi)).groupBy(F.length("seq").alias("len")).agg(F.sum("n").alias("n"))
    total = by.agg(F.sum("n").alias("total"))
    every = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("len"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return every.join(F.broadcast(by), "len", "left").crossJoin(F.broadcast(total)).select("len", n.alias("n"), F.round(F.coalesce(100 * n / F.col("total"), F.lit(0.0)), 4).alias("percent"))


def uniq_total_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("sample").agg(F.sum("n").alias("reads"), F.sum(F.col("n") * F.length("seq")).alias("bases"), F.count("*").alias("uniq_reads"), F.sum(F.length("seq")).cast("long").alias("uniq_bases"))


def first_base_bias(df: DataFrame, lo: int = 18, hi: int = 30, weighted: bool = False) -> DataFrame:
    """Reads by sample, length and first base (T as U), every length from lo to hi."""
    w = F.col("n") / F.col("hits") if weighted else F.col("n")
    base = F.translate(F.substring("seq", 1, 1), "T", "U")
    rows = df.where(F.length("seq").between(lo, hi)).select("sample", F.length("seq").alias("len"), base.alias("b"), w.alias("w"))
    by = rows.groupBy("sample", "len").pivot("b", list("AUCG")).agg(F.sum("w"))
    every = df.select("sample").distinct().withColumn("len", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
    zero = F.lit(0.0) if weighted else F.lit(0).cast("long")
    return every.join(by, ["sample", "len"], "left").select("sample", "len", *[F.coalesce(c, zero).alias(c.lower()) for c in "AUCG"])


def position_base_bias(df: DataFrame, n: int = 22) -> DataFrame:
    """Reads by sample, position 1 to n, and base (T as U)."""
    each = df.select("sample", "n", F.posexplode(letters(F.substring("seq", 1, n))).alias("p", "b")).withColumn("b", F.translate("b", "T", "U"))
    return each.groupBy("sample", (F.col("p") + 1).alias("pos")).pivot("b", list("AUCG")).agg(F.sum("n")).na.fill(0).select("sample", "pos", *[F.col(c).alias(c.lower()) for c in "AUCG"])


def share_specific(df: DataFrame) -> DataFrame:
    """For every two samples: sequences and reads that both have, or only one has.

    Counts come from sequences that two samples share and from sample totals, so nothing but shared rows is paired.
    """
    totals = df.groupBy("sample").agg(F.count("*").alias("u"), F.sum("n").alias("t"))
    own = df.groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("sample", "n"))).alias("own")).where(F.size("own") > 1)
    pairs = own.select(F.posexplode("own").alias("i", "a"), "own").select("a", F.explode(F.slice("own", F.col("i") + 2, F.size("own"))).alias("b"))
    both = pairs.groupBy(F.col("a.sample").alias("a"), F.col("b.sample").alias("b")).agg(F.count("*").alias("common_uniq"), F.sum("a.n").alias("ta"), F.sum("b.n").alias("tb"))
    two = totals.select(F.col("sample").alias("a"), F.col("u").alias("ua"), F.col("t").alias("na")).join(F.broadcast(totals.select(F.col("sample").alias("b"), F.col("u").alias("ub"), F.col("t").alias("nb"))), F.col("a") < F.col("b"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return two.join(both, ["a", "b"], "left").select("a", "b", zero("common_uniq").alias("common_uniq"), (zero("ta") + zero("tb")).alias("common_total"), (F.col("ua") - zero("common_uniq")).alias("a_uniq"), (F.col("na") - zero("ta")).alias("a_total"), (F.col("ub") - zero("common_uniq")).alias("b_uniq"), (F.col("nb") - zero("tb")).alias("b_total"))


def strand_normalise(df: DataFrame) -> DataFrame:
    """seq as the read had it: reverse complement where the hit is on the minus strand."""
    return df.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))


def normalise_seq(df: DataFrame) -> DataFrame:
    """Normalised sequences; those with N go."""
    return df.withColumn("seq", normalised(F.col("seq"))).where(~F.col("seq").contains("N"))


def gc_fraction(df: DataFrame, letters_: str = "GC") -> DataFrame:
    """Share of a set of letters per read, averaged by sample, and the counts of A, C, G and T."""
    share = F.regexp_count("seq", F.lit(f"[{letters_}]")) / F.length("seq")
    return df.where(F.length("seq") > 0).groupBy("sample").agg(F.round(F.avg(share), 6).alias("mean_share"), *[F.sum(F.regexp_count("seq", F.lit(b))).alias(b.lower()) for b in "ACGT"])


def multimap_weight(aln: DataFrame, mode: str = "weight") -> DataFrame:
    """Hits per read m, and the weights n/m and 1/m; with mode ``unique`` only reads of one hit."""
    m = F.count("*").over(Window.partitionBy("read_id"))
    out = aln.withColumn("m", m)
    if mode == "unique":
        return out.where("m = 1")
    return out.withColumn("weight", F.col("n") / F.col("m")).withColumn("uniq_weight", F.lit(1.0) / F.col("m"))


def seq_lengths(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.length("seq").alias("len"))
