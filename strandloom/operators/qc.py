"""Read cleaning: filters, adapters, and the quality tables of raw and clean reads.

Reads have sample, read_id, seq and, where it is used, qual (Phred + 33).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.seq import let, once
from strandloom.functions.seqarrays import adapter_ends, adapter_place, counted, tally


def _quality() -> Column:
    """The quality that a letter counted by ``tally`` stands for."""
    return F.col("code") - 33


def _count_upto(q: int) -> Column:
    """How many letters of ``qual`` stand for a quality of at most ``q``."""
    return counted(F.col("qual"), 1, q + 33)


def n_rich(rate: float = 0.1) -> Column:
    return F.length("seq") * rate <= F.regexp_count("seq", F.lit("[nN]"))


def low_quality(q: int = 5, rate: float = 0.5) -> Column:
    return F.length("seq") * rate <= _count_upto(q)


def filter_n_rate(df: DataFrame, rate: float = 0.1) -> DataFrame:
    """Keep reads whose share of N is below ``rate``."""
    return df.where(~n_rich(rate))


def filter_low_qual(df: DataFrame, q: int = 5, rate: float = 0.5) -> DataFrame:
    """Keep reads with less than ``rate`` of the bases at quality ``q`` or below."""
    return df.where(~low_quality(q, rate))


def clean_header(df: DataFrame) -> DataFrame:
    """Take ``#`` and the word after it out of read ids."""
    return df.withColumn("read_id", F.regexp_replace("read_id", r"#\w+", ""))


def head_trim(df: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` bases and qualities."""
    return df.withColumns({c: F.substring(c, 1, n) for c in ("seq", "qual") if c in df.columns})


def has_adapter5(a5: str, least: int = 8, mismatches: int = 1) -> Column:
    """A 5' adapter, or a suffix of it at the read's start, ends at some base from ``least`` on."""
    return adapter_ends(F.col("seq"), a5, mismatches, least)


def adapter5_detect(df: DataFrame, a5: str, min5: int = 8, mm: int = 1) -> DataFrame:
    return df.withColumn("has5", has_adapter5(a5, min5, mm))


def insert3(a3: str, least: int = 8, mismatches: int = 2) -> Column:
    """What stands before the leftmost 3' adapter (a part of at least ``least`` bases at the end counts); null if none."""
    seq = F.col("seq")
    at = adapter_place(seq, a3, mismatches, least)
    return let(at, lambda p: F.when(p > 0, F.substr(seq, F.lit(1), p - 1)))


def adapter3_trim(df: DataFrame, a3: str, min3: int = 8, mm: int = 2) -> DataFrame:
    """``insert``: the read before its 3' adapter, empty where none is found."""
    return once(df, "insert", F.coalesce(insert3(a3, min3, mm), F.lit("")))


def filter_insert(df: DataFrame, n: int = 10) -> DataFrame:
    return df.where(F.length("insert") >= n)


def homopolymer(c: Column, n: int = 7) -> Column:
    return c.rlike("|".join(f"{b}{{{n},}}" for b in "ATGC"))


def filter_homopolymer(df: DataFrame, n: int = 7) -> DataFrame:
    return df.where(~homopolymer(F.col("seq"), n))


def filter_length(df: DataFrame, lo: int = 18, hi: int = 35) -> DataFrame:
    return df.where(F.length("seq").between(lo, hi))


def qc_reason(a3: str, a5: str, lo: int = 16, hi: int = 35, poly: int = 7, least: int = 10) -> Column:
    """The first test that a read fails: adapter5, insert, poly, length; else pass. Needs ``insert``."""
    ins = F.col("insert")
    return F.when(has_adapter5(a5), "adapter5").when(F.length(ins) < least, "insert").when(homopolymer(ins, poly), "poly").when(~F.length(ins).between(lo, hi), "length").otherwise("pass")


def qc_waterfall(df: DataFrame, a3: str, a5: str, **limits) -> DataFrame:
    """Reads and bases by the reason they are dropped for, and the share of all reads."""
    tagged = once(adapter3_trim(df, a3), "reason", qc_reason(a3, a5, **limits))
    by = tagged.groupBy("reason").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))
    return by.crossJoin(F.broadcast(by.agg(F.sum("reads").alias("total")))).select("reason", "reads", "bases", F.round(100 * F.col("reads") / F.col("total"), 4).alias("percent"))


def adaptor_tool(df: DataFrame, a3: str, a5: str | None = None, lo: int = 18, hi: int = 30) -> DataFrame:
    """5' check where an adapter is given, 3' trimming, size filter; seq is the insert."""
    if a5:
        df = df.where(~has_adapter5(a5))
    return adapter3_trim(df, a3).where(F.length("insert").between(lo, hi)).withColumn("seq", F.col("insert")).drop("insert")


def base_composition(df: DataFrame) -> DataFrame:
    """Per position (from 1): count and percent of A, T, G, C and N."""
    own = lambda b: F.coalesce(F.sum(F.when(F.col("code") == ord(b), F.col("n"))), F.lit(0).cast("long"))
    by = tally(df, [], ["seq"]).groupBy("pos").agg(*[own(b).alias(b) for b in "ATGCN"])
    total = sum((F.col(b) for b in "ATGCN"), F.lit(0))
    return by.select("pos", *[F.col(b).alias(f"n_{b.lower()}") for b in "ATGCN"], *[F.round(100 * F.col(b) / total, 4).alias(f"p_{b.lower()}") for b in "ATGCN"])


def quality_by_position(df: DataFrame) -> DataFrame:
    """Per position (from 1): mean quality and the error percentage it stands for."""
    q = F.sum(_quality() * F.col("n")) / F.sum("n")
    return tally(df, [], ["qual"]).groupBy("pos").agg(F.round(q, 6).alias("mean_q"), F.round(100 * F.pow(F.lit(10.0), -q / 10), 6).alias("error"))


def quality_histogram(df: DataFrame) -> DataFrame:
    return tally(df, [], ["qual"]).groupBy(_quality().alias("q")).agg(F.sum("n").alias("n"))


def fastq_summary(df: DataFrame) -> DataFrame:
    """Per sample: reads, bases, N, low quality, Q20, Q30, GC (all in percent) and duplication."""
    return _summary(df, tally(df, ["sample"], ["seq", "qual"]))


def _summary(df: DataFrame, letters: DataFrame) -> DataFrame:
    """The summary of reads from the distinct ones and from counts of letters by place."""
    code = F.col("code")
    of = lambda text, test: F.sum(F.when(F.col("text") == text, F.when(test, F.col("n")).otherwise(0)))
    counts = letters.groupBy("sample").agg(of("seq", code == ord("N")).alias("nn"), of("seq", code.isin(ord("G"), ord("C"))).alias("gc"), *[of("qual", code.between(1, q + 33)).alias(f"q{q}") for q in (5, 19, 29)])
    s = df.groupBy("sample", "seq").agg(F.count("*").alias("n"))
    s = s.groupBy("sample").agg(F.sum("n").alias("reads"), F.count("*").alias("distinct"), F.sum(F.length("seq") * F.col("n")).alias("len"))
    s = s.join(F.broadcast(counts.withColumnRenamed("sample", "__s")), F.col("sample").eqNullSafe(F.col("__s")), "left")
    pct = lambda a, b: F.round(100 * a / b, 4)
    n = F.col("len")
    return s.select(
        "sample", "reads", n.alias("bases"), pct(F.col("nn"), n).alias("n_percent"), pct(F.col("q5"), n).alias("low_percent"),
        F.round(100 - 100 * F.col("q19") / n, 4).alias("q20"), F.round(100 - 100 * F.col("q29") / n, 4).alias("q30"),
        pct(F.col("gc"), n - F.col("nn")).alias("gc_percent"), pct(F.col("reads") - F.col("distinct"), F.col("reads")).alias("duplication"),
    )


def fastq_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw against clean reads by sample: the summary of either stage, the error (its positions' errors over 100, summed) and, for clean, the reads discarded."""
    key = ["sample", "stage"]

    def stage(df: DataFrame, name: str) -> DataFrame:
        letters = tally(df, ["sample"], ["seq", "qual"])
        error = letters.where("text = 'qual'").groupBy("sample", "pos").agg((F.sum(_quality() * F.col("n")) / F.sum("n")).alias("q"))
        error = error.groupBy("sample").agg(F.round(F.sum(F.pow(F.lit(10.0), -F.col("q") / 10)), 6).alias("error"))
        return _summary(df, letters).join(error, "sample", "left").withColumn("stage", F.lit(name))

    both = stage(raw, "raw").unionByName(stage(clean, "clean"))
    before = Window.partitionBy("sample").orderBy(F.desc("stage"))
    return both.withColumn("discarded", F.coalesce(F.lag("reads").over(before) - F.col("reads"), F.lit(0))).select(*key, *[c for c in both.columns if c not in key], "discarded")


def qc_passrate(df: DataFrame) -> DataFrame:
    """df: sample, ok. Per sample: filtered, total, passed, percent passed."""
    passed = F.count_if(F.col("ok"))
    return df.groupBy("sample").agg((F.count("*") - passed).alias("filtered"), F.count("*").alias("total"), passed.alias("passed"), F.round(100 * passed / F.count("*"), 2).alias("rate"))
