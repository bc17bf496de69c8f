"""Sequence and alignment views over the given tables, in Spark and in SQL with the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.seqarrays import cut, spelled

A3, A5 = "GATTACAGTACCTG", "CTGAAGTCCA"
_ABC, _DNA = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTNCGTACGTAC"
_BASES, _QUAL = "ACGTN", "IC5/#"


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, sample, s: the letters of a text as bases."""
    text = F.coalesce("text", F.lit(""))
    return read(spark, d, "documents").select("doc_id", F.col("source").alias("sample"), spelled(text, dict(zip(_ABC + _ABC.upper(), _DNA + _DNA, strict=True))).alias("s"))


def reads(spark: SparkSession, d: str) -> DataFrame:
    """sample, doc_id, i, read_id, seq, qual: every letter of every text, in reads of 18 to 36 bases by document; a text's last read may be shorter."""
    size = 18 + F.col("doc_id") % 19
    rid = F.concat_ws("_", "doc_id", F.concat(F.col("i"), F.lit("#x")))
    rows = sequences(spark, d).select("sample", "doc_id", F.posexplode(cut(F.col("s"), size)).alias("i", "seq"))
    return rows.select("sample", "doc_id", "i", rid.alias("read_id"), "seq", spelled(F.col("seq"), dict(zip(_BASES, _QUAL, strict=True))).alias("qual"))


def collapsed(spark: SparkSession, d: str) -> DataFrame:
    return reads(spark, d).groupBy("sample", "seq").agg(F.count("*").alias("n"))


def alignments(spark: SparkSession, d: str) -> DataFrame:
    """sample, read_id, strand, ref, pos, n, over lineitem."""
    return read(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("sample"), F.concat_ws("_", "l_orderkey").alias("read_id"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.col("l_suppkey").alias("ref"), F.col("l_partkey").cast("int").alias("pos"), F.col("l_quantity").cast("int").cast("long").alias("n"), F.col("l_linenumber").alias("k"),
    )


SEQS = f"""s AS (SELECT doc_id, source AS sample, translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{_ABC}', '{_DNA}') AS s FROM documents)"""
READS = f"""{SEQS}, reads AS (SELECT sample, doc_id, i, doc_id || '_' || i || '#x' AS read_id, substr(s, CAST(size * i + 1 AS BIGINT), size) AS seq,
  translate(substr(s, CAST(size * i + 1 AS BIGINT), size), '{_BASES}', '{_QUAL}') AS qual
  FROM (SELECT *, CAST(18 + doc_id % 19 AS BIGINT) AS size, unnest(range(0, (len(s) + 17 + doc_id % 19) // (18 + doc_id % 19))) AS i FROM s))"""
COLLAPSED = f"{READS}, c AS (SELECT sample, seq, count(*) AS n FROM reads GROUP BY 1, 2)"
ALN = "a AS (SELECT l_returnflag AS sample, CAST(l_orderkey AS VARCHAR) AS read_id, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, l_suppkey AS ref, CAST(l_partkey AS INT) AS pos, CAST(l_quantity AS BIGINT) AS n, l_linenumber AS k FROM lineitem)"


def ham(a: str, b: str) -> str:
    """SQL for unlike letters of two strings of one length."""
    return f"len(list_filter(range(1, len({a}) + 1), lambda h: substr({a}, h, 1) <> substr({b}, h, 1)))"
