"""Queries on sinks, matrices and upserts, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.plans.quant import LONG, longs
from strandloom.plans.views import SEQS, read, sequences
from strandloom.sources import readers, sinks
from strandloom.streaming.upsert import upsert_qc

_S = ["A", "N", "R"]

QUERIES = {
    "fastq_to_fasta": (lambda s, d: readers.fastq_to_fasta(sequences(s, d).select(F.col("doc_id").alias("read_id"), F.col("s").alias("seq"))), f"WITH {SEQS} SELECT '>' || doc_id || chr(10) || s AS value FROM s"),
    "split_fasta_n": (lambda s, d: sinks.split_fasta_n(sequences(s, d).select("doc_id"), ["doc_id"], n=7).join(sinks.split_fasta_n(sequences(s, d).select("doc_id"), ["doc_id"], k=30).withColumnRenamed("part", "part_k"), "doc_id"), "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) AS part, CAST(ceil(row_number() OVER (ORDER BY doc_id) / 30.0) AS BIGINT) AS part_k FROM documents"),
    "read_matrix_long": (lambda s, d: readers.melt(sinks.wide_matrix(longs(s, d), _S), "id"), "WITH {}, w AS (SELECT id, {} FROM lo GROUP BY 1) UNPIVOT w ON A, N, R INTO NAME sample VALUE value".format(LONG, ", ".join(f"coalesce(sum(value) FILTER (sample = '{x}'), 0)::DOUBLE AS \"{x}\"" for x in _S))),
    "merge_sample_files": (lambda s, d: readers.merge_sample_files([longs(s, d).where(f"sample = '{x}'") for x in _S]), f"WITH {LONG} SELECT id, sample, value FROM lo"),
    "upsert_qc": (lambda s, d: upsert_qc(read(s, d, "events").where("event_id % 2 = 0").select("user_id", "event_type", "event_id", "value"), read(s, d, "events").where("event_id % 2 = 1").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], ["event_id"]), "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2"),
    "shard_by_taxon": (lambda s, d: sinks.shard_by_taxon(read(s, d, "part").select(F.concat(F.lower(F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))), F.lit("-"), F.col("p_partkey")).alias("id"), F.col("p_name").alias("seq")), s.createDataFrame([("standard", "plant"), ("small", "animal")], "prefix string, taxon string"), True).select("id", "taxon", "seq"), "SELECT lower(split_part(p_type, ' ', 1)) || '-' || p_partkey AS id, CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'plant' WHEN 'SMALL' THEN 'animal' ELSE 'all' END AS taxon, 'XX' || p_name || 'XX' AS seq FROM part"),
}
