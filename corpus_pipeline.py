"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

toxicity drops what the classifier rejects; minhash keeps one document of each near-duplicate group; substring cuts
passages that repeat; decontamination drops what holds a benchmark item; packing returns the pieces of the rest.

All stages but the last return the columns of the documents, whatever else they hold and however their columns are named. Null
and empty texts are clean: they link with nothing, lose nothing and become pieces of one end mark. Repeated rows are copies: one
of those with equal id and text stays. Ties go to the least doc_id. An empty table gives no pieces. A very long text is held
whole by one task of each stage (see textarrays). What a stage wrote for itself is deleted when its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandloom.functions.scratch import result, scope
from strandloom.llm import decontaminate, minhash, packing, substring, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("minhash near-dedup", minhash.stage),
    ("substring dedup", substring.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("best-fit packing", packing.stage),
]

#: No SQL expresses a trained classifier or a genetic algorithm; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scope(spark):
        for name, stage in STAGES[:-1]:
            with scope(spark):
                docs = result(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        name, stage = STAGES[-1]
        return result(stage(spark, docs, sf_dir), name.replace(" ", "-"))
