"""Keyed upsert of per-sample quality facts: as a batch, and as the foreachBatch of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert_qc(target: DataFrame | None, batch: DataFrame, keys: list[str], time: list[str]) -> DataFrame:
    """The row of each key with the latest load time; percent strings become fractions."""
    for c, kind in batch.dtypes:
        if kind == "string" and c.startswith("pct_"):
            batch = batch.withColumn(c, F.regexp_replace(c, "%", "").cast("double") / 100)
    rows = batch if target is None else target.unionByName(batch)
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*time)).alias("__v")).select(*keys, "__v.*")


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Buckets by version, of versions that were written to their end."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, list[int]] = {}
    for done in fs.globStatus(hadoop.Path(f"{path}/v=*/_SUCCESS")) or []:
        found[int(done.getPath().getParent().getName().partition("=")[2])] = []
    for part in fs.globStatus(hadoop.Path(f"{path}/v=*/upsert_bucket=*")) or []:
        version = int(part.getPath().getParent().getName().partition("=")[2])
        if version in found:
            found[version].append(int(part.getPath().getName().partition("=")[2]))
    return found


def _newest(found: dict[int, list[int]], before: float) -> dict[int, int]:
    """The version of each bucket, of those under ``before``."""
    return {bucket: version for version in sorted(found) if version < before for bucket in found[version]}


def read_upserted(spark: SparkSession, path: str, before: float = float("inf")) -> DataFrame | None:
    """The table that ``upsert_stream`` keeps under ``path``: each bucket in its newest version; None if there is no version."""
    newest = _newest(_versions(spark, path), before)
    if not newest:
        return None
    parts = [f"{path}/v={version}/upsert_bucket={bucket}" for bucket, version in newest.items()]
    return spark.read.parquet(*parts)


def upsert_stream(stream: DataFrame, keys: list[str], time: list[str], path: str, checkpoint: str, buckets: int = 64):
    """Upserts a stream into the table under ``path``, which ``read_upserted`` reads. ``buckets`` must not change later.

    Keys are dealt to buckets by hash. A micro-batch reads and writes only the buckets that its keys fall into, as
    ``v=<batch>/upsert_bucket=<b>``; the others stay where they are. A batch starts from versions before its own, so one that runs
    twice writes the same rows, and a version counts once its _SUCCESS file is there. Folders that newer ones had replaced before
    the batch began go at its end: those it started from stay until the next, in case it runs again.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        dealt = batch.withColumn("upsert_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = {r[0] for r in dealt.select("upsert_bucket").distinct().collect()}  # at most ``buckets`` numbers
            found = _versions(spark, path)
            newest = _newest(found, epoch)
            parts = [f"{path}/v={v}/upsert_bucket={b}" for b, v in newest.items() if b in touched]
            old = spark.read.parquet(*parts) if parts else None
            rows = upsert_qc(old, dealt.drop("upsert_bucket"), keys, time).withColumn("upsert_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
            rows.repartition("upsert_bucket").write.mode("overwrite").partitionBy("upsert_bucket").parquet(f"{path}/v={epoch}")
        finally:
            dealt.unpersist()
        hadoop = spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for version, inside in found.items():
            stale = [b for b in inside if newest.get(b, version) > version]
            for b in stale:
                fs.delete(hadoop.Path(f"{path}/v={version}/upsert_bucket={b}"), True)
            if version < epoch and len(stale) == len(inside):
                fs.delete(hadoop.Path(f"{path}/v={version}"), True)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).start()
