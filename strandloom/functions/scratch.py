"""Tables that cut lineage, in the folder the cluster shares: ``spark.checkpoint.dir``.

Where that is unset a session on one machine (master ``local``, as in tests) gets a temporary folder; any other is refused.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
#: The scopes around what runs now, of this thread (or context) alone: queries in other threads have their own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-strandloom-"))
    return _LOCAL[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path; the innermost ``scope`` deletes it at its end."""
    path = f"{shared_dir(spark)}/strandloom/{name}-{uuid.uuid4().hex}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def result(df: DataFrame, name: str) -> DataFrame:
    """A table that outlives the innermost scope (and goes with the one around it, if there is one)."""
    token = _SCOPES.set(_SCOPES.get()[:-1])
    try:
        return table(df, name)
    finally:
        _SCOPES.reset(token)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables made inside at its end; what is returned must rest on ``result`` tables or given data only."""
    mine: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), mine))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in mine:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
