"""Stage tables: where one step hands its rows to the next.

Stages live in the shared folder the cluster names in spark.checkpoint.dir, so
a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: list[str] = []


def workspace(spark: SparkSession) -> str:
    """Shared scratch folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/slotwise"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="slotwise-"))
    return _local_root[0]


def new_stage(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage_sink(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> str:
    """Write a stage as Parquet; an empty table still leaves its schema."""
    writer = df.write.mode(mode)
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    return path


def read_stage(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def staged(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write df as a new stage and read it back: cuts lineage, keeps column pruning. Eager.

    With `partition`, rows are rebalanced on that column first: small values
    share a file, a hot value is split over several.
    """
    spark = df.sparkSession
    rows = df.hint("rebalance", partition) if partition else df
    path = stage_sink(rows, new_stage(spark, name), partition)
    return read_stage(spark, path, df.schema).select(*df.columns)
