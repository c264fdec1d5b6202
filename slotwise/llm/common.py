"""What several corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from slotwise.sources.stages import new_stage, staged  # noqa: F401

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that a task holds as Python objects at a time.
SLICE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(text, F.lit(""))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back; eager, cuts lineage."""
    return staged(df, f"llm-{name}")


def parts(spark: SparkSession, amount: float, each: float) -> int:
    """Partitions for an amount of work: enough for the cluster's setting, and none above `each`."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((amount or 0) / each), 1)


def text_hash(text: Column) -> Column:
    return F.sha2(whole(text), 256)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows that `gone` names by doc_id and, if it has that column, text_sha256; all columns stay."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_hash(F.col("text")).alias("hash"))
    named = "text_sha256" in gone.columns
    keys = gone.select(F.col("doc_id").alias("gone_id"), *[F.col("text_sha256").alias("gone_hash")] * named)
    same = F.col("id").eqNullSafe(F.col("gone_id"))
    return rows.join(keys, same & (F.col("hash") == F.col("gone_hash")) if named else same, "left_anti").select("row.*")


def with_made(df: DataFrame, read: str, made: pa.Schema, worker: Callable[[], Callable]) -> DataFrame:
    """df with the columns `made`, which worker()(value of column `read`) returns as a tuple; other columns pass as they are."""
    schema = StructType([*df.schema.fields, *from_arrow_schema(made).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = worker()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = [of(x.as_py()) for x in part.column(read)]
                new = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)
