"""Published forecast table: schema and rolling overwrite."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.sources.stages import new_stage, read_stage, stage_sink


def _fields() -> list[tuple[str, str]]:
    impact = "decimal(5,4)"
    cols = [
        ("ref_date", "date"), ("slot", "int"), ("program_id", "int"), ("channel_id", "int"),
        ("sl_pred", "decimal(5,4)"), ("vol_plan", "int"), ("hc_plan", "int"), ("aht_plan_avg", "decimal(10,2)"),
        ("sl_lag_1", "decimal(5,4)"), ("avg_wait_lag_1", "decimal(10,4)"), ("vol_dev_pct_lag_1", "decimal(10,4)"),
        ("impact_volume", impact), ("impact_people", impact), ("impact_handle_time", impact),
        ("impact_health", impact), ("impact_context", impact),
    ]
    for side in ("detractor", "booster"):
        for i in (1, 2, 3):
            cols += [(f"{side}_{i}_name", "string"), (f"{side}_{i}_pillar", "string"), (f"{side}_{i}_impact", impact)]
    return [*cols, ("updated_at", "timestamp")]


FACT_FIELDS = _fields()
FACT_COLUMNS = [n for n, _ in FACT_FIELDS]


def fact_ddl() -> str:
    return ", ".join(f"{n} {t}" for n, t in FACT_FIELDS)


def fact_schema(df: DataFrame, updated_at: dt.datetime | None = None) -> DataFrame:
    """Cast scored rows to the published types; a value that does not fit is an error."""
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at)
    df = df.withColumn("updated_at", stamp)
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in FACT_FIELDS])


def min_slot_per_date(batch: DataFrame, scope: str = "date") -> DataFrame:
    keys = ["ref_date"] if scope == "date" else ["ref_date", "program_id"]
    return batch.groupBy(*keys).agg(F.min("slot").alias("min_slot"))


def stale_anti(existing: DataFrame, batch: DataFrame, scope: str = "date") -> DataFrame:
    """Existing rows the batch does not replace.

    A batch replaces, on each of its dates, everything from its first slot on:
    all programs and channels by default, only its own programs with
    scope='program'.
    """
    mins = min_slot_per_date(batch, scope)
    keys = [c for c in mins.columns if c != "min_slot"]
    joined = existing.join(mins, keys, "left")
    return joined.where(F.col("min_slot").isNull() | (F.col("slot") < F.col("min_slot"))).select(*existing.columns)


def rolling_overwrite(existing: DataFrame, batch: DataFrame, scope: str = "date") -> DataFrame:
    return stale_anti(existing, batch, scope).unionByName(batch.select(*existing.columns))


#: Attempts to publish on top of the newest version.
ATTEMPTS = 10


def _manifests(spark: SparkSession, path: str):
    """(folder of the manifests as a Hadoop path, its file system)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions of a table, oldest first; none for a table that does not exist."""
    folder, fs = _manifests(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    """Folder of each date of a version, the newest by default. One entry for each date of the table."""
    known = versions(spark, path)
    if not known or version == 0:
        return {}
    rows = spark.read.schema("ref_date string, folder string").json(f"{path}/_manifests/{version or known[-1]}.json")
    return {r["ref_date"]: f"{path}/{r['folder']}" for r in rows.collect()}


def commit(spark: SparkSession, path: str, version: int, folders: dict[str, str]) -> bool:
    """Make a version visible; False if another writer already made one of that number.

    The manifest is written aside and renamed, which fails if its name is taken: readers see all of it or nothing.
    """
    jvm, (folder, fs) = spark._jvm, _manifests(spark, path)
    fs.mkdirs(folder)
    lines = [json.dumps({"ref_date": d, "folder": f.removeprefix(f"{path}/")}) for d, f in sorted(folders.items())]
    aside = jvm.org.apache.hadoop.fs.Path(folder, f".{version}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(folder, f"{version}.json"), no_options)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    return True


def publish(spark: SparkSession, path: str, batch: DataFrame, scope: str = "date") -> int:
    """Apply a batch to the stored table in one version, and return its number. Applying it twice equals applying it once.

    The new content of the batch's dates goes into a folder of its own, which no version names yet. One manifest then gives
    the folder of every date, so a reader has the table before the batch or after it, never between. A version is based on
    the one before it: of two writers with the same base one commits, the other starts again from the new version.
    """
    batch_path = stage_sink(batch, new_stage(spark, "batch"), None)
    batch = read_stage(spark, batch_path, batch.schema)
    dates = [str(r["ref_date"]) for r in batch.select("ref_date").distinct().collect()]
    for _ in range(ATTEMPTS):
        base = max(versions(spark, path), default=0)
        folders = manifest(spark, path, base)
        touched = [folders[d] for d in dates if d in folders]
        merged = rolling_overwrite(spark.read.schema(batch.schema).parquet(*touched), batch, scope) if touched else batch
        folder = f"{path}/data/{uuid.uuid4().hex}"
        (
            merged.select(*batch.columns).withColumn("day", F.date_format("ref_date", "yyyy-MM-dd"))
            .hint("rebalance", "day")
            .sortWithinPartitions("day", "program_id", "channel_id", "slot")
            .write.partitionBy("day")
            .parquet(folder)
        )
        if commit(spark, path, base + 1, folders | {d: f"{folder}/day={d}" for d in dates}):
            return base + 1
    raise RuntimeError(f"{path}: other writers were first {ATTEMPTS} times")


def read_forecast(spark: SparkSession, path: str, schema, version: int | None = None) -> DataFrame:
    """A published version, the newest by default. Rows are read from the folders its manifest names."""
    folders = manifest(spark, path, version)
    return spark.read.schema(schema).parquet(*folders.values()) if folders else spark.createDataFrame([], schema)
