"""Small stores: program names, encodings, metric documents, attributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions import suffix as sfx
from slotwise.sources.stages import read_stage, stage_sink

METRIC = (
    "n_rows bigint, sl_actual_mean double, sl_pred_mean double, sl_plan_mean double, "
    "mae_model double, rmse_model double, r2_model double, mae_plan double, rmse_plan double, r2_plan double, "
    "uplift_mae_pct double"
)
METRIC_COLUMNS = [c.split()[0] for c in METRIC.split(", ")]
#: What a program's metrics hold on top: its mean pillar impacts.
PROGRAM_METRIC = METRIC + "".join(f", {c} double" for c in catalog.PILLAR_COLUMNS)
DOC_SCHEMA = (
    f"overall struct<{METRIC.replace(' ', ':').replace(',:', ',')}>, "
    f"by_program map<string,struct<{PROGRAM_METRIC.replace(' ', ':').replace(',:', ',')}>>, "
    "metadata struct<executed_at:string,days:int,suffix:string>, _corrupt_record string"
)


def program_dim(spark: SparkSession, path: str) -> DataFrame:
    """Header-less 'code;name' file: trimmed, blanks dropped, the last duplicate wins.

    A missing file is an empty dimension.
    """
    try:
        lines = spark.read.csv(path, sep=";", schema="code string, name string", header=False)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "code string, name string")
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    rows = lines.select(F.trim("code").alias("code"), F.trim("name").alias("name"), place.alias("place"))
    rows = rows.where((F.col("code") != "") & (F.col("name") != ""))
    return rows.groupBy("code").agg(F.max_by("name", "place").alias("name"))


def with_program_name(df: DataFrame, names: DataFrame) -> DataFrame:
    joined = df.join(
        names.select(F.col("code").alias("_code"), F.col("name").alias("program_name")),
        F.col("program_id").cast("string") == F.col("_code"),
        "left",
    )
    return joined.withColumn("program_name", F.coalesce("program_name", F.lit(""))).drop("_code")


def save_encoding(encoding: DataFrame, path: str) -> str:
    return stage_sink(encoding.select("program_id", "enc", "global_mean", "n"), path)


# Fixed value: the time of a run whose document and name have none.
UNKNOWN_TIME = "desconhecida"

# Names in the JSON documents of a program's encoding, and of the mean in the document for all programs.
ENCODING_NAMES = {"program_id": "programa", "enc": "encoding", "global_mean": "media_global", "n": "n_amostras"}
GLOBAL_MEAN_NAME = "__media_global__"


def save_encoding_documents(encoding: DataFrame, path: str) -> str:
    """One JSON document per program, each in a folder named after it."""
    body = F.to_json(F.struct(*[F.col(c).alias(name) for c, name in ENCODING_NAMES.items()]))
    encoding.select(F.concat(F.lit("target_encoding_"), F.col("program_id")).alias("document"), body.alias("value")).write.mode(
        "overwrite").partitionBy("document").text(path)
    return path


def load_encoding_documents(spark: SparkSession, path: str) -> DataFrame:
    """Encodings from the programs' documents under a folder; the mean of the last one, by name, holds for all."""
    schema = "programa int, encoding double, media_global double, n_amostras bigint"
    docs = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    docs = docs.where("programa IS NOT NULL").withColumn("_path", F.col("_metadata.file_path"))
    last = docs.agg(F.max_by("media_global", F.struct(F.col("media_global").isNotNull(), "_path"))).scalar()
    return docs.select(
        F.col("programa").alias("program_id"), F.col("encoding").alias("enc"), last.alias("global_mean"), F.col("n_amostras").alias("n")
    )


def load_global_encoding_document(spark: SparkSession, path: str, default: float = 0.5) -> DataFrame:
    """Encodings from the one document that maps programs to values and names the mean."""
    values = F.from_json("value", "map<string, double>")
    doc = spark.read.option("wholetext", True).text(path).select(values.alias("m"))
    rows = doc.select(F.try_element_at("m", F.lit(GLOBAL_MEAN_NAME)).alias("mean"), F.explode("m").alias("k", "enc"))
    return rows.where(F.col("k") != GLOBAL_MEAN_NAME).select(
        F.col("k").cast("int").alias("program_id"), "enc", F.coalesce("mean", F.lit(default)).alias("global_mean"), F.lit(None).cast("bigint").alias("n")
    )


def load_encoding(spark: SparkSession, per_program_path: str | None, global_path: str | None = None) -> DataFrame:
    """Stored encodings: the per-program store if it exists, else the global one, else empty."""
    schema = "program_id int, enc double, global_mean double, n bigint"
    for path in (per_program_path, global_path):
        if path is None:
            continue
        try:
            return read_stage(spark, path, schema)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return spark.createDataFrame([], schema)


def metric_documents(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """One JSON document per run from global (is_total) and per-program metric rows.

    Programs carry their mean pillar impacts if the rows have them.
    """
    body = F.struct(*METRIC_COLUMNS)
    own = F.struct(*METRIC_COLUMNS, *[c for c in catalog.PILLAR_COLUMNS if c in metrics.columns])
    docs = metrics.groupBy("suffix").agg(
        F.max(F.when(F.col("is_total") == 1, body)).alias("overall"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("is_total") == 0, F.struct(F.col("program_id").cast("string"), own)))
        ).alias("by_program"),
    )
    meta = F.struct(
        F.date_format(F.col("as_of").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("executed_at"), "days", "suffix"
    )
    return docs.join(runs.select("suffix", "as_of", "days"), "suffix").select(
        "suffix", F.to_json(F.struct("overall", "by_program", meta.alias("metadata"))).alias("value")
    )


def metrics_sink(documents: DataFrame, path: str) -> str:
    documents.write.mode("overwrite").partitionBy("suffix").text(path)
    return path


def scan_metric_docs(spark: SparkSession, path: str) -> DataFrame:
    """All metric documents under a path or glob; corrupt ones are skipped.

    Metadata missing from the document is taken from its file or folder name.
    """
    docs = (
        spark.read.schema(DOC_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("_path", F.col("_metadata.file_path"))
    )
    named = F.regexp_extract("_path", r"suffix=([^/]+)/", 1)
    named = F.when(named != "", named).otherwise(sfx.strip_prefix(F.regexp_extract("_path", r"([^/]+)$", 1)))
    docs = docs.where(F.col("_corrupt_record").isNull()).withColumn(
        "suffix", F.coalesce(F.col("metadata.suffix"), named)
    )
    return docs.select(
        "suffix",
        F.coalesce(
            F.nullif(F.col("metadata.executed_at"), F.lit("")),
            F.nullif(sfx.timestamp_text("suffix"), F.lit("")),
            F.lit(UNKNOWN_TIME),
        ).alias("executed_at"),
        F.coalesce(F.col("metadata.days"), sfx.days("suffix")).alias("days"),
        "overall",
        "by_program",
    )


def scan_run_rows(spark: SparkSession, path: str, suffix: str, schema=None) -> DataFrame:
    """Rows of one run: a partition filter. Unknown runs give an empty table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(F.col("suffix") == suffix)


def save_attributions(df: DataFrame, path: str, contribs: str = "contribs", target_transform: bool = True) -> str:
    """Matrix form: one impact array per row, with names, base value and whether the model works on the transformed target."""
    c = F.col(contribs)
    return stage_sink(
        df.select(
            "program_id",
            "row_num",
            F.transform(c, lambda x: x["feature"]).alias("features"),
            F.transform(c, lambda x: x["impact"]).alias("impacts"),
            "base_value",
            F.lit(bool(target_transform)).alias("target_transform"),
        ),
        path,
    )


def load_attributions(spark: SparkSession, path: str, program_id: int | None = None) -> DataFrame:
    df = read_stage(spark, path)
    return df if program_id is None else df.where(F.col("program_id") == program_id)
