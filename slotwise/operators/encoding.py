"""Smoothed target encoding of the program."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators.columns import with_program_facts

SMOOTHING = 30


def target_encoding_fit(df: DataFrame, target: str = "sl_actual", smoothing: int = SMOOTHING) -> DataFrame:
    """(program_id, enc, global_mean, n): n/(n+s) of the program mean, the rest global mean."""
    per_program = df.groupBy("program_id").agg(
        F.avg(target).alias("program_mean"), F.sum(F.col(target).cast("double")).alias("total"), F.count(target).alias("n")
    )
    weight = F.col("n") / (F.col("n") + smoothing)
    overall = per_program.agg(F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).scalar()  # from the same exchange
    return per_program.withColumn("global_mean", overall).select(
        "program_id",
        (weight * F.col("program_mean") + (1 - weight) * F.col("global_mean")).alias("enc"),
        "global_mean",
        "n",
    )


def encoding_lookup(df: DataFrame, encoding: DataFrame, default: float = 0.5, many: bool = False) -> DataFrame:
    """Program -> encoding; unseen programs get the stored global mean, else 0.5. `many`: see with_program_facts."""
    fallback = F.coalesce(encoding.agg(F.max("global_mean")).scalar(), F.lit(default))
    joined = with_program_facts(df.drop("program_enc"), encoding.select("program_id", "enc"), many)
    return joined.withColumn("program_enc", F.coalesce(F.col("enc"), fallback)).drop("enc")


def encoding_override(df: DataFrame, stored: DataFrame, tolerance: float = 1e-6, many: bool = False) -> DataFrame:
    """The stored per-program value wins; enc_mismatch marks rows it changed."""
    joined = with_program_facts(df, stored.select("program_id", F.col("enc").alias("_enc")), many)
    return joined.withColumns(
        {
            "enc_mismatch": F.coalesce(F.abs(F.col("program_enc") - F.col("_enc")) > tolerance, F.lit(False)),
            "program_enc": F.coalesce(F.col("_enc"), F.col("program_enc")),
        }
    ).drop("_enc")
