"""Schema-level operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType
from pyspark.sql import types as T


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail early, by name, when a feature or target column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def available_features(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """Expected inputs in model order, split into present and missing."""
    have = set(df.columns)
    return [c for c in expected if c in have], [c for c in expected if c not in have]


def ensure_columns(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> DataFrame:
    """Absent columns appear with the default; present ones lose their nulls."""
    have = set(df.columns)
    fill = F.lit(default)
    return df.withColumns({c: F.coalesce(F.col(c), fill) if c in have else fill for c in cols})


def fill_numeric(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Null -> value in every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)) for c in numeric})


def result_projection(df: DataFrame, renames: Mapping[str, str], wanted: Sequence[str]) -> DataFrame:
    """Rename, then keep the wanted columns that exist, in the wanted order."""
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    return df.select(*[c for c in wanted if c in df.columns])


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (empty when the grain holds)."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


#: Programs whose facts travel as one map; a lookup in it takes time in proportion.
MAP_PROGRAMS = 1_000
#: Parts that the rows of a program are dealt to where facts are joined.
SALTS = 16


def with_program_facts(df: DataFrame, facts: DataFrame, many: bool = False, key: str = "program_id") -> DataFrame:
    """df with the columns of `facts` (one row for each program), null for programs without.

    The facts become one map, a scalar subquery computed once, and each row looks its program up: the rows are not
    exchanged. A map of more than MAP_PROGRAMS programs is an error that asks for `many`, which joins on program and a salt
    instead, so that a program's rows are spread over SALTS tasks.
    """
    names = [c for c in facts.columns if c != key]
    if many:
        salted = facts.select(F.col(key).alias("_key"), *names, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
        atomic = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
        rows = df.withColumn("_salt", F.pmod(F.xxhash64(*atomic), F.lit(SALTS)).cast("int"))
        same = (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_part"))
        return rows.join(salted, same, "left").drop("_salt", "_key", "_part")
    pairs = F.collect_list(F.struct(F.col(key), F.struct(*names)))
    too_many = F.raise_error(F.lit(f"more than {MAP_PROGRAMS} programs: pass many=True"))
    entries = F.when(F.count(F.lit(1)) > MAP_PROGRAMS, too_many).otherwise(pairs)
    table = facts.where(F.col(key).isNotNull()).agg(F.map_from_entries(entries).alias("facts")).scalar()
    found = F.try_element_at(table, F.col(key))
    return df.withColumn("_facts", found).select(*[f"`{c}`" for c in df.columns], *[F.col(f"_facts.{c}").alias(c) for c in names])
