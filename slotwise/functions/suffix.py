"""Run suffixes such as '7d' or '20240114_030000_7d'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.numbers import col

# Prefixes of report files, forms of a run's name, and its readable titles.
PREFIXES = r"^(metrics_|metricas_|benchmark_)"
DAYS_AT_END = r"_(\d+)d$"
DAYS_ONLY = r"^(\d+)d$"
STARTED = r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})_.*$"
DATED = r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(?:\d{2})?_(\d+)d$"
DATED_TITLE = "Benchmark de $6 dias - $1-$2-$3 $4:$5"
DAYS_TITLE = "Benchmark de $1 dias"


def strip_prefix(file_name: str | Column) -> Column:
    """File name without extension and without its report prefix."""
    stem = F.regexp_replace(col(file_name), r"\.[^.]*$", "")
    return F.regexp_replace(stem, PREFIXES, "")


def days(suffix: str | Column) -> Column:
    """Evaluated days: the trailing '_<n>d', or a bare '<n>d'; else 0."""
    s = col(suffix)
    tail, bare = F.regexp_extract(s, DAYS_AT_END, 1), F.regexp_extract(s, DAYS_ONLY, 1)
    return F.when(tail != "", tail).when(bare != "", bare).otherwise("0").cast("int")


def timestamp_text(suffix: str | Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' from a leading yyyyMMdd_HHmmss_, else ''."""
    s = col(suffix)
    return F.when(s.rlike(STARTED), F.regexp_replace(s, STARTED, "$1-$2-$3 $4:$5:$6")).otherwise("")


def title(suffix: str | Column) -> Column:
    """Readable run title; an unknown form is its own title."""
    s = col(suffix)
    return (
        F.when(s.rlike(DATED), F.regexp_replace(s, DATED, DATED_TITLE))
        .when(s.rlike(DAYS_ONLY), F.regexp_replace(s, DAYS_ONLY, DAYS_TITLE))
        .otherwise(s)
    )
