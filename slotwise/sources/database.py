"""Named SQL texts and database tables as sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from configparser import ConfigParser

from pyspark.sql import DataFrame, SparkSession


def load_queries(path: str) -> dict[str, str]:
    """Section name -> SQL text of its 'query' entry."""
    parser = ConfigParser(interpolation=None)
    if not parser.read(path, encoding="utf-8"):
        raise FileNotFoundError(path)
    return {section: parser.get(section, "query").strip() for section in parser.sections()}


def run_query(spark: SparkSession, text: str, args: Mapping[str, object], **tables: DataFrame) -> DataFrame:
    """Run a named query: values are bound as parameters, tables as DataFrames."""
    return spark.sql(text, args=dict(args), **tables)


def day_predicates(date_col: str, first: dt.date, last: dt.date, days: int = 1) -> list[str]:
    """Disjoint date ranges covering first..last, one database partition each."""
    out, start = [], first
    while start <= last:
        stop = min(start + dt.timedelta(days=days), last + dt.timedelta(days=1))
        out.append(f"{date_col} >= '{start.isoformat()}' AND {date_col} < '{stop.isoformat()}'")
        start = stop
    return out


def jdbc_scan(
    spark: SparkSession, url: str, table: str, date_col: str, first: dt.date, last: dt.date, days: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a date window of a database table, one range of days per task."""
    return spark.read.jdbc(
        url, table, predicates=day_predicates(date_col, first, last, days), properties=dict(properties or {})
    )
