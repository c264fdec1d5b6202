"""The table of checks: name -> (Spark query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.sqltext import with_ctes

# Sums of doubles differ in the last bit with their order. A value that ends in
# exactly half a unit of the sixth digit (0.6796875) would then round either way,
# so both sides move such values off the boundary before rounding.
TIE_BREAK = 1.7e-9

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Comparable output types: dates and timestamps as text, decimals and doubles rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(TIE_BREAK), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def _typed(select: str, columns: dict[str, str]) -> str:
    """Give every output column the type of its Spark twin."""
    cast = {
        "date": "strftime({c}, '%Y-%m-%d')",
        "timestamp": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
        "double": f"round(cast({{c}} AS double) + {TIE_BREAK!r}, 6) + 0.0",
        "bigint": "cast({c} AS bigint)",
        "string": "cast({c} AS varchar)",
        "boolean": "cast({c} AS boolean)",
    }
    cols = ", ".join(f"{cast[t].format(c=n)} AS {n}" for n, t in columns.items())
    return f"SELECT {cols} FROM (\n{select.strip()}\n) AS result"


def columns(spec: str) -> dict[str, str]:
    """'a b:double c:date' -> names with types; the type carries on until the next one."""
    out, pending = {}, []
    for token in spec.split():
        name, _, kind = token.partition(":")
        pending.append(name)
        if kind:
            out.update({n: kind for n in pending})
            pending = []
    if pending:
        raise ValueError(f"untyped columns: {pending}")
    return out


def check(name: str, spec: str | None = None, needs: list[str] | None = None, sql: str | None = None):
    """Register a query; with `sql`, also the statement it must agree with.

    `spec` lists the output columns and their types for both sides.
    """

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        cols = columns(spec) if spec else None

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return present(df.select(*cols) if cols else df)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            if cols is None:
                raise ValueError(f"{name}: SQL needs a column spec")
            ORACLES[name] = with_ctes(needs or [], _typed(sql, cols))
        return fn

    return register
