"""Registry of named queries and the SQL text that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.functions.dates import add_months
from braidlake.sources import lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Run month of the registered queries; the orders span 1995-01 to 2001-08.
RUN = dt.date(2000, 6, 1)
ANCHORS = [RUN, add_months(RUN, -1), add_months(RUN, -2)]
NOW_TEXT = "2000-06-15 12:00:00"


class Tables:
    """Lazy access to the sample tables: ``t.orders`` reads <dir>/orders.parquet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        # Kept on the object, so that a query sees one frame per table.
        frame = self.__dict__[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return frame


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: decimals as double, dates and times as text."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType | T.FloatType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.IntegerType | T.ShortType | T.BooleanType):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            col = col.cast("string")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its SQL twin if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        def run(spark: SparkSession, root: str) -> DataFrame:
            if not spark.conf.get("spark.checkpoint.dir", None):
                # Sample runs without a shared folder stage in the warehouse, which is shared too.
                spark.conf.set(lake.STAGING_KEY, f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged")
            return portable(fn(Tables(spark, root)))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def now() -> Column:
    """Fixed load time, so that stamps are the same on every run."""
    return F.lit(NOW_TEXT).cast("timestamp_ntz")


def money(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("decimal(18,2)")


def day(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("date")


# SQL fragments shared by the twins.
def sql_money(col: str) -> str:
    return f"CAST({col} AS DECIMAL(18,2))"


def sql_month(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def sql_ratio(top: str, bottom: str, factor: int = 1) -> str:
    """factor * top / bottom rounded half up to two decimals, exactly; both in the same unit."""
    a = f"(CAST({top} AS HUGEINT) * {factor * 100})"
    b = f"nullif(CAST({bottom} AS HUGEINT), 0)"
    return f"(CAST(sign({a}) * ((2 * abs({a}) + {b}) // (2 * {b})) AS DOUBLE) / 100)"


def sql_fingerprint(cols, upper: bool = False) -> str:
    """The md5 of ``keys.fingerprint``: columns as text one after the other, NULL as ''."""
    text = " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"md5(upper({text}))" if upper else f"md5({text})"
