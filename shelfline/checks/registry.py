"""Registration of queries and their comparison SQL."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES = {}
ORACLES = {}


def comparable(df):
    """Plain types for comparison: decimals as double, dates as ISO text, whole numbers as bigint."""

    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("long").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])


def query(name, sql=None):
    """Register a query function (spark, sf_dir) -> DataFrame under a name."""

    def register(function):
        QUERIES[name] = lambda spark, sf_dir: comparable(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
