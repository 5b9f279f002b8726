"""Result types that read the same in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as longs, dates as ISO text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd").alias(field.name)
        columns.append(column)
    return df.select(*columns)
