"""Plain values for consumers of the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(name: str, data_type: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(data_type, T.DecimalType):
        return c.cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(data_type, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(data_type, T.BinaryType):
        return F.decode(c, "UTF-8")
    return c


def normalise(table: DataFrame) -> DataFrame:
    """Decimals as doubles, times and dates as ISO text, bytes as UTF-8 text."""
    return table.select([_plain(f.name, f.dataType).alias(f.name) for f in table.schema])
