"""Final projection of an extract: the text forms the CSV files carry.

Dates become ``yyyy-MM-dd`` text and datetimes ``yyyy-MM-dd HH:mm:ss``
text, the formats the loaders parse; integer columns are widened to
BIGINT. Column names and order are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timewin import fmt_iso_day, fmt_iso_ts

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def export_view(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = fmt_iso_day(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = fmt_iso_ts(c)
        elif isinstance(f.dataType, _INTEGRAL):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
