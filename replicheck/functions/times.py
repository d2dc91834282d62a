"""The time column as a number that orders rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text form of a time.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def time_value(name: str, dtype: T.DataType, time_format: str) -> Column:
    """Epoch seconds in the session's time zone, or the integer itself. NULL where the value
    does not read as the declared format, or has a fraction of a second."""
    c = F.col(name)
    if time_format == "int":
        number = c.try_cast("bigint")
        if isinstance(dtype, T.FractionalType):
            return F.when(number == c, number)
        return number
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_trunc("second", c) == c
        return F.when(whole, F.unix_timestamp(c))
    return F.unix_timestamp(F.try_to_timestamp(c.cast("string"), F.lit(TIME_PATTERN)))


def bad_time(name: str, dtype: T.DataType, time_format: str) -> Column:
    return time_value(name, dtype, time_format).isNull()
