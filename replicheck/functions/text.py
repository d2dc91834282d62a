"""A row's text and checksum, the same on every engine that follows these rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck.spec import Refused

SEPARATOR = "#"
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def canonical(
    name: str, dtype: T.DataType, decimal: tuple[int, int] | None = None, fraction: int = 6
) -> Column:
    """Text of one column. Floating point is refused unless a decimal type is given for it."""
    c = F.col(name)
    if decimal is not None:
        dtype = T.DecimalType(*decimal)
        c = c.cast(dtype)
    if isinstance(dtype, T.DecimalType):
        # Beyond six fraction digits a cast may print an exponent.
        if dtype.scale <= 6:
            return c.cast("string")
        return F.call_function("format_number", c, F.lit("0." + "0" * dtype.scale))
    if isinstance(dtype, (*_PLAIN, T.DateType, T.StringType, T.BinaryType)):
        return c.cast("string")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        digits = "." + "S" * fraction if fraction else ""
        return F.date_format(c, f"yyyy-MM-dd HH:mm:ss{digits}")
    hint = " (give a decimal type for it)" if isinstance(dtype, T.FractionalType) else ""
    raise Refused(f"column {name} of type {dtype.simpleString()} has no fixed text{hint}")


def null_flags(columns: Sequence[str]) -> Column:
    """One '1' or '0' per nullable column, or '1' where there is none."""
    if not columns:
        return F.lit("1")
    return F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])


def row_text(
    schema: T.StructType,
    columns: Sequence[str],
    nullable: Sequence[str],
    decimals: Mapping[str, tuple[int, int]] | None = None,
    fraction_digits: Mapping[str, int] | None = None,
) -> Column:
    """Columns joined by '#', NULLs left out, followed by the NULL flags.

    Fields are not escaped: ('a#b','c') and ('a','b#c') have the same text.
    """
    texts = [
        canonical(
            c, schema[c].dataType, (decimals or {}).get(c), (fraction_digits or {}).get(c, 6)
        )
        for c in columns
    ]
    flagged = [c for c in columns if c in set(nullable)]
    return F.concat_ws(SEPARATOR, *texts, null_flags(flagged))


def typed_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash of the typed columns and their NULL flags instead of a text's CRC."""
    return F.xxhash64(*[F.col(c) for c in columns], null_flags(columns))


def text_crc(text: Column) -> Column:
    """CRC32 of the text's bytes, as an unsigned number in a BIGINT."""
    return F.crc32(text.cast("binary"))


def crc_hex(fold: Column) -> Column:
    """Lower-case hex without padding; nothing folded is '0'."""
    return F.lower(F.hex(F.coalesce(fold, F.lit(0).cast("bigint"))))
