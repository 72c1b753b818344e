"""A lossless text of any value, for digests that tell all contents apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL = "~"


def canonical(value: Column, data_type: T.DataType) -> Column:
    """Two values of one type have the same text if and only if they are the same.

    Texts carry their length, so no value can look like the end of another;
    nulls have a mark of their own; times keep their microseconds, in UTC;
    floats keep every digit, NaN and the sign of zero; entries of a map are
    sorted by their key.
    """
    if isinstance(data_type, T.StructType):
        parts = [canonical(value[f.name], f.dataType) for f in data_type]
        text = F.concat(F.lit("("), *[x for p in parts for x in (p, F.lit(";"))], F.lit(")"))
    elif isinstance(data_type, T.ArrayType):
        items = F.transform(value, lambda v: canonical(v, data_type.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    elif isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.concat(canonical(e["key"], data_type.keyType), F.lit("="), canonical(e["value"], data_type.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(F.array_sort(entries), ","), F.lit("}"))
    elif isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        text = F.concat(F.length(value).cast("string"), F.lit(":"), value)
    elif isinstance(data_type, T.BinaryType):
        text = F.hex(value)
    elif isinstance(data_type, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        text = value.cast("string")  # the shortest text that reads back as the same float
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(_NULL))


def digest(value: Column, data_type: T.DataType) -> Column:
    """SHA-256 of :func:`canonical`."""
    return F.sha2(canonical(value, data_type), 256)
