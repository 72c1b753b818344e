"""Simple and value-with-unit types, and the columns they become."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The simple types of the source models, by Spark type.
STRING_TYPES = """
    string normalizedString token language NMTOKEN NMTOKENS Name NCName ID IDREF IDREFS ENTITY ENTITIES
    duration hexBinary base64Binary anyURI QName NOTATION NilReasonType NilReasonEnumeration SignType
    booleanOrNilReason doubleOrNilReason integerOrNilReason NameOrNilReason stringOrNilReason
    UomIdentifier UomSymbol UomURI UnitOfMeasureType
    booleanList doubleList integerList NameList NCNameList QNameList doubleBetween0and1List
    booleanOrNilReasonList NameOrNilReasonList doubleOrNilReasonList integerOrNilReasonList
    TransformationMatrix4x4Type TransformationMatrix2x2Type TransformationMatrix3x4Type
"""
BOOLEAN_TYPES = "boolean"
DOUBLE_TYPES = "decimal float double doubleBetween0and1"
TIMESTAMP_TYPES = "dateTime time date"
DATE_TYPES = "gYear gYearMonth gMonth gMonthDay gDay"
INTEGER_TYPES = """
    integer nonPositiveInteger long int short byte nonNegativeInteger unsignedLong unsignedInt
    unsignedShort unsignedByte positiveInteger integerBetween0and4
"""

SPARK_TYPE = {
    name: spark_type
    for names, spark_type in [
        (STRING_TYPES, "string"),
        (BOOLEAN_TYPES, "boolean"),
        (DOUBLE_TYPES, "double"),
        (TIMESTAMP_TYPES, "timestamp_ntz"),
        (DATE_TYPES, "date"),
        (INTEGER_TYPES, "bigint"),
    ]
    for name in names.split()
}

# Parts of the value types, as (name, simple type); the value
# itself has no name of its own.
_UNIT = (("uom", "string"), ("", "double"))
VALUE_PARTS = {
    "CodeType": (("codespace", "string"), ("", "string")),
    "VectorType": _UNIT,
    "LengthType": _UNIT,
    "AngleType": _UNIT,
    "SpeedType": _UNIT,
    "ScaleType": _UNIT,
    "AreaType": _UNIT,
    "VolumeType": _UNIT,
    "MeasureType": _UNIT,
    "QuantityExtentType": _UNIT,
    "TimePositionType": (
        ("frame", "string"),
        ("calendarEraName", "string"),
        ("indeterminatePosition", "string"),
        ("", "string"),
    ),
    "TimeIntervalLengthType": (("unit", "string"), ("radix", "integer"), ("factor", "integer"), ("", "double")),
}


def spark_type(simple_type: str) -> str:
    """Spark type of a simple type; unknown types are kept as text."""
    return SPARK_TYPE.get(simple_type, "string")


def simple_column(value: Column, simple_type: str, name: str) -> Column:
    """A simple value; what does not parse becomes null."""
    return value.try_cast(spark_type(simple_type)).alias(name.lower())


def text_column(value: Column, data_type: T.DataType, name: str) -> Column:
    """A value of unknown type as text, nested values as JSON."""
    nested = isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))
    return (F.to_json(value) if nested else value.cast("string")).alias(name.lower())


def value_parts(value: Column, value_type: str, name: str) -> list[tuple[str, Column, str]]:
    """(column, raw value, simple type) of each part of a value with unit: ``width`` and ``width_uom``.

    ``value`` is a struct with a field ``value`` and one per further part.
    """
    return [(f"{name}_{part}" if part else name, value[part or "value"], simple) for part, simple in VALUE_PARTS[value_type]]


def period_parts(value: Column, name: str) -> list[tuple[str, Column, str]]:
    """(column, raw value, simple type) of both ends of a time period."""
    return [(f"{name}_{column}", value[end], "dateTime") for end, column in (("begin", "beginposition"), ("end", "endposition"))]


def bad_value(value: Column, simple_type: str) -> Column:
    """Whether a given value does not parse, so that its column is null."""
    return value.isNotNull() & value.try_cast(spark_type(simple_type)).isNull()


def measure_list_columns(value: Column, name: str) -> list[Column]:
    """A list of measures as text, blank between the numbers, and its unit."""
    text = F.when(value["values"].isNotNull(), F.array_join(value["values"].cast("array<string>"), " "))
    return [text.alias(name.lower()), value["uom"].cast("string").alias(f"{name}_uom".lower())]
