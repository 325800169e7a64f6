"""Column selection and scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes one value of a fixed-width type takes in a row.
_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.NullType: 0,
}


def quoted(name: str) -> str:
    """The column called exactly ``name`` as SQL text, even when it holds dots."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column called exactly ``name``."""
    return F.col(quoted(name))


def text_literal(value: str | None) -> str:
    """A string literal as SQL text.

    How quotes and backslashes are escaped depends on a setting of the session, so text
    that holds one is spelled in hexadecimal.
    """
    if value is None:
        return "cast(null as string)"
    if "\\" in value or "'" in value:
        return f"decode(unhex('{value.encode().hex()}'), 'UTF-8')"
    return f"'{value}'"


def numeric_columns(df: DataFrame, limit: int | None = None) -> list[str]:
    """Names of the numeric columns (byte to decimal), at most ``limit``."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return names[:limit]


def require_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"Unknown columns: {', '.join(absent)}")
    return list(names)


def as_double(name: str) -> Column:
    return named(name).cast("double")


def is_missing_number(column: Column) -> Column:
    """True for NULL and NaN, the two values no fit accepts as a label."""
    return column.isNull() | F.isnan(column)


def percent_text(part: str, total: str, digits: int | None = None) -> str:
    """``part`` of ``total`` in percent as SQL text, 0 when the total is 0."""
    return rounded_text(f"coalesce(try_divide(({part}) * 100D, {total}), 0D)", digits)


def rounded_text(text: str, digits: int | None) -> str:
    return text if digits is None else f"round({text}, {digits})"


def rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def clamp(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), column))


def fixed_width(data_type: T.DataType) -> int | None:
    """Bytes per value of a type whose size does not depend on the value."""
    if isinstance(data_type, T.DecimalType):
        return 8 if data_type.precision <= 18 else 16
    if isinstance(data_type, T.StructType):
        widths = [fixed_width(f.dataType) for f in data_type.fields]
        return None if None in widths else sum(widths)
    return _FIXED_WIDTH.get(type(data_type))


def value_bytes(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """Bytes of one value as SQL text, 0 for a NULL of variable width."""
    width = fixed_width(data_type)
    if width is not None:
        return f"{width}L"
    if isinstance(data_type, T.ArrayType):
        return _array_bytes(value, data_type.elementType, depth)
    if isinstance(data_type, T.MapType):
        keys = _array_bytes(f"map_keys({value})", data_type.keyType, depth)
        return f"{keys} + {_array_bytes(f'map_values({value})', data_type.valueType, depth)}"
    if isinstance(data_type, T.StructType):
        return " + ".join(
            value_bytes(f"{value}.{quoted(f.name)}", f.dataType, depth) for f in data_type.fields
        )
    if not isinstance(data_type, (T.StringType, T.BinaryType)):
        value = f"cast({value} as string)"
    return f"cast(coalesce(octet_length({value}), 0) as bigint)"


def _array_bytes(value: str, element_type: T.DataType, depth: int) -> str:
    width = fixed_width(element_type)
    if width is not None:
        return f"coalesce(cast(array_size({value}) as bigint) * {width}L, 0L)"
    item, total = f"item_{depth}", f"total_{depth}"
    size = value_bytes(item, element_type, depth + 1)
    return f"coalesce(aggregate({value}, 0L, ({total}, {item}) -> {total} + {size}), 0L)"
