"""Text of ids, attribute values and token lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsync.functions.times import iso_date


def plain_text(c: Column, data_type: T.DataType) -> Column:
    """Text of a value; decimals lose trailing zeros, so 1.00 and 1 are the same key."""
    text = c.cast("string")
    if isinstance(data_type, T.DecimalType) and data_type.scale > 0:
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return text


def column_text(df: DataFrame, name: str) -> Column:
    return plain_text(F.col(f"`{name}`"), df.schema[name].dataType)


def is_whole(data_type: T.DataType) -> bool:
    """A number without decimals that fits into a bigint."""
    if isinstance(data_type, T.DecimalType):
        return data_type.scale == 0 and data_type.precision <= 18
    return isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def join_keys(left: DataFrame, left_name: str, right: DataFrame, right_name: str):
    """The two columns in a form that compares equal when their texts do.

    Whole numbers are compared as bigint, which is smaller to shuffle and faster to hash than
    text; everything else as text.
    """
    sides = ((left, left_name), (right, right_name))
    if all(is_whole(df.schema[name].dataType) for df, name in sides):
        return tuple(F.col(f"`{name}`").cast("bigint") for _, name in sides)
    return tuple(column_text(df, name) for df, name in sides)


def typed_value(df: DataFrame, string: str, date: str, number: str) -> Column:
    """One text value from the string, date and number variants of an attribute."""
    return F.coalesce(F.col(string), iso_date(F.col(date)), column_text(df, number))


def doc_id(df: DataFrame, columns, separator: str = "-") -> Column:
    """Id text: the columns joined by the separator, null as soon as one of them is null.

    Decimals are written as in join keys, so a NUMBER that a driver reads with ten decimals has
    the id 1, not 1.0000000000.
    """
    parts = [column_text(df, c) for c in columns]
    if len(parts) == 1:
        return parts[0]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(separator), part)
    return joined


def pattern_tokens(c: Column, pattern: str) -> Column:
    """What lies between the matches of a pattern; empty tokens do not count."""
    return F.filter(F.split(c, pattern), lambda token: token != "")


def comma_tokens(c: Column) -> Column:
    return pattern_tokens(c, ",")


def pair_text(key: Column, value: Column) -> Column:
    """``key value `` with its trailing space; a null value is written as the word null."""
    return F.concat(key, F.lit(" "), F.coalesce(value, F.lit("null")), F.lit(" "))
