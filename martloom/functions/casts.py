"""Casts that turn unparseable text into NULL under ANSI mode.

Each takes the column's current type, so an already typed column passes
through and a cast table can be applied to text and typed inputs alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the strict timestamp pattern of the source files.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def to_timestamp(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col
    return F.try_to_timestamp(col, F.lit(TIMESTAMP_PATTERN))


def to_double(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    """NaN and the infinities count as unparseable: one of them would poison every sum."""
    value = col if isinstance(dtype, T.DoubleType) else col.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_int(col: Column, dtype: T.DataType = T.StringType()) -> Column:
    if isinstance(dtype, T.IntegerType):
        return col
    return col.try_cast("int")


_CASTS = {"timestamp": to_timestamp, "double": to_double, "int": to_int}


def apply_casts(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Replace columns by their typed form; text originals stay as ``<column>_raw``."""
    types = {f.name: f.dataType for f in df.schema}
    present = {c: kind for c, kind in casts.items() if c in types}
    raw = {f"{c}_raw": F.col(c) for c in present if isinstance(types[c], T.StringType)}
    typed = {c: _CASTS[kind](F.col(c), types[c]) for c, kind in present.items()}
    return df.withColumns({**raw, **typed}) if present else df
