"""The light-curve schema and the checks made before a plan is built."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and widths of the light-curve files.
LIGHTCURVE_SCHEMA = T.StructType(
    [
        T.StructField("objectid", T.LongType()),
        T.StructField("filterid", T.ByteType()),
        T.StructField("fieldid", T.ShortType()),
        T.StructField("rcid", T.ByteType()),
        T.StructField("objra", T.FloatType()),
        T.StructField("objdec", T.FloatType()),
        T.StructField("nepochs", T.LongType()),
        T.StructField("hmjd", T.ArrayType(T.DoubleType())),
        T.StructField("mag", T.ArrayType(T.FloatType())),
        T.StructField("magerr", T.ArrayType(T.FloatType())),
        T.StructField("clrcoeff", T.ArrayType(T.FloatType())),
        T.StructField("catflags", T.ArrayType(T.IntegerType())),
    ]
)

EPOCH_COLUMNS = ("hmjd", "mag", "magerr", "clrcoeff", "catflags")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise on the driver when a column is missing, before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; found: {', '.join(df.columns)}")


def _has_fraction(value: Column) -> Column:
    return value.isNotNull() & (value != F.floor(value))


def _conform_column(df: DataFrame, field: T.StructField, strict: bool) -> Column:
    source = df.schema[field.name].dataType
    value = F.col(field.name)
    if not strict:
        return value.try_cast(field.dataType).alias(field.name)
    if isinstance(source, T.ArrayType) != isinstance(field.dataType, T.ArrayType):
        raise TypeError(f"{field.name}: cannot turn {source.simpleString()} into {field.dataType.simpleString()}")
    is_array = isinstance(source, T.ArrayType)
    source_leaf = source.elementType if is_array else source
    target_leaf = field.dataType.elementType if is_array else field.dataType
    cast = value.cast(field.dataType)
    # ANSI casts raise on overflow but cut fractions off without a word.
    if isinstance(source_leaf, _FRACTIONAL) and isinstance(target_leaf, _INTEGRAL):
        bad = F.exists(value, _has_fraction) if is_array else _has_fraction(value)
        cast = F.when(bad, F.raise_error(F.lit(f"{field.name}: fractional value"))).otherwise(cast)
    return cast.alias(field.name)


def conform(df: DataFrame, strict: bool = True) -> DataFrame:
    """Project onto the 12 light-curve columns in order, with their exact types.

    ``strict`` fails on values that do not fit; otherwise such values become null.
    The projection is row-local and works on a stream as well.
    """
    require_columns(df, LIGHTCURVE_SCHEMA.fieldNames())
    return df.select(*[_conform_column(df, field, strict) for field in LIGHTCURVE_SCHEMA.fields])
