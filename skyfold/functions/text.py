"""String expressions for paths, sizes and listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal size units as directory listings print them.
SIZE_UNITS = {"B": 1, "K": 10**3, "M": 10**6, "G": 10**9, "T": 10**12}

def parse_size(size: Column) -> Column:
    """Bytes of a size such as ``313K`` or ``2.1M``; -1 when it is not a number and a unit."""
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*([BKMGT])\s*$"
    number = F.regexp_extract(size, pattern, 1)
    unit = F.regexp_extract(size, pattern, 2)
    factor = F.lit(0).cast("long")
    for name, value in SIZE_UNITS.items():
        factor = F.when(unit == name, F.lit(value).cast("long")).otherwise(factor)
    scaled = F.round(number.try_cast("double") * factor).cast("long")
    return F.when(size.isNotNull(), F.when(number == "", F.lit(-1).cast("long")).otherwise(scaled))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """The second-last segment, or null when there is none."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - 2))


def last_two(path: Column) -> Column:
    """The last two segments: what a derived file keeps of its source's path."""
    return F.substring_index(path, "/", -2)


def is_folder(path: Column) -> Column:
    return path.endswith("/")


def field_token(path: Column) -> Column:
    """The last ``field`` with a number in a path, or null."""
    return F.try_element_at(F.regexp_extract_all(path, F.lit("field[0-9]+"), F.lit(0)), F.lit(-1))


def join_url(base: str, path: Column) -> Column:
    """Base address and a relative path that may start with ``./``."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(path, r"^\./", ""))


def uri_bucket(uri: Column, protocol: str = "s3") -> Column:
    """The bucket of an object-store address; fails on any other protocol."""
    return F.when(_has_protocol(uri, protocol), F.parse_url(uri, F.lit("HOST"))).otherwise(_refuse(uri, protocol))


def uri_path(uri: Column, protocol: str = "s3") -> Column:
    """The path in the bucket, without the leading slash; fails on any other protocol."""
    path = F.regexp_replace(F.parse_url(uri, F.lit("PATH")), "^/", "")
    return F.when(_has_protocol(uri, protocol), path).otherwise(_refuse(uri, protocol))


def _has_protocol(uri: Column, protocol: str) -> Column:
    return F.parse_url(uri, F.lit("PROTOCOL")) == protocol


def _refuse(uri: Column, protocol: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"not an address of the {protocol} protocol: "), uri)).cast("string")
