"""Joins on object keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyfold.operators.xmatch import nearest_with_ties
from skyfold.schema import require_columns

KEYS = ("objectid", "filterid")


def strip_suffix(df: DataFrame, suffix: str = "_2") -> DataFrame:
    """Cut a suffix off column names; fails if two columns would get one name."""
    names = [c[: -len(suffix)] if c.endswith(suffix) else c for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"cutting {suffix} off would repeat: {', '.join(twice)}")
    return df.toDF(*names)


def join_labels(labels: DataFrame, curves: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Curves that have a label, with the label's columns first.

    No side is broadcast by hint: Spark does it when its own size estimate allows,
    and sorts and merges both sides otherwise.
    """
    require_columns(labels, keys)
    require_columns(curves, keys)
    return labels.join(curves, list(keys), "inner")


def join_outer(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Full outer join; rows of either side keep their keys.

    Written as a left join plus the right rows without a partner.  Adaptive
    execution can split a crowded key of the left side in these two joins, which
    it cannot do in a full join.  The second one reads only the keys of the left
    side, so that side should be a stored table rather than a long computation.
    Neither side is sent whole through the driver, however small its files.
    """
    require_columns(left, keys)
    require_columns(right, keys)
    partnered = left.join(right.hint("merge"), list(keys), "left")
    alone = right.join(left.select(*keys).hint("merge"), list(keys), "left_anti")
    return partnered.unionByName(alone, allowMissingColumns=True)


def matched_payload(matches: DataFrame, position: tuple[str, ...] = ("ra", "dec")) -> DataFrame:
    """A match table reduced to its nearest rows, keys and catalogue columns."""
    nearest = nearest_with_ties(matches).drop("distance", *position, *(f"{c}_2" for c in position))
    return strip_suffix(nearest)


def training_set(features: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Features with the nearest rows of two match tables, all three outer-joined.

    The nearest rows depend on the match tables alone, so they are taken before
    the joins, and the two small results are joined first, on the partitioning
    that this left behind.  The wide feature table is then shuffled once instead
    of four times.
    """
    matches = matched_payload(first).join(matched_payload(second).hint("merge"), list(KEYS), "full")
    return join_outer(features, matches)
