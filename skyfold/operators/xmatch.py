"""Match two catalogues by position.

The sphere is cut into declination zones and each zone into cells.  The objects
get the one cell they lie in; the catalogue gets every cell its search circle
touches.  The match is then an equi-join on (zone, cell) with an exact distance
test, so Spark hashes and sorts it like any other join, and adaptive execution
splits a cell that holds too many rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions import sphere
from skyfold.schema import require_columns
from skyfold.workspace import bucketed, checkpointed

_WORK = ("_zone", "_cell")


def with_healpix(df: DataFrame, level: int, ra: str = "ra", dec: str = "dec", name: str = "ipix") -> DataFrame:
    """Add the nested HEALPix pixel of each row."""
    require_columns(df, (ra, dec))
    return df.withColumn(name, sphere.healpix(F.col(ra), F.col(dec), level))


def usable(df: DataFrame, ra: str, dec: str) -> DataFrame:
    """Rows with a position on the sphere: neither null nor NaN or infinite, declination from -90 to 90.

    Default positions such as -999 would otherwise touch cells without end.
    """
    east, north = F.col(ra).cast("double"), F.col(dec).cast("double")
    finite = ~F.isnan(east) & (F.abs(east) < float("inf")) & ~F.isnan(north)
    return df.filter(east.isNotNull() & north.isNotNull() & finite & north.between(-90.0, 90.0))


def _with_own_cell(df: DataFrame, ra: str, dec: str, height: float) -> DataFrame:
    zoned = df.withColumn("_zone", sphere.zone(F.col(dec), height))
    return zoned.withColumn("_cell", sphere.cell_in_zone(F.col(ra), sphere.cells_in_zone(F.col("_zone"), height)))


def _with_touched_cells(df: DataFrame, ra: str, dec: str, radius: float, height: float) -> DataFrame:
    """One row for each cell that the circle of ``radius`` around a row touches."""
    position = F.col(dec).cast("double")
    # A hair over the radius, so that rounding cannot lose a pair on the edge.
    reach = radius * (1.0 + 1e-9) + 1e-12
    zones = F.sequence(
        sphere.zone(F.greatest(position - reach, F.lit(-90.0)), height),
        sphere.zone(F.least(position + reach, F.lit(90.0)), height),
    )
    ratio = F.try_divide(F.lit(math.sin(math.radians(reach))), F.cos(F.radians(position)))
    half_width = F.when(F.abs(position) + reach >= 90.0, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0))))
    )
    zoned = (
        df.withColumn("_half", half_width)
        .withColumn("_zone", F.explode(zones))
        .withColumn("_cells", sphere.cells_in_zone(F.col("_zone"), height))
    )
    per_degree = F.col("_cells") / 360.0
    east = F.col(ra).cast("double")
    first = F.floor((east - F.col("_half")) * per_degree).cast("long")
    last = F.floor((east + F.col("_half")) * per_degree).cast("long")
    # A circle that reaches round the pole touches every cell of the zone once.
    last = F.least(last, first + F.col("_cells") - 1)
    cells = F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.col("_cells")))
    return zoned.withColumn("_cell", F.explode(F.array_distinct(cells))).drop("_half", "_cells")


def default_cell(radius: float) -> float:
    """Cell height for a radius: four radii.

    A catalogue row then falls into about (1 + 2/4)^2 = 2.25 cells, and a cell
    holds few rows even in crowded fields.
    """
    return min(max(4.0 * radius, 1e-5), 90.0)


def xmatch(
    objects: DataFrame,
    catalogue: DataFrame,
    radius: float,
    cell: float | None = None,
    ra: str = "ra",
    dec: str = "dec",
    suffix: str = "_2",
    spread: str = "catalogue",
) -> DataFrame:
    """All pairs within ``radius`` degrees.

    ``spread`` names the side whose rows are copied to every cell they touch, best the
    smaller one: ``catalogue`` or ``objects``.

    Both inputs have ``ra`` and ``dec``.  The result has the columns of
    ``objects``, those of ``catalogue`` with ``suffix``, and ``distance`` in
    degrees.
    """
    require_columns(objects, (ra, dec))
    require_columns(catalogue, (ra, dec))
    if not 0 < radius <= 90:
        raise ValueError("the radius must lie between 0 and 90 degrees")
    height = default_cell(radius) if cell is None else cell
    if height < radius:
        raise ValueError("a cell must not be smaller than the radius")
    renamed = catalogue.toDF(*[f"{c}{suffix}" for c in catalogue.columns])
    ra2, dec2 = f"{ra}{suffix}", f"{dec}{suffix}"
    if spread not in ("catalogue", "objects"):
        raise ValueError("spread is catalogue or objects")
    left, right = usable(objects, ra, dec), usable(renamed, ra2, dec2)
    if spread == "catalogue":
        left, right = _with_own_cell(left, ra, dec, height), _with_touched_cells(right, ra2, dec2, radius, height)
    else:
        left, right = _with_touched_cells(left, ra, dec, radius, height), _with_own_cell(right, ra2, dec2, height)
    # Neither side is sent whole: files and cells say little of the size of a catalogue, as its rows are packed
    # and each is copied to the cells it touches, and a table sent whole goes through the driver.
    pairs = left.join(right.hint("merge"), list(_WORK))
    # The cheap comparison goes first and spares most of the trigonometry.
    band = F.abs(F.col(dec).cast("double") - F.col(dec2).cast("double")) <= radius * (1.0 + 1e-9) + 1e-12
    apart = sphere.distance(F.col(ra), F.col(dec), F.col(ra2), F.col(dec2))
    return pairs.filter(band).withColumn("distance", apart).filter(F.col("distance") <= radius).drop(*_WORK)


def with_cells(df: DataFrame, radius: float, touched: bool, cell: float | None = None, parts: int = 1, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows with ``_key``, the cell they lie in, or one row for each cell they touch.

    With ``parts`` a cell has as many keys: a row that touches it gets all of them, one
    that lies in it gets one of them by a hash of all its columns.
    """
    height = default_cell(radius) if cell is None else cell
    zoned = _with_touched_cells(usable(df, ra, dec), ra, dec, radius, height) if touched else _with_own_cell(usable(df, ra, dec), ra, dec, height)
    own = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if touched else F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
    # Zones and cells of the least height take 25 and 26 bits.
    return zoned.withColumn("_part", own).withColumn("_key", (F.shiftleft("_zone", 26) + F.col("_cell")) * parts + F.col("_part")).drop(*_WORK, "_part")


class StoredCatalogue:
    """A catalogue written once by cell, for many matches of up to ``radius`` degrees.

    The table is bucketed and sorted by cell: a match sends and sorts the objects only.
    Where a third of all objects lies in one cell, ``parts`` keeps as many copies of the
    catalogue and spreads the objects of each cell over them, as a stored table
    is not split while a job runs.  Catalogue rows without a usable position are left out.
    """

    def __init__(self, catalogue: DataFrame, radius: float, buckets: int, parts: int = 1, suffix: str = "_2"):
        require_columns(catalogue, ("ra", "dec"))
        if not 0 < radius <= 90:
            raise ValueError("the radius must lie between 0 and 90 degrees")
        if buckets < 1 or parts < 1:
            raise ValueError("at least one bucket and one part")
        self.radius, self.parts, self.suffix = radius, parts, suffix
        self.table = bucketed(with_cells(catalogue, radius, True, parts=parts), "_key", buckets, "catalogue-by-cell")

    def xmatch(self, objects: DataFrame, radius: float | None = None) -> DataFrame:
        """All pairs within ``radius`` degrees, as ``xmatch`` gives them."""
        require_columns(objects, ("ra", "dec"))
        reach = self.radius if radius is None else radius
        if not 0 < reach <= self.radius:
            raise ValueError("the radius must not pass that of the stored catalogue")
        renamed = self.table.withColumnsRenamed({c: f"{c}{self.suffix}" for c in self.table.columns if c != "_key"})
        # The height of the cells follows the stored radius, whatever the radius of the match. A merge of sorted
        # buckets is asked for: the objects' side would else be sent whole wherever it looks small.
        pairs = with_cells(objects, self.radius, False, parts=self.parts).hint("merge").join(renamed, "_key")
        ra2, dec2 = f"ra{self.suffix}", f"dec{self.suffix}"
        band = F.abs(F.col("dec").cast("double") - F.col(dec2).cast("double")) <= reach * (1.0 + 1e-9) + 1e-12
        apart = sphere.distance(F.col("ra"), F.col("dec"), F.col(ra2), F.col(dec2))
        return pairs.filter(band).withColumn("distance", apart).filter(F.col("distance") <= reach).drop("_key")


def nearest_one(
    matches: DataFrame, keys: tuple[str, ...] = ("objectid", "filterid"), tiebreak: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: the smallest distance, then the tiebreak columns.

    Distances are compared to 1e-4 arcsec, so that rounding noise cannot decide.
    Spark applies the row limit before the shuffle as well as after it.
    """
    require_columns(matches, (*keys, "distance", *tiebreak))
    order = Window.partitionBy(*keys).orderBy(F.round(F.col("distance") * 3600.0, 4), *tiebreak)
    return matches.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def nearest_with_ties(
    matches: DataFrame, keys: tuple[str, ...] = ("filterid", "objectid"), by: str = "distance"
) -> DataFrame:
    """Every row at the smallest distance of its key.

    Rows behind the first rank are dropped before the shuffle as well as after it.
    """
    require_columns(matches, (*keys, by))
    order = Window.partitionBy(*keys).orderBy(F.col(by).asc_nulls_last())
    return matches.withColumn("_rank", F.rank().over(order)).filter("_rank = 1").drop("_rank")


def xmatch_nearest(
    objects: DataFrame,
    catalogue: DataFrame,
    radius: float,
    tiebreak: str,
    keys: tuple[str, ...] = ("objectid", "filterid"),
    cell: float | None = None,
    first_radii: tuple[float, ...] = (),
) -> DataFrame:
    """``xmatch``, then the nearest catalogue row of each key.

    Of catalogue rows at one and the same position only the first by the tiebreak
    can be an answer, so the others are dropped before the match: a crowd of
    copies, such as rows with a default position, makes no crowd of pairs.

    ``first_radii`` are smaller radii to search first, for fields so crowded that
    many sources lie within ``radius`` of an object.  A key answered at a smaller
    radius has its answer and takes no part in the wider searches, so pairs are
    only made where sources are sparse on that scale.  The result is the same.
    """
    place = Window.partitionBy("ra", "dec").orderBy(tiebreak)
    single = usable(catalogue, "ra", "dec").withColumn("_copy", F.row_number().over(place)).filter("_copy = 1").drop("_copy")
    order = (f"{tiebreak}_2",)
    if not first_radii:
        return nearest_one(xmatch(objects, single, radius, cell), keys, order)
    if list(first_radii) != sorted(set(first_radii)) or first_radii[-1] >= radius:
        raise ValueError("the first radii must rise and stay below the radius")
    single = checkpointed(single, "catalogue")
    waiting, answers = objects, []
    for reach in first_radii:
        found = checkpointed(nearest_one(xmatch(waiting, single, reach), keys, order), "nearest")
        answers.append(found)
        waiting = waiting.join(found.select(*keys), list(keys), "left_anti")
    answers.append(nearest_one(xmatch(waiting, single, radius, cell), keys, order))
    return reduce(DataFrame.unionByName, answers)
