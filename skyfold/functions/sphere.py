"""Positions on the sky: distance, galactic coordinates, pixels and match cells.

All angles are in degrees, all expressions are plain column arithmetic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Galactic pole (ICRS) and galactic longitude of the celestial pole.
GALACTIC_POLE_RA = 192.85948
GALACTIC_POLE_DEC = 27.12825
CELESTIAL_POLE_L = 122.93192


def _rad(angle: Column) -> Column:
    return F.radians(angle.cast("double"))


def distance(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance by the haversine form, exact for tiny separations."""
    half_dec = F.sin((_rad(dec2) - _rad(dec1)) / 2.0)
    half_ra = F.sin((_rad(ra2) - _rad(ra1)) / 2.0)
    chord = half_dec * half_dec + F.cos(_rad(dec1)) * F.cos(_rad(dec2)) * half_ra * half_ra
    return F.degrees(F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * 2.0)


def galactic_b(ra: Column, dec: Column) -> Column:
    pole = math.radians(GALACTIC_POLE_DEC)
    turn = _rad(ra) - math.radians(GALACTIC_POLE_RA)
    height = F.sin(_rad(dec)) * math.sin(pole) + F.cos(_rad(dec)) * math.cos(pole) * F.cos(turn)
    return F.degrees(F.asin(F.greatest(F.least(height, F.lit(1.0)), F.lit(-1.0))))


def galactic_l(ra: Column, dec: Column) -> Column:
    pole = math.radians(GALACTIC_POLE_DEC)
    turn = _rad(ra) - math.radians(GALACTIC_POLE_RA)
    east = F.cos(_rad(dec)) * F.sin(turn)
    north = F.sin(_rad(dec)) * math.cos(pole) - F.cos(_rad(dec)) * math.sin(pole) * F.cos(turn)
    return F.pmod(F.lit(CELESTIAL_POLE_L) - F.degrees(F.atan2(east, north)), F.lit(360.0))


# Shifts and masks that spread the low 32 bits of a long to its even places.
_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def _spread(value: Column) -> Column:
    for shift, mask in _SPREAD:
        value = value.bitwiseXOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def healpix(ra: Column, dec: Column, level: int) -> Column:
    """HEALPix pixel in the nested scheme at nside 2^level (Gorski et al. 2005)."""
    if not 0 <= level <= 29:
        raise ValueError("the level must lie between 0 and 29")
    nside = 1 << level
    z = F.sin(_rad(dec))
    quarter = F.pmod(ra.cast("double"), F.lit(360.0)) / 90.0
    last = F.lit(nside - 1).cast("long")

    def whole(x: Column) -> Column:
        return F.floor(x).cast("long")

    # Equatorial belt: the two diagonal line numbers give the face and the place in it.
    rise = (quarter + 0.5) * float(nside)
    slope = z * (0.75 * nside)
    down, up = whole(rise - slope), whole(rise + slope)
    face_down, face_up = F.shiftright(down, level), F.shiftright(up, level)
    belt_face = (
        F.when(face_down == face_up, face_down.bitwiseAND(F.lit(3)) + 4)
        .when(face_down < face_up, face_down)
        .otherwise(face_up + 8)
    )
    belt_x = up.bitwiseAND(last)
    belt_y = last - down.bitwiseAND(last)

    # Polar caps: distance from the pole, written so that it stays exact near it.
    sector = F.least(whole(quarter), F.lit(3).cast("long"))
    along = quarter - sector
    radius = F.cos(_rad(dec)) * math.sqrt(3.0) * nside / F.sqrt(F.abs(z) + 1.0)
    near = F.least(whole(along * radius), last)
    far = F.least(whole((F.lit(1.0) - along) * radius), last)
    north = z >= 0
    cap_face = F.when(north, sector).otherwise(sector + 8)
    cap_x = F.when(north, last - far).otherwise(near)
    cap_y = F.when(north, last - near).otherwise(far)

    belt = F.abs(z) <= 2.0 / 3.0
    face = F.when(belt, belt_face).otherwise(cap_face)
    x = F.when(belt, belt_x).otherwise(cap_x)
    y = F.when(belt, belt_y).otherwise(cap_y)
    inside = _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))
    return face * F.lit(nside * nside).cast("long") + inside


def zone(dec: Column, height: float) -> Column:
    """Number of the declination band of the given height that holds ``dec``."""
    return F.floor((dec.cast("double") + 90.0) / height).cast("long")


def cells_in_zone(number: Column, height: float) -> Column:
    """How many match cells the band is cut into, none narrower than its height."""
    edge = F.greatest(F.abs(number * height - 90.0), F.abs((number + 1) * height - 90.0))
    width = F.cos(F.radians(F.least(edge, F.lit(90.0)))) * 360.0 / height
    return F.greatest(F.floor(width), F.lit(1)).cast("long")


def cell_in_zone(ra: Column, cells: Column) -> Column:
    place = F.floor(F.pmod(ra.cast("double"), F.lit(360.0)) / 360.0 * cells).cast("long")
    return F.least(place, cells - 1)
