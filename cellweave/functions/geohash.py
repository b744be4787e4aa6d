"""Geohash cells as native column expressions (no Python runs per row).

A geohash halves the longitude and latitude ranges in turn and writes five
halvings as one character. The rule here sends a point that lies exactly on a
dividing line to the *lower* cell, clamps points outside the ranges to the border
cell, and treats NaN as lower than every line.

Both axes are first cut into ``2**30`` equal steps. A step is ``45 * 2**k``
degrees, so every dividing line is an exact double, and dividing a coordinate by
the step can never round it across a line: neighbouring doubles around
``m * step`` are at least 0.7 units in the last place of ``m`` apart after the
division. ``ceil`` of that quotient is therefore the exact answer, and coarser
cells are its leading bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash alphabet and the half ranges of the two axes.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LNG_LIMIT = 180.0
LAT_LIMIT = 90.0

MAX_PRECISION = 12
DEFAULT_PRECISION = 4
_STEP_BITS = 30


def _check(precision: int) -> None:
    if not 1 <= precision <= MAX_PRECISION:
        raise ValueError(f"precision must be 1..{MAX_PRECISION}, got {precision}")


def _axis_bits(precision: int) -> tuple[int, int]:
    """Bits of (longitude, latitude) in a hash of this many characters."""
    return (5 * precision + 1) // 2, 5 * precision // 2


def _step(value: Column, limit: float) -> Column:
    """Number of the axis step that holds ``value``; null stays null."""
    width = 2 * limit / 2**_STEP_BITS
    value = value.cast("double")
    # NaN sorts above every number in Spark, so it has to be caught first.
    inside = (
        F.when(F.isnan(value) | (value <= -limit), F.lit(width - limit))
        .when(value > limit, F.lit(limit))
        .otherwise(value)
    )
    return F.ceil(inside / F.lit(width)) + F.lit(2 ** (_STEP_BITS - 1) - 1)


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cell_id(lat: Column | str, lng: Column | str, precision: int = DEFAULT_PRECISION) -> Column:
    """The cell as one ``bigint`` (longitude bits, then latitude bits).

    Cheaper to shuffle and to group by than the text; ``cell_text`` turns it back.
    """
    _check(precision)
    lng_bits, lat_bits = _axis_bits(precision)
    column = F.shiftright(_step(_as_column(lng), LNG_LIMIT), _STEP_BITS - lng_bits)
    row = F.shiftright(_step(_as_column(lat), LAT_LIMIT), _STEP_BITS - lat_bits)
    return F.shiftleft(column, lat_bits).bitwiseOR(row)


def _letters(lng_first: bool) -> Column:
    """The 32 letters, indexed by one letter's longitude bits then latitude bits."""
    lng_count, lat_count = (3, 2) if lng_first else (2, 3)
    letters = []
    for index in range(32):
        lng_bits = [index >> (lat_count + i) & 1 for i in reversed(range(lng_count))]
        lat_bits = [index >> i & 1 for i in reversed(range(lat_count))]
        mixed = [0] * 5
        mixed[0 if lng_first else 1 :: 2] = lng_bits
        mixed[1 if lng_first else 0 :: 2] = lat_bits
        letters.append(ALPHABET[int("".join(map(str, mixed)), 2)])
    # One literal that the planner folds to an array, instead of 32.
    return F.split(F.lit(" ".join(letters)), " ")


def _text(lng: Column, lng_bits: int, lat: Column, lat_bits: int, precision: int) -> Column:
    """Text from the lowest ``lng_bits`` and ``lat_bits`` bits of two numbers."""
    tables = (_letters(True), _letters(False))
    parts = []
    for place in range(precision):
        lng_used, lat_used = _axis_bits(place + 1)
        lng_count, lat_count = (3, 2) if place % 2 == 0 else (2, 3)
        lng_part = F.shiftright(lng, lng_bits - lng_used).bitwiseAND(F.lit(2**lng_count - 1))
        lat_part = F.shiftright(lat, lat_bits - lat_used).bitwiseAND(F.lit(2**lat_count - 1))
        index = F.shiftleft(lng_part, lat_count).bitwiseOR(lat_part).cast("int")
        parts.append(F.get(tables[place % 2], index))
    return F.concat(*parts)


def cell_text(cell: Column | str, precision: int = DEFAULT_PRECISION) -> Column:
    """Geohash text of a ``cell_id`` made with the same precision."""
    _check(precision)
    cell = _as_column(cell)
    lng_bits, lat_bits = _axis_bits(precision)
    return _text(F.shiftright(cell, lat_bits), lng_bits, cell, lat_bits, precision)


def _bits_of_letters(positions: tuple[int, ...]) -> Column:
    """For each letter of the alphabet, the bits at these positions as one number."""
    return F.lit([int("".join(str(index >> p & 1) for p in positions), 2) for index in range(32)])


def cell_of_text(text: Column | str, precision: int = DEFAULT_PRECISION) -> Column:
    """The ``cell_id`` of a geohash text; null for text that is no geohash.

    Text longer than the precision stands for the larger cell it lies in.
    """
    _check(precision)
    # A blank is not in the alphabet, so text that is too short gives null.
    padded = F.rpad(_as_column(text), precision, " ")
    # The axis that goes first in a letter has three of its five bits.
    three, two = _bits_of_letters((4, 2, 0)), _bits_of_letters((3, 1))
    column = row = F.lit(0).cast("bigint")
    for place in range(precision):
        letter = F.instr(F.lit(ALPHABET), F.substring(padded, place + 1, 1)) - 1
        lng_bits, lng_count, lat_bits, lat_count = (three, 3, two, 2) if place % 2 == 0 else (two, 2, three, 3)
        column = F.shiftleft(column, lng_count).bitwiseOR(F.get(lng_bits, letter).cast("bigint"))
        row = F.shiftleft(row, lat_count).bitwiseOR(F.get(lat_bits, letter).cast("bigint"))
    return F.shiftleft(column, _axis_bits(precision)[1]).bitwiseOR(row)


def geohash(lat: Column | str, lng: Column | str, precision: int = DEFAULT_PRECISION) -> Column:
    """Geohash text of a point; null if either coordinate is null."""
    _check(precision)
    column = _step(_as_column(lng), LNG_LIMIT)
    row = _step(_as_column(lat), LAT_LIMIT)
    return _text(column, _STEP_BITS, row, _STEP_BITS, precision)
