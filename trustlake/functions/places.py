"""Places as cells of a grid named by letters: cells of coordinates and the cells around them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value of the published format: the 32 letters by value.
LETTERS = "0123456789bcdefghjkmnpqrstuvwxyz"


def _bits(precision: int) -> tuple[int, int]:
    """Bits of longitude and of latitude; longitude comes first."""
    return -(-5 * precision // 2), 5 * precision // 2


def _cut(share: Column, bits: int) -> Column:
    """A share of the range as a whole number of so many bits; the far end belongs to the last cell."""
    return F.least(F.floor(share * (1 << bits)).cast("long"), F.lit((1 << bits) - 1).cast("long"))


def _name(x: Column, y: Column, precision: int) -> Column:
    """The letters of column x and row y: their bits in turn, five to a letter."""
    across, up = _bits(precision)
    letters = []
    for i in range(precision):
        code = F.lit(0).cast("long")
        for j in range(5 * i, 5 * i + 5):
            bit = F.shiftright(x, across - 1 - j // 2) if j % 2 == 0 else F.shiftright(y, up - 1 - j // 2)
            code = code * 2 + bit.bitwiseAND(F.lit(1).cast("long"))
        letters.append(F.substring(F.lit(LETTERS), (code + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def _named(places: list[tuple[Column, Column]], precision: int) -> Column:
    """The names of columns and rows, which are worked out once for all bits of a name."""
    pairs = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in places])
    return F.transform(pairs, lambda p: _name(p["x"], p["y"], precision))


def _place(lat: Column, lon: Column, precision: int) -> tuple[Column, Column, Column]:
    across, up = _bits(precision)
    there = lat.between(-90, 90) & lon.between(-180, 180)
    return there, _cut((lon.cast("double") + 180) / 360, across), _cut((lat.cast("double") + 90) / 180, up)


def cell(lat: Column, lon: Column, precision: int = 5) -> Column:
    """The cell of coordinates in degrees, by as many letters as ``precision`` says (1 to 12); null outside the ranges."""
    there, x, y = _place(lat, lon, precision)
    return F.when(there, _named([(x, y)], precision)[0])


def cells_near(lat: Column, lon: Column, precision: int = 5) -> Column:
    """The cell of coordinates and its eight neighbours, each once, as an array: the cell, then from south-west on by rows.

    Columns go round at the date line. Over a pole the neighbour is on the same row, half way round; null outside the ranges.
    """
    across, up = _bits(precision)
    there, x, y = _place(lat, lon, precision)
    columns, rows = 1 << across, 1 << up
    out = [(x, y)]
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            if dx or dy:
                row = y + dy
                over = (row < 0) | (row >= rows)
                row = F.greatest(F.lit(0).cast("long"), F.least(row, F.lit(rows - 1).cast("long")))
                column = F.pmod(x + dx + F.when(over, columns // 2).otherwise(0), F.lit(columns).cast("long"))
                out.append((column, row))
    return F.when(there, F.array_distinct(_named(out, precision)))
