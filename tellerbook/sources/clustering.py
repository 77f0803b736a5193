"""Clustering by several columns: files in the order of a Z curve over ranges of quantiles.

Each column's values are cut into ranges of about equal numbers of rows. The bits of the
ranges' numbers alternate in one key, so rows near each other in every column lie near
each other in the files, and a filter on any of the columns skips most files by their
smallest and largest values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Ranges per column are 2^BITS; the boundaries are within 1 / ACCURACY of the rows.
BITS, ACCURACY = 6, 10_000
# Bytes of a text, behind what all texts begin with, that decide its range: a double holds them.
_LETTERS = 6


@dataclass(frozen=True)
class Cuts:
    """A column's boundaries, distinct and rising, and how many bytes all its texts begin with."""

    name: str
    bounds: list[float]
    common: int | None

    def position(self) -> Column:
        """A number in the order of the column's values."""
        if self.common is None:
            return F.col(self.name).cast("double")
        start = F.substring(F.encode(F.col(self.name), "utf-8"), self.common + 1, _LETTERS)
        return F.conv(F.rpad(F.hex(start), 2 * _LETTERS, "0"), 16, 10).cast("double")

    def number(self) -> Column:
        """The value's range, spread over 0 to 2^BITS - 1; NULL is in the first."""
        place = self.position()
        bounds = F.array(*[F.lit(b) for b in self.bounds]).cast("array<double>")
        passed = F.size(F.filter(bounds, lambda b: b <= place))
        spread = F.floor(passed * 2**BITS / (len(self.bounds) + 1))
        return F.when(place.isNull(), 0).otherwise(spread).cast("long")


def boundaries(rows: DataFrame, columns: Sequence[str]) -> list[Cuts]:
    """Quantiles of each column: at most 2^BITS numbers a column, from two passes over them."""
    texts = [c for c in columns if isinstance(rows.schema[c].dataType, StringType)]
    common: dict[str, int] = {}
    if texts:
        ends = rows.agg(*[f(c).alias(f"{i}{j}") for i, c in enumerate(texts) for j, f in enumerate((F.min, F.max))]).head()
        for i, c in enumerate(texts):
            both = [(ends[f"{i}{j}"] or "").encode() for j in (0, 1)]
            common[c] = len(commonprefix(both))
    found = [Cuts(c, [], common.get(c)) for c in columns]
    shares = [i / 2**BITS for i in range(1, 2**BITS)]
    quantiles = rows.agg(*[F.percentile_approx(c.position(), shares, ACCURACY).alias(c.name) for c in found]).head()
    return [Cuts(c.name, sorted(set(quantiles[c.name] or [])), c.common) for c in found]


def z_key(cuts: Sequence[Cuts]) -> Column:
    """The place on the Z curve: the bits of the ranges' numbers in turn, the first column's first."""
    key = F.lit(0).cast("long")
    for at, own in enumerate(cuts):
        number = own.number()
        for bit in range(BITS):
            place = bit * len(cuts) + (len(cuts) - 1 - at)
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), place))
    return key


def write_clustered(
    rows: DataFrame, path: str, columns: Sequence[str], files: int, partition: str | None = None, mode: str = "overwrite"
) -> None:
    """Write about ``files`` files of even size along the Z curve, within a partition column if named.

    The curve is cut where its cells end, as many cells as files: a file that began in
    the middle of one would reach over two far ends of it. A cell that is too full for
    one file is not split. A partition gets files in proportion to its rows.
    """
    cuts = boundaries(rows, columns)
    first = [partition] if partition else []
    depth = min((files - 1).bit_length(), BITS * len(columns))
    dealt = rows.withColumn("_z", z_key(cuts)).withColumn("_cell", F.shiftright("_z", BITS * len(columns) - depth))
    # Twice the ranges, so that sampled bounds seldom put two cells together; empty ones leave no file.
    dealt = dealt.repartitionByRange(2 * files, *first, "_cell")
    writer = dealt.sortWithinPartitions(*first, "_z").drop("_z", "_cell").write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)
