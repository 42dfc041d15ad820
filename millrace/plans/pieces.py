"""Tables cut by key hash: into how many pieces, and which of them a change touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.lake import Table

#: Bytes of source that a piece is meant for, and the least number of pieces.
PIECE_BYTES = 512 << 20
LEAST_PIECES = 8
#: A table is cut anew once it wants this many times its pieces; a new cut rewrites it whole.
OUTGROWN = 4


def piece_of(columns: Sequence[str], pieces: int) -> Column:
    """The slice a row belongs to, ``<number>-of-<pieces>``."""
    number = F.pmod(F.xxhash64(*columns), F.lit(pieces))
    return F.concat(number.cast("string"), F.lit(f"-of-{pieces}"))


def pieces_for(table: Table, source: Table, wanted: int | None = None) -> int:
    """``wanted``, or a number by the size of the source; a stored table keeps its own until it has outgrown it."""
    if wanted:
        return wanted
    numbers = [s.rpartition("-of-")[2] for s in table.slices()]
    held = max((int(n) for n in numbers if n.isdigit()), default=0)
    size = source.bytes() if source.exists() else 0
    fitting = max(LEAST_PIECES, -(-size // PIECE_BYTES))
    return held if fitting <= OUTGROWN * held else fitting


def names(df: DataFrame, piece: Column) -> list[str]:
    """The different pieces rows belong to; there are no more than pieces."""
    return sorted(r[0] for r in df.select(piece.alias("piece")).distinct().collect())


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row that changes with its values.

    The built-in hash passes over NULLs, so a value that moves to an empty column would go
    unseen: which columns are NULL is hashed as well.
    """
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
