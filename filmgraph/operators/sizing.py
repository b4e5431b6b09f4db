"""Size-checked broadcast.

Catalyst estimates a filtered or aggregated plan at the size of its input unless table statistics
exist, so a handful of keys derived from a 100 TB table is planned as if it were 100 TB: a
sort-merge join that shuffles the big side. Adaptive execution can switch to a broadcast only
after both sides' shuffles have already run. Where a small side feeds a join with a big table,
the library therefore proves its size first:

* a side built from an explicit list of keys has a known bound (the list length);
* otherwise the side is written to the shared checkpoint folder and counted (one pass over a
  result that is small in the cases that matter; it also cuts the lineage).

Within ``limit`` rows and ``BROADCAST_BYTE_LIMIT`` bytes the side is broadcast - the big side is streamed, never shuffled, and a hot
key cannot skew anything. Beyond it the join is left to a shuffled sort-merge join, with AQE's
skew splitting for hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session

# Rows of narrow key columns (bigint/short strings): at most a few tens of MB per executor.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 64 << 20


@dataclass
class Sized:
    df: DataFrame
    rows: int | None          # proven upper bound on the row count, None if unknown
    width: int = 0            # measured bytes, 0 for lists of keys (bounded by their length)


def materialize(df: DataFrame) -> Sized:
    """Checkpoint ``df`` to the shared folder, count its rows and add up their bytes."""
    return measure(checkpoint(df))


def measure(df: DataFrame) -> Sized:
    """Count the rows of a stored table and add up their bytes."""
    rows, width = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return Sized(df, rows, int(width))


def _row_bytes(df: DataFrame):
    """Bytes of a row: text by its length, arrays and structs by their text, 8 for the rest."""
    total = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind in ("array", "struct", "map"):
            total = total + F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
        else:
            total = total + 8
    return total


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy."""
    session.checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ensure_bound(side: Sized) -> Sized:
    return side if side.rows is not None else materialize(side.df)


def for_join(side: Sized, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """The side itself, hinted for broadcast when its proven size is within ``limit``."""
    side = ensure_bound(side)
    small = side.rows <= limit and side.width <= BROADCAST_BYTE_LIMIT
    return F.broadcast(side.df) if small else side.df
