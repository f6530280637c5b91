"""Text keys as the database compares them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000         # rows up to which a code table is broadcast
_UNKNOWN_BYTES = 1 << 42    # the planner's estimate of a relation of unknown size is beyond this


def text_key(c: Column) -> Column:
    """The collation key of a text: two texts are equal to the database iff
    their keys are.  It ignores trailing blanks, so ``'LN1 '`` meets ``'LN1'``
    and ``'  '`` meets ``''``; leading blanks, tabs and case count.  Null
    stays null.  As an ordinary expression it serves hash joins, aggregates
    and runtime filters alike."""
    return F.rtrim(c.cast("string"))


def blank_key(c: Column) -> Column:
    """``COALESCE(c, '')`` compared so: missing, empty and blank are one key."""
    return F.coalesce(text_key(c), F.lit(""))


def broadcast_small(codes: DataFrame) -> DataFrame:
    """A code table, marked for broadcast if it is small.

    Where the planner knows its size (inline rows, files) that is left to the
    planner; a table of unknown size (a remote relation) is counted up to
    ``SMALL_ROWS`` rows, and beyond them joined like any other."""
    known = int(codes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if known < _UNKNOWN_BYTES:
        return codes
    return F.broadcast(codes) if codes.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else codes
