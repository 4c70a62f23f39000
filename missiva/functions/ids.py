"""Message identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_id(c: Column | str) -> Column:
    """Lower case, without outer white space and angle brackets; null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(F.lower(c), r"(?U)^[\s<>]+|[\s<>]+$", "")
    return F.when(F.length(bare) > 0, bare)
