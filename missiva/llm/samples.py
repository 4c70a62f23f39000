"""Bounded reads for the driver that stay bounded however many partitions there are.

An ordered limit lets every task send as many rows as the limit; these do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FINE = 1 << 30


def hash_sample(df: DataFrame, rows: int, *keys: Column | str) -> DataFrame:
    """About ``rows`` rows, drawn by a hash of their keys; all rows of a smaller table.

    The same rows are drawn whatever the partitioning. The number is bounded by twice ``rows``.
    """
    total = df.count()
    if total <= rows:
        return df
    place = F.pmod(F.xxhash64(F.lit(11), *keys), F.lit(_FINE))
    return df.filter(place < int(_FINE * rows / total)).limit(2 * rows)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of ``counts`` with the highest ``n``, at most ``most``: all from the least count that still fits.

    The cut comes from a histogram of the counts, so no sort and no ordered limit is needed.
    """
    left, cut = most, None
    for r in counts.groupBy(F.col(n).alias("_n")).agg(F.count("*").alias("_rows")).orderBy(F.desc("_n")).toLocalIterator():
        if r["_rows"] > left:
            break
        left, cut = left - r["_rows"], r["_n"]
    return counts.filter(F.col(n) >= cut) if cut is not None else hash_sample(counts, most // 2, *counts.columns)


def split_by_frequency(counts: DataFrame, n: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``counts`` with the highest ``n``, at most ``most``, and all others, None where there are none.

    Rows of equal ``n`` stay together.
    """
    if counts.count() <= most:
        return counts, None
    left, cut = most, None
    for r in counts.groupBy(F.col(n).alias("_n")).agg(F.count("*").alias("_rows")).orderBy(F.desc("_n")).toLocalIterator():
        if r["_rows"] > left:
            break
        left, cut = left - r["_rows"], r["_n"]
    return (counts.filter(F.col(n) >= cut), counts.filter(F.col(n) < cut)) if cut is not None else (counts.limit(0), counts)


def most_frequent_by(counts: DataFrame, by: str, n: str, most: int) -> DataFrame:
    """The same for each value of ``by``, of which there are few: at most ``most`` rows of each."""
    left, cut = {}, {}
    for r in counts.groupBy(F.col(by).alias("_by"), F.col(n).alias("_n")).agg(F.count("*").alias("_rows")).orderBy(F.desc("_n")).toLocalIterator():
        have = left.get(r["_by"], most)
        if have is not None and r["_rows"] <= have:
            left[r["_by"]], cut[r["_by"]] = have - r["_rows"], r["_n"]
        else:
            left[r["_by"]] = None
            if r["_by"] not in cut:  # the first class alone is too large: part of it, by a hash
                cut[r["_by"]] = r["_n"], most / r["_rows"]
    keep = F.lit(False)
    for value, at in cut.items():
        least = F.col(n) >= at if not isinstance(at, tuple) else (F.col(n) == at[0]) & (F.pmod(F.xxhash64(F.lit(11), *counts.columns), F.lit(_FINE)) < int(0.9 * _FINE * at[1]))
        keep = keep | (F.col(by).eqNullSafe(F.lit(value)) & least)
    return counts.filter(keep)
