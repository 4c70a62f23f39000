"""Places within groups, for groups of any size: a group is spread over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from missiva.session import cut

#: Groups with more rows are numbered across partitions, the rest in windows; the numbers are the same.
HOT_ROWS = 1_000_000


def _partitions(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def numbered(rows: DataFrame, by: str, order: list[Column | str], name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``name``: the place of each row in its group from 1, in an order that leaves no ties.

    Null is a group too. Rows of hot groups are sorted into ranges of (group, order); a row's place
    is its place in its range plus the rows of the group in the ranges before, of which there is
    one number for each range and hot group.
    """
    window = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    sizes = rows.groupBy(by).agg(F.count("*").alias("_size")).filter(F.col("_size") > hot_rows).select(F.col(by).alias("_hot"))
    hot = cut(sizes)  # at most rows / hot_rows groups
    if hot.isEmpty():
        return rows.withColumn(name, window)
    same = F.col(by).eqNullSafe(F.col("_hot"))
    few = rows.join(F.broadcast(hot), same, "left_anti").withColumn(name, window)
    many = rows.join(F.broadcast(hot), same, "left_semi")
    n = _partitions(rows)
    laid = cut(many.repartitionByRange(n, by, *order).sortWithinPartitions(by, *order).withColumn("_at", F.monotonically_increasing_id()))
    counts = laid.groupBy(F.col(by).alias("_by"), F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_by", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_plus"))
    placed = laid.join(F.broadcast(starts), F.col(by).eqNullSafe(F.col("_by")) & (F.shiftright("_at", 33) == F.col("_range")))
    return few.unionByName(placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_at") + F.col("_plus")).cast("int").alias(name)))


def greedy_parts(rows: DataFrame, group: str, order: list[Column | str], size: str, max_size: int, max_rows: int, slices: int | None = None) -> DataFrame:
    """Add ``part`` and ``place``: each group's rows in order, a new part where the next row would exceed a bound.

    A row larger than the bound stands alone; null sizes count 0; null is a group too. The rows lie
    in slices by ranges of (group, order). Where a part begins decides alone where it ends, and a
    part has at most ``max_rows`` rows, so a slice is summed up by what follows from each of its
    first rows as the first beginning of a part: how many parts begin, and where the last one. The
    summaries (bounded for each slice and group) are chained, then each slice is replayed from its
    own start.
    """
    spark = rows.sparkSession
    n = slices or _partitions(rows)
    laid = cut(rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()))
    thin = laid.select(F.shiftright("_at", 33).alias("_slice"), "_at", F.col(group).cast("string").alias("_g"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("_s"))
    thin = thin.repartition("_slice").sortWithinPartitions("_slice", "_at")

    def runs(batches):
        """Slice, group, places and sizes of each run of rows of one group in one slice."""
        now, at, sizes = None, [], []
        for pdf in batches:
            for s, a, g, z in zip(pdf["_slice"].tolist(), pdf["_at"].tolist(), pdf["_g"].tolist(), pdf["_s"].tolist()):
                if now != (s, g):
                    if at:
                        yield now, at, sizes
                    now, at, sizes = (s, g), [], []
                at.append(a)
                sizes.append(z)
        if at:
            yield now, at, sizes

    def ends(sizes, start=0):
        """For each row from which a part may begin, the row at which the next one begins (len: none in the run)."""
        out, total, j = [0] * len(sizes), 0, start
        for i in range(start, len(sizes)):
            if j <= i:
                j, total = i, 0
            while j < len(sizes) and (j == i or (j - i < max_rows and total + sizes[j] <= max_size)):
                total += sizes[j]
                j += 1
            out[i] = j
            total -= sizes[i]
        return out

    names = ["s", "g", "first", "k", "head", "parts", "last", "tail"]

    def summary(s, at, sizes):
        k, nxt = len(sizes), ends(sizes)
        parts, last = [0] * (k + 1), [-1] * (k + 1)
        for i in range(k - 1, -1, -1):
            j = nxt[i]
            parts[i], last[i] = 1 + parts[j], (i if j >= k else last[j])
        head = min(k, max_rows + 1)
        return {"s": s, "first": at[0], "k": k, "head": sizes[:head], "parts": parts[:head], "last": last[:head], "tail": sizes[max(0, k - max_rows) :]}

    def summarise(batches):
        """The first and the last run of each slice; a run between them stands for itself."""
        import pandas as pd

        before = None
        for (s, g), at, sizes in runs(batches):
            if before is None or before[0] != s:
                out = [before[1]] if before and before[1] else []
                yield pd.DataFrame([{**x, "g": h} for x, h in [*out, (summary(s, at, sizes), g)]], columns=names)
                before = s, None
            else:
                before = s, (summary(s, at, sizes), g)
        if before and before[1]:
            yield pd.DataFrame([{**before[1][0], "g": before[1][1]}], columns=names)

    found = thin.mapInPandas(summarise, "s bigint, g string, first bigint, k bigint, head array<bigint>, parts array<bigint>, last array<bigint>, tail array<bigint>")
    # Two rows a slice reach the driver, one after another.
    starts, now, state = [], None, (0, 0, 0)  # of the open part: its number, rows and size
    for r in cut(found).repartitionByRange(1, "s", "first").sortWithinPartitions("s", "first").toLocalIterator():
        if starts and r["g"] == now:
            part, count, total = state
        else:
            now, (part, count, total) = r["g"], (0, 0, 0)
        starts.append((r["first"], part, count, total))
        i = 0
        while i < len(r["head"]) and count and count < max_rows and total + r["head"][i] <= max_size:
            count, total, i = count + 1, total + r["head"][i], i + 1
        if i < r["k"]:  # else the open part goes on beyond the slice
            tail = r["tail"][r["last"][i] - r["k"] :]
            part, count, total = part + r["parts"][i], len(tail), sum(tail)
        state = part, count, total
    begun = spark.createDataFrame(starts, "_first bigint, _part int, _count int, _total bigint") if starts else spark.createDataFrame([], "_first bigint, _part int, _count int, _total bigint")

    def replay(batches):
        import pandas as pd

        part = count = total = 0
        now = object()
        for pdf in batches:
            parts, places = [], []
            for s, g, z, p, c, t in zip(*(pdf[x].tolist() for x in ("_slice", "_g", "_s", "_part", "_count", "_total"))):
                if now != (s, g):  # the first row of a run
                    now = s, g
                    part, count, total = (int(p), int(c), int(t)) if p == p and p is not None else (0, 0, 0)
                if not count or count >= max_rows or total + z > max_size:
                    part, count, total = part + 1, 0, 0
                count, total = count + 1, total + z
                parts.append(part)
                places.append(count)
            yield pd.DataFrame({"_at": pdf["_at"], "part": parts, "place": places})

    sent = thin.join(begun, F.col("_at") == F.col("_first"), "left").select("_slice", "_g", "_at", "_s", "_part", "_count", "_total")
    placed = sent.repartition("_slice").sortWithinPartitions("_slice", "_at").mapInPandas(replay, "_at bigint, part int, place int")
    return laid.join(placed, "_at").drop("_at")
