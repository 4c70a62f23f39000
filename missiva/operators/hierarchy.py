"""Problem 5: parent-child links to full hierarchies.

1. Each row gets its parent, the row of lowest id among those that carry the parent's identifier.
2. Leaves are peeled, round by round, which leaves the loops bare. Peeling stops after
   ``peel_rounds`` rounds; pointer doubling tells the loops from what is left of deep trees, so
   depth costs logarithmically many rounds.
3. Loops are cut: their rows become roots. An Euler tour (an entry and an exit event for each
   row) runs through each tree, and list ranking by pointer doubling gives each event its tree,
   its place and the sum of +1 for entries and -1 for exits. From these follow root, depth and
   the interval of entry and exit, which holds exactly the descendants.

No step gathers a tree, or a parent's children, in one task: siblings are linked within salted
groups first and the groups then in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from missiva.functions.ids import canonical_id
from missiva.session import cut, drop

#: Groups a parent's children are split into to link siblings.
SALTS = 64


def parent_links(df: DataFrame, key: str, id_col: str, parent_col: str) -> DataFrame:
    """``(v, p, named)``: each row, its parent row or null, and whether it names a parent at all."""
    rows = df.select(
        F.col(key).cast("bigint").alias("v"),
        canonical_id(id_col).alias("_id"),
        canonical_id(parent_col).alias("_pid"),
        F.coalesce(F.length(F.regexp_replace(F.col(parent_col), r"(?U)\s+", "")) > 0, F.lit(False)).alias("named"),
    ).filter("v IS NOT NULL")
    owner = rows.filter("_id IS NOT NULL").groupBy(F.col("_id").alias("_own")).agg(F.min("v").alias("p"))
    return rows.drop("_id").join(owner, F.expr("_pid = _own"), "left").select("v", "p", "named")


def _double(lists: DataFrame, done: str, sums: list[str]) -> DataFrame:
    """Pointer doubling over ``(e, nxt, *sums)`` until every ``nxt`` is a list's end (where ``nxt`` is null in its own row).

    sums are added along the way; columns named ``min_...`` take the least instead.
    """
    fold = lambda s, a, b: F.least(a, b) if s.startswith("min_") else a + b
    now, files = lists, None
    for _ in range(64):
        right = now.select(F.col("e").alias("_e"), F.col("nxt").alias("_nxt"), *[F.col(s).alias(f"_{s}") for s in sums])
        step = now.join(right, F.expr("nxt = _e"), "left").select(
            "e",
            F.coalesce("_nxt", "nxt").alias("nxt"),
            *[F.when(F.col("_nxt").isNull(), F.col(s)).otherwise(fold(s, F.col(s), F.col(f"_{s}"))).alias(s) for s in sums],
            (F.col("_nxt").isNotNull()).alias("moved"),
        )
        step = cut(step)
        if files is not None:
            drop(files)
        files, now = step, step.drop("moved")
        if not step.filter("moved").limit(1).count():
            break
    return now


def loops(links: DataFrame, peel_rounds: int = 12) -> DataFrame:
    """``(v, loop)``: the rows on loops with the lowest row of their loop."""
    edges = cut(links.filter("p IS NOT NULL").select("v", "p"))
    left = edges.count()
    for _ in range(peel_rounds):
        if not left:
            break
        inner = edges.select(F.col("p").alias("v")).distinct()
        nodes = edges.join(inner, "v", "left_semi")  # a row that is nobody's parent is a leaf
        # an edge to a row that has no edge itself hangs below a root
        nodes = cut(nodes.join(edges.select(F.col("v").alias("p")).distinct(), "p", "left_semi").select("v", "p"), edges)
        now = nodes.count()
        edges, left, same = nodes, now, now == left
        if same:
            break
    if not left:
        return edges.select("v", F.col("v").alias("loop"))
    # What is left are loops, and middles of trees deeper than the rounds. After as many doublings
    # as cover all of it a row of a tree has run out; the others stand on a loop.
    now, reach, files = edges.select("v", F.col("p").alias("nxt"), F.least("v", "p").alias("low")), 1, edges
    while reach < 2 * left:
        right = now.select(F.col("v").alias("_e"), F.col("nxt").alias("_nxt"), F.col("low").alias("_low"))
        now = files = cut(now.join(right, F.expr("nxt = _e")).select("v", F.col("_nxt").alias("nxt"), F.least("low", "_low").alias("low")), files)
        reach *= 2
    # Every row still there runs into a loop; those that some row arrives at are on it.
    on = now.select(F.col("nxt").alias("v")).distinct()
    return now.join(on, "v", "left_semi").select("v", F.col("low").alias("loop"))


def _tour(forest: DataFrame) -> DataFrame:
    """``(e, nxt, w, steps)``: the events of the Euler tours; row v enters as 2v and leaves as 2v+1."""
    kids = forest.filter("p IS NOT NULL").select("p", "v", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int").alias("s"))
    kids = kids.withColumn("_in", F.lead("v").over(Window.partitionBy("p", "s").orderBy("v")))
    groups = kids.groupBy("p", "s").agg(F.min("v").alias("head"))
    groups = groups.withColumn("_then", F.lead("head").over(Window.partitionBy("p").orderBy("s")))  # at most SALTS rows a parent
    ends = groups.filter("_then IS NOT NULL").select("p", "s", "_then")
    last = kids.filter("_in IS NULL").join(ends, ["p", "s"], "left").select("v", F.coalesce(2 * F.col("_then"), 2 * F.col("p") + 1).alias("nxt"))
    leave = kids.filter("_in IS NOT NULL").select((2 * F.col("v") + 1).alias("e"), (2 * F.col("_in")).alias("nxt")).unionByName(last.select((2 * F.col("v") + 1).alias("e"), "nxt"))
    roots = forest.filter("p IS NULL").select((2 * F.col("v") + 1).alias("e"), F.lit(None).cast("bigint").alias("nxt"))
    first = groups.groupBy("p").agg(F.min_by("head", "s").alias("head"))
    enter = forest.select("v").join(first.withColumnRenamed("p", "v"), "v", "left").select((2 * F.col("v")).alias("e"), F.coalesce(2 * F.col("head"), 2 * F.col("v") + 1).alias("nxt"))
    return enter.select("e", "nxt", F.lit(1).alias("w")).unionByName(leave.unionByName(roots).select("e", "nxt", F.lit(-1).alias("w"))).select("e", "nxt", "w", F.lit(1).cast("bigint").alias("steps"))


def hierarchy(df: DataFrame, key: str = "raw_id", id_col: str = "message_id", parent_col: str = "parent_record_message_id", peel_rounds: int = 12) -> DataFrame:
    """``(v, p, named, root, depth, loop, tree, first, last, descendants)`` of each row.

    depth is 0 for a row without a parent row, and -1 for a row on or below a loop, whose root is
    the lowest row on the loop. ``tree, first, last``: the Euler interval; u is a descendant of v
    where both have the same tree and ``v.first < u.first`` and ``u.last < v.last`` (on loops only
    what hangs below a row counts). Rows with a null key are left out; ids that are null or blank
    are nobody's parent; a row that names its own id is a loop of one. An empty table gives no
    rows. The claims of the data about depth are not read.
    """
    links = cut(parent_links(df, key, id_col, parent_col))
    rings = cut(loops(links, peel_rounds))  # read for the result too
    forest = links.join(rings, "v", "left").select("v", F.when(F.col("loop").isNull(), F.col("p")).alias("p"), F.col("p").alias("p0"), "named", "loop")
    forest = cut(forest, links)  # read for the result too
    tour = cut(_tour(forest))
    ranked = _double(tour.select("e", "nxt", F.when(F.col("nxt").isNull(), 0).otherwise(F.col("w")).cast("bigint").alias("w"), F.when(F.col("nxt").isNull(), 0).otherwise(F.col("steps")).alias("steps")), "nxt", ["w", "steps"])
    # The sums now run up to, not including, the tour's last event, whose weight is -1.
    ranked = ranked.select(F.expr("e div 2").alias("v"), (F.col("e") % 2).alias("out"), F.coalesce(F.expr("nxt div 2"), F.expr("e div 2")).alias("tree"), "w", "steps")
    rows = ranked.groupBy("v").agg(
        F.min("tree").alias("tree"),
        F.max(F.when(F.col("out") == 0, 1 - F.col("w"))).alias("depth"),
        F.max(F.when(F.col("out") == 0, F.col("steps"))).alias("_first"),
        F.max(F.when(F.col("out") == 1, F.col("steps"))).alias("_last"),
    )
    tops = rows.filter("v = tree").select(F.col("v").alias("tree"), F.col("_first").alias("_length"))
    ring_of = rings.select(F.col("v").alias("tree"), F.col("loop").alias("_ring"))
    placed = rows.join(tops, "tree").join(ring_of, "tree", "left")
    return placed.join(forest.select("v", F.col("p0").alias("p"), "named", "loop"), "v").select(
        "v", "p", "named",
        F.coalesce("_ring", "tree").alias("root"),
        F.when(F.col("_ring").isNotNull(), F.lit(-1)).otherwise(F.col("depth")).cast("int").alias("depth"),
        "loop", "tree",
        (F.col("_length") - F.col("_first")).alias("first"),
        (F.col("_length") - F.col("_last")).alias("last"),
        F.expr("(_first - _last - 1) div 2").alias("descendants"),
    )


def with_paths(rows: DataFrame) -> DataFrame:
    """Add ``path``, the rows from the root (or the loop's row) down to the row itself, by doubling."""
    start = rows.select("v", F.when(F.col("loop").isNull(), F.col("p")).alias("up"))
    now = cut(start.select("v", F.col("up").alias("top"), F.when(F.col("up").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("up")).alias("path")))
    while now.filter("top IS NOT NULL").limit(1).count():
        right = now.select(F.col("v").alias("_v"), F.col("top").alias("_top"), F.col("path").alias("_path"))
        now = cut(
            now.join(right, F.expr("top = _v"), "left").select(
                "v", F.col("_top").alias("top"), F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("_path", "path")).alias("path")
            ),
            now,
        )
    return rows.join(now.select("v", F.concat("path", F.array("v")).alias("path")), "v")


def descendant_pairs(rows: DataFrame, kept: Column | None = None) -> DataFrame:
    """``(ancestor, descendant)``, written out from the paths; as many rows as all depths together."""
    paths = with_paths(rows if kept is None else rows.filter(kept))
    return paths.select(F.explode(F.slice("path", 1, F.size("path") - 1)).alias("ancestor"), F.col("v").alias("descendant"))
