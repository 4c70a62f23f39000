"""Problem 9: a mix of sources with target shares of the tokens.

Distinct texts of a source are laid into blocks by a hash, and a block's tokens are summed. From
the sums follow the size of the mix and each source's quota: whole passes over the source and one
partial pass that ends inside a block. The exact block quotas of all sources are then split among
output shards by a tree of multivariate hypergeometric draws, each leaf gets disjoint permuted
blocks, and each shard is shuffled within itself. The driver sees sums by block only: sources x
blocks numbers, whatever the corpus has.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from missiva.llm.tokens import TOKENIZER_DIR, blank, with_ids

#: Blocks a source is laid into, and parts a cut block is laid into; tokens that a shard is to hold, and a task of it.
BLOCKS, SHARD_TOKENS, TASK_TOKENS = 1024, 1 << 30, 1 << 25
#: A plan of more rows is joined by a shuffle instead of sent to all executors.
PLAN_ROWS = 200_000


def split_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Exact counts of each source for each shard, by halving: one multivariate hypergeometric draw at each node."""
    if shards == 1:
        return [counts]
    left, total = shards // 2, int(counts.sum())
    take = int(round(total * left / shards))
    drawn = rng.multivariate_hypergeometric(counts, take) if total else np.zeros_like(counts)
    return split_tree(drawn, left, rng) + split_tree(counts - drawn, shards - left, rng)


def _sized(docs: DataFrame, targets: DataFrame, seed: int, name: str, folder: str, blocks: int) -> DataFrame:
    """``(source, doc_id, tokens, h, block)`` of the first document of each distinct text of a source of the targets."""
    have = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source"), F.col("text")).filter(~blank(F.col("text")) & F.col("source").isNotNull() & F.col("doc_id").isNotNull())
    have = have.join(targets.select("source").distinct(), "source", "left_semi")
    sized = with_ids(have, "text", "tokens", name, folder, count_only=True).select("source", "doc_id", "tokens", F.sha2("text", 256).alias("_key"))
    first = sized.groupBy("source", "_key").agg(F.min("doc_id").alias("doc_id"), F.min("tokens").cast("bigint").alias("tokens"))
    h = F.xxhash64(F.lit(seed), F.col("_key"))
    return first.select("source", "doc_id", "tokens", h.alias("h"), F.pmod(h, F.lit(blocks)).cast("int").alias("block"))


def plan_quotas(sums: dict[str, float], targets: list[tuple[str, float, int]], total: float | None = None) -> dict[str, float]:
    """Tokens of each source: the largest mix (or ``total``) that no source's cap stands against.

    Sources without tokens, share or repeats get nothing, and the others' shares stand as given.
    """
    live = [(s, w, r) for s, w, r in targets if w and w > 0 and r and r > 0 and sums.get(s, 0) > 0]
    if not live:
        return {}
    room = min(sums[s] * r / w for s, w, r in live)
    size = room if total is None else min(total, room)
    return {s: w * size for s, w, _ in live}


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, shards: int | None = None, seed: int = 20, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, blocks: int = BLOCKS) -> DataFrame:
    """``(source, doc_id, repeat, tokens, shard, position)``: one row for each text in the mix.

    targets: ``(source, target_share, max_repeats)``, at most a few thousand sources. Each distinct
    text of a source appears at most ``max_repeats`` times (repeat counts from 0); of documents
    with the same text the lowest ``doc_id`` stands for all. Documents of other sources, without a
    source, id or text are left out. A source's tokens miss its quota by less than half a text
    plus rounding. Empty tables give an empty mix. shards: by default as many as the mix has
    ``SHARD_TOKENS``, 16 at least; a large shard lies in several tasks, in ranges of its order.
    """
    from missiva.session import cut

    spark = docs.sparkSession
    goal = [(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).filter("source IS NOT NULL").orderBy("source").collect()]
    rows = cut(_sized(docs, targets, seed, name, folder, blocks))
    sums = {(r.source, r.block): int(r.tokens) for r in rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).collect()}  # sources x blocks
    whole: dict[str, int] = {}
    for (s, _), t in sums.items():
        whole[s] = whole.get(s, 0) + t
    quotas = plan_quotas(whole, goal, total)
    # Each source: all blocks in every whole pass, then blocks in an order of its own until one is cut.
    rng = np.random.default_rng(seed)
    taken: list[tuple[str, int, int, int]] = []  # source, repeat, block, tokens to take (-1: all)
    for s in sorted(quotas):
        own = [b for b in range(blocks) if (s, b) in sums]
        passes, rest = divmod(int(round(quotas[s])), whole[s])
        for k in range(passes):
            taken += [(s, k, b, -1) for b in own]
        for b in rng.permutation(own) if rest else ():
            t = sums[s, int(b)]
            taken.append((s, passes, int(b), -1 if t <= rest else rest))
            rest -= t
            if rest <= 0:
                break
    size = sum(min(quotas[s], float(whole[s]) * 2**31) for s in quotas)
    shards = shards or max(16, -int(-size // SHARD_TOKENS))
    # Block quotas among shards, and the blocks themselves in a permuted order.
    names = sorted(quotas)
    by_source = {s: [t for t in taken if t[0] == s] for s in names}
    leaves = split_tree(np.array([len(by_source[s]) for s in names], dtype=np.int64), shards, rng)
    placed = []
    for i, s in enumerate(names):
        order = [by_source[s][int(j)] for j in rng.permutation(len(by_source[s]))]
        at = 0
        for shard, leaf in enumerate(leaves):
            placed += [(*x, shard) for x in order[at : at + int(leaf[i])]]
            at += int(leaf[i])
    plan = spark.createDataFrame(placed, "source string, repeat int, block int, upto bigint, shard int")  # sources x blocks x repeats rows
    joined = rows.join(F.broadcast(plan) if len(placed) <= PLAN_ROWS else plan, ["source", "block"])
    inside = joined.filter("upto < 0")
    # The one cut block of a source is laid into parts of its own; the parts are taken in order, whole until one is cut,
    # and only that one is summed up row by row, in hash order; a text that crosses the quota by less than half stays.
    edge = joined.filter("upto >= 0").withColumn("_part", F.pmod(F.xxhash64(F.lit(seed + 2), "h"), F.lit(blocks)).cast("int"))
    parts = edge.groupBy("source", "block", "repeat", "_part").agg(F.sum("tokens").alias("_tokens"))  # one block a source: sources x blocks rows
    before = Window.partitionBy("source", "block", "repeat").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_tokens").over(before), F.lit(0))).select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "_before", "_tokens")
    edge = edge.join(parts, (F.col("source") == F.col("_s")) & (F.col("_part") == F.col("_p"))).filter("_before < upto")
    order = Window.partitionBy("source", "block", "repeat", "_part").orderBy("h", "doc_id")
    taken_whole = edge.filter("_before + _tokens <= upto")
    last = edge.filter("_before + _tokens > upto").withColumn("_sum", F.col("_before") + F.sum("tokens").over(order)).filter("_sum - tokens / 2 <= upto")
    edge = taken_whole.select(*joined.columns).unionByName(last.select(*joined.columns))
    out = inside.unionByName(edge).withColumn("_at", F.xxhash64(F.lit(seed + 1), "h", "repeat"))
    tasks = max(shards, -int(-size // TASK_TOKENS))
    return out.repartitionByRange(tasks, "shard", "_at").sortWithinPartitions("shard", "_at").select("source", "doc_id", "repeat", "tokens", "shard", F.col("_at").alias("position"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, actual_share, tokens, texts, most_repeats)`` of each target source."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("texts"), (F.max("repeat") + 1).alias("most_repeats"))
    want = targets.groupBy("source").agg(F.sum("target_share").alias("target_share"))
    both = want.join(got, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = F.sum("tokens").over(Window.partitionBy())  # one row for each source of the targets
    return both.select("source", "target_share", F.when(total > 0, F.col("tokens") / total).otherwise(F.lit(0.0)).alias("actual_share"), "tokens", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
