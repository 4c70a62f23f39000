"""Problem 4: messages delivered more than once.

The rows are laid into time buckets by arrival. Each bucket has a Bloom filter, kept as rows
``(bucket, word, bits)``: an identifier sets ``HASHES`` bits in one 64-bit word, so a bucket's
filter is built by ``bit_or`` with partial aggregation and is never in one place. An identifier
that no filter holds besides its own row's entry is new for certain. The others are verified
exactly, by identifier, and only they pass the second shuffle.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missiva.functions.ids import canonical_id

#: Bits set for each identifier in its word, and words for each row of a bucket.
HASHES, WORDS_PER_ROW = 3, 8


def _mask(h: Column) -> Column:
    """``HASHES`` bits of a 64-bit word, taken from the higher bits of the hash."""
    mask = F.lit(0).cast("bigint")
    for k in range(HASHES):
        place = F.shiftrightunsigned(h, 40 + 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def _keyed(df: DataFrame, id_col: str, order_col: str, time_col: str, words: int) -> DataFrame:
    h = F.xxhash64("_id")
    return df.select(
        F.col(order_col).cast("bigint").alias("_seq"),
        canonical_id(id_col).alias("_id"),
        F.coalesce(F.date_format(F.col(time_col), "yyyyMM").cast("int"), F.lit(0)).alias("_bucket"),
    ).filter("_id IS NOT NULL AND _seq IS NOT NULL").select("*", F.pmod(h, F.lit(words)).alias("_word"), _mask(h).alias("_mask"))


def bucket_filters(keyed: DataFrame) -> DataFrame:
    """The Bloom filters: one row for each word in use of each time bucket."""
    return keyed.groupBy("_word", "_bucket").agg(F.bit_or("_mask").alias("_bits"), F.count("*").alias("_n"))


def possible_repeats(keyed: DataFrame) -> DataFrame:
    """The rows whose identifier another row may hold, by the filters alone.

    A row is screened out when its own bucket holds nothing else in its word and no other bucket
    holds all its bits. Rows of one identifier always pass together.
    """
    words = bucket_filters(keyed).groupBy("_word").agg(
        F.sum("_n").alias("_rows"),
        F.collect_list(F.struct("_bucket", "_bits", "_n")).alias("_filters"),  # at most one entry a time bucket
    )
    crowded = words.filter("_rows > 1").drop("_rows")
    hit = F.exists(
        "_filters",
        lambda f: F.when(f["_bucket"] == F.col("_bucket"), f["_n"] > 1).otherwise(f["_bits"].bitwiseAND(F.col("_mask")) == F.col("_mask")),
    )
    return keyed.join(crowded, "_word").filter(hit).select("_seq", "_id", "_bucket")


def surplus_rows(df: DataFrame, id_col: str = "message_id", order_col: str = "ingest_seq", time_col: str = "received_at", words: int = 1 << 34) -> DataFrame:
    """``(ingest_seq_a, ingest_seq_b)``: each surplus row b with the first row a of its identifier.

    Ids that differ in case, outer white space or angle brackets are one id. Rows with a null or
    empty id, or without an order number, are never cases; a row repeated with the same order
    number is no case against itself. An empty table gives an empty result. Columns of the input
    may have any further names.

    words: the words of each time bucket's filter. Only words in use exist, so a large number
    costs nothing; it should exceed the rows of a bucket ``WORDS_PER_ROW`` times.
    """
    maybe = possible_repeats(_keyed(df, id_col, order_col, time_col, words))
    first = maybe.groupBy("_id").agg(F.min("_seq").alias("_a"), F.max("_seq").alias("_z")).filter("_a < _z").drop("_z")
    return (
        maybe.select("_seq", "_id")
        .join(first, "_id")
        .filter("_seq > _a")
        .select(F.col("_a").alias("ingest_seq_a"), F.col("_seq").alias("ingest_seq_b"))
    )


def mark_deliveries(df: DataFrame, id_col: str = "message_id", order_col: str = "ingest_seq", record_col: str = "record_id", time_col: str = "received_at") -> DataFrame:
    """All rows, with ``is_duplicate`` and ``duplicate_of`` (the kept row's record id) set anew.

    Exactly one row of each identifier keeps ``is_duplicate = false``; rows without an identifier
    are kept as they are no copies of anything.
    """
    pairs = surplus_rows(df, id_col, order_col, time_col)
    names = df.select(F.col(order_col).cast("bigint").alias("ingest_seq_a"), F.col(record_col).alias("_of"))
    told = pairs.join(names, "ingest_seq_a").select(F.col("ingest_seq_b").alias("_b"), "_of", F.lit(True).alias("_dup"))
    kept = [c for c in df.columns if c not in ("is_duplicate", "duplicate_of")]
    out = df.select(*[F.col(f"`{c}`") for c in kept])
    return out.join(told, F.col(f"`{order_col}`").cast("bigint") == F.col("_b"), "left").select(
        *[F.col(f"`{c}`") for c in kept], F.coalesce("_dup", F.lit(False)).alias("is_duplicate"), F.col("_of").alias("duplicate_of")
    )


class DeliveryStore:
    """Identifiers seen so far, for batches that arrive one after another.

    In the shared folder each batch has a folder of its own with two tables, ``ids`` partitioned by
    time bucket, and ``filters``, the Bloom words of each bucket; a batch counts from the moment
    its mark lies in ``done``, which is made last and in one step. A batch whose addition fails
    leaves nothing that counts and can be added again. A folder that cannot be read is an error. A
    batch is screened with the filters; only possible repeats are compared with the identifiers,
    and only in the buckets whose filter matched.
    """

    def __init__(self, spark, path: str, words: int = 1 << 34):
        self.spark, self.path, self.words = spark, path.rstrip("/"), words

    def _files(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def batches(self) -> list[str]:
        """The batches that count."""
        fs, path = self._files(f"{self.path}/done")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _read(self, name: str, schema: str) -> DataFrame:
        known = [f"{self.path}/batches/{b}/{name}" for b in self.batches()]
        tables = [self.spark.read.option("basePath", p).schema(schema).parquet(p) for p in known]
        return reduce(DataFrame.unionByName, tables) if tables else self.spark.createDataFrame([], schema)

    def add(self, batch: DataFrame, id_col: str = "message_id", order_col: str = "ingest_seq", time_col: str = "received_at") -> DataFrame:
        """Pairs as in ``surplus_rows`` for this batch against itself and all batches before."""
        from missiva.session import cut

        keyed = cut(_keyed(batch, id_col, order_col, time_col, self.words))
        inside = possible_repeats(keyed).groupBy("_id").agg(F.min("_seq").alias("_a"))
        filters = self._read("filters", "_word bigint, _bits bigint, _bucket int")
        ids = self._read("ids", "_seq bigint, _id string, _bucket int")
        matched = keyed.join(filters.withColumnRenamed("_bucket", "_in"), "_word").filter("_bits & _mask = _mask").select("_id", "_in").distinct()
        old = ids.join(matched.withColumnRenamed("_id", "_known"), F.expr("_bucket = _in AND _id = _known")).select("_id", "_seq")
        before = cut(old.groupBy("_id").agg(F.min("_seq").alias("_old")))
        firsts = keyed.select("_seq", "_id").join(inside, "_id", "left").join(before, "_id", "left")
        pairs = cut(firsts.select(F.coalesce("_old", "_a", "_seq").alias("ingest_seq_a"), F.col("_seq").alias("ingest_seq_b")).filter("ingest_seq_a < ingest_seq_b"))
        fresh = keyed.join(before, "_id", "left_anti").groupBy("_id").agg(F.min("_seq").alias("_seq"), F.min("_bucket").alias("_bucket"), F.min("_word").alias("_word"), F.min("_mask").alias("_mask"))
        self._commit(cut(fresh, keyed))
        return pairs

    def _commit(self, fresh: DataFrame) -> None:
        name = uuid.uuid4().hex
        fresh.select("_seq", "_id", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/batches/{name}/ids")
        fresh.groupBy("_word", "_bucket").agg(F.bit_or("_mask").alias("_bits")).write.partitionBy("_bucket").parquet(f"{self.path}/batches/{name}/filters")
        fs, mark = self._files(f"{self.path}/done/{name}")
        fs.mkdirs(mark)
