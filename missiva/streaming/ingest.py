"""Mail files as a stream: an extension of the batch operators for archives that keep growing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missiva.functions.ids import canonical_id
from missiva.sources.eml import parse_files


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of every file that appears below a folder."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(folder)
    return parse_files(files)


def first_deliveries(stream: DataFrame, time_col: str, within: str = "7 days", id_col: str = "message_id") -> DataFrame:
    """Each identifier once within the watermark; the state is bounded by it. Later repeats are the batch operator's."""
    return stream.withColumn("_id", F.coalesce(canonical_id(id_col), F.expr("uuid()"))).withWatermark(time_col, within).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def weekly_counts(stream: DataFrame, time_col: str, late: str = "1 day") -> DataFrame:
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, "7 days")).agg(F.count("*").alias("messages"))
