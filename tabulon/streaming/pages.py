"""Page-local operators over a stream of layout files: they hold no state, so a stream runs them as it stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.text import detect_unit, page_kind


def stream_pages(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """(source, page, text) of layout files as they arrive."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", per_trigger).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("source"), F.posexplode(F.split(F.decode("content", "UTF-8"), "\f")).alias("page", "text")).withColumn("page", F.col("page") + 1)


def classified(pages: DataFrame) -> DataFrame:
    """Kind and unit of each page; the fallback for whole files needs all their pages and stays with the batch job."""
    return pages.withColumn("kind", page_kind("text")).withColumn("unit", detect_unit("text"))
