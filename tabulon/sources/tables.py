"""CSV tables with a byte order mark, by explicit schemas; results are written as Parquet, and as CSV for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabulon import schemas
from tabulon import vocabulary as voc
from tabulon.functions.text import company_name, to_number

BOM = "\ufeff"


WIDTH = 64  # columns that a file may have


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns by the names in each file's own header, whatever their order there; those that a file lacks are NULL. With the file and the line's place in it as `ordinal`."""
    cells = [f"_c{i}" for i in range(WIDTH)]
    raw = spark.read.schema(", ".join(f"{c} string" for c in cells)).option("multiLine", True).option("escape", '"').csv(path)
    place = Window.partitionBy("_file").orderBy("_line")
    lines = raw.select(F.array(*cells).alias("_v"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("_line"))
    lines = lines.withColumn("_h", F.first("_v").over(place)).withColumn("ordinal", F.row_number().over(place) - 2).filter("ordinal >= 0")
    at = F.transform("_h", lambda x: F.trim(F.regexp_replace(x, BOM, "")))

    def column(name: str) -> Column:
        i = F.array_position(at, name)
        return F.when(i > 0, F.get("_v", i.cast("int") - 1))

    return lines.select(*(column(f.name).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields), "file", "ordinal")


def read_alias(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ALIAS)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Truth rows with their values as numbers and the word 'nan' of notes as NULL."""
    rows = read_csv(spark, path, schemas.TRUTH).withColumn("company", company_name("company"))
    return rows.withColumns({c: to_number(c) for c in voc.COLS}).withColumn("_note", F.nullif("_note", F.lit("nan")))


def read_extracted(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.EXTRACTED)


def write_table(df: DataFrame, path: str, csv: bool = False) -> None:
    """df under `path`, replacing what was there; without rows nothing is written and an error raised. CSV files begin with a byte order mark."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no rows to write to {path}")
    if csv:
        first, *rest = df.columns
        df.select(F.col(f"`{first}`").alias(BOM + first), *(f"`{c}`" for c in rest)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def first_existing(spark: SparkSession, candidates: list[str], explicit: str | None = None, marker: str | None = None) -> str:
    """The explicit path, or the first candidate that exists and holds the marker; any file system."""
    if explicit:
        return explicit
    path = spark._jvm.org.apache.hadoop.fs.Path
    for c in candidates:
        p = path(f"{c}/{marker}" if marker else c)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return c
    raise FileNotFoundError(f"none of {candidates} exists")
