"""Pages of layout text, from text files, from PDFs with an outside tool, and back to files."""

from __future__ import annotations

import platform
import shutil
import subprocess
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.text import company_of

FOLDER = "layout_of"  # folders of write_layout()


def read_layout(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(source, page, text): text files of form-feed separated pages, as they come or as write_layout() left them."""
    reader = spark.read.option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("name"), F.regexp_extract(F.col("_metadata.file_path"), f"/{FOLDER}=-([^/]*)/[^/]*$", 1).alias("folder"))
    own = F.col("folder") != ""
    decoded = lambda c: F.url_decode(F.regexp_replace(c, r"\+", "%2B"))  # noqa: E731 - once for the path, once for the folder's name
    source = F.when(own, decoded(decoded("folder"))).otherwise(F.col("name"))
    value = F.when(own, F.regexp_replace("value", r"\n\z", "")).otherwise(F.col("value"))
    return files.select(source.alias("source"), F.posexplode(F.split(value, "\f")).alias("page", "text")).withColumn("page", F.col("page") + 1)


def known_sources(pages: DataFrame, known: list[str], every: bool = False) -> DataFrame:
    """pages with the company of their file's name; files without a known one go, or with `every` are called by their stem. Judged by names, before any text is read."""
    stem = F.upper(F.regexp_replace("source", r"\.[^.]*$", ""))
    out = pages.withColumn("company", company_of("source", known))
    return out.withColumn("company", F.coalesce("company", stem)) if every else out.filter(F.col("company").isNotNull())


def tool_hint(tool: str = "pdftotext") -> str | None:
    """How to get a tool that is missing here, or None if it is there."""
    if shutil.which(tool):
        return None
    how = {"Linux": "install the package poppler-utils", "Darwin": "brew install poppler", "Windows": "unpack a build of poppler and add it to PATH"}
    return f"{tool} is missing: {how.get(platform.system(), 'install poppler')}"


def run_text(command: list[str]) -> str:
    """What a command prints, as UTF-8; '' if it fails or prints nothing."""
    try:
        done = subprocess.run(command, capture_output=True, check=False)
    except OSError:
        return ""
    return (done.stdout or b"").decode("utf-8", "replace")


def read_pdf(spark: SparkSession, path: str, glob: str = "*.pdf", limit: int = 20) -> DataFrame:
    """(source, page, text) of PDFs by pdftotext on the executors; one page of '' where it fails."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("source"), "content")

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["source"], batch["content"], strict=True):
                try:
                    done = subprocess.run(["pdftotext", "-layout", "-enc", "UTF-8", "-l", str(limit), "-", "-"], input=content, capture_output=True, check=False)
                    text = (done.stdout or b"").decode("utf-8", "replace")
                except OSError:
                    text = ""
                parts = text.split("\f")[:limit]
                yield pd.DataFrame({"source": source, "page": range(1, len(parts) + 1), "text": parts})

    return files.mapInPandas(pages, "source string, page int, text string")


def page_count(pages: DataFrame) -> DataFrame:
    return pages.groupBy("source").agg(F.count("*").alias("n_pages"))


def read_images(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    """(source, page, content): page images named by number, in order of the numbers, not of the names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    number = F.regexp_extract("path", r"(\d+)\.[^.]*$", 1).try_cast("int")
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("source"), number.alias("page"), "content").orderBy("page", "source")


def check_writable(spark: SparkSession, path: str) -> None:
    """Fail now if nothing can be written below a path, not after the slow work."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_probe")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(p, True).close()
    fs.delete(p, False)


def write_layout(pages: DataFrame, path: str) -> None:
    """A text file for each source's pages, joined by form feeds, in a folder by source; read_layout() gives the same pages back."""
    check_writable(pages.sparkSession, path)
    joined = pages.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))), lambda p: p["text"]), "\f").alias("value"))
    joined.select(F.concat(F.lit("-"), "source").alias(FOLDER), "value").write.mode("overwrite").partitionBy(FOLDER).option("lineSep", "\n").text(path)


def page_images(spark: SparkSession, path: str, glob: str = "*.pdf", limit: int = 20, dpi: int = 300) -> DataFrame:
    """(source, page, content): PNG images of PDF pages by pdftoppm on the executors; no rows for a file where it fails."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("source"), "content")

    def images(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source, content in zip(batch["source"], batch["content"], strict=True):
                for page in range(1, limit + 1):
                    try:
                        done = subprocess.run(["pdftoppm", "-r", str(dpi), "-f", str(page), "-l", str(page), "-png", "-"], input=content, capture_output=True, check=False)
                    except OSError:
                        break
                    if done.returncode or not done.stdout:
                        break
                    yield pd.DataFrame({"source": [source], "page": [page], "content": [done.stdout]})

    return files.mapInPandas(images, "source string, page int, content binary")
