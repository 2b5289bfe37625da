"""A training-data pipeline over `documents`: five stages, each by one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's docs. All but the last return the
columns of `documents`; texts that a stage changes have their n_chars renewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import common
from tabulon.llm.decontaminate import contaminated, contamination
from tabulon.llm.language_id import NONE, identify, learn
from tabulon.llm.packing import pieces
from tabulon.llm.simhash import near_duplicates
from tabulon.llm.suffix_dedup import suffix_dedup
from tabulon.session import small_batches

#: Workers live on from stage to stage; words that one keeps the results of.
CACHE = 150_000
#: Stands for the languages where no row has a label: all texts with a letter are of it.
UNLABELLED = (("unlabelled", " "),)


def ready(docs: DataFrame) -> DataFrame:
    """docs once the last stage's scratch is gone: its result has been written elsewhere by now."""
    common.release(docs.sparkSession)
    small_batches(docs.sparkSession)
    return docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letters) go; the others' lang becomes the predicted one.

    Languages are learned from the bounded sample of labelled rows that the operator documents.
    Where there is none, every text with a letter stays and lang stays null. Repeated rows and rows
    without an id stay; an empty table stays empty.
    """
    docs = ready(docs)
    samples = learn(docs)
    kept = identify(slim(docs), samples or UNLABELLED, beside=("language", "score")).filter(F.col("language") != NONE)
    return whole(kept, docs, {"lang": F.col("language")} if samples else {})


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns, also those with a dot in their names."""
    return [F.col(f"`{c}`") for c in docs.columns]


def slim(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): the other columns in one, so that no name of theirs clashes with an operator's."""
    others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*others) if others else F.lit(None).cast("string")).alias("rest"))


def whole(df: DataFrame, docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """The columns of docs from a slim() table, some of them renewed."""
    old = lambda c: F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c)
    return df.select(*((new[c].cast(kind) if c in new else old(c)).alias(c) for c, kind in docs.dtypes))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays, and of repeated rows one.

    Of a group in which no document has an id one stays, too: there, hashes of the texts stand for ids.
    Null and empty texts are copies of each other; an empty table stays empty.
    """
    docs = ready(docs)
    groups = near_duplicates(docs)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").select(*columns_of(docs))
    kept = kept.dropDuplicates(["doc_id", "text"]) if common.repeated(docs, "doc_id") else kept
    without_id = docs.filter(F.col("doc_id").isNull())
    if without_id.isEmpty():
        return kept
    (key,) = common.fresh(docs, "key")
    nameless = groups.filter("doc_id IS NULL AND component_id IS NULL").select("fingerprint").distinct()
    own = near_duplicates(by_text(without_id)).filter(F.col("doc_id") == F.col("component_id")).join(nameless, "fingerprint", "left_semi").select(F.col("doc_id").alias(key))
    return kept.unionByName(without_id.join(own.distinct(), F.xxhash64("text") == own[key], "left_semi").dropDuplicates(["text"]))


def by_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a hash of the text as doc_id, for operators that tell rows by it."""
    return docs.select(F.xxhash64("text").alias("doc_id"), "text")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat earlier text go from each document.

    A character of which only a part is covered stays whole; documents of which nothing is left go,
    null and empty texts with them. Of rows with one doc_id (null is one) the later in the order of
    their texts and other columns count as later documents. An empty table stays empty.
    """
    docs = ready(docs)
    changed = suffix_dedup(docs, with_text=True).filter("n_removed > 0").select("doc_id", "sub", F.col("rest").alias("shorter"))
    rows = common.keyed(slim(docs), "text", "rest")
    same = rows.doc_id.eqNullSafe(changed.doc_id) & (rows["sub"] == changed["sub"])
    joined = rows.join(changed, same, "left").select(rows.doc_id, F.coalesce("shorter", "text").alias("text"), "rest", F.col("shorter").isNull().alias("same")).filter(F.length("text") > 0)
    return whole(joined, docs, {"n_chars": F.when(F.col("same"), F.col("rest").getField("n_chars")).otherwise(F.length("text"))} if "n_chars" in docs.columns else {})


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule holds for go.

    Rows without an id are told apart by their texts; null and empty texts and repeated rows stay,
    and an empty table or benchmark takes nothing away.
    """
    docs = ready(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = contamination(docs, benchmark).filter(contaminated()).select("doc_id").distinct()
    kept = docs.join(bad, "doc_id", "left_anti").select(*columns_of(docs))
    without_id = docs.filter(F.col("doc_id").isNull())
    if without_id.isEmpty():
        return kept
    (key,) = common.fresh(docs, "key")
    bad = contamination(by_text(without_id), benchmark).filter(contaminated()).select(F.col("doc_id").alias(key)).distinct()
    return kept.filter(F.col("doc_id").isNotNull()).unionByName(without_id.join(bad, F.xxhash64("text") == bad[key], "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 4096 ids.

    Every row is packed for itself, repeated ones and those without an id too; a null text is its
    end alone, a null source a source of its own. An empty table gives no pieces.
    """
    import public_tokenizers

    return pieces(ready(docs), public_tokenizers.path("word_bpe_49k.json"), ids=False, cache=CACHE)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_array_dedup", suffix_array_dedup), ("benchmark_decontamination", benchmark_decontamination), ("packing", packing)]
#: No SQL can express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            path = f"{common.shared_dir(spark)}/pipeline-{common.uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if kept:
                common.delete(spark, kept)
            kept = path
    return docs
