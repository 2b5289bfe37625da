"""Picking rows: the only place where one of several rows is chosen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import company_name, skeleton


def filled(columns: list[str]) -> Column:
    """How many of the columns have a value."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def pick_rows(df: DataFrame, keys: tuple[str, ...] = ("company", "concept"), values: list[str] | None = None, score: str | None = "match_score", concept: str = "concept", equal: str | None = None, last: Column | None = None, ordinal: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """One row for each key: rows that `last` holds for come last, then higher scores, then fuller rows, then the order of the input.

    Rows without a concept go before anything else; then, with `equal`, the
    concept for equations takes its place.
    """
    df = df.filter(F.col(concept).isNotNull())
    if "company" in df.columns:
        df = df.withColumn("company", company_name("company"))
    if equal:
        df = df.withColumn(concept, F.coalesce(equal, concept))
    order = [last.cast("int").asc()] if last is not None else []
    order += [F.desc_nulls_last(score)] if score and score in df.columns else []
    order += [filled(values or voc.COLS).desc(), *(F.asc(c) for c in ordinal)]
    return first_by(df, list(keys), order)


def unpivot(df: DataFrame, keys: list[str], values: list[str], name: str = "col", value: str = "value") -> DataFrame:
    """(keys, col, value): a row for each value that is there."""
    return df.unpivot(keys, values, name, value).filter(F.col(value).isNotNull())


def lookup_table(df: DataFrame, values: list[str] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(lut, picked rows): values by company, concept and column; rows of statements of equity come last."""
    options = {"equal": "concept_eq", "last": F.col("statement") == "SE"} | options
    picked = pick_rows(df, values=values, **options)
    return unpivot(picked, ["company", "concept"], values or voc.COLS), picked


def view_rows(df: DataFrame, key: str = "concept", **options) -> DataFrame:
    """One row for each company, statement and concept."""
    return pick_rows(df, ("company", "statement", key), **options)


def first_seen(df: DataFrame, keys: list[str], ordinal: str = "ordinal") -> DataFrame:
    return first_by(df, keys, [F.asc(ordinal)])


def first_filled(df: DataFrame, keys: list[str], values: list[str], pages: str, ordinal: str = "ordinal", section: str | None = None) -> DataFrame:
    """Rows of a key as one: the first value of each column in the order of the input, and the pages of all in that order."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(pages).cast("string").alias("p")))), lambda x: x["p"])
    more = [F.max_by(section, F.when(F.col(section).isNotNull(), F.col(ordinal))).alias(section)] if section else []
    return df.groupBy(*keys).agg(*(first(c) for c in values), F.array_join(listed, ",").alias(pages), *more, F.min(ordinal).alias(ordinal))


def merge_key(concept: str = "concept", item: str = "item_used", chars: str = voc.CONSONANTS) -> Column:
    """A concept, or the label's skeleton marked as none."""
    return F.coalesce(F.col(concept), F.concat(F.lit("~"), skeleton(item, chars)))


def stratified(df: DataFrame, group: str, stratum: str, n: int, strata: int, order: list[Column]) -> DataFrame:
    """Up to n rows of each group, at first max(2, n / strata + 1) of each stratum."""
    each = max(2, n // strata + 1)
    inner = df.withColumn("_r", F.row_number().over(Window.partitionBy(group, stratum).orderBy(*order))).filter(F.col("_r") <= each).drop("_r")
    return inner.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
