"""Audits of facts and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.operators.select import filled


def fill_mode(df: DataFrame, column: str, unknown: str = "unknown", by: list[str] | None = None, override: str | None = None) -> DataFrame:
    """Unknown values become the most frequent known one of their group or of all rows, the least at a tie; an override sets all."""
    if override is not None:
        return df.withColumn(column, F.lit(override))
    known = df.filter(F.col(column).isNotNull() & (F.col(column) != unknown))
    n = known.groupBy(*(by or []), column).agg(F.count("*").alias("_n"))
    if by:
        best = n.groupBy(*by).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias("_mode"))
        out = df.join(best, by, "left")
    else:
        best = n.agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias("_mode"))
        out = df.crossJoin(F.broadcast(best))  # one row
    return out.withColumn(column, F.when(F.col(column) == unknown, F.coalesce("_mode", column)).otherwise(F.col(column))).drop("_mode")


def still_unknown(df: DataFrame, column: str, name: str, unknown: str = "unknown") -> DataFrame:
    return df.filter(F.col(column) == unknown).select(name).distinct().orderBy(name)


def mixed(df: DataFrame, key: str, column: str, ordinal: str = "ordinal") -> DataFrame:
    """(key, n, first) of keys with several values of a column."""
    return df.groupBy(key).agg(F.count_distinct(column).alias("n"), F.min_by(column, ordinal).alias("first")).filter("n > 1")


def conflicts(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, n) of keys with several rows that don't agree in their values, NULL agreeing with NULL."""
    row = F.struct(*(F.bround(F.col(c).cast("double"), 4).alias(c) for c in values))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.size(F.collect_set(row)).alias("n_distinct")).filter("n >= 2 and n_distinct > 1")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def cells_filled(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(filled(columns)).alias("n_filled"), (F.count("*") * len(columns)).alias("n_cells"))


def missing_values(df: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """Values of a list that the column never has."""
    every = df.sparkSession.createDataFrame([(w,) for w in wanted], f"{column} string")
    return every.join(df.select(column).distinct(), column, "left_anti").orderBy(column)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def known_only(df: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a known key, and the others' keys."""
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti").select(key).distinct()


def gate(df: DataFrame, pages: DataFrame, verdict: DataFrame, strong: str = "title") -> DataFrame:
    """One row of signals whether an extraction can be trusted, each with its threshold, and all of them together.

    df: facts (concept, unit, statement); pages (page_how); verdict (verdict).
    """
    facts = df.agg(F.coalesce(F.avg(F.col("concept").isNotNull().cast("double")), F.lit(0.0)).alias("mapped"), F.max((F.col("statement") == "BS").cast("int")).alias("_bs"), F.max((F.col("unit") == "unknown").cast("int")).alias("_u"))
    seen = pages.agg(F.coalesce(F.avg((F.col("page_how") == strong).cast("double")), F.lit(0.0)).alias("strong"))
    checked = verdict.agg(F.sum((F.col("verdict") == "pass").cast("int")).alias("n_pass"), F.sum((F.col("verdict") == "fail").cast("int")).alias("n_fail"))
    one = facts.crossJoin(seen).crossJoin(checked)  # one row each
    signal = {
        "mapped_ok": F.col("mapped") >= 0.5,
        "pages_ok": F.col("strong") >= 0.5,
        "balance_ok": F.coalesce(F.col("_bs") == 1, F.lit(False)),
        "equations_ok": F.coalesce((F.col("n_pass") >= 1) & (F.col("n_fail") == 0), F.lit(False)),
        "unit_ok": F.coalesce(F.col("_u") == 0, F.lit(False)),
    }
    every = F.lit(True)
    for c in signal.values():
        every = every & c
    return one.select("mapped", "strong", "n_pass", "n_fail", *(c.alias(k) for k, c in signal.items()), every.alias("passed"))


def share_bucket(share) -> Column:
    s = F.col(share) if isinstance(share, str) else share
    return F.when(s >= 0.6, "good").when(s >= 0.4, "fair").otherwise("poor")


def multiset(hit: DataFrame, against: DataFrame, key: list[str], token: str) -> DataFrame:
    """(key, n_hit, n_extra): tokens of `hit` that `against` has too, each as often as in both, and the rest."""
    count = lambda df, name: df.groupBy(*key, token).agg(F.count("*").alias(name))
    both = count(hit, "a").join(count(against, "b"), [*key, token], "left")
    n = F.least("a", F.coalesce("b", F.lit(0)))
    return both.groupBy(*key).agg(F.sum(n).alias("n_hit"), F.sum(F.col("a") - n).alias("n_extra"))


def upper_median(column: str) -> Column:
    """The middle value, the upper one of two."""
    listed = F.array_sort(F.collect_list(column))
    return F.get(listed, F.floor(F.size(listed) / 2).cast("int"))


def agreement(a: DataFrame, b: DataFrame, keys: list[str], tol: float = voc.AGREE_TOL) -> DataFrame:
    """(n, n_agree) of keys that two lookup tables share."""
    met = a.select(*keys, F.col("value").alias("x")).join(b.select(*keys, F.col("value").alias("y")), keys)
    return met.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.abs(F.col("x") - F.col("y")) <= tol).cast("int")), F.lit(0)).alias("n_agree"))


def first_rows(df: DataFrame, partition: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
