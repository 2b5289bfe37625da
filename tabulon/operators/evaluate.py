"""Extracted values against truth: cells, accuracy, coverage, and what the truth itself can detect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import cell_status, same


def cells(truth: DataFrame, picked: DataFrame, keys: list[str], values: list[str] | None = None, keep: list[str] | None = None, tol: float = voc.CELL_TOL) -> DataFrame:
    """(keys, keep, col, want, have, status): a row for each value column of each truth row; picked is unique by keys."""
    cols = values or voc.COLS
    right = picked.select(*keys, F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in cols))
    met = truth.join(right, keys, "left")
    each = F.array(*(F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("want"), F.col(f"_{c}").cast("double").alias("have")) for c in cols))
    out = met.select(*keys, *(keep or []), F.coalesce("_there", F.lit(False)).alias("_there"), F.explode(each).alias("c")).select(*keys, *(keep or []), "_there", "c.*")
    return out.withColumn("status", cell_status("want", "have", "_there", tol)).drop("_there")


def ok() -> Column:
    return F.col("status").isin("ok", "ok_empty")


def accuracy(found: DataFrame, by: str | None = None, half_even: bool = True) -> DataFrame:
    """n_ok, n, pct in all or by a column without its NULLs, the worst first."""
    good = F.sum(ok().cast("int"))
    n = F.count("*")
    pct = (F.bround if half_even else F.round)(100.0 * good / n, 1)
    if by is None:
        return found.agg(good.alias("n_ok"), n.alias("n"), pct.alias("pct"))
    return found.filter(F.col(by).isNotNull()).groupBy(by).agg(good.alias("n_ok"), n.alias("n"), pct.alias("pct")).orderBy("pct", by)


def coverage(truth: DataFrame, found: DataFrame, concept: str = "concept") -> DataFrame:
    """coverage, accuracy and their product; zero where there is nothing."""
    mapped = truth.agg(F.coalesce(F.avg(F.col(concept).isNotNull().cast("double")), F.lit(0.0)).alias("coverage"))
    right = found.agg(F.coalesce(F.avg(ok().cast("double")), F.lit(0.0)).alias("accuracy"))
    return mapped.crossJoin(right).withColumn("weighted", F.col("coverage") * F.col("accuracy"))  # one row each


def histogram(found: DataFrame, column: str = "status") -> DataFrame:
    return found.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def mismatches(found: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n cells that aren't right."""
    return found.filter(~ok()).orderBy(*order).limit(n)


def opening_rows(matrix: DataFrame, page: list[str], kind: str = "kind", index: str = "row_index") -> DataFrame:
    """The first balance row of each page."""
    balances = matrix.filter(F.col(kind) == "balance")
    return balances.withColumn("_m", F.min(index).over(Window.partitionBy(*page))).filter(F.col(index) == F.col("_m")).drop("_m")


def matrix_cells(truth: DataFrame, opening: DataFrame, keys: list[str], value: str = "value", tol: float = voc.MATRIX_TOL) -> DataFrame:
    """(keys, value_gt, value_ex, ok) for each truth value."""
    gt, ex = truth.select(*keys, F.col(value).alias("value_gt")), opening.select(*keys, F.col(value).alias("value_ex"))
    return gt.join(ex, keys, "left").withColumn("ok", same("value_gt", "value_ex", tol))


def by_page(found: DataFrame, page: list[str]) -> DataFrame:
    """n_ok and n of each page, and whether all of it is wrong: a sign that columns moved."""
    return found.groupBy(*page).agg(F.sum(F.col("ok").cast("int")).alias("n_ok"), F.count("*").alias("n"), (F.sum((~F.col("ok")).cast("int")) == F.count("*")).alias("shifted"))


def shift_power(truth: DataFrame, page: list[str], order: str, value: str = "value", tol: float = voc.MATRIX_TOL) -> DataFrame:
    """(page, n_differ, n, caught): how many values would differ if the page's columns moved by one."""
    moved = truth.withColumn("_s", F.lag(value).over(Window.partitionBy(*page).orderBy(order)))
    return moved.groupBy(*page).agg(F.sum((~same(value, "_s", tol)).cast("int")).alias("n_differ"), F.count("*").alias("n")).withColumn("caught", F.col("n_differ") > 0)
