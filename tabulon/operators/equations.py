"""Equations as data, and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import company_name, failure_message


def terms(spark: SparkSession, equations: list | None = None) -> DataFrame:
    """(eq_id, role, concept, optional, cols): a row for each addend and total."""
    rows = []
    for name, addends, total, cols in equations if equations is not None else voc.EQUATIONS:
        rows += [(name, "addend", a.lstrip("?"), a.startswith("?"), cols) for a in addends]
        rows.append((name, "total", total, False, cols))
    return spark.createDataFrame(rows, "eq_id string, role string, concept string, optional boolean, cols array<string>")


def grid(equations: list | None = None, cols: list[str] | None = None) -> Column:
    """The terms of all equations for all columns that they hold for, as a constant array to explode."""
    rows = []
    for name, addends, total, only in equations if equations is not None else voc.EQUATIONS:
        for col in cols or voc.COLS:
            if only is None or col in only:
                rows += [(name, col, "addend", a.lstrip("?"), a.startswith("?")) for a in addends] + [(name, col, "total", total, False)]
    names = ("eq_id", "col", "role", "concept", "optional")
    return F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rows))


def verdicts(lut: DataFrame, equations: list | None = None, tol: float = voc.EQUATION_TOL, company: str = "company", companies: DataFrame | None = None, cols: list[str] | None = None) -> DataFrame:
    """(company, col, eq_id, addends_sum, total, verdict, message): pass, fail, or skip where a total or a needed addend is missing.

    lut: (company, concept, col, value), one value for each three. Names of
    companies are trimmed on both sides. Companies of `companies` without any
    value show as skipped. One company's values that equations ask for are one
    map, so the table is read and shuffled once.
    """
    asked = sorted({a.lstrip("?") for _, addends, total, _ in (equations if equations is not None else voc.EQUATIONS) for a in [*addends, total]})
    name = company_name if dict(lut.dtypes)[company] == "string" else F.col
    key = F.struct("concept", "col")
    rows = lut.select(name(company).alias(company), F.when(F.col("concept").isin(asked) & F.col("value").isNotNull(), F.struct(key.alias("key"), F.col("value").cast("double").alias("value"))).alias("e"))
    if companies is not None:
        rows = rows.unionByName(companies.select(name(company).alias(company)), allowMissingColumns=True)
    held = rows.groupBy(company).agg(F.map_from_entries(F.collect_set("e")).alias("m"))
    terms_ = held.select(company, "m", F.explode(grid(equations, cols)).alias("t")).select(company, "t.*", F.col("m")[F.struct(F.col("t.concept"), F.col("t.col"))].alias("value"))
    addend = F.col("role") == "addend"
    out = terms_.groupBy(company, "col", "eq_id").agg(
        F.sum(F.when(addend, F.coalesce("value", F.lit(0.0)))).alias("addends_sum"),
        F.max(F.when(F.col("role") == "total", F.col("value"))).alias("total"),
        F.bool_or(addend & ~F.col("optional") & F.col("value").isNull()).alias("missing"),
    )
    verdict = F.when(F.col("total").isNull() | F.col("missing"), "skip").when(F.abs(F.col("addends_sum") - F.col("total")) < tol, "pass").otherwise("fail")
    out = out.withColumn("verdict", verdict).drop("missing")
    return out.withColumn("message", F.when(F.col("verdict") == "fail", failure_message("addends_sum", "total", "eq_id", company, "col")))


def summary(found: DataFrame, company: str = "company") -> DataFrame:
    """Passed, failed and skipped by company and, with a NULL company, in all; blind: nothing was checked. Without any verdict there is no row, which is no pass either."""
    count = lambda v: F.sum((F.col("verdict") == v).cast("long")).alias(f"n_{v}")
    out = found.rollup(company).agg(*map(count, ("pass", "fail", "skip")))
    return out.select(F.col(company).cast("string").alias(company), "n_pass", "n_fail", "n_skip", ((F.col("n_pass") + F.col("n_fail")) == 0).alias("blind"))
