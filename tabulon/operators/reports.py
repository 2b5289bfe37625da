"""Reports: pivots, counts, comparable values and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import scaled


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list[str], total: str | None = "total", counted: str | None = None) -> DataFrame:
    """Counts of rows by columns, 0 where there are none, with a total of each row, the largest first. The values are given, so no job is needed to find them."""
    what = F.count(counted if counted else F.lit(1))
    out = df.groupBy(rows).pivot(columns, values).agg(what).fillna(0, subset=values)
    if total is None:
        return out.orderBy(rows)
    out = out.withColumn(total, sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`")))
    return out.orderBy(F.desc(total), rows)


def spread(df: DataFrame, key: str, counted: str, preferred: list[str] | None = None) -> DataFrame:
    """(key, n, default): distinct values by key, the most first; default marks the key to show first, the first preferred one that is there."""
    out = df.groupBy(key).agg(F.count_distinct(counted).alias("n"))
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, preferred)) if preferred else F.array().cast("array<string>"), F.col(key)), F.lit(0))
    rank = F.when(rank == 0, 1 << 30).otherwise(rank)
    best = out.agg(F.min_by(key, F.struct(rank, -F.col("n"), F.col(key))).alias("_d"))
    return out.crossJoin(F.broadcast(best)).withColumn("default", F.col(key) == F.col("_d")).drop("_d").orderBy(F.desc("n"), key)  # one row


def comparable(df: DataFrame, value: str, unit: str, units: dict[str, float] | None = None) -> DataFrame:
    """Rows that can be compared: value present and unit known, with the value in the base unit."""
    return df.withColumn("normalised", scaled(value, unit, units)).filter(F.col(value).isNotNull() & F.col("normalised").isNotNull())


def trace(df: DataFrame, company: str, statement: str, names: dict[str, str], mapped_only: bool = False) -> DataFrame:
    """Rows of one company and statement under other names; columns that aren't there are left out."""
    out = df.filter((F.col("company") == company) & (F.col("statement") == statement))
    out = out.filter(F.col("concept").isNotNull()) if mapped_only else out
    return out.select(*(F.col(k).alias(v) for k, v in names.items() if k in df.columns))


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(c for c in columns if c in df.columns))


def top(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows."""
    return df.orderBy(*order).limit(n)


def counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each column, and rows."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_distinct(c).alias(f"n_{c}") for c in columns))


def union(first: DataFrame, second: DataFrame, reader: str = "reader", default: str = "text") -> DataFrame:
    """Extracts with differing columns as one; rows without a reader have the default one."""
    both = first.unionByName(second, allowMissingColumns=True)
    return both.withColumn(reader, F.coalesce(reader, F.lit(default))) if reader in both.columns else both.withColumn(reader, F.lit(default))


def not_scanned(df: DataFrame, reader: str = "reader") -> DataFrame:
    """What equations are checked on: rows that weren't read by OCR."""
    return df.filter(F.col(reader) != "ocr")


def template(df: DataFrame, keys: list[str], n: int, order: list, group: str = "company", stratum: str = "trap") -> DataFrame:
    """A truth template: rows seen first, up to n of each company spread over the traps, values blank, sorted by company and page as text."""
    from tabulon.operators.select import first_seen, stratified

    some = stratified(first_seen(df, keys), group, stratum, n, len(voc.TRAPS), order)
    return some.withColumns({c: F.lit(None).cast("string") for c in voc.COLS}).orderBy(group, F.col("page").cast("string"))
