"""Statements of equity: periods side by side, spilled columns, pages of one statement as one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import bones, skeleton
from tabulon.operators.select import merge_key


def cash_flow_only(kind: str, concept: str, names: list[str] | None = None) -> Column:
    """The concept, but NULL for those of cash flows on other statements."""
    return F.when((F.col(kind) != "CF") & F.col(concept).isin(names if names is not None else voc.CF_ONLY), F.lit(None).cast("string")).otherwise(F.col(concept))


def remapped(concept: str, table: dict[str, str] | None = None) -> Column:
    known = table if table is not None else voc.SE_REMAP
    return F.coalesce(F.create_map(*(x for k, v in known.items() for x in (F.lit(k), F.lit(v))))[F.col(concept)], F.col(concept))


def year_blocks(df: DataFrame, partition: list[str], order: str, label: str, starts: Column | None = None, year: str = rf"\b({voc.YEAR})\b") -> DataFrame:
    """block and block_year: a block begins at a label that names the year's first month; its year is that of its first row, 0 if missing."""
    begin = starts if starts is not None else F.contains(skeleton(label), F.lit(bones(voc.MONTHS[0])))
    w = Window.partitionBy(*partition).orderBy(order)
    out = df.withColumn("block", F.sum(begin.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    head = F.first(F.regexp_extract(F.col(label), year, 1)).over(Window.partitionBy(*partition, "block").orderBy(order))
    return out.withColumn("block_year", F.coalesce(head.try_cast("int"), F.lit(0)))


def periods(df: DataFrame, partition: list[str]) -> DataFrame:
    """df with `period` 1 for the block of the latest year and 2 for the one before; of blocks with one year the last comes first."""
    rank = F.dense_rank().over(Window.partitionBy(*partition).orderBy(F.desc("block_year"), F.desc("block")))
    return df.withColumn("period", rank).filter("period <= 2")


def side_by_side(rows: DataFrame, keys: list[str], concept: str, label: str, value: str, ordinal: str, shown: str | None = None) -> DataFrame:
    """rows of `period` 1 with the value of period 2, by concept and else by the label's skeleton (the first of each); the first row of period 2 with another skeleton follows with no current value.

    shown: the concept of the result, by which earlier ones are looked up, if it
    differs from theirs. The rows of a statement are looked up among each other
    in one array, as many as its pages have lines.
    """
    others = [c for c in rows.columns if c not in (*keys, "period", value)]
    row = F.struct(F.col(ordinal).alias("o"), "period", F.col(concept).alias("c"), F.col(shown or concept).alias("w"), skeleton(label).alias("s"), F.col(value).cast("double").alias("v"), F.struct(*others).alias("rest"))
    g = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    g = g.withColumn("cur", F.filter("rows", lambda r: r["period"] == 1)).withColumn("prev", F.filter("rows", lambda r: r["period"] == 2))
    only = F.filter("prev", lambda p, i: ~F.exists("cur", lambda c: c["s"] == p["s"]) & ~F.exists(F.slice("prev", F.lit(1), i), lambda q: q["s"] == p["s"]))
    first = lambda test: F.get(F.filter("prev", test), F.lit(0))["v"]
    both = lambda r, late: F.struct(r["rest"].alias("rest"), (F.lit(None).cast("double") if late else r["v"]).alias("current"), F.coalesce(first(lambda p: p["c"] == r["w"]), first(lambda p: p["s"] == r["s"])).alias("previous"), F.lit(late).alias("only_previous"))
    out = g.select(*keys, F.explode(F.concat(F.transform("cur", lambda r: both(r, False)), F.transform(only, lambda r: both(r, True)))).alias("x"))
    return out.select(*keys, "x.rest.*", "x.current", "x.previous", "x.only_previous")


def attach_spill(rows: DataFrame, spilled: DataFrame, page: list[str], order: str, spill_order: str, value: str, to: str) -> DataFrame:
    """The n-th spilled value to the n-th row of a page, only where there are as many of both."""
    number = lambda df, o: df.withColumn("_n", F.row_number().over(Window.partitionBy(*page).orderBy(o))).withColumn("_m", F.count("*").over(Window.partitionBy(*page)))
    right = number(spilled, spill_order).select(*page, "_n", "_m", F.col(value).alias(to))
    return number(rows, order).join(right, [*page, "_n", "_m"], "left").drop("_n", "_m")


def merge_pages(rows: DataFrame, keys: list[str], values: list[str], concept: str = "concept", item: str = "item_used", page: str = "page", section: str = "section", ordinal: str = "ordinal", both: str = voc.BOTH_SIDES, chars: str = voc.CONSONANTS) -> DataFrame:
    """Rows of one meaning as one: the first, with later ones' values where it has none, the pages of all, and a section of its own if there were several."""
    keyed = rows.withColumn("_key", merge_key(concept, item, chars))
    others = [c for c in rows.columns if c not in (*keys, *values, page, section)]
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(page).cast("string").alias("p")))), lambda x: x["p"])
    out = keyed.groupBy(*keys, "_key").agg(
        F.min_by(F.struct(*others, F.col(section).alias("_section")), ordinal).alias("_f"), *map(first, values), F.array_join(listed, ",").alias(page), F.count("*").alias("_n")
    )
    named = F.when(F.col("_n") > 1, both).otherwise(F.col("_f._section")).alias(section)
    return out.select(*(F.col(f"_f.{c}").alias(c) if c in others else named if c == section else F.col(c) for c in rows.columns))


def page_how(rows: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """How the first page of each row was recognised, '?' if not known. pages: (source, page as text, page_how), and company where rows have one."""
    keys = [c for c in ("company", "source") if c in rows.columns and c in pages.columns]
    first = rows.withColumn("_p", F.get(F.split(page, ","), F.lit(0)))
    return first.join(pages.select(*keys, F.col("page").alias("_p"), "page_how"), [*keys, "_p"], "left").withColumn("page_how", F.coalesce("page_how", F.lit("?"))).drop("_p")
