"""Columns of a page by the places where its numbers end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import clean_label, skeleton, to_number
from tabulon.functions.tokens import is_cell, tokens


def gap_clusters(df: DataFrame, partition: list[str], order: str, gap: float, to: str = "cluster") -> DataFrame:
    """Numbers runs of rows whose values lie no further than `gap` from the one before."""
    w = Window.partitionBy(*partition).orderBy(order)
    new = (F.col(order) - F.lag(order).over(w)) > gap
    return df.withColumn("_n", F.coalesce(new.cast("int"), F.lit(0))).withColumn(to, F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_n")


def representatives(df: DataFrame, partition: list[str], cluster: str, position: str, count: str, share: float = 0.25) -> DataFrame:
    """(partition, cluster, score, pos): the busiest position of each cluster, rightmost at a tie; clusters with a small part of the best go."""
    out = df.groupBy(*partition, cluster).agg(F.sum(count).alias("score"), F.max_by(position, F.struct(count, position)).alias("pos"))
    return out.withColumn("_top", F.max("score").over(Window.partitionBy(*partition))).filter(F.col("score") >= F.col("_top") * share).drop("_top")


def find_columns(lines: DataFrame, page: list[str], least: int = 3, gap: float = 6, share: float = 0.25) -> DataFrame:
    """(page, columns) from lines with `toks`: where cells end at least so often, as clusters, each by its busiest place."""
    ends = lines.select(*page, F.explode(F.filter("toks", lambda t: is_cell(t["tok"]))).alias("t")).groupBy(*page, F.col("t.end").alias("pos")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    kept = representatives(gap_clusters(ends, page, "pos", gap), page, "cluster", "pos", "n", share)
    return kept.groupBy(*page).agg(F.array_sort(F.collect_list("pos")).alias("columns"))


def column_stats(lines: DataFrame, columns: DataFrame, page: list[str]) -> DataFrame:
    """(page, columns, comma_shares, short_share): how the tokens at each column look.

    Both sides of the joins have a row for each page, so neither goes through the
    driver, however small the files that they come from are.
    """
    cells = lines.select(*page, F.explode("toks").alias("t")).join(columns.hint("merge"), page).select(*page, "columns", "t", F.posexplode("columns").alias("i", "c")).filter(F.abs(F.col("t.end") - F.col("c")) <= 3)
    tok = F.trim("t.tok")
    short = ~F.contains(tok, F.lit(",")) & (F.length(F.regexp_replace(tok, r"^[()\-]+|[()\-]+$", "")) <= 2)
    per = cells.groupBy(*page, "i").agg(F.avg(F.contains(tok, F.lit(",")).cast("double")).alias("comma"), F.avg(short.cast("double")).alias("short"))
    listed = per.groupBy(*page).agg(F.map_from_entries(F.collect_list(F.struct("i", "comma"))).alias("m"), F.max(F.when(F.col("i") == 0, F.col("short"))).alias("short_share"))
    out = columns.join(listed.hint("merge"), page, "left")
    return out.select(*page, "columns", F.transform("columns", lambda _, i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("comma_shares"), F.coalesce("short_share", F.lit(0.0)).alias("short_share"))


def with_tokens(lines: DataFrame) -> DataFrame:
    return lines.withColumn("toks", tokens("line"))


def strip_dates(cells: DataFrame, row: list[str], index: str, value: str, keep: int = 3) -> DataFrame:
    """Drops leading columns that have values, all of them a day or a year, while more than `keep` columns are left."""
    date = (F.col(value) == F.floor(value)) & (F.col(value).between(1, 31) | F.col(value).between(2400, 2700))
    per = cells.groupBy(*row, index).agg(F.coalesce(F.min(date), F.lit(False)).alias("_d"))
    w = Window.partitionBy(*row).orderBy(index)
    lead = per.withColumn("_lead", F.min("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)) & (F.row_number().over(w) <= F.count("*").over(Window.partitionBy(*row)) - keep))
    return cells.join(lead.filter(~F.col("_lead")).select(*row, index), [*row, index], "left_semi")


def merge_adjacent(columns: Column, gap: int = 12) -> Column:
    """Columns as (pos, lines) from left to right, where neighbours within `gap` and without a common line become the busier one of them (the earlier at a tie), with its own lines."""
    first = F.slice(columns, 1, 1)
    rest = F.slice(columns, 2, F.greatest(F.size(columns) - 1, F.lit(0)))

    def step(acc: Column, c: Column) -> Column:
        last = F.element_at(acc, -1)
        apart = (c["pos"] - last["pos"] > gap) | F.arrays_overlap(c["lines"], last["lines"])
        one = F.when(F.size(c["lines"]) > F.size(last["lines"]), c).otherwise(last)
        return F.when(apart, F.concat(acc, F.array(c))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(one)))

    return F.when(F.size(columns) > 0, F.aggregate(rest, first, step)).otherwise(columns)


def header_names(tokens_: DataFrame, columns: DataFrame, page: list[str], slack: int = 4, label_end: str | None = None, first_data: str | None = None, fallback: str | None = None, chars: str = voc.CONSONANTS) -> DataFrame:
    """(page, col_index, name): header tokens whose middle lies between the column before and this one, top to bottom.

    tokens_: (page, line_no, start, end, tok); columns: (page, col_index, pos)
    and, if named, where labels end (what stands before is no header) and the
    first line of data. With `fallback` every column has a cleaned name, a word
    and the column's number where there are no letters.
    """
    floor = F.col(label_end) if label_end else F.lit(0)
    lo = F.coalesce(F.lag("pos").over(Window.partitionBy(*page).orderBy("pos")) + slack, floor)
    bounds = columns.withColumn("lo", F.greatest(lo, floor)).withColumn("hi", F.col("pos") + slack)
    mid = (F.col("start") + F.col("end")) / 2
    met = tokens_.withColumn("mid", mid).join(bounds, page).filter((F.col("mid") >= F.col("lo")) & (F.col("mid") < F.col("hi")))
    met = met.filter(F.col("line_no") < F.col(first_data)) if first_data else met
    listed = F.array_sort(F.collect_list(F.struct("line_no", "start", "tok")))
    named = met.groupBy(*page, "col_index").agg(F.array_join(F.transform(listed, lambda x: x["tok"]), " ").alias("name"))
    if fallback is None:
        return named
    name = clean_label(F.coalesce("name", F.lit("")), chars)
    every = columns.select(*page, "col_index").join(named, [*page, "col_index"], "left")
    return every.withColumn("name", F.when(skeleton(name, chars) != "", name).otherwise(F.concat_ws(" ", F.lit(fallback), (F.col("col_index") + 1).cast("string"))))


def header_nearest(groups: DataFrame, columns: DataFrame, page: list[str], limit: int = 14, back: int = 10) -> DataFrame:
    """(page, col_index, name): header word groups by the nearest right edge within `limit`, from the lines just above the data."""
    near = groups.filter((F.col("line_no") < F.col("first_data")) & (F.col("line_no") >= F.col("first_data") - back)).join(columns, page)
    best = near.withColumn("d", F.abs(F.col("end") - F.col("pos"))).withColumn("r", F.row_number().over(Window.partitionBy(*page, "line_no", "start").orderBy("d", "col_index"))).filter((F.col("r") == 1) & (F.col("d") <= limit))
    return best.groupBy(*page, "col_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "start", "tok"))), lambda x: x["tok"]), " ").alias("name"))


def lines_of(lines: DataFrame, columns: DataFrame, page: list[str], near: int = 4) -> DataFrame:
    """(page, col_index, pos, value, line_no): numbers that end within `near` of a column; columns: (page, columns)."""
    each = lines.select(*page, "line_no", F.explode("toks").alias("t")).withColumn("value", to_number("t.tok")).filter("value IS NOT NULL")
    met = each.join(columns.select(*page, F.posexplode("columns").alias("col_index", "pos")), page)
    return met.filter(F.abs(F.col("t.end") - F.col("pos")) <= near).select(*page, "col_index", "pos", "value", "line_no")


def matrix_columns(lines: DataFrame, page: list[str], least: int = 3) -> DataFrame:
    """(page, columns) of wide tables: columns of dates at the left go, neighbours that never share a line become one; pages with fewer than `least` columns are left out."""
    found = find_columns(lines, page).filter(F.size("columns") >= least)
    cells = lines_of(lines, found, page)
    every = found.select(*page, F.posexplode("columns").alias("col_index", "pos"))
    per = every.join(cells.drop("pos"), [*page, "col_index"], "left")
    kept = strip_dates(per.select(*page, "col_index", "pos", "value", "line_no"), page, "col_index", "value", least)
    listed = kept.groupBy(*page, "col_index", "pos").agg(F.array_sort(F.collect_set("line_no")).alias("lines"))
    ordered = listed.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct("pos", "lines"))).alias("c"))
    return ordered.select(*page, F.transform(merge_adjacent(F.col("c")), lambda x: x["pos"]).alias("columns"))
