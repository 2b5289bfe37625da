"""Pages and their lines: classification, sections, memory of headings, sides and spilled columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import bones, page_kind, page_side, skeleton
from tabulon.functions.tokens import spill_values

PAGE = ["source", "page"]


def classify(pages: DataFrame, limit: int = voc.MAX_PAGES, **options) -> DataFrame:
    """pages(source, page, text) up to a page number, with `kind`; a source none of whose pages has one is judged loosely."""
    some = pages.filter(F.col("page") <= limit)
    strict = F.max("_k").over(Window.partitionBy("source"))
    kinds = some.withColumn("_k", page_kind("text", **options)).withColumn("_any", strict)
    return kinds.withColumn("kind", F.when(F.col("_any").isNull(), page_kind("text", strict=False, **options)).otherwise(F.col("_k"))).drop("_k", "_any")


def of_statements(pages: DataFrame, statements: list[str]) -> DataFrame:
    """Pages of the kinds asked for; put before tokens are looked for."""
    return pages.filter(F.col("kind").isin(statements))


def until_blank(pages: DataFrame) -> DataFrame:
    """Pages before a source's first blank one."""
    blank = F.min(F.when(~F.coalesce("text", F.lit("")).rlike(r"\S"), F.col("page"))).over(Window.partitionBy("source"))
    return pages.withColumn("_b", blank).filter(F.col("_b").isNull() | (F.col("page") < F.col("_b"))).drop("_b")


def scanned(pages: DataFrame, least: int = 50, first: int = 5, chars: str = voc.CONSONANTS) -> DataFrame:
    """(source, scanned): hardly any letters on the first pages, so there is no text layer."""
    return pages.groupBy("source").agg((F.coalesce(F.sum(F.when(F.col("page") <= first, F.length(skeleton("text", chars)))), F.lit(0)) < least).alias("scanned"))


def by_title_only(pages: DataFrame, how: str = "page_how") -> DataFrame:
    """Pages whose title was read as it is; the strict way with OCR."""
    return pages.filter(F.col(how) == "title")


def starts_label(line, least: int = 2) -> Column:
    """Whether a line without values may be the first part of a label."""
    return F.length(skeleton(line)) >= least


def with_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with any value."""
    return df.filter(F.coalesce(*columns).isNotNull())


def with_label(df: DataFrame, label: str = "label", prefixes: str = "prefixes") -> DataFrame:
    """Rows that have a label or lines before them that may be one; others are unnamed sums."""
    return df.filter((F.length(skeleton(label)) > 0) | (F.size(prefixes) > 0))


def long_enough(df: DataFrame, label: str = "label_used", least: int = voc.MIN_LABEL) -> DataFrame:
    """Rows whose label is long enough to be one."""
    return df.filter(F.length(skeleton(label)) >= least)


def continued(df: DataFrame, partition: list[str], order: str, label: str, has_values: Column, first_data: str, depth: int = 2) -> DataFrame:
    """df with `item`: the label, or, where it has no letters, the last `depth` lines with letters since the last line with values, from the first line of data on."""
    keeps = F.when(~has_values & (F.col(order) >= F.col(first_data)) & (skeleton(label) != ""), F.col(label))
    found = memory(df.withColumn("_k", keeps).withColumn("_r", has_values), partition, order, "_k", "_r", "_p", depth)
    item = F.when((skeleton(label) == "") & (F.size("_p") > 0), F.array_join("_p", " ")).otherwise(F.col(label))
    return found.withColumn("item", item).drop("_k", "_r", "_p")


def lines(pages: DataFrame) -> DataFrame:
    """pages as lines, with line_no from 0."""
    keep = [c for c in pages.columns if c != "text"]
    return pages.select(*keep, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def section_of(line, sections: list[str] | None = None, chars: str = voc.CONSONANTS) -> Column:
    """The section that a whole line is the header of."""
    table = {}
    for s in sections if sections is not None else voc.SECTIONS:
        table[bones(s, chars)] = s
    known = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.lit(v))))
    return known[skeleton(line, chars)]


def fill_forward(df: DataFrame, value: str, partition: list[str], order: str | Column, to: str) -> DataFrame:
    """The last value so far within a partition."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(to, F.last(value, ignorenulls=True).over(w))


def memory(df: DataFrame, partition: list[str], order: str, remembered: str, resets: str, to: str = "prefixes", depth: int = voc.PREFIXES) -> DataFrame:
    """The last `depth` remembered labels since the last reset; a row that resets still sees what came before it."""
    before = Window.partitionBy(*partition).orderBy(order)
    epoch = F.coalesce(F.sum(F.col(resets).cast("int")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = df.withColumn("_epoch", epoch)
    within = Window.partitionBy(*partition, "_epoch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    listed = F.collect_list(remembered).over(within)
    return kept.withColumn(to, F.slice(listed, F.greatest(F.size(listed) - depth + 1, F.lit(1)), depth)).drop("_epoch")


def after(df: DataFrame, marker: Column, partition: list[str], order: str, to: str) -> DataFrame:
    """Whether the marker held for an earlier row of the partition."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(to, F.coalesce(F.max(marker.cast("int")).over(w), F.lit(0)) == 1)


def adjustment_after(df: DataFrame, partition: list[str], order: str, concept: str = "concept", marker: str = "CASH_NET_CHANGE", adjustments: list[str] | None = None) -> DataFrame:
    """concept_eq: adjustments that stand behind the net change get a mark, since only those are still to be added."""
    found = after(df, F.col(concept) == marker, partition, order, "_after")
    mark = F.col("_after") & F.col(concept).isin(adjustments if adjustments is not None else voc.CF_ADJUSTMENTS)
    return found.withColumn("concept_eq", F.when(mark, F.concat(concept, F.lit("_AFTER"))).otherwise(F.col(concept))).drop("_after")


def all_but_last(df: DataFrame, partition: list[str], order: str, key: str, to: str) -> DataFrame:
    """Whether the same key comes again later in the partition."""
    return df.withColumn(to, F.lead(key).over(Window.partitionBy(*partition, key).orderBy(order)).isNotNull())


def before_items(df: DataFrame, partition: list[str], order: str, subtotals: list[str], concept: str = "concept") -> DataFrame:
    """Subtotals that come again on a page are those before further items."""
    found = all_but_last(df, partition, order, concept, "_again")
    return found.withColumn(concept, F.when(F.col("_again") & F.col(concept).isin(subtotals), F.concat(concept, F.lit("_BEFORE_ITEMS"))).otherwise(F.col(concept))).drop("_again")


def sides(pages: DataFrame, separate: list[str] | None = None, consolidated: str = voc.CONSOLIDATED, chars: str = voc.CONSONANTS, by: list[str] | None = None) -> DataFrame:
    """side of each page: by titles if all pages of the source have one and both sides occur, or if there is one page only (which has no side without a title); else the first page is consolidated and the rest are not."""
    w = Window.partitionBy(*(by or ["source"]))
    side = pages.withColumn("_s", page_side("text", separate, consolidated, chars=chars))
    trusted = (F.min(F.col("_s").isNotNull()).over(w) & (F.size(F.collect_set("_s").over(w)) == 2)) | (F.count("*").over(w) == 1)
    nth = F.row_number().over(w.orderBy("page"))
    return side.withColumn("side", F.when(trusted, F.col("_s")).otherwise(F.when(nth == 1, "con").otherwise("sep"))).drop("_s")


def spills(pages: DataFrame, ahead: int = 3, by: list[str] | None = None, chars: str = voc.CONSONANTS) -> DataFrame:
    """pages with `spill`: values of the first page with spilled ones among the next `ahead`, before any page with a kind."""
    w = Window.partitionBy(*(by or ["source"])).orderBy("page")
    found = pages.withColumn("_v", spill_values("text", chars))
    out, barred = F.lit(None).cast("array<double>"), F.lit(False)
    for n in range(1, ahead + 1):
        kind, v = F.lead("kind", n).over(w), F.lead("_v", n).over(w)
        barred = barred | kind.isNotNull()
        out = F.coalesce(out, F.when(~barred, v))
    return found.withColumn("spill", out).drop("_v")


def next_within(df: DataFrame, partition: list[str], order: str, wanted: Column, value: str, ahead: int, barrier: Column, to: str) -> DataFrame:
    """The value of the first wanted row among the next `ahead`, unless a barrier row comes first; an as-of lookup forward."""
    w = Window.partitionBy(*partition).orderBy(order)
    marked = df.withColumn("_w", F.when(wanted, F.col(value))).withColumn("_b", barrier)
    out, barred = F.lit(None).cast(df.schema[value].dataType), F.lit(False)
    for n in range(1, ahead + 1):
        barred = barred | F.coalesce(F.lead("_b", n).over(w), F.lit(False))
        out = F.coalesce(out, F.when(~barred, F.lead("_w", n).over(w)))
    return marked.withColumn(to, out).drop("_w", "_b")
