"""From pages to facts, and from facts to verdicts: whole jobs as lazy plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.similarity import page_kind_alike
from tabulon.functions.text import clean_label, component_label, detect_unit, digits, page_kind, page_side, reattach_year, skeleton, trap
from tabulon.functions.tokens import matrix_row, parsed, parsed_total, value_columns, words
from tabulon.operators import columns as cols
from tabulon.operators import equations, evaluate, matching, pages, quality, rollforward, select, statement

PAGE = ["company", "source", "page"]


FACT = ["company", "source", "statement", "unit", "page", "section", "item_raw", "item_used", "concept", "concept_eq", "match_score", *voc.COLS, "ordinal"]


def kinds(pages_: DataFrame, max_pages: int, classifier: str) -> DataFrame:
    """pages with `kind` and, with 'ocr', `page_how`."""
    if classifier != "ocr":
        return pages.classify(pages_, max_pages)
    found = pages_.filter(F.col("page") <= max_pages).withColumn("_k", page_kind_alike("text"))
    return found.withColumn("kind", F.col("_k.kind")).withColumn("page_how", F.col("_k.how")).drop("_k")


def facts(pages_: DataFrame, alias: DataFrame, statements: list[str] | None = None, max_pages: int = voc.MAX_PAGES, cutoff: float = voc.FUZZY_CUTOFF, subtotals: list[str] | None = None, classifier: str = "text", strict: bool = False, unit: str | None = None) -> DataFrame:
    """Fact rows from pages(company, source, page, text): classified, cut into columns and lines, matched, with units filled.

    Statements of equity go another way than the others: equity_rows().
    classifier='ocr' also takes titles that are only alike and judges units
    over all companies; strict then keeps pages with a title only, and `unit`
    overrides the unit of all rows. Pages of other statements are dropped
    before any token is looked for.
    """
    wanted = statements or ["BS", "IS", "CF", "SE"]
    found = kinds(pages_, max_pages, classifier)
    if classifier == "ocr" and strict:
        how = F.col("page_how") == "title"
        found = found.withColumn("kind", F.when(how, F.col("kind")))
    parts = [statement_rows(pages.of_statements(found, [k for k in wanted if k != "SE"]), alias, cutoff, subtotals)] if set(wanted) - {"SE"} else []
    if "SE" in wanted:
        parts.append(equity_rows(found, alias, cutoff))
    out = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    out = quality.fill_mode(out, "unit", by=None if classifier == "ocr" else ["company"], override=unit if classifier == "ocr" else None)
    if classifier != "ocr":
        return out.select(*FACT)
    how = found.select("company", "source", F.col("page").cast("string").alias("page"), "page_how")
    return statement.page_how(out, how).select(*FACT, "page_how")


def statement_rows(found: DataFrame, alias: DataFrame, cutoff: float, subtotals: list[str] | None) -> DataFrame:
    """Rows of balance sheets, income and cash flows: up to four columns of amounts on each page."""
    found = found.withColumn("unit", detect_unit("text"))
    lines = cols.with_tokens(pages.lines(found))
    where = cols.find_columns(lines, PAGE).filter(F.size("columns") >= 2)
    where = cols.column_stats(lines, where, PAGE).select(*PAGE, value_columns("columns", "comma_shares", "short_share").alias("columns"))
    rows = lines.join(where, PAGE).withColumn("p", parsed("line", "toks", "columns"))
    rows = rows.withColumn("has", F.coalesce(F.exists("p.values", lambda v: v.isNotNull()), F.lit(False)))
    rows = rows.withColumn("_section", F.when(F.col("p").isNull(), pages.section_of("line")))
    rows = rows.withColumn("_keeps", F.when(F.col("p").isNull() & F.col("_section").isNull() & pages.starts_label("line"), clean_label("line")))
    rows = rows.withColumn("_reset", F.col("p").isNotNull() | F.col("_section").isNotNull() | F.col("_keeps").isNull())
    rows = pages.fill_forward(rows, "_section", PAGE, "line_no", "section")
    rows = pages.memory(rows, PAGE, "line_no", "_keeps", "_reset")
    data = pages.with_label(rows.filter("has").withColumn("label", F.col("p.label")))
    named = matching.match(data, alias, [*PAGE, "line_no"], prefixes="prefixes", section="section", cutoff=cutoff, keep=["kind", "unit", "section", "label", "p"])
    out = pages.long_enough(named).withColumn("concept", statement.cash_flow_only("kind", "concept"))
    out = pages.before_items(out, PAGE, "line_no", voc.CF_SUBTOTALS if subtotals is None else subtotals)
    out = pages.adjustment_after(out, PAGE, "line_no")
    out = out.withColumns({c: F.get("p.values", F.lit(i)) for i, c in enumerate(voc.COLS)})
    return out.select("company", "source", F.col("kind").alias("statement"), "unit", F.col("page").cast("string").alias("page"), F.coalesce("section", F.lit("")).alias("section"), F.col("label").alias("item_raw"), F.col("label_used").alias("item_used"), "concept", "concept_eq", F.bround("match_score", 3).alias("match_score"), *voc.COLS, place("source", F.lit(1), "page", "line_no", F.lit(0)))


def place(source: str, part, page, line, late) -> Column:
    """The order of facts: a source's statements of equity, consolidated ones first, and then its other pages line by line."""
    long = lambda c: (F.col(c) if isinstance(c, str) else c).cast("int")
    return F.struct(F.col(source).alias("source"), long(part).alias("part"), long(late).alias("late"), long(page).alias("page"), long(line).alias("line")).alias("ordinal")


def equity_rows(found: DataFrame, alias: DataFrame, cutoff: float) -> DataFrame:
    """Rows of statements of equity: the column of totals, both periods side by side, consolidated and separate pages as one.

    found: all pages with `kind`, since a column of totals may have gone to a
    page of its own behind its table. A side's pages are one run of lines; it
    is cut where a period begins.
    """
    every = pages.spills(found.select(*PAGE, "text", "kind"), by=["company", "source"])
    page = pages.sides(every.filter(F.col("kind") == "SE"), by=["company", "source"]).filter(F.col("side").isNotNull())
    own = ["company", "source", "side"]
    group = Window.partitionBy(*own).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    page = page.withColumn("unit", F.first(detect_unit("text")).over(group)).withColumn("pages", F.array_join(F.collect_list("page").over(group), ","))
    lines = cols.with_tokens(pages.lines(page))
    where = cols.find_columns(lines, PAGE).filter(F.size("columns") >= 3)
    rows = lines.join(where, PAGE).withColumn("p", parsed_total("line", "toks", "columns")).withColumn("value", F.get("p.values", F.lit(0)))
    rows = rows.withColumn("data", F.col("p").isNotNull() & (F.col("value").isNotNull() | F.col("spill").isNotNull()))
    rows = rows.withColumn("_keeps", F.when(~F.col("data") & pages.starts_label("line"), clean_label("line")))
    rows = pages.memory(rows.withColumn("_reset", F.col("_keeps").isNull()), PAGE, "line_no", "_keeps", "_reset")
    key = [*PAGE, "line_no"]
    data = rows.filter("data").withColumn("raw", component_label("p.label"))
    data = matching.match(data, alias, key, label="raw", prefixes="prefixes", cutoff=cutoff, keep=["side", "unit", "pages", "raw", "value", "spill"]).withColumn("label", reattach_year("raw", "label_used"))
    nth = Window.partitionBy(*PAGE)
    at = F.row_number().over(nth.orderBy("line_no"))
    data = data.withColumn("value", F.when(F.size("spill") == F.count("*").over(nth), F.get("spill", at - 1)).otherwise(F.col("value")))
    data = data.select(*own, "unit", "pages", "page", "line_no", "label", "value").withColumn("at", F.struct("page", "line_no"))
    data = statement.periods(statement.year_blocks(data, own, "at", "label"), own)
    key = [*own, "page", "line_no"]
    data = matching.match(data, alias, key, cutoff=cutoff, keep=["label", "value", "at", "unit", "pages", "period"]).withColumn("shown", statement.remapped("concept"))
    both = statement.side_by_side(data, own, "concept", "label", "value", "at", "shown")
    both = pages.long_enough(both)
    con = F.col("side") == "con"
    values = {c: F.when(con if c.startswith("con") else ~con, F.col("current" if c.endswith("cur") else "previous")) for c in voc.COLS}
    side = F.when(con, voc.SIDES["con"]).otherwise(voc.SIDES["sep"])
    # a side's rows without a current value stand behind the others
    order = place("source", F.lit(0), "page", "line_no", F.when(con, 0).otherwise(2) + F.col("only_previous").cast("int"))
    out = both.withColumns(values).select("company", "source", F.lit("SE").alias("statement"), "unit", F.col("pages").alias("page"), side.alias("section"), F.col("label").alias("item_raw"), F.col("label_used").alias("item_used"), F.col("shown").alias("concept"), F.col("shown").alias("concept_eq"), F.bround("match_score", 3).alias("match_score"), *voc.COLS, order)
    return statement.merge_pages(out, ["company", "source"], voc.COLS)


def equity_cells(pages_: DataFrame, max_pages: int = voc.MAX_PAGES, least: int = 3) -> DataFrame:
    """All cells of statements of equity from pages(company, source, page, text): (company, source, page, unit, side, block, row_index, item, col_index, equity_component, is_total_col, kind, value), and `odd` where a page's balances don't pair up."""
    found = pages.until_blank(pages_.filter(F.col("page") <= max_pages)).withColumn("kind", page_kind("text"))
    found = found.filter(F.col("kind") == "SE").select(*PAGE, "text", detect_unit("text").alias("unit"), F.coalesce(page_side("text"), F.lit("")).alias("side"))
    lines = cols.with_tokens(pages.lines(found))
    where = cols.matrix_columns(lines, PAGE, least)
    rows = lines.join(where, PAGE).withColumn("p", matrix_row("line", "toks", "columns", least))
    data, page = F.coalesce(F.col("p.data"), F.lit(False)), Window.partitionBy(*PAGE)
    rows = rows.withColumn("data", data).withColumn("first_data", F.min(F.when(data, F.col("line_no"))).over(page)).withColumn("label_end", F.min(F.when(data, F.col("p.start"))).over(page)).filter("first_data IS NOT NULL")
    heads = rows.filter(F.col("line_no") < F.col("first_data")).select(*PAGE, "line_no", F.explode(words("line")).alias("w")).select(*PAGE, "line_no", "w.*")
    grid = rows.filter(F.col("line_no") == F.col("first_data")).select(*PAGE, "label_end", F.posexplode("columns").alias("col_index", "pos"))
    heads = heads.join(grid.filter("col_index = 0").select(*PAGE, "label_end"), PAGE).filter((F.col("start") + F.col("end")) / 2 >= F.col("label_end")).drop("label_end")
    names = cols.header_names(heads, grid, PAGE, label_end="label_end", fallback=voc.COLUMN)
    label = F.coalesce("p.label", clean_label("line"))
    rows = pages.continued(rows.withColumn("label", label), PAGE, "line_no", "label", F.coalesce(F.col("p.filled"), F.lit(0)) > 0, "first_data").filter("data")
    rows = rows.withColumn("is_balance", rollforward.is_balance("item"))
    rows = rollforward.blocks(rows, PAGE, "line_no", F.col("is_balance"))
    cells = rows.select(*PAGE, "unit", "side", "block", "odd", F.col("line_no").alias("row_index"), "item", F.when(F.col("is_balance"), "balance").otherwise("movement").alias("kind"), F.size("p.values").alias("n"), F.posexplode("p.values").alias("col_index", "value"))
    cells = cells.join(names, [*PAGE, "col_index"])
    return cells.select(*PAGE, "unit", "side", "block", "row_index", "item", "col_index", F.col("name").alias("equity_component"), (F.col("col_index") == F.col("n") - 1).alias("is_total_col"), "kind", "value", "odd")


CELL_GROUP = [*PAGE, "block", "col_index"]


def check_rollforward(cells: DataFrame, tol: float = voc.ROLL_TOL) -> dict[str, DataFrame]:
    """Whether opening and movements give the closing balance in each block and column, and how often subtotals were taken out by name and by number."""
    named = cells.withColumn("is_balance", F.col("kind") == "balance")
    return {"checks": rollforward.check(named, [*CELL_GROUP, "equity_component"], tol=tol), "audit": rollforward.audit(named, CELL_GROUP, tol=tol)}


def evaluate_matrix(truth: DataFrame, cells: DataFrame, tol: float = voc.MATRIX_TOL) -> dict[str, DataFrame]:
    """Opening balances against truth(company, page, col_index, value): cells, pages, and how many pages a shift of columns would show on."""
    page = ["company", "page"]
    found = evaluate.matrix_cells(truth, evaluate.opening_rows(cells, page), [*page, "col_index"], tol=tol)
    return {"cells": found, "pages": evaluate.by_page(found, page), "power": evaluate.shift_power(truth, page, "col_index", tol=tol)}


def truth_template(extracted: DataFrame, alias: DataFrame, per_company: int | None = None, mapped_only: bool = False) -> DataFrame:
    """Rows to be keyed by hand, values left blank: each item of a section once, spelled as the dictionary spells it where it was found there, with its difficulty."""
    some = pages.with_values(extracted, voc.COLS)
    sure = F.col("concept").isNotNull() & (F.col("match_score") >= 1.0)
    named = matching.canonical(some, alias, "item_used").withColumn("sure", F.coalesce(sure, F.lit(False)))
    named = named.filter("sure") if mapped_only else named
    named = named.withColumn("item", F.when(F.col("sure"), F.col("canonical")).otherwise(F.col("item_used"))).withColumn("_s", skeleton("item")).withColumn("_d", digits("item"))
    rows = select.first_seen(named, ["company", "section", "_s", "_d"])
    rows = rows.withColumn("trap", trap("item", voc.COLS)).withColumn("_note", F.when(F.col("sure"), "").otherwise("?"))
    if per_company:
        strata = rows.select("trap").distinct().count()
        rows = select.stratified(rows, "company", "trap", per_company, max(1, strata), [F.asc("_note"), F.asc("ordinal")])
    blank = {c: F.lit("") for c in voc.COLS}
    return rows.withColumns(blank).select("company", "unit", "page", "section", "item", *voc.COLS, "trap", F.coalesce("concept", F.lit("")).alias("_concept_hint"), "_note").orderBy("company", "page")


def crosscheck(extracted: DataFrame, tol: float = voc.EQUATION_TOL) -> DataFrame:
    """Verdicts of all equations on extracted facts."""
    lut, _ = select.lookup_table(extracted)
    return equations.verdicts(lut, tol=tol, companies=extracted.select("company"))


def validate(truth: DataFrame, extracted: DataFrame, alias: DataFrame) -> dict[str, DataFrame]:
    """Cells, accuracy by trap and company, coverage and equation verdicts."""
    keyed = truth.withColumn("_k", F.struct("file", "ordinal"))
    named = matching.truth_concepts(keyed, alias, ["_k"]).select("_k", "concept")
    gt = keyed.join(named, "_k").drop("_k")
    picked = select.pick_rows(extracted)
    found = evaluate.cells(gt.filter(F.col("concept").isNotNull()), picked, ["company", "concept"], keep=["item", "trap"])
    lut, _ = select.lookup_table(picked)
    return {"cells": found, "by_trap": evaluate.accuracy(found, "trap"), "by_company": evaluate.accuracy(found, "company"), "coverage": evaluate.coverage(gt, found), "equations": equations.verdicts(lut)}


def validate_truth(truth: DataFrame) -> dict[str, DataFrame]:
    """What a truth file says of itself: traps that are missing, mixed units, duplicates, filled cells, traps by company."""
    return {
        "missing_traps": quality.missing_values(truth, "trap", voc.TRAPS),
        "mixed_units": quality.mixed(truth, "company", "unit"),
        "duplicates": quality.duplicates(truth, ["company", "section", "item"]),
        "filled": quality.cells_filled(truth, voc.COLS, ["company"]),
    }


def order_invariant(df: DataFrame, job) -> DataFrame:
    """Rows in which job(df) and job(df in another order) differ; none if the job doesn't depend on the order of its input."""
    a, b = job(df), job(df.repartition(7).sortWithinPartitions(F.rand(1)))
    return a.exceptAll(b).union(b.exceptAll(a))


def numbered(df: DataFrame, order: list) -> DataFrame:
    return df.withColumn("ordinal", F.row_number().over(Window.orderBy(*order)))
