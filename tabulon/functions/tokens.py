"""Numbers in layout text: tokens with their places, columns of a page, and lines as cells.

Spark's own functions give matches without places, so one Arrow function finds
the tokens of each line; all that follows works on the array that it returns.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tabulon import vocabulary as voc
from tabulon.functions.text import bones, clean_label, text, to_number

TOKENS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("tok", StringType())]))
_pattern = re.compile(voc.TOKEN)


@F.pandas_udf(TOKENS)
def _tokens(lines: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [{"start": m.start(), "end": m.end(), "tok": m.group()} for m in _pattern.finditer(x)] for x in lines])


@F.pandas_udf(TOKENS)
def _words(lines: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [{"start": m.start(), "end": m.end(), "tok": m.group()} for m in re.finditer(r"\S+", x)] for x in lines])


def words(line) -> Column:
    """What stands between white space, with places."""
    return _words(text(line))


def tokens(line) -> Column:
    """Numbers and lone dashes of a line with their places."""
    return _tokens(text(line))


def is_cell(tok: Column) -> Column:
    """Whether a token is a value or a dash for none."""
    return to_number(tok).isNotNull() | (F.trim(tok) == "-")


def distance(token: Column, column: Column) -> Column:
    """From a token's end to a column, measured with and without closing parentheses."""
    bare = token["end"] - (F.length(token["tok"]) - F.length(F.regexp_replace(token["tok"], r"[) ]+$", "")))
    return F.least(F.abs(token["end"] - column), F.when(F.rtrim(token["tok"]).endswith(")"), F.abs(bare - column)).otherwise(F.abs(token["end"] - column)))


def nearest(token: Column, columns: Column) -> Column:
    """(dist, idx) of the nearest column; the leftmost at a tie."""
    return F.array_min(F.transform(columns, lambda c, i: F.struct(distance(token, c).alias("dist"), i.alias("idx"))))


def placed(toks, columns, tolerance: int = 4) -> Column:
    """Tokens that are cells and lie at a column: (idx, start, value)."""
    cols = text(columns)
    near = F.transform(text(toks), lambda t: F.struct(nearest(t, cols).alias("n"), t["start"].alias("start"), t["tok"].alias("tok")))
    hit = F.filter(near, lambda x: (x["n"]["dist"] <= tolerance) & is_cell(x["tok"]))
    return F.transform(hit, lambda x: F.struct(x["n"]["idx"].alias("idx"), x["start"].alias("start"), to_number(x["tok"]).alias("value")))


def adaptive(toks, columns, limit: int = 8) -> Column:
    """placed() where the tolerance is half the way to the second nearest column, at most `limit`."""
    cols = text(columns)

    def near(t: Column) -> Column:
        by = F.array_sort(F.transform(cols, lambda c, i: F.struct(distance(t, c).alias("dist"), i.alias("idx"))))
        second = F.coalesce(F.get(by, F.lit(1))["dist"], F.lit(2 * limit))
        return F.struct(F.get(by, F.lit(0)).alias("n"), F.least(F.lit(float(limit)), second / 2).alias("most"), t["start"].alias("start"), t["tok"].alias("tok"))

    hit = F.filter(F.transform(text(toks), near), lambda x: (x["n"]["dist"] <= x["most"]) & is_cell(x["tok"]))
    return F.transform(hit, lambda x: F.struct(x["n"]["idx"].alias("idx"), x["start"].alias("start"), to_number(x["tok"]).alias("value")))


def cells(hits, columns) -> Column:
    """One value for each column: of several tokens the last wins, a dash is NULL."""
    h = text(hits)
    return F.transform(text(columns), lambda _, i: F.get(F.reverse(F.filter(h, lambda x: x["idx"] == i)), F.lit(0))["value"])


def is_years(values, western: bool = True) -> Column:
    """Whether all values that are there are years: a header, not data. western: years of either calendar, else Thai ones only."""
    there = F.filter(text(values), lambda v: v.isNotNull())
    return (F.size(there) > 0) & F.forall(there, lambda v: v.between(2400, 2700) | v.between(1990, 2100) if western else v.between(2400, 2700))


def bound(value: Column, body) -> Column:
    """body(value) with value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parsed(line, toks, columns, tolerance: int = 4) -> Column:
    """(label, values) of a data line, NULL for any other; the label ends at the first token that is placed."""
    cols = text(columns)

    def of(hits: Column) -> Column:
        first = F.array_min(F.transform(hits, lambda x: x["start"]))
        label = clean_label(F.substr(text(line), F.lit(1), first))
        return bound(cells(hits, cols), lambda v: F.when((F.size(hits) > 0) & ~is_years(v), F.struct(label.alias("label"), v.alias("values"))))

    return bound(placed(toks, cols, tolerance), of)


def matrix_row(line, toks, columns, least: int = 3) -> Column:
    """(label, values, filled, start) of a row of a wide table: cells by adaptive tolerance, a dash counts as filled; NULL without any cell.

    data: at least so many filled cells, and not only Thai years.
    """
    cols = text(columns)

    def of(hits: Column) -> Column:
        first = F.array_min(F.transform(hits, lambda x: x["start"]))
        label, filled = clean_label(F.substr(text(line), F.lit(1), first)), F.size(hits)

        def row(v: Column) -> Column:
            data = (filled >= least) & ~is_years(v, western=False)
            return F.when(filled > 0, F.struct(label.alias("label"), v.alias("values"), filled.alias("filled"), first.alias("start"), data.alias("data")))

        return bound(cells(hits, cols), row)

    return bound(adaptive(toks, cols), of)


def parsed_total(line, toks, columns, wide: int = 12) -> Column:
    """parsed() at the rightmost column; without a value the line's last token counts if it ends within `wide` of it."""
    cols = text(columns)
    right = F.when(F.size(cols) > 0, F.array(F.element_at(cols, -1)))
    last = F.when(F.size(text(toks)) > 0, F.array(F.element_at(text(toks), -1)["end"]))
    close = F.abs(F.get(last, F.lit(0)) - F.get(right, F.lit(0))) <= wide
    strict, loose = parsed(line, toks, right), parsed(line, toks, last)
    empty = strict.isNull() | F.get(strict["values"], F.lit(0)).isNull()
    return F.when(empty & close & loose.isNotNull(), loose).otherwise(strict)


def money_columns(columns, shares, least: float = 0.4) -> Column:
    """Columns whose tokens have thousands commas often enough, given that share by column."""
    pairs = F.arrays_zip(text(columns).alias("c"), text(shares).alias("s"))
    return F.transform(F.filter(pairs, lambda p: p["s"] >= least), lambda p: p["c"])


def value_columns(columns, comma_shares, short_share) -> Column:
    """Columns of amounts: those of money if there are two or more, else all but a first one of short notes; then four of them."""
    cols = text(columns)
    money = money_columns(cols, comma_shares)
    some = F.when(F.size(money) >= 2, money).when(text(short_share) > 0.6, F.slice(cols, 2, F.greatest(F.size(cols) - 1, F.lit(0)))).otherwise(cols)
    return F.when(F.size(cols) <= 4, cols).otherwise(_four(some))


def _four(some: Column) -> Column:
    n = F.size(some)
    half = F.floor(n / 2).cast("int")
    at = lambda i: F.get(some, i)
    ends = F.array(at(F.lit(0)), at(half - 1), at(half), at(n - 1))
    return F.when(n <= 4, some).when(n % 2 == 1, F.slice(some, -4, 4)).otherwise(ends)


def spill_values(page, consonants: str = voc.CONSONANTS, least: int = 3, max_lines: int = 24) -> Column:
    """Values of a column that went to a page of its own: the number of each line with one token and no letters, on a short page with a line of totals; dashes are left out; NULL if fewer than `least`."""
    lines = F.filter(F.split(text(page), "\n"), lambda ln: F.trim(ln) != "")

    def of(lines: Column) -> Column:
        total = F.exists(lines, lambda ln: F.regexp_replace(ln, f"[^{consonants}]", "").startswith(bones(voc.TOTAL, consonants)))
        found = F.transform(F.filter(lines, lambda ln: ~ln.rlike(f"[{consonants}]")), lambda ln: F.regexp_extract_all(ln, F.lit(voc.TOKEN), F.lit(0)))
        single = F.transform(F.filter(found, lambda x: F.size(x) == 1), lambda x: to_number(F.get(x, F.lit(0))))
        short = ~F.contains(F.element_at(lines, -1), F.lit(","))

        def judge(v: Column) -> Column:  # a short number at the end is the page's own
            number = short & (F.abs(F.element_at(v, -1)) < 1000)
            kept = F.when((F.size(v) > 0) & number, F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0)))).otherwise(v)
            return F.when((F.size(lines) <= max_lines) & total & (F.size(kept) >= least), kept)

        return bound(F.filter(single, lambda v: v.isNotNull()), judge)

    return F.when(F.exists(F.split(text(page), "\n"), lambda ln: F.trim(ln) != ""), bound(lines, of))
