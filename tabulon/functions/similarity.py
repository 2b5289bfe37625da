"""Similarity of strings by longest matching blocks; Spark has no such function, so Arrow batches of pairs go to Python."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tabulon import vocabulary as voc
from tabulon.functions.text import bones, has_table, head, page_kind, skeleton, text


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio(a, b) -> Column:
    """2 * matched / (length a + length b); the order of the arguments matters."""
    return _ratio(text(a), text(b))


BEST = StructType([StructField("r", DoubleType()), StructField("place", IntegerType()), StructField("alias", IntegerType())])


def nearest(forms, known: list[str], memo: int = 100_000) -> Column:
    """(r, place, alias): of an array of strings the one most like any known string, and which; ties to the earlier form, then the earlier known one.

    Each string is compared once by a worker, and only in full where upper bounds of the ratio allow more than is found already.
    """

    @F.pandas_udf(BEST)
    def best(lists: pd.Series) -> pd.DataFrame:
        matchers = [SequenceMatcher(None, "", k) for k in known]
        found: dict[str, tuple[float, int]] = {}

        def one(s: str) -> tuple[float, int]:
            if (got := found.get(s)) is not None:
                return got
            top, at = 0.0, -1
            for i, m in enumerate(matchers):
                m.set_seq1(s)
                if m.real_quick_ratio() > top and m.quick_ratio() > top and (r := m.ratio()) > top:
                    top, at = r, i
            if len(found) >= memo:
                found.clear()
            found[s] = top, at
            return top, at

        def row(forms: list | None) -> tuple[float, int, int]:
            top = (0.0, -1, -1)
            for place, s in enumerate(forms if forms is not None else ()):
                r, at = one(s)
                if r > top[0]:
                    top = r, place, at
            return top

        return pd.DataFrame([row(x) for x in lists], columns=["r", "place", "alias"])

    return best(text(forms))


def grams(s, cutoff: float) -> Column:
    """Some (character, occurrence) pairs of a string; of two strings whose ratio reaches the cutoff, at least one pair is common.

    The matched characters of two such strings are common pairs, at least cutoff / (2 - cutoff) of the longer one's and the shorter one's length;
    so among the first ones by hash, one more than all others, there must be one of them.
    """
    chars = F.filter(F.split(text(s), ""), lambda c: c != "")
    pairs = F.transform(chars, lambda c, i: F.xxhash64(c, F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c))))
    n = F.size(pairs)
    return F.slice(F.array_sort(pairs), 1, F.greatest(n - F.ceil(n * (cutoff / (2 - cutoff)) - 1e-9).cast("int") + 1, F.lit(1)))


def may_reach(a, b, cutoff: float) -> Column:
    """Whether lengths allow a ratio of at least cutoff: never loses a match."""
    x, y = F.length(text(a)), F.length(text(b))
    return (x + y > 0) & (2 * F.least(x, y) >= cutoff * (x + y))


ALIKE = StructType([StructField("kind", StringType()), StructField("r", DoubleType())])


def title_kind(page, titles: list[tuple[str, str]] | None = None) -> Column:
    """(kind, r) of the title most like a stretch of the page's head, by a window of the title's length; ties to the first."""
    wanted = [(k, bones(t)) for k, t in (titles if titles is not None else voc.TITLES)]

    @F.pandas_udf(ALIKE)
    def best(heads: pd.Series) -> pd.DataFrame:
        def one(h: str | None) -> tuple[str | None, float]:
            top, kind = 0.0, None
            if h is None:
                return kind, top
            for k, t in wanted:
                for i in range(max(1, len(h) - len(t) + 1)):
                    m = SequenceMatcher(None, t, h[i : i + len(t)])
                    if m.real_quick_ratio() > top and m.quick_ratio() > top and (r := m.ratio()) > top:
                        top, kind = r, k
            return kind, top

        return pd.DataFrame([one(h) for h in heads], columns=["kind", "r"])

    return best(skeleton(head(page)))


def page_kind_alike(page, titles: list[tuple[str, str]] | None = None, content: list[tuple[str, list[str]]] | None = None, cutoff: float = voc.TITLE_CUTOFF) -> Column:
    """(kind, how) of a page read by OCR: by its title; else, with a table and no heading of notes, by the title most alike, or by words of its body.

    how: title, alike and the ratio, content, notes, or none.
    """
    exact, sk, body = page_kind(page, titles=titles), skeleton(head(page)), skeleton(page)
    pair = lambda kind, how: F.struct(kind.alias("kind"), how.alias("how"))
    nothing = F.lit(None).cast("string")
    words = nothing
    for kind, marks in reversed(content if content is not None else voc.CONTENT):
        words = F.when(reduce(lambda a, b: a | b, [F.contains(body, F.lit(bones(m))) for m in marks]), kind).otherwise(words)
    asked = exact.isNull() & has_table(page) & ~F.contains(sk, F.lit(bones(voc.NOTES)))
    near = title_kind(F.when(asked, text(page)), titles)
    return (
        F.when(exact.isNotNull(), pair(exact, F.lit("title")))
        .when(~F.coalesce(has_table(page), F.lit(False)), pair(nothing, F.lit("none")))
        .when(F.contains(sk, F.lit(bones(voc.NOTES))), pair(nothing, F.lit("notes")))
        .when(near["r"] >= cutoff, pair(near["kind"], F.concat(F.lit("alike "), F.format_number(near["r"], 2))))
        .otherwise(pair(words, F.when(words.isNotNull(), "content").otherwise("none")))
    )
