"""Words with boxes to layout text: lines by their middles, words to columns. Folds over a page; pages are independent and go to Python many at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.text import normalise_digits

NUMBER = re.compile(r"[\d,.()\-]+")


def assemble(words: pd.DataFrame, near: float = 0.6) -> str:
    """Layout text of one page's words (text, x, y, w, h). Only numbers tell how wide a character is, if there are any: marks above and below letters take no room."""
    return assembled([(str(r.text), r.x, r.y, r.w, r.h) for r in words.itertuples()], near)


def assembled(words: list[tuple], near: float = 0.6) -> str:
    """assemble() of words as tuples; words whose middles are level stay in their order."""
    if not words:
        return ""
    rows = sorted(((y + h / 2, i, x, w, t) for i, (t, x, y, w, h) in enumerate(words)), key=lambda r: r[:2])
    width = lambda some: sorted(w / max(1, len(t)) for _, _, _, w, t in some)
    widths, heights = width([r for r in rows if NUMBER.fullmatch(r[4])]) or width(rows), sorted(r[4] for r in words)
    height, char = heights[len(heights) // 2], widths[len(widths) // 2] or 1
    lines: list[list] = []
    at = None
    for mid, _, x, w, t in rows:
        if at is not None and abs(mid - at) <= near * height:
            lines[-1].append((x, w, t))
            at = (at + mid) / 2
        else:
            lines.append([(x, w, t)])
            at = mid
    out = []
    for line in lines:
        text, right = "", None
        for x, w, t in sorted(line, key=lambda r: r[0]):
            if right is None or x - right >= 0.5 * char:
                column = round(x / char)
                text = text.ljust(column if column >= len(text) else len(text) + 1)
            text += t
            right = x + w
        out.append(text.rstrip())
    return "\n".join(out)


def layout(boxes: DataFrame, least: float = 30.0) -> DataFrame:
    """(source, page, text) from boxes (source, page, text, x, y, w, h, conf) that were read surely enough; letters in numbers that OCR takes for digits are put right."""
    good = boxes.withColumn("text", F.trim("text")).filter((F.col("conf") >= least) & (F.col("text") != "")).withColumn("text", normalise_digits("text"))

    word = F.struct("y", "x", "text", "w", "h")
    listed = good.groupBy("source", "page").agg(F.array_sort(F.collect_list(word)).alias("words"))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column(2)
            y, x, t, w, h = (c.to_pylist() if pa.types.is_string(c.type) else c.cast(pa.float64()).to_numpy(zero_copy_only=False).tolist() for c in each.flatten().flatten())
            at = each.offsets.to_numpy() - each.offsets[0].as_py()  # a batch may be a slice
            text = [assembled(list(zip(t[i:j], x[i:j], y[i:j], w[i:j], h[i:j], strict=True))) for i, j in pairwise(at.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=["source", "page", "text"])

    return listed.select(F.col("source").cast("string"), F.col("page").cast("int"), "words").mapInArrow(pages, "source string, page int, text string")
