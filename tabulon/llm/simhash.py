"""SimHash near-duplicates: 64-bit fingerprints linked within a Hamming distance by pigeonring filtering.

The ring has 16 segments of 4 bits. Two fingerprints with at most 3 different
bits have a place on the ring from where every prefix chain of segments stays
within its proportional budget l * 3 / 16: the first five segments are equal
(20 bits), and the ten first ones have at most one difference, so one of the
two halves of the next 20 bits is equal too. Each fingerprint is therefore
filed under 16 * 2 keys of 30 bits; within a key the remaining chain budgets
are tested before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import partitions, stored, tidy
from tabulon.llm.components import components

SEGMENTS, BITS = 16, 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(p, 42) for p in parts]), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col(id_column).cast("long"), text_column).mapInArrow(tidy(compute, keep=False), "doc_id long, fp long")


def rotated(fp: np.ndarray, start: int) -> np.ndarray:
    """fp with segment `start` of the ring foremost."""
    if not start:
        return fp
    n = 4 * start
    return (fp << np.uint64(n)) | (fp >> np.uint64(BITS - n))


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 32 keys of each fingerprint and, in step, the fingerprint. A key: start 4 bits, half 1 bit, 30 bits of the fingerprint."""
    out = []
    for start in range(SEGMENTS):
        r = rotated(fp, start)
        first = (r >> np.uint64(44)) << np.uint64(10)
        for half in (0, 1):
            rest = (r >> np.uint64(34 - 10 * half)) & np.uint64(1023)
            out.append(np.uint64(start * 2 + half) << np.uint64(30) | first | rest)
    return np.concatenate(out).view(np.int64), np.tile(fp, 2 * SEGMENTS)


def near(a: np.ndarray, b: np.ndarray, start: int, distance: int) -> np.ndarray:
    """Whether pairs pass the chain budgets from `start` on, and then the full distance."""
    x = rotated(a ^ b, start)
    ok = np.ones(x.shape, bool)
    for length in (10, 15):  # the budgets rise to 1 after five segments, to 2 after ten, to 3 after fifteen
        ok &= np.bitwise_count(x >> np.uint64(BITS - 4 * length)) <= distance * length // SEGMENTS
    ok[ok] = np.bitwise_count(x[ok]) <= distance
    return ok


def link(fps: np.ndarray, start: int, distance: int, low: int = 34, small: int = 256) -> Iterator[tuple[int, int]]:
    """Edges that connect what is near within one key; a spanning set, not all pairs.

    Large groups are cut again by each quarter of the bits that the key leaves
    open: of four quarters one is equal in any near pair.
    """
    n = len(fps)
    if n > small and low > 8:
        cut = set()
        for q in range(4):
            a, b = low * q // 4, low * (q + 1) // 4
            part = (rotated(fps, start) >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
            order = np.argsort(part, kind="stable")
            bounds = np.flatnonzero(np.diff(part[order], prepend=part[order][:1] ^ np.uint64(1), append=part[order][-1:] ^ np.uint64(1)))
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                if j - i > 1:
                    cut.update(link(fps[order[i:j]], start, distance, 0))
        yield from cut
        return
    left = np.arange(n)
    while len(left):  # breadth-first: each round links all that are near a reached one
        front = left[:1]
        left = left[1:]
        while len(front) and len(left):
            parent = np.full(len(left), -1)
            for at in range(0, len(front), 64):
                f = front[at : at + 64]
                hit = near(fps[left][:, None], fps[f][None, :], start, distance)
                got = hit.any(axis=1) & (parent < 0)
                parent[got] = f[hit[got].argmax(axis=1)]
            new = parent >= 0
            for i, p in zip(left[new], parent[new], strict=True):
                yield int(fps[p].view(np.int64)), int(fps[i].view(np.int64))
            front, left = left[new], left[~new]


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) among distinct fingerprints fp that connect every two of them within the distance."""
    if not 0 <= distance <= 3:
        raise ValueError("the ring's keys hold for distances up to 3")

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp = keys(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp.view(np.int64))], names=["key", "fp"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if len(b)]
        if not got:
            return
        key, fp = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((fp, key))
        key, fp = key[order], fp[order].view(np.uint64)
        bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        two = np.flatnonzero(np.diff(bounds) == 2)  # most groups: all at once
        out_a, out_b = [], []
        for start in range(SEGMENTS):
            i = bounds[two][(key[bounds[two]] >> 31) == start]
            ok = near(fp[i], fp[i + 1], start, distance)
            out_a.append(fp[i][ok].view(np.int64))
            out_b.append(fp[i + 1][ok].view(np.int64))
        for g in np.flatnonzero(np.diff(bounds) > 2):
            i, j = bounds[g], bounds[g + 1]
            if e := list(link(fp[i:j], int(key[i] >> 31), distance)):
                a, b = np.array(e, np.int64).T
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    n = partitions(distinct.sparkSession)
    return distinct.select("fp").mapInArrow(tidy(file, keep=False), "key long, fp long").repartition(n, "key").mapInArrow(tidy(pair, keep=False), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; component_id is the least doc_id reachable over links.

    Null and empty texts have fingerprint zero and are linked like others.
    Rows with a null doc_id get a component, but lend no id to it unless all of
    its ids are null. Repeated rows each have a row. Copies meet as one
    fingerprint before anything is paired; other columns play no part.
    """
    fps = stored(fingerprints(docs, shingle, id_column, text_column))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = stored(components(links(distinct, distance)))
    named = distinct.join(roots, distinct.fp == roots.node).groupBy("root").agg(F.min("least").alias("component_id"))
    of = distinct.join(roots, distinct.fp == roots.node, "left").join(named, "root", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(stored(of), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
