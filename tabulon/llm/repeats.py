"""Exact repeated windows over a corpus, found without sending every window.

What a removed symbol is: one covered by a window of `length` symbols (bytes or
words) whose content also starts earlier (smaller doc_id, or the same document
and an earlier start).

Every window has an anchor, the position of the least hash among its k-grams.
Equal windows have their anchors at equal places, so windows need only be
compared around equal anchors:

1. Map: anchors of whole texts with a hash of the k-gram and, for words, one of
   the whole context (the symbols that any window over the anchor can reach).
   Equal contexts within a task are settled there: all but the first are repeats.
2. Index: by k-gram, anchors that occur once drop out. For words, equal contexts
   are settled as in 1, and anchors whose k-gram has several contexts stay
   open; for bytes all stay open.
3. Open anchors fetch their contexts from the texts and are compared exactly.
4. The settled and compared ranges meet the texts.

Steps 2 and 3 are what the two operators over this module do in their own way:
a log-structured fingerprint index for words, sorted suffix runs for bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import NULL_ID, bucket_of, free, ids_of, keyed, pack, partitions, stored, text_bytes, tidy, unpack

GROUP = 1 << 19
FLUSH = 1 << 20
_R = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []
SUB = 40  # a position's low bits; the number of a repeated doc_id's row stands above


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i modulo 2^64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, GROUP + (1 << 16))
        for i, x in enumerate((_R, pow(_R, -1, 1 << 64))):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            _powers[i : i + 1] = [np.cumprod(steps, dtype=np.uint64)]
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix(sym: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum(sym * powers(len(sym) + 1)[0][: len(sym)], out=out[1:])
    return out


def span_hash(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mixed((p[hi] - p[lo]) * powers(len(p))[1][lo] + (hi - lo).astype(np.uint64))


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit symbol for each word (cut at ASCII white space) and the words' offsets by document."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = space
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = ~inside
    start[1:] &= inside[:-1] | edge[1:]
    starts = np.flatnonzero(start)
    end = np.zeros(len(data) + 1, bool)
    end[1:] = ~inside[:-1] & (inside[1:] | edge[1:])
    ends = np.flatnonzero(end)
    return span_hash(prefix(_TABLE[data]), starts, ends), np.searchsorted(starts, offsets)


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _TABLE[data], offsets


def sliding(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over x[i : i + w] for each i with a full window."""
    n = len(x) - w + 1
    pad = np.resize(x[-1:], -len(x) % w)
    rows = np.concatenate((x, pad)).reshape(-1, w)
    ahead = f.accumulate(rows, axis=1).ravel()
    back = f.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[:n], ahead[w - 1 : w - 1 + n])


@dataclass(frozen=True)
class Windows:
    """What is compared: windows of `length` symbols with anchors of k symbols."""

    length: int
    k: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    contexts: bool = True  # whether anchors have a hash of their context

    @property
    def reach(self) -> int:
        return self.length - self.k

    def anchors(self, sym: np.ndarray, offsets: np.ndarray, first: int | None = None, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, k-gram hash, context hash) of the anchors of all windows, or of those that start in [first, last)."""
        length, k = self.length, self.k
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(sym) < length:
            return none
        p = prefix(sym)
        i = np.arange(len(sym) - k + 1)
        h = span_hash(p, i, i + k) | np.uint64(1)
        least = sliding(h, length - k + 1, np.minimum)
        sizes = np.diff(offsets)
        # windows that don't lie within one document don't count
        valid = np.zeros(len(sym) + 1, np.int32)
        long = sizes >= length
        np.add.at(valid, offsets[:-1][long], 1)
        np.add.at(valid, offsets[1:][long] - length + 1, -1)
        valid = np.cumsum(valid)[: len(least)] > 0
        if first is not None:
            valid[:first] = False
            valid[last:] = False
        least[~valid] = 0
        most = sliding(np.concatenate((np.zeros(length - k, np.uint64), least, np.zeros(length - k, np.uint64))), length - k + 1, np.maximum)
        at = np.flatnonzero(most[: len(h)] == h)
        doc = np.searchsorted(offsets, at, "right") - 1
        if not self.contexts:
            return doc, at - offsets[doc], h[at], h[:0]
        lo, hi = np.maximum(at - self.reach, offsets[doc]), np.minimum(at + length, offsets[doc + 1])
        context = span_hash(p, lo, hi) + (at - lo).astype(np.uint64)
        return doc, at - offsets[doc], h[at], context

    def all_anchors(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """anchors() of many documents, in groups; very long documents by overlapping slices."""
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP, "right")) - 1)
            sym, so = self.symbols(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            if len(sym) <= 2 * GROUP:
                doc, place, h, c = self.anchors(sym, so)
                yield doc + i, place, h, c
            else:
                for s in range(0, len(sym), GROUP):
                    lo, hi = max(0, s - self.length), min(len(sym), s + GROUP + 2 * self.length)
                    _, place, h, c = self.anchors(sym[lo:hi], np.array([0, hi - lo]), s - lo, min(s + GROUP, len(sym) - self.length + 1) - lo)
                    yield np.full(len(place), i), place + lo, h, c
            i = j


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before; the first does."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def blocks(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One packed row for each bucket of rows."""
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    edges = np.append(np.flatnonzero(runs(sorted_)), len(sorted_)) if len(sorted_) else np.zeros(1, np.int64)
    columns = [c[order] for c in columns]
    data = [pack(*(c[i:j] for c in columns)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(sorted_[edges[:-1]] if len(sorted_) else [], pa.int32()), pa.array([kind] * len(data), pa.int32()), pa.array(data, pa.binary())], names=["bucket", "kind", "block"])


def one_block(bucket: int, kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([pack(*columns)], pa.binary())], names=["bucket", "kind", "block"])


BLOCKS = "bucket int, kind int, block binary"
ANCHORS, SETTLED, OPEN, COMPARED, TEXT = range(5)


def settle(key: np.ndarray, context: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by (key, context, doc, pos): which have an equal context before them, and which are the first of theirs."""
    new = runs(key, context)
    same = ~runs(key, context, doc, pos)  # the same place twice, from two slices
    return ~new & ~same, new


def map_anchors(windows: Windows, n: int, n_docs: int, settled: bool = True):
    """Step 1, with n buckets of k-grams and n_docs buckets of documents; without settling, anchors go on without a hash of their context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            doc, pos, h, c = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            bucket = (h >> np.uint64(8)).astype(np.int64) % n
            if not settled:
                order = np.lexsort((pos, doc, bucket))
                yield blocks(ANCHORS, bucket[order], h[order], doc[order], pos[order])
                return
            order = np.lexsort((pos, doc, c, h))
            doc, pos, h, c = doc[order], pos[order], h[order], c[order]
            repeat, first = settle(h, c, doc, pos)
            yield blocks(SETTLED, bucket_of(doc[repeat], n_docs), doc[repeat], pos[repeat])
            yield blocks(ANCHORS, (h[first] >> np.uint64(8)).astype(np.int64) % n, h[first], c[first], doc[first], pos[first])

        size = 0
        for batch in batches:
            ids, sub = ids_of(batch.column(0)), batch.column(1).to_numpy().astype(np.int64)
            data, offsets = text_bytes(batch.column(2))
            for d, place, h, c in windows.all_anchors(data, offsets):
                held.append((ids[d], (sub[d] << SUB) + place, h, c))
                size += len(d)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for batch in batches:
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block"), strict=True):
            if kind != TEXT:
                out.setdefault(kind, []).append(block.as_py())
    return out


def columns_of(found: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*map(unpack, found), strict=True)]


def resolve_anchors(windows: Windows, n: int, index):
    """Step 2: what the index says of each bucket's anchors, addressed to the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = gathered(batches)
        for block in found.get(SETTLED, ()):
            doc, pos = unpack(block)
            yield blocks(SETTLED, bucket_of(doc, n), doc, pos)
        if ANCHORS in found:
            h, doc, pos, repeat, open_ = index(found[ANCHORS])
            yield blocks(SETTLED, bucket_of(doc[repeat], n), doc[repeat], pos[repeat])
            yield blocks(OPEN, bucket_of(doc[open_], n), doc[open_], pos[open_], h[open_])

    return run


def closed(n: int):
    """Texts as rows beside blocks, each compressed: they are what is shuffled most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids = ids_of(batch.column(0))
            raw = batch.column(2).cast(pa.binary()).fill_null(b"").to_pylist()
            columns = [pa.array(bucket_of(ids, n), pa.int32()), pa.array(np.full(len(ids), TEXT, np.int32)), pa.array([compress(r) if r else b"" for r in raw], pa.binary()), batch.column(0), batch.column(1), pa.array([len(r) for r in raw], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "block", "doc_id", "sub", "n_bytes"])

    return run


_open = zstandard.ZstdDecompressor()


def opened(block: bytes) -> bytes:
    return _open.decompress(block) if block else b""


def contexts_of(windows: Windows, n: int, make):
    """Step 3a: the open anchors of each document with their contexts, as make()() packs them by bucket of their k-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = make()
        texts, found = split(batches)
        if OPEN not in found:
            for _ in texts:
                pass
            return
        doc, pos, h = columns_of(found[OPEN])
        order = np.lexsort((pos, doc))
        doc, pos, h = doc[order], pos[order], h[order]
        for batch in texts:
            ids, sub = ids_of(batch.column("doc_id")), batch.column("sub").to_numpy().astype(np.int64)
            lo, hi = ranges(doc, pos, ids, sub)
            with_any = np.flatnonzero(hi > lo)
            size = np.zeros(len(ids), np.int64)
            size[with_any] = batch.column("n_bytes").to_numpy()[with_any]
            for part in np.array_split(with_any, max(1, int(size.sum()) // GROUP)) if len(with_any) else ():
                rows = np.concatenate([np.arange(lo[i], hi[i]) for i in part])
                which = np.repeat(np.arange(len(part)), hi[part] - lo[part])
                raw = [opened(batch.column("block")[i].as_py()) for i in part.tolist()]
                off = np.cumsum([0, *map(len, raw)])
                yield from emit(np.frombuffer(b"".join(raw), np.uint8), off, which, pos[rows] & ((1 << SUB) - 1), h[rows], doc[rows], pos[rows])
        if hasattr(emit, "flush"):
            yield from emit.flush()

    return run


def split(batches: Iterator[pa.RecordBatch]) -> tuple[Iterator[pa.RecordBatch], dict[int, list[bytes]]]:
    """A partition's blocks, which come first, and the texts behind them as they come."""
    found: dict[int, list[bytes]] = {}
    batches = iter(batches)
    first = None
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        n = int(np.searchsorted(kind, TEXT))
        for k, block in zip(kind[:n].tolist(), batch.column("block")[:n], strict=True):
            found.setdefault(k, []).append(block.as_py())
        if n < len(kind):
            first = batch.slice(n)
            break
    return (x for x in chain([first] if first is not None else [], batches)), found


def ranges(doc: np.ndarray, pos: np.ndarray, ids: np.ndarray, sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each document's rows lie among rows sorted by (doc, pos)."""
    number = pos >> SUB
    lo, hi = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
    if len(sub) and (sub.any() or number.any()):
        for i in np.flatnonzero(hi > lo).tolist():
            a, b = lo[i], hi[i]
            lo[i], hi[i] = a + np.searchsorted(number[a:b], sub[i], "left"), a + np.searchsorted(number[a:b], sub[i], "right")
    return lo, hi


def finish(windows: Windows, words: bool, with_text: bool):
    """Step 4: what is left of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = split(batches)
        parts = []
        if SETTLED in found:
            doc, pos = columns_of(found[SETTLED])
            parts.append((doc, pos, pos - windows.reach, pos + windows.length))
        if COMPARED in found:
            doc, pos, most, least = columns_of(found[COMPARED])
            parts.append((doc, pos, pos - most, pos + windows.length - least))
        if parts:
            doc, pos, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((pos, doc))
            doc, pos, lo, hi = doc[order], pos[order], lo[order], hi[order]
        else:
            doc = pos = lo = hi = np.zeros(0, np.int64)
        low = (1 << SUB) - 1
        for batch in texts:
            ids, sub = ids_of(batch.column("doc_id")), batch.column("sub").to_numpy().astype(np.int64)
            first, last = ranges(doc, pos, ids, sub)
            out = []
            for i, block in enumerate(batch.column("block")):
                raw = opened(block.as_py())
                items = raw.split() if words else raw
                n = len(items)
                if first[i] < last[i]:
                    base = pos[first[i]] & ~low
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, np.maximum(lo[first[i] : last[i]] - base, 0), 1)
                    np.add.at(cover, np.minimum(hi[first[i] : last[i]] - base, n), -1)
                    gone = np.cumsum(cover)[:n] > 0
                    edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    kept = b" ".join(compress(items, (~gone).tolist())) if words else np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    edges = np.zeros(0, np.int64)
                    kept = b" ".join(items) if words else raw
                removed = int((edges[1::2] - edges[::2]).sum())
                row = (int(ids[i]) if ids[i] != NULL_ID else None, int(sub[i]), n, removed, len(edges) // 2, hashlib.sha256(kept).hexdigest())
                spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
                rest = None if not with_text else kept.decode() if words else without(raw, spans)
                out.append((*row, [{"first": a, "last": b} for a, b in spans], kept, rest) if with_text else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.binary(), pa.string()]
            names = ["doc_id", "sub", "n", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "rest"]
            m = 9 if with_text else 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names=names[:m])

    return run


def without(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """UTF-8 text without ranges of its bytes, each narrowed to whole characters."""
    inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    out, at = [], 0
    for first, last in spans:
        while inside(first):
            first += 1
        while last > first and inside(last):
            last -= 1
        out.append(raw[at:first])
        at = max(last, first)
    return (b"".join(out) + raw[at:]).decode()


def repeats(docs: DataFrame, windows: Windows, index, emit, compare, words: bool, with_text: bool = False, id_column: str = "doc_id", text_column: str = "text", history: tuple[DataFrame, DataFrame, int] | None = None, settled: bool = True) -> DataFrame:
    """(doc_id, sub, n, n_removed, n_spans, kept_sha256[, spans, kept, rest]) for each row of docs.

    index(blocks) -> (hashes, docs, positions, repeats, open) for step 2;
    what emit() makes packs the contexts of open anchors, compare decides on them.
    history: blocks of anchors and the texts (doc_id, sub, text) of earlier
    documents, and the number of buckets of those blocks.
    """
    n = partitions(docs.sparkSession)
    rows = keyed(docs.withColumnRenamed(id_column, "doc_id") if id_column != "doc_id" else docs, text_column).withColumnRenamed(text_column, "text")
    anchors = rows.mapInArrow(tidy(map_anchors(windows, history[2] if history else 4 * n, 4 * n, settled), keep=False), BLOCKS)
    if history:
        anchors = anchors.union(history[0])
    found = stored(anchors.repartition(n, "bucket").mapInArrow(tidy(resolve_anchors(windows, 4 * n, index), keep=False), BLOCKS))
    del anchors
    free(docs.sparkSession)

    def as_texts(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "sub", "text").mapInArrow(tidy(closed(4 * n), keep=False), BLOCKS + ", doc_id long, sub int, n_bytes long")

    def beside(blocks_: DataFrame, texts: DataFrame) -> DataFrame:
        wide = blocks_.select("bucket", "kind", "block", F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("sub"), F.lit(0).cast("long").alias("n_bytes"))
        return texts.union(wide).repartition(n, "bucket").sortWithinPartitions("kind")

    texts = as_texts(rows)
    every = texts.union(as_texts(history[1])) if history else texts
    contexts = beside(found.filter(F.col("kind") == OPEN), every).mapInArrow(tidy(contexts_of(windows, n, emit), keep=False), BLOCKS)
    compared = stored(contexts.repartition(n, "bucket").mapInArrow(tidy(compare, keep=False), BLOCKS))
    del contexts
    free(docs.sparkSession)
    schema = "doc_id long, sub int, n long, n_removed long, n_spans long, kept_sha256 string" + ", spans array<struct<first: long, last: long>>, kept binary, rest string" * with_text
    return beside(found.filter(F.col("kind") == SETTLED).union(compared), texts).mapInArrow(tidy(finish(windows, words, with_text), keep=False), schema)
