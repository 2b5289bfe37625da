"""Suffix-array dedup: a common-prefix-aware distributed merge sort of suffixes.

Suffixes are taken at anchors, of which every repeated window holds one, and
only at anchors whose first bytes occur elsewhere, too. Each task sorts its
suffixes (the bytes from an anchor on, as far as a window can reach) into runs,
and the reversed bytes before them into others, front-codes them and sends them
by the hash of the first bytes. A receiver merges its runs with loser trees
that compare only what lies behind the prefixes that are known already; the
merges yield the suffix array, the order to the left, and the common prefixes
of both. Anchors with equal surroundings stand side by side there; windows over
two others are equal if their suffixes share enough to the right and to the
left, which the common prefixes answer for all at once. Every byte that is
removed has been compared, none is judged by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabulon.llm.common import bucket_of, partitions
from tabulon.llm.repeats import COMPARED, OPEN, Windows, blocks, byte_symbols, columns_of, one_block, repeats, runs, unpack

WINDOW, GRAM = 100, 24
RUN = 1 << 16  # suffixes that are sorted into runs together


def differ(a: bytes, b: bytes) -> int:
    """Where two different strings of one length first differ."""
    return len(a) - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def past(a: bytes, b: bytes, k: int) -> tuple[int, bool]:
    """Common prefix of two strings that are known to share k bytes, and whether the first comes first (if they are equal, too); only bytes behind the k-th are looked at."""
    m = min(len(a), len(b))
    x, y = a[k:m], b[k:m]
    if x == y:
        return m, len(a) <= len(b)
    return k + differ(x, y), x < y


def front_coded(sorted_: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length, and what remains, of sorted strings."""
    shared = [0, *(past(s, t, 0)[0] for s, t in pairwise(sorted_))][: len(sorted_)]
    return np.array(shared, np.int32), np.array([len(s) for s in sorted_], np.int32), b"".join(s[k:] for s, k in zip(sorted_, shared, strict=True))


def decoded(shared: np.ndarray, lengths: np.ndarray, rest: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a front-coded run, each with its common prefix with the one before."""
    last, at = b"", 0
    for k, n in zip(shared.tolist(), lengths.tolist(), strict=True):
        last = last[:k] + rest[at : at + n - k]
        at += n - k
        yield last, k


def merged(several: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs of (string, common prefix with the one before) with a loser tree.

    Yields (run, string, common prefix with the string yielded before). Every
    inner node keeps the loser of its match and the prefix that it shares with
    the winner; a new entrant knows the prefix that it shares with the string
    just taken from its run. Of two contenders the one with the longer prefix
    is the lesser; only at equal prefixes are bytes compared, past the prefix.
    """
    k = 1
    while k < len(several):
        k *= 2
    head: list[bytes | None] = [None] * k
    shared = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then the one that it shares with the winner."""
        if head[a] is None or head[b] is None:
            return (a, b) if head[b] is None else (b, a)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n, first = past(head[a], head[b], shared[a])
        w, l = (a, b) if first else (b, a)
        shared[l] = n
        return w, l

    for r, run in enumerate(several):
        head[r] = next(run, (None, 0))[0]
    tree = [0] * k
    up = list(range(k))
    base = k
    while len(up) > 1:
        base //= 2
        nxt = []
        for i in range(0, len(up), 2):
            w, l = play(up[i], up[i + 1])
            tree[base + i // 2] = l
            nxt.append(w)
        up = nxt
    win = up[0]
    while head[win] is not None:
        yield win, head[win], shared[win]
        head[win], shared[win] = next(several[win], (None, 0))
        node = (win + k) // 2
        while node:
            other = tree[node]
            if head[other] is not None:  # a run that has ended stays where it lost
                if head[win] is None or shared[other] > shared[win]:
                    win, tree[node] = other, win
                elif shared[other] == shared[win]:
                    win, tree[node] = play(win, other)
            node //= 2


def index(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors whose first bytes occur more than once, by their hash; which of them are equal is left to the merge."""
    key, doc, pos = columns_of(found)
    order = np.lexsort((pos, doc, key))
    key, doc, pos = key[order], doc[order], pos[order]
    keep = runs(key, doc, pos)  # one place may come from two slices
    key, doc, pos = key[keep], doc[keep], pos[keep]
    new = runs(key)
    several = np.bincount(np.cumsum(new) - 1) > 1 if len(key) else np.zeros(0, bool)
    return key, doc, pos, np.zeros(len(key), bool), several[np.cumsum(new) - 1]


class Emitter:
    """Collects the suffixes of a task and the text before them, and sends them as sorted, front-coded runs, one for each bucket."""

    def __init__(self, windows: Windows, n: int):
        self.windows, self.n = windows, n
        self.right: list[bytes] = []
        self.left: list[bytes] = []
        self.rows: list[tuple] = []

    def __call__(self, data, offsets, which, place, h, doc, pos) -> Iterator[pa.RecordBatch]:
        raw, base = data.tobytes(), offsets[which]
        at = base + place
        hi = np.minimum(at + self.windows.length, offsets[which + 1]).tolist()
        lo = np.maximum(at - self.windows.reach, base).tolist()
        at = at.tolist()
        self.right += [raw[a:b] for a, b in zip(at, hi, strict=True)]
        self.left += [raw[a:b][::-1] for a, b in zip(lo, at, strict=True)]
        self.rows.append((h, doc, pos))
        if len(self.right) >= RUN:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.right:
            return
        h, doc, pos = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        right, left = self.right, self.left
        self.right, self.left, self.rows = [], [], []
        bucket = (h >> np.uint64(8)).astype(np.int64) % self.n
        by_bucket = bucket.tolist()
        rank = np.empty(len(doc), np.int64)
        rank[np.lexsort((pos, doc))] = np.arange(len(doc))
        rank = rank.tolist()
        order = sorted(range(len(right)), key=lambda i: (by_bucket[i], right[i], left[i], rank[i]))
        # of equal surroundings only the first goes on; the others repeat it
        again = np.array([False, *(right[i] == right[j] and left[i] == left[j] and by_bucket[i] == by_bucket[j] for i, j in pairwise(order))])
        order = np.array(order)
        same = order[again]
        left_size, right_size = np.array([len(x) for x in left]), np.array([len(x) for x in right])
        yield blocks(COMPARED, bucket_of(doc[same], 4 * self.n), doc[same], pos[same], left_size[same], np.maximum(self.windows.length - right_size[same], 0))
        order = order[~again]
        sorted_ = bucket[order]
        edges = np.append(np.flatnonzero(runs(sorted_)), len(order)).tolist()
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            o = order[i:j].tolist()
            ahead = [left[x] for x in o]
            by_left = sorted(range(len(o)), key=ahead.__getitem__)
            code = lambda strings: [*(x := front_coded(strings))[:2], np.frombuffer(x[2], np.uint8)]
            yield one_block(int(sorted_[i]), OPEN, *code([right[x] for x in o]), np.array(by_left, np.int32), *code([ahead[x] for x in by_left]), doc[o], pos[o])


def order_of(several: list[tuple[np.ndarray, np.ndarray, np.ndarray]], places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Front-coded runs merged: the places of all strings in order, and each one's common prefix with the one before."""
    at = [iter(p.tolist()) for p in places]
    array, shared = [], []
    for run, _, k in merged([decoded(a, b, c.tobytes()) for a, b, c in several]):
        array.append(next(at[run]))
        shared.append(k)
    return np.array(array, np.int64), np.array(shared, np.int64)


def comparer(windows: Windows, n: int):
    left, length = windows.reach, windows.length

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        told: list[list[np.ndarray]] = []
        for batch in batches:
            for bucket, kind, block in zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist(), batch.column("block"), strict=True):
                if kind == OPEN:
                    found.setdefault(bucket, []).append(block.as_py())
                else:
                    told.append(unpack(block.as_py()))
        while found:  # bucket by bucket, since no suffix of one equals one of another
            told.append(one(found.popitem()[1]))
        if told:  # one block for each bucket of documents
            doc, pos, most, least = (np.concatenate(x) for x in zip(*told, strict=True))
            yield blocks(COMPARED, bucket_of(doc, 4 * n), doc, pos, most, least)

    def one(several: list[bytes]) -> list[np.ndarray]:
        parts = [unpack(x) for x in several]
        start = np.cumsum([0, *(len(p[0]) for p in parts)])
        doc, pos = (np.concatenate([p[i] for p in parts]) for i in (7, 8))
        # the suffix array over all runs and the order of what stands before, with the common prefixes of neighbours
        right, right_shared = order_of([p[0:3] for p in parts], [np.arange(a, b) for a, b in pairwise(start)])
        by_left, left_shared = order_of([p[4:7] for p in parts], [p[3] + a for p, a in zip(parts, start, strict=False)])
        right_size, left_size = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
        for p, a in zip(parts, start, strict=False):
            right_size[a : a + len(p[1])], left_size[a + p[3]] = p[1], p[5]
        del parts
        rank = np.empty(len(doc), np.int64)
        rank[np.lexsort((pos, doc))] = np.arange(len(doc))

        def classes(order: np.ndarray, shared: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
            """A number for each string, the same for equal ones, as far as `most` bytes tell."""
            new = np.ones(len(order), bool)
            cut = np.minimum(size[order], most)
            new[1:] = (shared[1:] < cut[1:]) | (cut[1:] != cut[:-1])
            out = np.empty(len(order), np.int64)
            out[order] = np.cumsum(new)
            return out

        most, least = np.full(len(doc), -1), np.full(len(doc), length)
        # equal surroundings: all windows over the anchor repeat, but for the first of them
        key = classes(right, right_shared, right_size, length) * (len(doc) + 1) + classes(by_left, left_shared, left_size, left)
        by = np.lexsort((rank, key))
        new = runs(key[by])
        same = by[~new]
        most[same], least[same] = left_size[same], np.maximum(length - right_size[same], 0)
        # the first ones of anchors whose first bytes stand in several surroundings
        first = by[new]
        gram = classes(right, right_shared, right_size, windows.k)[first]
        open_ = np.sort(first[np.bincount(gram)[gram] > 1])
        inside = np.zeros(len(doc), bool)
        inside[open_] = True
        for order, shared in ((right, right_shared), (by_left, left_shared)):
            # common prefixes with the one before among those that are left
            keep = inside[order]
            run = np.cumsum(keep)
            least_shared = np.full(int(run[-1]) + 1 if len(run) else 1, length)
            np.minimum.at(least_shared, run - keep, shared)
            if order is right:
                right, right_shared = order[keep], least_shared[:-1][: keep.sum()]
            else:
                by_left, left_shared = order[keep], least_shared[:-1][: keep.sum()]
        r_id, l_id = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        for o in range(left + 1):  # windows that start o bytes before the anchor
            ok = open_[(left_size[open_] >= o) & (right_size[open_] >= length - o)]
            if len(ok) < 2:
                continue
            r_id[right] = np.cumsum(right_shared < length - o)
            l_id[by_left] = np.cumsum(left_shared < o)
            key = r_id[ok] * (len(doc) + 1) + l_id[ok]
            by = np.lexsort((rank[ok], key))
            hit = ok[by[1:][key[by][1:] == key[by][:-1]]]
            most[hit] = np.maximum(most[hit], o)
            least[hit] = np.minimum(least[hit], o)
        hit = most >= 0
        return [doc[hit], pos[hit], most[hit], least[hit]]

    return compare


def suffix_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Remove each byte covered by a string of `window` bytes that also starts earlier.

    Returns (doc_id, sub, n, n_removed, n_spans, kept_sha256) and, if asked,
    spans (ranges of removed bytes), kept (the other bytes) and rest (the text
    without the characters that lie within removed ranges). Null texts are
    empty, texts shorter than a window lose nothing, matches never cross
    documents. Of rows with the same doc_id (null ones too, which come first)
    the later in the order of their texts count as later documents, with sub
    above 0. Other columns play no part.
    """
    n = partitions(docs.sparkSession)
    windows = Windows(window, min(GRAM, window), byte_symbols, contexts=False)
    return repeats(docs, windows, index, lambda: Emitter(windows, n), comparer(windows, n), False, with_text, id_column, text_column, settled=False)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).selectExpr("doc_id", "n as n_bytes", "n_removed", "n_spans", "kept_sha256")
