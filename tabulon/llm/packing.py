"""Mixture-controlled packing: deficit round-robin over source queues fills windows to target token proportions.

Documents are encoded once and stored as parts: blocks of documents with the
ids of each. What a part's sources have been owed when the part begins follows
from the token counts of the parts before it, so that deficits carry over from
part to part although all parts are packed at the same time. Windows have
`length` ids; what is left at a part's end fills windows of falling powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import NULL_ID, ids_of, pack, stored, tidy, unpack
from tabulon.llm.encoding import CACHE, encoder
from tabulon.session import small_batches

PART_IDS = 1 << 21
PIECE = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def parts(docs: DataFrame, file: str, end: int | None, columns: tuple[str, str, str], cache: int = CACHE) -> DataFrame:
    """(task, seq, sources, counts, block): blocks of encoded documents, in the order of the input."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file, cache)
        last = np.array([] if end is None else [end], e.dtype)
        task = TaskContext.get().partitionId()
        seq = size = 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, size
            docs_, names, n, ids = (np.concatenate([h[k] for h in held]) for k in range(4))
            held.clear()
            known: dict = {}
            s = np.array([known.setdefault(x, len(known)) for x in names.tolist()], np.int32)
            counts = np.bincount(s, weights=n, minlength=len(known)).astype(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([seq], pa.int32()), pa.array([list(known)], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([pack(docs_, s, n, ids)], pa.binary())], names=["task", "seq", "sources", "counts", "block"])
            seq, size = seq + 1, 0
            return out

        for batch in batches:
            docs_, names, at = ids_of(batch.column(0)), np.array(batch.column(1).to_pylist(), object), 0
            for ids, bounds in e.column(batch.column(2)):
                n = np.diff(bounds)
                to = at + len(n)
                held.append((docs_[at:to], names[at:to], n + len(last), np.insert(ids, np.repeat(bounds[1:], len(last)), last[0]) if len(last) else ids))
                size += len(held[-1][3])
                at = to
                if size >= PART_IDS:
                    yield flush()
        if held:
            yield flush()

    doc, source, text = columns
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(doc).cast("long"), F.col(source).cast("string"), F.col(text).cast("string"))
    return slim.mapInArrow(tidy(encode), "task int, seq int, sources array<string>, counts array<long>, block binary")


def fill(sizes: list[int], shares: np.ndarray, owed: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For each window size, the (source, ids) taken for it by deficit round-robin; owed and left are carried on in place."""
    first = 0
    for size in sizes:
        owed += shares * size
        took, room = np.zeros(len(left), np.int64), size
        order = np.roll(np.arange(len(left)), -first)
        first = (first + 1) % len(left)
        for s in order:
            if (n := min(int(owed[s]), int(left[s]), room)) > 0:
                took[s] += n
                owed[s] -= n
                left[s] -= n
                room -= n
        while room:
            s = int(np.argmax(np.where(left > 0, owed, -np.inf)))
            n = min(int(left[s]), room)
            took[s] += n
            owed[s] -= n
            left[s] -= n
            room -= n
        yield size, [(int(s), int(took[s])) for s in order if took[s]]


def windows(total: int, length: int) -> list[int]:
    """Window sizes for so many ids: full ones, then falling powers of two."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, file: str, length: int = 4096, end: int | None = 2, targets: dict[str, float] | None = None, ids: bool = True, columns: tuple[str, str, str] = ("doc_id", "source", "text"), cache: int = CACHE) -> DataFrame:
    """Packed pieces: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, the ids as little-endian unsigned 32-bit numbers.

    targets: the wanted token share of each source; without it, the shares of
    the whole input. Sources without a target are only used to fill up. Null
    texts have no ids but the end; a null source is a source of its own; each
    row is packed for itself, whether or not its doc_id is null or repeated.
    cache: words that a worker keeps the ids of; it only costs or saves time.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("length must be a power of two")
    got = stored(parts(docs, file, end, columns, cache))
    counts = got.select("task", "seq", F.explode(F.arrays_zip("sources", "counts")).alias("c")).select("task", "seq", F.col("c.sources").alias("source"), F.col("c.counts").alias("n"))
    # sums over the parts before, by source and over all: first within a task, then over tasks
    whole = counts.groupBy("task", "seq").agg(F.sum("n").alias("n"))
    rest = F.col("n") % length
    whole = whole.withColumn("w", F.expr(f"cast(n div {length} as long)") + F.bit_count(rest))
    by_task = whole.groupBy("task").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    over = Window.orderBy("task")
    by_task = by_task.select("task", (F.sum("n").over(over) - F.col("n")).alias("n0"), (F.sum("w").over(over) - F.col("w")).alias("w0"))
    within = Window.partitionBy("task").orderBy("seq")
    whole = whole.withColumn("n1", F.sum("n").over(within) - F.col("n")).withColumn("w1", F.sum("w").over(within) - F.col("w"))
    whole = whole.join(by_task, "task").select("task", "seq", (F.col("n0") + F.col("n1")).alias("before"), (F.col("w0") + F.col("w1")).alias("first_sequence"))
    source_task = counts.groupBy("source", "task").agg(F.sum("n").alias("n"))
    source_task = source_task.withColumn("s0", F.sum("n").over(Window.partitionBy("source").orderBy("task")) - F.col("n")).drop("n")
    within = Window.partitionBy("source", "task").orderBy("seq")
    counts = counts.withColumn("s1", F.sum("n").over(within) - F.col("n"))
    same = counts.source.eqNullSafe(source_task.source) & (counts.task == source_task.task)
    counts = counts.join(source_task, same).select(counts.task, "seq", counts.source, (F.col("s0") + F.col("s1")).alias("had"))
    if targets is None:
        sums = got.select(F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy(F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"))
        shares = sums.withColumn("share", F.col("n") / F.nullif(F.sum("n").over(Window.partitionBy()), F.lit(0))).drop("n")
    else:
        shares = docs.sparkSession.createDataFrame([(k, v / sum(targets.values())) for k, v in targets.items()], "source string, share double")
    owed = counts.join(shares, counts.source.eqNullSafe(shares.source), "left").select("task", "seq", counts.source, F.coalesce("share", F.lit(0.0)).alias("share"), "had")
    state = owed.groupBy("task", "seq").agg(F.collect_list(F.struct("source", "share", "had")).alias("state")).join(whole, ["task", "seq"])
    ready = got.join(state, ["task", "seq"]).select("sources", "counts", "block", "state", "before", "first_sequence")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield packed(row, length, ids)

    return ready.mapInArrow(tidy(put, keep=False), PIECE if ids else PIECE.rpartition(",")[0])


def packed(row: dict, length: int, with_ids: bool) -> pa.RecordBatch:
    docs, source, n, ids = unpack(row["block"])
    at = np.cumsum(n) - n
    state = {x["source"]: x for x in row["state"]}
    shares = np.array([state[s]["share"] for s in row["sources"]])
    owed = np.array([state[s]["share"] * row["before"] - state[s]["had"] for s in row["sources"]])
    left = np.array(row["counts"], np.int64)
    queue = [np.flatnonzero((source == s) & (n > 0)) for s in range(len(left))]
    head, used = [0] * len(left), [0] * len(left)
    out, wide = [], ids.astype("<u4")
    for k, (_, taken) in enumerate(fill(windows(len(ids), length), shares, owed, left)):
        offset = 0
        for s, want in taken:
            while want:
                d = queue[s][head[s]]
                size = min(want, int(n[d]) - used[s])
                raw = wide[at[d] + used[s] : at[d] + used[s] + size].tobytes()
                out.append((None if docs[d] == NULL_ID else int(docs[d]), row["sources"][s], used[s], size, zlib.crc32(raw), int(n[d]), row["first_sequence"] + k, offset, raw))
                offset += size
                want -= size
                used[s] += size
                if used[s] == n[d]:
                    head[s], used[s] = head[s] + 1, 0
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 6, pa.binary()]
    names = [x.split()[0] for x in PIECE.split(", ")]
    columns = list(zip(*out, strict=True)) or [()] * len(kinds)
    keep = len(kinds) if with_ids else len(kinds) - 1
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:keep], kinds[:keep], strict=True)], names=names[:keep])


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), ids=False)
