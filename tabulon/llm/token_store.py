"""Token-ID files: every document's ids compressed by itself with one shared zstandard dictionary.

A store is a folder with two Parquet tables. `dictionary` holds the dictionary
and its hash. Each row of `shards` is a block of documents in ascending order of
their ids: the compressed frames one after the other, an offset index to find a
short document without its neighbours, the number of ids of each, and the
dictionary's hash. Parquet only carries the blocks, so that any file system
that Spark reaches will do and a lost task's output is replaced as a whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import NULL_ID, ids_of, keyed, partitions, scratch, tidy
from tabulon.llm.encoding import encoder
from tabulon.session import small_batches

SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8000, 1 << 16
PARTS = 4  # ranges of ids for each shuffle partition
SHARD_IDS, SHARD_DOCS = 1 << 20, 1 << 13
SHARD = "part int, seq int, first_doc long, last_doc long, start long, n_ids long, width int, dictionary_hash string, doc_ids binary, counts binary, offsets binary, frames binary"


def train(texts: list[str], file: str, size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the texts' serialized ids; empty where they are too few to train one."""
    samples = [x for x in encoder(file).encode(texts) if x]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(docs: DataFrame, file: str, path: str, end: int | None = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of every whole text, each followed by `end`, to a store at `path`.

    Null ids come first and null texts have no ids of their own; rows of the
    same id are all kept, in the order of their texts. The dictionary is
    trained on at most SAMPLE_ROWS texts, the first by a hash of the id and no
    longer than SAMPLE_CHARS; nothing else depends on the sample.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = keyed(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")), "text")
    by = F.xxhash64("doc_id")
    least = [r[0] for r in rows.select(by.alias("h")).orderBy("h").limit(SAMPLE_ROWS).collect()]
    sample = rows.filter((by <= max(least, default=0)) & (F.length("text") <= SAMPLE_CHARS)).limit(SAMPLE_ROWS).collect()
    dictionary = train([r["text"] for r in sample], file)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    # ranges of ids with about as many rows each; only ids are read for them
    n = partitions(spark)
    shares = [i / (PARTS * n) for i in range(1, PARTS * n)]
    edges = np.unique(np.array(rows.agg(F.percentile_approx("doc_id", shares)).first()[0] or [], np.int64))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file)
        last = b"" if end is None else np.array([end], e.dtype).tobytes()
        compress = zstandard.ZstdCompressor(level=1, dict_data=shared(dictionary), write_content_size=True, write_dict_id=False).compress
        for batch in batches:
            docs_ = ids_of(batch.column(0))
            part = np.where(docs_ == NULL_ID, 0, np.searchsorted(edges, docs_, "right"))
            at = 0
            for ids, bounds in e.column(batch.column(2)):
                raw, cut = ids.tobytes(), (bounds * e.dtype.itemsize).tolist()
                frames = [compress(raw[i:j] + last) for i, j in zip(cut, cut[1:], strict=False)]
                to = at + len(frames)
                counts = np.diff(bounds) + len(last) // e.dtype.itemsize
                yield pa.RecordBatch.from_arrays([pa.array(part[at:to], pa.int32()), *(batch.column(k).slice(at, to - at) for k in (0, 1)), pa.array(counts), pa.array(frames, pa.binary())], names=["part", "doc_id", "sub", "n", "frame"])
                at = to

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(file).dtype.itemsize
        at, seq, start = -1, 0, 0
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, start
            ids, counts = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            frames = [f for h in held for f in h[2]]
            offsets = np.cumsum([0, *map(len, frames)], dtype=np.int64)
            total = int(counts.sum())
            row = (at, seq, int(ids[0]), int(ids[-1]), start, total, width, digest, ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), offsets.tobytes(), b"".join(frames))
            seq, start = seq + 1, start + total
            held.clear()
            kinds = [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.int32(), pa.string()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[x.split()[0] for x in SHARD.split(", ")])

        for batch in batches:
            part, ids, counts = batch.column(0).to_numpy(), ids_of(batch.column(1)), batch.column(3).to_numpy()
            frames = batch.column(4).to_pylist()
            # a shard ends with its range, or where it is full
            full = np.cumsum(counts) // SHARD_IDS + np.arange(len(ids)) // SHARD_DOCS
            cuts = [0, *(np.flatnonzero((np.diff(part) != 0) | (np.diff(full) != 0)) + 1).tolist(), len(ids)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if held and (part[i] != at or sum(h[1].sum() for h in held) >= SHARD_IDS or sum(len(h[0]) for h in held) >= SHARD_DOCS):
                    yield flush()
                if part[i] != at:
                    at, seq, start = int(part[i]), 0, 0
                held.append((ids[i:j], counts[i:j], frames[i:j]))
        if held:
            yield flush()

    framed = rows.mapInArrow(tidy(encode), "part int, doc_id long, sub int, n long, frame binary")
    ordered = framed.repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "sub").select("part", "doc_id", "sub", "n", "frame")
    ordered.mapInArrow(tidy(shards), SHARD).write.option("compression", "uncompressed").parquet(f"{path}/shards")


def shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def frames_of(row: dict, dictionary: bytes, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(doc_id, ids before it in its part, its ids as bytes) of a shard's documents, or of those at `wanted`."""
    if hashlib.sha256(dictionary).hexdigest() != row["dictionary_hash"]:
        raise ValueError("the shard was written with another dictionary")
    expand = zstandard.ZstdDecompressor(dict_data=shared(dictionary)).decompress
    docs, counts, offsets = (np.frombuffer(row[k], "<i8") for k in ("doc_ids", "counts", "offsets"))
    starts = row["start"] + np.cumsum(counts) - counts
    for i in range(len(docs)) if wanted is None else wanted:
        raw = expand(row["frames"][offsets[i] : offsets[i + 1]]) if counts[i] else b""
        yield int(docs[i]), int(starts[i]), raw


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    """The shards with the number of ids before their part, and the dictionary. Parts are as many as the writer's ranges of ids."""
    shards = spark.read.parquet(f"{path}/shards")
    total = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = total.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return shards.join(F.broadcast(before), "part"), bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): every document of a store; start counts the ids of all documents before it."""
    shards, dictionary = _opened(spark, path)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = list(frames_of(row, dictionary))
                ids = [np.frombuffer(raw, f"<u{row['width']}") for _, _, raw in got]
                yield pa.RecordBatch.from_arrays([pa.array([None if d == NULL_ID else d for d, _, _ in got], pa.int64()), pa.array([s + row["before"] for _, s, _ in got]), pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))], names=["doc_id", "start", "ids"])

    return shards.mapInArrow(tidy(expand, keep=False), "doc_id long, start long, ids array<long>")


def lookup(spark: SparkSession, path: str, docs: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: shards are pruned by their range of ids, and only the asked frames are expanded."""
    shards = spark.read.parquet(f"{path}/shards")
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    asked = sorted(set(docs))
    # plain terms, which the scan skips row groups by
    hit = reduce(lambda a, b: a | b, [(F.col("first_doc") <= d) & (F.col("last_doc") >= d) for d in asked], F.lit(False))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = list(frames_of(row, dictionary, np.flatnonzero(np.isin(np.frombuffer(row["doc_ids"], "<i8"), asked))))
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in got], pa.int64()), pa.array([np.frombuffer(raw, f"<u{row['width']}").tolist() for _, _, raw in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return shards.filter(hit).mapInArrow(tidy(expand, keep=False), "doc_id long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, from its files."""
    shards, dictionary = _opened(spark, path)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = [(None if d == NULL_ID else d, s + row["before"], len(raw) // row["width"], zlib.crc32(np.frombuffer(raw, f"<u{row['width']}").astype("<u4").tobytes())) for d, s, raw in frames_of(row, dictionary)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(tidy(expand, keep=False), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark)
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return digests(spark, path)
