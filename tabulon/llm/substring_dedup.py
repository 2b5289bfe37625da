"""Substring dedup over word windows: a log-structured fingerprint index.

The index holds fingerprints (anchors of windows) of all text seen so far as
sorted immutable runs. A new batch is sorted and merge-joined with every run;
what is found is settled or verified word by word, then the batch becomes a run
itself, and runs of like size are compacted into one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import NULL_ID, bucket_of, keyed, partitions, stored, tidy, unpack
from tabulon.llm.repeats import ANCHORS, BLOCKS, COMPARED, OPEN, Windows, blocks, columns_of, gathered, map_anchors, one_block, repeats, runs, word_symbols

WINDOW, GRAM = 20, 6
FANOUT, BATCH = 4, 1 << 18


class Run:
    """An immutable run: fingerprints (key, context, doc, pos) sorted by all four; one row, the first, for each key and context."""

    def __init__(self, key: np.ndarray, context: np.ndarray, doc: np.ndarray, pos: np.ndarray):
        order = np.lexsort((pos, doc, context, key))
        self.columns = [x[order] for x in (key, context, doc, pos)]
        first = runs(*self.columns[:2])
        self.columns = [x[first] for x in self.columns]

    def __len__(self) -> int:
        return len(self.columns[0])

    def join(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge-join with sorted keys: the rows of this run, and of the batch, that meet."""
        lo, hi = np.searchsorted(self.columns[0], key, "left"), np.searchsorted(self.columns[0], key, "right")
        return lo, hi

    @staticmethod
    def compacted(several: list[Run]) -> Run:
        return Run(*(np.concatenate(x) for x in zip(*(r.columns for r in several), strict=True)))


class FingerprintIndex:
    """Sorted immutable runs in levels; FANOUT runs of a level are compacted into one of the next.

    Batches may come in any order of documents: of equal contexts the earlier
    one is always the one that stays.
    """

    def __init__(self) -> None:
        self.levels: list[list[Run]] = []

    def runs(self) -> list[Run]:
        return [r for level in self.levels for r in level]

    def contains(self, key: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Whether each (key, context) is in the index."""
        seen = np.zeros(len(key), bool)
        for run in self.runs():
            lo, hi = run.join(key)
            while (todo := np.flatnonzero((lo < hi) & ~seen)).size:  # the contexts of a key, one after the other by binary search
                mid = (lo[todo] + hi[todo]) // 2
                at = run.columns[1][mid]
                seen[todo[at == context[todo]]] = True
                less = at < context[todo]
                lo[todo[less]] = mid[less] + 1
                hi[todo[~less]] = mid[~less]
        return seen

    def add(self, run: Run) -> None:
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < FANOUT:
                return
            run, self.levels[level] = Run.compacted(self.levels[level]), []
            level += 1

    def ingest(self, key: np.ndarray, context: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Add a batch in ascending (doc, pos) order that lies after all that the index holds; returns which rows repeat an earlier context."""
        order = np.lexsort((pos, doc, context, key))
        k, c, d, p = key[order], context[order], doc[order], pos[order]
        new = runs(k, c)
        repeat = np.zeros(len(k), bool)
        repeat[order] = (~new & runs(k, c, d, p)) | self.contains(k, c)
        self.add(Run(k, c, d, p))
        return repeat


def index(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of one bucket go through the index in the order of documents, batch by batch."""
    key, context, doc, pos = columns_of(found)
    order = np.lexsort((pos, doc))
    key, context, doc, pos = key[order], context[order], doc[order], pos[order]
    keep = runs(doc, pos)
    key, context, doc, pos = key[keep], context[keep], doc[keep], pos[keep]
    store = FingerprintIndex()
    parts = [store.ingest(*(x[at : at + BATCH] for x in (key, context, doc, pos))) for at in range(0, len(key), BATCH)]
    repeat = np.concatenate(parts) if parts else np.zeros(0, bool)
    whole = Run.compacted(store.runs()) if store.runs() else Run(key, context, doc, pos)
    lo, hi = whole.join(key)
    return key, doc, pos, repeat, ~repeat & (hi - lo > 1)


def emitter(windows: Windows, n: int):
    """Contexts as words: a row of symbols around the anchor and how far it reaches to either side."""
    left = windows.reach

    def emit(data, offsets, which, place, h, doc, pos) -> Iterator[pa.RecordBatch]:
        sym, so = word_symbols(data, offsets)
        at = so[which] + place
        l, r = np.minimum(place, left), np.minimum(so[which + 1] - at, windows.length)
        cols = np.arange(-left, windows.length)
        inside = (cols >= -l[:, None]) & (cols < r[:, None])
        rows = np.where(inside, sym[np.clip(at[:, None] + cols, 0, len(sym) - 1)], np.uint64(0))
        bucket = (h >> np.uint64(8)).astype(np.int64) % n
        order = np.argsort(bucket, kind="stable")
        edges = np.append(np.flatnonzero(runs(bucket[order])), len(order))
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            o = order[i:j]
            yield one_block(int(bucket[o[0]]), OPEN, rows[o].ravel(), l[o], r[o], doc[o], pos[o])

    return emit


def comparer(windows: Windows, n: int):
    """Verify open fingerprints word by word: for each offset of a window over the anchor, which contexts agree with an earlier one."""
    left, length = windows.reach, windows.length

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = gathered(batches)
        if OPEN not in found:
            return
        rows, l, r, doc, pos = columns_of(found[OPEN])
        rows = rows.reshape(len(l), -1)
        order = np.lexsort((pos, doc))
        rows, l, r, doc, pos = rows[order], l[order], r[order], doc[order], pos[order]
        most, least = np.full(len(l), -1), np.full(len(l), length)
        weights = np.random.default_rng(11).integers(1, 1 << 62, length).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for o in range(left + 1):
            ok = np.flatnonzero((l >= o) & (r >= length - o))
            if len(ok) < 2:
                continue
            w = rows[ok, left - o : left - o + length]
            key = (w * weights).sum(axis=1)
            by = np.argsort(key, kind="stable")
            equal = (key[by][1:] == key[by][:-1]) & (w[by][1:] == w[by][:-1]).all(axis=1)
            hit = ok[by[1:][equal]]
            most[hit] = np.maximum(most[hit], o)
            least[hit] = np.minimum(least[hit], o)
        hit = most >= 0
        yield blocks(COMPARED, bucket_of(doc[hit], 4 * n), doc[hit], pos[hit], most[hit], least[hit])

    return compare


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Remove each word covered by a window of words whose sequence also starts earlier.

    Returns (doc_id, sub, n, n_removed, n_spans, kept_sha256) and, if asked,
    spans (ranges of removed words), kept and rest (the kept words, joined by
    single spaces, as bytes and as text). Words are cut at ASCII white space. Null texts have no words, texts
    shorter than a window lose none. Of rows with the same doc_id (null ones
    too, which come first) the later in the order of their texts count as later
    documents, with sub above 0. Other columns play no part.
    """
    n = partitions(docs.sparkSession)
    windows = Windows(window, min(GRAM, window), word_symbols)
    return repeats(docs, windows, index, lambda: emitter(windows, n), comparer(windows, n), True, with_text, id_column, text_column)


class SubstringIndex:
    """The fingerprint index in a folder, for corpora that grow batch by batch.

    A run is a table of fingerprints (key, context, doc, pos), bucketed and
    sorted by key, that is never changed. A batch is judged against all batches
    before it and within itself: its fingerprints are merge-joined with each run
    where it lies, so that of the history only the rows that meet are moved, and
    only texts of their documents are read again. Then it becomes a run itself;
    FANOUT runs of a level are compacted into one of the next, in which each
    fingerprint and context stands once. Ids of a batch must lie above all
    earlier ones. What belongs to the index is told by its latest commit, one
    file that is renamed into place when all else is written: a batch that broke
    off leaves nothing that counts.
    """

    RUN = "key long, context long, doc long, pos long"
    TEXTS = "doc_id long, sub int, text string"

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW, buckets: int | None = None):
        self.spark, self.path, self.window = spark, path.rstrip("/"), window
        state = self.state()
        if state is None:
            state = {"window": window, "buckets": buckets or 4 * partitions(spark), "most": None, "runs": [], "texts": []}
            self._commit(state, 0)
        if state["window"] != window:
            raise ValueError(f"the index was made for windows of {state['window']} words")
        self.buckets = state["buckets"]

    def _hadoop(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commits(self) -> list[str]:
        p, fs = self._hadoop("commits")
        return sorted(f.getPath().getName() for f in fs.listStatus(p) if not f.getPath().getName().startswith(".")) if fs.exists(p) else []

    def state(self) -> dict | None:
        """What the latest commit says: runs as [level, name], names of texts, the largest id."""
        done = self._commits()
        return json.loads(self.spark.read.text(f"{self.path}/commits/{done[-1]}", wholetext=True).first()[0]) if done else None

    def _commit(self, state: dict, number: int) -> None:
        new, fs = self._hadoop(f"commits/.{uuid.uuid4().hex}")
        out = fs.create(new, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not fs.rename(new, self._hadoop(f"commits/{number:08d}")[0]):
            raise RuntimeError("another batch was committed meanwhile")

    def _run(self, name: str) -> DataFrame:
        """A run as a bucketed table."""
        table = f"tabulon_{hashlib.sha256(f'{self.path}/{name}'.encode()).hexdigest()[:24]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({self.RUN}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return self.spark.table(table)

    def _write(self, rows: DataFrame) -> str:
        """rows as a new run: the first place of each key and context."""
        name = f"run-{uuid.uuid4().hex}"
        first = rows.groupBy("key", "context").agg(F.min(F.struct("doc", "pos")).alias("f")).select("key", "context", "f.*")
        table = f"tabulon_{uuid.uuid4().hex}"
        first.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.path}/{name}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # its files stay
        return name

    def _met(self, keys: DataFrame, runs_: list[str]) -> DataFrame | None:
        """Rows of the runs whose key is among a batch's."""
        found = [self._run(r).hint("merge").join(keys.hint("merge"), "key", "left_semi") for r in runs_]
        return reduce(DataFrame.union, found) if found else None

    def ingest(self, docs: DataFrame, with_text: bool = False) -> DataFrame:
        """substring_dedup() of a new batch, judged after all batches before it, which becomes part of the index."""
        number, state = len(self._commits()), self.state()
        n = partitions(self.spark)
        windows = Windows(self.window, min(GRAM, self.window), word_symbols)
        rows = keyed(docs, "text")
        least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        if state["most"] is not None and ((least is not None and least <= state["most"]) or rows.filter("doc_id IS NULL").limit(1).count()):
            raise ValueError(f"ids of a new batch must lie above {state['most']}")
        anchors = stored(rows.mapInArrow(tidy(map_anchors(windows, self.buckets, 4 * n), keep=False), BLOCKS).filter(F.col("kind") == ANCHORS).mapInArrow(tidy(unpacked, keep=False), self.RUN))
        met = self._met(anchors.select("key").distinct(), [r for _, r in state["runs"]])
        history = None
        if met is not None:
            met = stored(met)
            texts = self.spark.read.schema(self.TEXTS).parquet(*(f"{self.path}/{x}" for x in state["texts"]))
            asked = met.select(F.col("doc").alias("d")).distinct()
            texts = texts.join(asked, F.coalesce("doc_id", F.lit(NULL_ID).cast("long")) == F.col("d"), "left_semi")
            history = met.mapInArrow(tidy(packed(self.buckets), keep=False), BLOCKS), texts, self.buckets
        result = stored(repeats(docs, windows, index, lambda: emitter(windows, n), comparer(windows, n), True, with_text, history=history))
        text = f"texts-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{text}")
        new = {**state, "most": most if most is not None else state["most"], "texts": [*state["texts"], text], "runs": [*state["runs"], [0, self._write(anchors)]]}
        self._commit(new, number)
        self.compact()
        return result

    def compact(self) -> None:
        """FANOUT runs of one level become one of the next, from the lowest level up."""
        while True:
            number, state = len(self._commits()), self.state()
            levels: dict[int, list[str]] = {}
            for level, name in state["runs"]:
                levels.setdefault(level, []).append(name)
            full = next((x for x in sorted(levels) if len(levels[x]) >= FANOUT), None)
            if full is None:
                return
            several = levels[full]
            one = self._write(reduce(DataFrame.union, map(self._run, several)))
            self._commit({**state, "runs": [[x, r] for x, r in state["runs"] if r not in several] + [[full + 1, one]]}, number)
            for name in several:
                p, fs = self._hadoop(name)
                fs.delete(p, True)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of fingerprints as rows."""
    for batch in batches:
        for block in batch.column("block"):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in unpack(block.as_py())], names=["key", "context", "doc", "pos"])


def packed(buckets: int):
    """Rows of fingerprints as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, context, doc, pos = (x.to_numpy() for x in batch.columns)
            key = key.view(np.uint64)
            yield blocks(ANCHORS, (key >> np.uint64(8)).astype(np.int64) % buckets, key, context.view(np.uint64), doc, pos)

    return run


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).selectExpr("doc_id", "n as n_words", "n_removed", "n_spans", "kept_sha256")
