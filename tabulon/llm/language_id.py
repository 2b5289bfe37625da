"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton. A text, in lower
case and with one space for whatever stands between letters, is parsed against
it into phrases, each the longest match from where the last one ended; the language that needs the fewest
phrases, each weighed with the logarithm of the length of its labelled text,
wins. Phrases run over words; they only end at the last character of a stretch
of STRETCH characters, so that stretches of many texts are parsed side by side,
against all automata at once, with a few array operations for each character.
"""

from __future__ import annotations

import functools
import math
import pickle
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tabulon.llm.common import cut, held, tidy

#: Bounds of the labelled sample, for each language: rows, and characters in all.
SAMPLE_ROWS, SAMPLE_CHARS = 300, 120_000
STRETCH, LANES, GROUP = 4096, 1024, 1 << 20
NONE = "und"


@functools.cache
def kinds() -> np.ndarray:
    """Of each code point: 2 for a letter, 1 for a mark on one, 0 for all else."""
    first = np.fromiter((ord(unicodedata.category(chr(i))[0]) for i in range(0x110000)), np.uint8, 0x110000)
    return (first == ord("L")) * np.uint8(2) + (first == ord("M")).astype(np.uint8)


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts as they are parsed, how many each has, and whether it has a letter."""
    raw = [f" {(t or '').lower()} " for t in texts]
    points = np.frombuffer("".join(raw).encode("utf-32-le", "replace"), np.uint32)
    edges = np.cumsum([0, *map(len, raw)])
    kind = kinds()[points]
    inside = kind > 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[edges[:-1]] = True
    until = lambda x: np.concatenate(([0], np.cumsum(x)))[edges]
    return np.where(inside, points, np.uint32(32))[keep], np.diff(until(keep)), np.diff(until(kind == 2)) > 0


class SuffixAutomaton:
    """All substrings of a text; `go` holds the transitions of each state, 0 being the start."""

    def __init__(self, text: str):
        self.go: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            at = len(self.go)
            self.go.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in self.go[p]:
                self.go[p][c] = at
                p = link[p]
            if p >= 0:
                q = self.go[p][c]
                if length[p] + 1 == length[q]:
                    link[at] = q
                else:
                    copy = len(self.go)
                    self.go.append(dict(self.go[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.go[p].get(c) == q:
                        self.go[p][c] = copy
                        p = link[p]
                    link[q] = link[at] = copy
            last = at

    def phrases(self, text: str) -> int:
        """Number of longest matches that make up the text; a character that never occurs is a phrase of its own."""
        go, at, n = self.go, 0, 0
        first = go[0]
        for c in text:
            to = go[at].get(c)
            if to is None:
                n += at != 0
                to = first.get(c, 0)
                n += to == 0
            at = to
        return n + (at != 0)


class Parser:
    """The automata of all languages as arrays: states with one way on hold it themselves, all others have a row of a dense table.

    What a state and a character lead to is the next state and, above STATE
    bits, how many phrases end there: none if the match goes on, one if the
    character begins the next phrase, and one more if it occurs nowhere and so
    is a phrase of its own.
    """

    STATE = 28

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        self.weights = np.array([math.log2(len(text) + 2) for _, text in samples])
        alphabet = sorted({c for _, text in samples for c in text})
        width = len(alphabet) + 1
        self.code = np.zeros(0x110000, np.uint16)
        self.code[[ord(c) for c in alphabet]] = np.arange(1, width)
        of = {c: i for i, c in enumerate(alphabet, 1)}
        one = 1 << self.STATE
        self.start = np.zeros(len(samples), np.int64)
        only, to, row, dense, base, rows = [], [], [], [], 0, 0
        go: list[dict[str, int]] = []
        for n, (_, text) in enumerate(samples):
            go.clear()  # the last one's, before the next is built
            go = SuffixAutomaton(text).go
            self.start[n] = base
            again = np.full(width, 2 * one + base, np.int32)  # after a match that ends
            for c, state in go[0].items():
                again[of[c]] = one + base + state
            table = [again]
            mine = np.zeros((3, len(go)), np.int32)
            mine[0] = width  # no character has this code
            for state, ways in enumerate(go):
                if len(ways) == 1 and state:
                    ((c, target),) = ways.items()
                    mine[:, state] = of[c], base + target, rows * width
                    continue
                mine[2, state] = (rows + len(table)) * width
                line = again.copy() if state else np.full(width, one + base, np.int32)
                line[[of[c] for c in ways]] = [base + x for x in ways.values()]
                table.append(line)
            only.append(mine[0])
            to.append(mine[1])
            row.append(mine[2])
            dense.append(np.concatenate(table))
            base, rows = base + len(go), rows + len(table)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int32)
        self.only, self.to, self.row, self.dense = join(only).astype(np.uint16), join(to), join(row), join(dense)

    def phrases(self, points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many phrases texts, as code points one after the other, need in each language (a row for each text)."""
        out = np.zeros((len(sizes), len(self.names)), np.int64)
        codes = self.code[points]
        many = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        first = np.repeat(np.cumsum(sizes) - sizes, many) + nth * STRETCH
        size = np.minimum(STRETCH, sizes[text] - nth * STRETCH)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), LANES):
            o = order[at : at + LANES]
            np.add.at(out, text[o], self._lanes(codes, first[o], size[o]).T)
        return out

    def _lanes(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of stretches in descending order of size, by language and stretch."""
        steps = np.arange(size[0], dtype=np.int32)
        chars = np.take(codes, steps[:, None] + first.astype(np.int32), mode="clip")
        alive = len(size) - np.searchsorted(size[::-1], steps, "right")
        state = np.repeat(self.start[:, None], len(size), axis=1)
        total = np.zeros(state.shape, np.int64)
        mask = (1 << self.STATE) - 1
        k = 0
        for c, m in zip(chars, alive.tolist(), strict=True):
            if m != k:  # shorter stretches are done
                if k:
                    total[:, m:k] += s[:, m:k] != self.start[:, None]
                    state[:, :k] = s
                k, s = m, np.ascontiguousarray(state[:, :m])
                hit, got, way = np.empty(s.shape, np.uint16), np.empty(s.shape, np.int32), np.empty(s.shape, np.int32)
                n = np.zeros(s.shape, np.int64)
            c = c[:k].astype(np.int32)
            np.take(self.row, s, out=got, mode="clip")
            np.take(self.dense, got + c, out=got, mode="clip")
            np.take(self.only, s, out=hit, mode="clip")
            np.take(self.to, s, out=way, mode="clip")
            np.copyto(got, way, where=hit == c)
            total[:, :k] += got >> self.STATE
            s = (got & mask).astype(np.int64)
        total[:, :k] += s != self.start[:, None]
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        points, sizes, some = letters(texts)
        out: list[tuple[str, float]] = [(NONE, 0.0)] * len(texts)
        if self.names:
            total = self.phrases(points, sizes) * self.weights
            best = np.argmin(total, axis=1)
            least = np.sort(total, axis=1)
            for i in np.flatnonzero(some).tolist():
                first, second = least[i, :2].tolist() if len(self.names) > 1 else (0.0, 1.0)
                out[i] = self.names[best[i]], second / (first + second)
        return out


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """((language, text), ...) from labelled(doc_id, text, lang): a sample with bounds on rows and characters of each language.

    Rows are taken in the order of a hash of their doc_id; rows without a
    language or a letter teach nothing.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", "text")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return ()
    # hashes are spread evenly: below this one there are about twice as many rows as are wanted
    bound = {k: -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 2 * rows // n) for k, n in sizes.items()}
    table = F.create_map(*(x for k, v in bound.items() for x in (F.lit(k), F.lit(v).cast("long"))))
    h = F.xxhash64("doc_id")
    taken = known.filter(h <= table[F.col("lang")]).select("lang", h.alias("h"), F.substring("text", 1, chars).alias("text")).limit(4 * rows * len(sizes))
    out: dict[str, list[str]] = {}
    for r in sorted(taken.toLocalIterator(), key=lambda r: (r["lang"], r["h"], r["text"])):
        have = out.setdefault(r["lang"], [])
        if len(have) < rows and sum(map(len, have)) < chars:
            have.append("".join(map(chr, letters([r["text"]])[0][1:].tolist())))
    return tuple((k, f" {''.join(v)}"[:chars]) for k, v in sorted(out.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], id_column: str = "doc_id", text_column: str = "text", beside: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of each row's whole text; with `beside`, all columns of docs and the two of these names.

    `und` with score 0 for a null text, one without a letter, or if nothing was
    learned. The score is the runner-up's part of what the two best languages
    need together: 0.5 at a tie, which goes to the first name, up to 1.
    Repeated rows each have a row; null ids stay null; other columns play no
    part. An empty table has no rows.
    """

    # a bounded sample makes bounded tables, which are built once and not in every worker; workers drop them with the next operator
    tables = docs.sparkSession.sparkContext.broadcast(zstandard.ZstdCompressor(level=1).compress(pickle.dumps(Parser(samples))))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held(("parser", name), lambda: pickle.loads(zstandard.ZstdDecompressor().decompress(tables.value)))
        for whole in batches:
            for batch in cut(whole, at, GROUP):
                got = p.predict(batch.column(at).to_pylist())
                mine = [pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())]
                if beside:
                    yield pa.RecordBatch.from_arrays([*batch.columns, *mine], names=[*batch.schema.names, *beside])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), *mine], names=["doc_id", "lang_pred", "score"])

    at = docs.columns.index(text_column) if beside else 1
    if beside:
        return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(beside[0], StringType()), StructField(beside[1], DoubleType())]))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def remainder(column: str, n: int):
    """crc32 of an id as text, modulo n; null ids have 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    samples = learn(docs.filter(remainder("doc_id", 3) != 1))
    got = identify(docs, samples)
    return got.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
