"""Whole-text encoding with a tokenizers file, with a cache of the pieces between which that tokenizer always cuts.

The ids are exactly those of Tokenizer.encode() on the whole text. Two families
of pre-tokenizers are known, in which cuts at white space (and between a letter
or digit and closing punctuation) can't be straddled by a token; any other
tokenizer, and any text with unusual white space, is encoded in one call.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tabulon.llm.common import held, text_bytes

CACHE, GROUP, CALL = 800_000, 1 << 23, 1 << 14
ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‍ -  -⁠　﻿]")
UNUSUAL = re.compile(r"[ \n\t\r]|" + ODD.pattern)
CHUNK = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
CLOSING = ".,;:!?"
#: Bytes that unusual white space has: control characters, and first bytes of all others.
SUSPECT = np.isin(np.arange(256), [0x0B, 0x0C, *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])


class Encoder:
    def __init__(self, file: str, cache: int = CACHE):
        # with a small cache, groups of texts are small, too
        self.cache, self.size = cache, GROUP if cache >= CACHE else GROUP >> 2
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            made = json.load(f)
        pre, normal = made["pre_tokenizer"] or {}, made["normalizer"]
        plain = not any(t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in made["added_tokens"])
        self.spaced = plain and normal is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        parts = [x["type"] for x in (normal or {}).get("normalizers", [])]
        self.bare = plain and parts == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size < 1 << 16 else "<u4")
        suffix = made["model"].get("end_of_word_suffix")
        #: How many bytes of text each id stands for, if it is a byte-level one.
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        #: ids of pieces; a piece without white space stands for one after a space if self.spaced. Two generations.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: ids of pieces as they are: starts of texts, punctuation, chunks that begin with other white space.
        self.heads: dict[str, bytes] = {}

    def direct(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.dtype.itemsize == 2 else "I"
        return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, bases: list[str]) -> list[bytes]:
        """direct() of pieces without white space, in one call: their ids are told apart by the bytes that each stands for, or by ends of words."""
        if self.spaced:
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(bases)], add_special_tokens=False)[0].ids, self.dtype)
            cuts = self._cuts(np.cumsum(self.bytes[ids]), np.cumsum([len(b.encode()) + 1 for b in bases]))
            return self.direct([f" {b}" for b in bases]) if cuts is None else self._parts(ids, cuts)
        whole = [b for b in bases if b.isalpha()]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(whole)], add_special_tokens=False)[0].ids, self.dtype)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(whole):
            return self.direct(bases)
        got = dict(zip(whole, self._parts(ids, cuts), strict=True))
        rest = [b for b in bases if b not in got]
        got.update(zip(rest, self.direct(rest), strict=True))
        return [got[b] for b in bases]

    def _cuts(self, until: np.ndarray, wanted: np.ndarray) -> np.ndarray | None:
        """Behind which ids the wanted numbers of bytes are reached exactly; None if not all are."""
        at = np.searchsorted(until, wanted)
        if not len(until) or until[-1] != wanted[-1] or (until[at] != wanted).any():
            return None
        return at + 1

    def _parts(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        raw, size = ids.tobytes(), self.dtype.itemsize
        ends = (cuts * size).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def head(self, piece: str) -> bytes:
        if (ids := self.heads.get(piece)) is None:
            if len(self.heads) >= self.cache // 4:
                self.heads.clear()
            ids = self.heads[piece] = self.direct([piece])[0]
        return ids

    def split(self, piece: str) -> tuple[str, str]:
        """A piece as what the cache is asked for, and closing punctuation that is always cut off."""
        if self.bare and max(piece) < "Ā":
            piece = piece.lower()
        base = piece.rstrip(CLOSING)
        return (base, piece[len(base) :]) if base and base[-1].lower()[-1].isalnum() else (piece, "")

    def resolve(self, missing: Iterable[str]) -> None:
        """Bring pieces without white space into self.new."""
        missing = list(missing)
        new, old = self.new, self.old.get
        if self.old:
            was = list(map(old, missing))
            new.update((p, ids) for p, ids in zip(missing, was, strict=True) if ids is not None)
            missing = [p for p, ids in zip(missing, was, strict=True) if ids is None]
        cut = list(map(self.split, missing))
        need = {base: None for base, _ in cut if base not in new}
        if self.old and need:
            for base in need:
                if (ids := old(base)) is not None:
                    new[base] = ids
            need = {base: None for base in need if base not in new}
        bases = list(need)
        for i in range(0, len(bases), CALL):  # a call's result takes some 400 bytes for each piece
            new.update(zip(bases[i : i + CALL], self.words(bases[i : i + CALL]), strict=True))
        new.update((p, new[base] + self.head(tail)) for p, (base, tail) in zip(missing, cut, strict=True) if tail)
        new.update((p, new[base]) for p, (base, tail) in zip(missing, cut, strict=True) if not tail and p != base)

    def slow(self, text: str) -> bytes:
        """A text whose white space is more than single spaces and line ends."""
        if not (self.spaced or self.bare) or ODD.search(text):
            return self.direct([text])[0]
        chunks = CHUNK.findall(text)
        self.resolve({c[1:] for c in chunks if c[0] == " " and c[1:2] not in " \n\t\r"} - self.new.keys())
        return b"".join([self.new[c[1:]] if c[0] == " " and c[1:2] not in " \n\t\r" else self.head(c) for c in chunks])

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each whole text, as little-endian numbers of self.dtype; null is empty."""
        for ids, bounds in self.column(pa.array(list(texts), pa.string())):
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield ids[i:j].tobytes()

    def column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the whole texts of a column one after the other, and where each text's begin and end, by groups of texts; null is empty.

        Arrow cuts texts and tells equal pieces apart, so only a group's distinct pieces are looked up.
        """
        gc.disable()  # the caches are large and nothing here makes cycles
        data, offsets = text_bytes(texts)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + self.size, "right")) - 1)
            part = texts.slice(i, j - i).fill_null("").cast(pa.large_string())
            if self.spaced or self.bare:
                yield self._pieces(part, data[offsets[i] : offsets[j]], offsets[i:j] - offsets[i])
            else:
                yield joined(self.direct(part.to_pylist()), self.dtype)
            i = j

    def _pieces(self, part: pa.Array, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.new) >= self.cache:
            self.old, self.new = self.new, {}
        # a line end becomes the first character of what is behind it, which has no space then
        cut = pc.split_pattern(pc.replace_substring(part, "\n", " \n"), " ") if self.spaced else pc.ascii_split_whitespace(part)
        first = np.asarray(cut.offsets)
        values = cut.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        first = first - first[0]
        index, pieces = values.indices.to_numpy().astype(np.int32), values.dictionary.to_pylist()
        got = list(map(self.new.get, pieces))
        lost = self._unknown(pieces, got) if None in got else []
        # texts with unusual white space, or that start with some, go another way
        slow = set(self._odd(part, data, starts))
        heads = []
        if self.spaced:
            if lost:
                bad = np.zeros(len(got), bool)
                bad[lost] = True
                bad = bad[index]
                bad[first[:-1]] = False  # before the first piece there is no space
                slow.update(np.unique(np.searchsorted(first, np.flatnonzero(bad), "right") - 1).tolist())
            heads = [pieces[k] for k in index[first[:-1]].tolist()]
            slow.update(k for k, h in enumerate(heads) if not h or UNUSUAL.search(h))
        texts = sorted(slow)
        got += [self.slow(t) if t else b"" for t in (part[k].as_py() for k in texts)]
        for n, k in enumerate(texts, len(pieces)):
            index[first[k] : first[k + 1]] = self.nothing
            index[first[k]] = n
        if heads:
            plain = [k for k in range(len(part)) if k not in slow]
            index[first[plain]] = len(got) + np.arange(len(plain))
            got += [self.head(heads[k]) for k in plain]
        got.append(b"")  # for self.nothing, which is -1
        here = np.fromiter(map(len, got), np.int32, len(got)) // np.int32(self.dtype.itemsize)
        size = here[index]
        flat = np.frombuffer(b"".join(got), self.dtype)
        until = np.concatenate(([0], np.cumsum(size)))
        kind = np.int32 if until[-1] < 1 << 31 else np.int64
        begin = (np.cumsum(here) - here)[index] - until[:-1]
        ids = flat[np.repeat(begin.astype(kind), size) + np.arange(until[-1], dtype=kind)]
        return ids, until[first]

    nothing = -1

    def _odd(self, part: pa.Array, data: np.ndarray, starts: np.ndarray) -> list[int]:
        """Texts that hold white space other than spaces and line ends; most are cleared by their bytes alone."""
        at = np.flatnonzero(SUSPECT[data])
        return [k for k in np.unique(np.searchsorted(starts, at, "right") - 1).tolist() if ODD.search(part[k].as_py())]

    def _unknown(self, pieces: list[str], got: list[bytes | None]) -> list[int]:
        """Fill in the ids of pieces that self.new doesn't have, but of those that only self.slow() can do; their places are returned, and they count as b""."""
        at = [k for k, g in enumerate(got) if g is None]
        missing = [pieces[k] for k in at]
        if self.bare:
            odd = {""} & set(missing)
        else:
            odd = {p for p in missing if not p or UNUSUAL.search(p)}
            lines = [p for p in odd if p[:1] == "\n" and len(p) > 1 and not UNUSUAL.search(p, 1)]
            self.new.update(zip(lines, self.direct(lines), strict=True))
            odd.difference_update(lines)
        self.resolve(set(missing).difference(odd, self.new))
        lost = []
        for k, p in zip(at, missing, strict=True):
            if p in odd:
                lost.append(k)
                got[k] = b""
            else:
                got[k] = self.new[p]
        return lost


def joined(several: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Arrays given as bytes, one after the other, and their bounds."""
    sizes = np.array([len(x) for x in several], np.int64) // kind.itemsize
    return np.frombuffer(b"".join(several), kind), np.concatenate(([0], np.cumsum(sizes)))


def encoder(file: str, cache: int = CACHE) -> Encoder:
    return held(("encoder", file, cache), lambda: Encoder(file, cache))
