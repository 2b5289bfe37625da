"""Token counts: greedy longest-match word pieces counted with a linear-time automaton.

The vocabulary is a trie with failure links; every node knows how many tokens
are popped on the way along its failure link, so a word's piece count comes
from one pass over its characters and no piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabulon.llm.common import held, tidy

CACHE = 400_000


class PieceCounter:
    """Counts word pieces of words: initial pieces start a word, others continue it; a word without a full match is one unknown."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        # Node 0 starts words, node 1 continues them.
        self.go: list[dict[str, int]] = [{}, {}]
        token = [False, False]
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.go[at].get(c)
                    if to is None:
                        to = self.go[at][c] = len(self.go)
                        self.go.append({})
                        token.append(False)
                    at = to
                if at > 1:
                    token[at] = True
        self.fail, self.pops = [-1] * len(token), [0] * len(token)
        layer = [(0, c, v) for c, v in self.go[0].items()] + [(1, c, v) for c, v in self.go[1].items()]
        while layer:
            following = []
            for parent, c, v in layer:
                if token[v]:
                    self.fail[v], self.pops[v] = 1, 1
                else:
                    z, popped = self.fail[parent], self.pops[parent]
                    while z >= 0 and c not in self.go[z]:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.go[z][c], popped
                following += [(v, d, u) for d, u in self.go[v].items()]
            layer = following

    def count(self, word: str) -> int:
        """Number of pieces, or 0 if the word has no full match."""
        go, fail, pops, at, n = self.go, self.fail, self.pops, 0, 0
        for c in word:
            while (to := go[at].get(c)) is None:
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return 0
            at = to
        while at != 1:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return 0
        return n


def vocabulary(model_file: str) -> tuple[list[str], list[str]]:
    """Initial pieces (they begin with the word mark ▁) and continuing pieces of a sentencepiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    return [x for x in pieces if x[0] == "▁" and "▁" not in x[1:]], [x for x in pieces if "▁" not in x]


def counter(model_file: str) -> tuple[PieceCounter, dict[str, int]]:
    return held(("counter", model_file), lambda: (PieceCounter(*vocabulary(model_file)), {}))


def token_counts(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Words, word pieces and unknown words of each row's whole text: (id, n_words, n_tokens, n_unknown).

    Words are cut at ASCII white space and get the word mark in front. A word
    that the vocabulary can't cover counts as one token. Null and empty texts have zeros; repeated rows
    each have a row; other columns play no part.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = counter(model_file)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1):
                found = (text.as_py() or "").encode().split()
                n = list(map(cache.get, found))
                if None in n:
                    for i, x in enumerate(n):
                        if x is None:
                            if (x := cache.get(found[i])) is None:
                                if len(cache) >= CACHE:
                                    cache.clear()
                                x = cache[found[i]] = automaton.count("▁" + found[i].decode())
                            n[i] = x
                words.append(len(n))
                unknown.append(zeros := n.count(0))
                tokens.append(sum(n) + zeros)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], names=[id_column, "n_words", "n_tokens", "n_unknown"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(tidy(count), f"`{id_column}` {kind}, n_words long, n_tokens long, n_unknown long")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
