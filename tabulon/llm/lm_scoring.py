"""LM scoring: a causal self-attention model over subword ids, beside exact word counts of the corpus.

A text is words and one end. Each word is spelled in subword ids; a one-layer
attention model, trained in numpy on every window of all training texts, gives
the next id by its class and then by its place in the class. Texts are cut and
spelled once, into blocks that counting, training and scoring read. Training
goes in rounds: each task goes through its blocks of the round from the last
round's model on, and the tasks' models are averaged by ids trained on. Windows
overlap, so that every id is scored once and with context; a batch of windows
goes through masked attention at once. A word's probability is its discounted
share of all training words, and its spelling's part of what the discount
frees; a part of it goes to the words that the text has had before. The counts
cover the whole corpus: blocks of documents ask for the counts of their
distinct words, buckets of words add up what the training documents hold and
answer every block.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import NULL_ID, cut, delete, free, ids_of, pack, partitions, scratch, stored, text_bytes, tidy, unpack
from tabulon.llm.encoding import CLOSING, encoder
from tabulon.llm.language_id import remainder
from tabulon.llm.repeats import word_symbols

WIDTH, WINDOW, STRIDE = 16, 48, 32
CLASSES, MEMBERS = 64, 64  # the most frequent ids by 64; all others are one more class, and keep their shares there
#: Training goes through all ids once, and up to this many steps of so many windows where there are few; of more windows where there are many.
STEPS, BATCH, LARGE_BATCH = 300, 48, 256
ROUNDS, ONE_TASK = 4, 1 << 21  # rounds after which models are averaged; up to so many ids one task makes the one model
PART, ROWS = 32, 768  # windows, and ids, whose wide arrays are worked on at once
LOT, PIECES = 1 << 16, 16  # windows that are shuffled together; pieces in which models are added up
DISCOUNT = 0.75  # taken from each counted word's count
COPY, COPY_AFTER = 0.3, 100  # part of a word's probability that earlier words of its text give, and after how many it has half of that
STEP = 1024  # log10 probabilities of spellings are kept in steps of 1/1024, as 64-bit numbers: no word is too long for them
BLOCK_WORDS, SLICE_WORDS = 1 << 21, 1 << 17
F4 = np.float32
MARK, ALNUM = (np.isin(np.arange(256), list(x.encode())) for x in (CLOSING, string.ascii_letters + string.digits))


class Attention:
    """One causal self-attention layer over subword ids, with a two-level softmax as its output.

    `weights`: e (ids), p (places), q, k, v, o, u, b (classes), u2, b2 (ids of a
    class); `slot`: each id's class and place in it, as one number; `share`:
    log10 of the shares in the last class. The last id is a text's end and start.
    """

    def __init__(self, weights: dict[str, np.ndarray], slot: np.ndarray, share: np.ndarray):
        self.w, self.slot, self.share = weights, slot, share
        self.of, self.at = slot // MEMBERS, slot % MEMBERS
        w = weights
        self.kind, self.rooms = self.of.astype(np.uint8), {}
        self.mask, self.seen = np.where(np.tri(WINDOW, dtype=bool), F4(0), F4(-1e9)), np.tri(WINDOW, dtype=F4)
        scale = F4(1 / math.sqrt(WIDTH))
        # ids and places come apart in what is linear, so both are projected once; a one beside v adds up what it is weighted by
        (self.kv, self.qe), (self.pkv, self.pqe) = (
            (np.concatenate((t @ w["k"], t @ w["v"] @ w["o"], np.full((len(t), 1), one, F4)), 1), np.concatenate((t @ w["q"] * scale, t), 1)) for t, one in ((w["e"], 1), (w["p"], 0))
        )

    @staticmethod
    def start(size: int, counts: np.ndarray, seed: int = 5) -> Attention:
        """An untrained model; frequent ids are classes of their own, others share classes of like weight."""
        rng = np.random.default_rng(seed)
        order = np.argsort(-counts, kind="stable")
        slot = np.full(size, CLASSES * MEMBERS, np.int64)
        own = order[: CLASSES * MEMBERS]
        slot[own] = np.arange(len(own))
        smooth = counts + 0.1
        share = np.log10(smooth / max(smooth[slot >= CLASSES * MEMBERS].sum(), 0.1))
        some = lambda *s: rng.normal(0, 0.2, s).astype(F4)
        w = {"e": some(size, WIDTH), "p": some(WINDOW, WIDTH), "q": some(WIDTH, WIDTH), "k": some(WIDTH, WIDTH), "v": some(WIDTH, WIDTH), "o": some(WIDTH, WIDTH), "u": some(WIDTH, CLASSES + 1), "u2": some(CLASSES, WIDTH, MEMBERS)}
        w["b"] = np.log(np.bincount(slot // MEMBERS, weights=smooth, minlength=CLASSES + 1) / smooth.sum() + 1e-9).astype(F4)
        b2 = np.full(CLASSES * MEMBERS, -9, F4)
        b2[: len(own)] = np.log(smooth[own])
        w["b2"] = b2.reshape(CLASSES, MEMBERS) - b2.reshape(CLASSES, MEMBERS).max(-1, keepdims=True)
        return Attention(w, slot, share.astype(F4))

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array of any content, in memory that the next call with this name gets again."""
        size = math.prod(shape)
        if name not in self.rooms or self.rooms[name].size < size:
            self.rooms[name] = np.empty(size, F4)
        return self.rooms[name][:size].reshape(shape)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean cross-entropy of the ids y after the ids x (windows by places), its gradients, and the ids that those of e, row by row, are for.

        Exponentials stay as they are: what divides them by their sums is put
        on the narrow side of each product. A column of ones beside v and z gives
        sums and adds b. Wide arrays are worked on in parts that a core's cache holds.
        """
        w, scale, n_w, wide, n = self.w, F4(1 / math.sqrt(WIDTH)), *x.shape, y.size
        flat = lambda t: t.reshape(-1, t.shape[-1])
        seen, kind = self.seen[:wide, :wide], self.kind.take(y.ravel())
        e = w["e"].take(x, 0)
        e += w["p"][:wide]
        to_qkv = np.concatenate((w["q"] * scale, w["k"], w["v"]), 1)
        qkv = self.room("qkv", n_w, wide, 3 * WIDTH + 1)
        qkv[..., -1] = 1
        np.matmul(flat(e), to_qkv, out=flat(qkv)[:, :-1])
        q, k, v1 = qkv[..., :WIDTH], qkv[..., WIDTH : 2 * WIDTH], qkv[..., 2 * WIDTH :]
        a, av = self.room("a", n_w, wide, wide), self.room("av", n_w, wide, WIDTH + 1)
        for i in range(0, n_w, PART):
            part = slice(i, i + PART)
            attend(q[part], k[part], v1[part], seen, a[part], av[part])
        over = 1 / av[..., WIDTH:]
        av = flat(av[..., :WIDTH] * over)
        z = self.room("z", n, WIDTH + 1)
        z[:, WIDTH] = 1
        np.matmul(av, w["o"], out=z[:, :WIDTH])
        z[:, :WIDTH] += flat(e)
        u, loss = np.concatenate((w["u"], w["b"][None])), 0.0
        du, dz = np.zeros_like(u), self.room("dz", n, WIDTH)
        for i in range(0, n, ROWS):
            part = slice(i, i + ROWS)
            g = self.room("g", len(z[part]), CLASSES + 1)
            more, r = softmax_error(g, lambda g, part=part: np.matmul(z[part], u, out=g), kind[part], n)
            loss += more
            du += (z[part] * r).T @ g
            np.multiply(g @ w["u"].T, r, out=dz[part])
        # the ids of the classes, class by class
        by, edges = by_class(kind)
        zo, m = z.take(by, 0), self.at.take(y.ravel().take(by))
        u2 = np.concatenate((w["u2"], w["b2"][:, None]), 1)
        du2, dzo = np.zeros_like(u2), self.room("dzo", len(by) + 1, WIDTH)
        for group in groups(edges):
            lo, hi = group[0][1], group[-1][2]
            g = self.room("g", hi - lo, MEMBERS)
            more, r = softmax_error(g, members(zo, u2, group), m[lo:hi], n)
            loss += more
            zr = zo[lo:hi] * r
            for c, i, j in group:
                du2[c] += zr[i - lo : j - lo].T @ g[i - lo : j - lo]
                np.matmul(g[i - lo : j - lo], w["u2"][c].T, out=dzo[i:j])
            dzo[lo:hi] *= r
        dzo[-1] = 0
        back = np.full(n, len(by))
        back[by] = np.arange(len(by))
        dz += dzo.take(back, 0)
        out = {"u": du[:WIDTH], "b": du[WIDTH], "u2": du2[:, :WIDTH], "b2": du2[:, WIDTH], "o": sum_of_products(av, dz)}
        dav = self.room("dav", n, WIDTH + 1)
        np.matmul(dz, w["o"].T, out=dav[:, :WIDTH])
        np.negative(np.einsum("ij,ij->i", dav[:, :WIDTH], av), out=dav[:, WIDTH])
        dav *= flat(over)
        dav, dqkv = dav.reshape(n_w, wide, -1), self.room("dqkv", n_w, wide, 3 * WIDTH)
        for i in range(0, n_w, PART):
            part = slice(i, i + PART)
            ds = np.matmul(dav[part], v1[part].transpose(0, 2, 1), out=self.room("ds", *a[part].shape))
            ds *= a[part]
            np.matmul(ds, k[part], out=dqkv[part, :, :WIDTH])
            np.matmul(ds.transpose(0, 2, 1), q[part], out=dqkv[part, :, WIDTH : 2 * WIDTH])
            np.matmul(a[part].transpose(0, 2, 1), dav[part, :, :WIDTH], out=dqkv[part, :, 2 * WIDTH :])
        dqkv = flat(dqkv)
        dw = sum_of_products(flat(e), dqkv)
        out["q"], out["k"], out["v"] = dw[:, :WIDTH] * scale, dw[:, WIDTH : 2 * WIDTH], dw[:, 2 * WIDTH :]
        de = dqkv @ to_qkv.T
        de += dz
        out["p"] = np.zeros_like(w["p"])
        out["p"][:wide] = de.reshape(n_w, -1).sum(0).reshape(wide, WIDTH)
        ids = x.ravel().astype(np.uint16 if len(self.slot) <= 1 << 16 else np.int64)
        by = np.argsort(ids, kind="stable")
        ids = ids[by].astype(np.int64)
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        out["e"] = np.add.reduceat(de.take(by, 0), first)
        return loss / n, out, ids[first]

    def train(self, lots: Iterator[np.ndarray], passes: int = 1, batch: int = BATCH, rate: float = 0.02, steps: int = 0, seed: int = 6) -> int:
        """Adam over all windows of each lot (rows of ids, each with the id behind it), in random order; gives how many ids were gone through. The rate falls to 0 over steps, if they are given.

        An id's embedding and its moments only move in steps that have the id.
        """
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        t = done = 0
        for lot in lots:
            for _ in range(passes):
                order = rng.permutation(len(lot))
                for i in range(0, len(order), batch):
                    ids = lot[order[i : i + batch]].astype(np.int64)
                    _, g, rows = self.gradients(ids[:, :-1], ids[:, 1:])
                    t += 1
                    now = rate * min(1.0, t / 20) * (max(0.0, 1 - t / (steps + 1)) ** 0.5 if steps else 1.0)
                    for k, v in g.items():
                        first, second = (m[k].take(rows, 0), s[k].take(rows, 0)) if k == "e" else (m[k], s[k])
                        first *= F4(0.9)
                        first += F4(0.1) * v
                        second *= F4(0.99)
                        second += F4(0.01) * v * v
                        step = np.sqrt(second * F4(1 / (1 - 0.99**t)))
                        step += F4(1e-8)
                        self.w[k][rows if k == "e" else ...] -= F4(now / (1 - 0.9**t)) * first / step
                        if k == "e":
                            m[k][rows], s[k][rows] = first, second
            done += lot.shape[0] * (lot.shape[1] - 1)
        return done

    def score(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 probability of each id of texts laid end to end; text i is ids[bounds[i] : bounds[i + 1]].

        What goes in is the end, then the ids but the last. The first window of
        a text scores all its places, each later one its last STRIDE places.
        """
        end = len(self.slot) - 1
        before = np.empty(len(ids), np.int64)
        before[1:] = ids[:-1]
        sizes = np.diff(bounds)
        before[bounds[:-1][sizes > 0]] = end
        out = np.empty(len(ids), F4)
        # (first id to see, first id to score, one behind the last) of every window
        extra = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
        text = np.repeat(np.arange(len(sizes)), extra)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(extra) - extra, extra)
        later = bounds[text] + WINDOW + nth * STRIDE
        stop = np.minimum(later + STRIDE, bounds[text + 1])
        some = np.flatnonzero(sizes > 0)
        first = bounds[some]
        self._windows(before, ids, first, np.minimum(first + WINDOW, bounds[some + 1]), 0, out)
        self._windows(before, ids, later - (WINDOW - STRIDE), stop, WINDOW - STRIDE, out)
        return out

    def _windows(self, before, ids, see, stop, skip, out) -> None:
        """Score windows that see from `see` on, at their places from `skip` on."""
        place, order = np.arange(WINDOW), np.argsort(stop - see, kind="stable")
        u, u2 = np.concatenate((self.w["u"], self.w["b"][None])), np.concatenate((self.w["u2"], self.w["b2"][:, None]), 1)
        for at in range(0, len(order), 256):
            o = order[at : at + 256]
            width = int((stop[o] - see[o]).max())
            target = see[o][:, None] + place[:width]
            x = before.take(target, mode="clip")
            kv = self.kv.take(x, 0)
            kv += self.pkv[:width]
            qe = self.qe.take(x[:, skip:], 0)
            qe += self.pqe[skip:width]
            av = self.room("av", len(o), width - skip, WIDTH + 1)
            for i in range(0, len(o), PART):
                part = slice(i, i + PART)
                a = self.room("a", len(o[part]), width - skip, width)
                attend(qe[part, :, :WIDTH], kv[part, :, :WIDTH], kv[part, :, WIDTH:], self.seen[skip:width, :width], a, av[part])
            av /= av[..., WIDTH:].copy()
            av[..., :WIDTH] += qe[..., WIDTH:]
            target = target[:, skip:]
            ok = target < stop[o][:, None]
            z, target = (av[ok], target[ok]) if not ok.all() else (av.reshape(-1, WIDTH + 1), target.ravel())
            y = ids.take(target)
            c = self.kind.take(y)
            got = np.empty(len(y), F4)
            for i in range(0, len(y), ROWS):
                part = slice(i, i + ROWS)
                got[part] = softmax_at(self.room("g", len(c[part]), CLASSES + 1), lambda g, z=z[part]: np.matmul(z, u, out=g), c[part])
            by, edges = by_class(c)
            zo, m, inside = z.take(by, 0), self.at.take(y.take(by)), np.empty(len(by), F4)
            for group in groups(edges):
                lo, hi = group[0][1], group[-1][2]
                inside[lo:hi] = softmax_at(self.room("g", hi - lo, MEMBERS), members(zo, u2, group), m[lo:hi])
            got[by] += inside
            got *= F4(1 / math.log(10))
            rare = np.flatnonzero(c == CLASSES)
            got[rare] += self.share[y[rare]]
            out[target] = got


def usual(sums: np.ndarray) -> bool:
    """Whether no sum of exponentials has overflown or vanished, or come near it."""
    return not sums.size or bool(sums.min() > 1e-20 and sums.max() < 1e20)


def attend(q: np.ndarray, k: np.ndarray, v1: np.ndarray, seen: np.ndarray, a: np.ndarray, av: np.ndarray) -> None:
    """exp(q k') where seen, into a, and what it adds up of v and of the ones beside it, into av."""
    kt = k.transpose(0, 2, 1)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(np.matmul(q, kt, out=a), out=a)
        a *= seen
        np.matmul(a, v1, out=av)
    if not usual(av[..., -1]):  # once more, with rows lowered by their maxima
        np.copyto(np.matmul(q, kt, out=a), F4(-np.inf), where=seen == 0)
        a -= a.max(-1, keepdims=True)
        np.matmul(np.exp(a, out=a), v1, out=av)


def powers(g: np.ndarray, make) -> tuple[np.ndarray, bool]:
    """exp of what make() puts into g, in place; its sums; and whether rows had to be lowered by their maxima before."""
    make(g)
    ones = np.ones(g.shape[1], F4)
    with np.errstate(over="ignore", invalid="ignore"):
        sums = np.exp(g, out=g) @ ones
    if usual(sums):
        return sums, False
    make(g)
    g -= g.max(-1, keepdims=True)
    return np.exp(g, out=g) @ ones, True


def softmax_error(g: np.ndarray, make, chosen: np.ndarray, n: int) -> tuple[float, np.ndarray]:
    """Cross-entropy of the chosen places under the softmax of what make() puts into g; g times the column that is also given becomes its gradient, over n."""
    sums, _ = powers(g, make)
    at, each = np.arange(0, g.size, g.shape[1]) + chosen, g.ravel()
    hit = each.take(at)
    each[at] = hit - sums
    return -float(np.log(hit / sums + F4(1e-12)).sum()), (1 / (sums * F4(n)))[:, None]


def softmax_at(g: np.ndarray, make, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of what make() puts into g, at the chosen places."""
    sums, lowered = powers(g, make)
    at = np.arange(0, g.size, g.shape[1]) + chosen
    if not lowered:
        hit = g.ravel().take(at)
        if usual(hit):
            return np.log(hit / sums)
    make(g)
    g -= g.max(-1, keepdims=True)
    hit = g.ravel().take(at)
    return hit - np.log(np.exp(g, out=g).sum(-1))


def members(z: np.ndarray, u2: np.ndarray, group: list[tuple[int, int, int]]):
    """What puts z, in order of classes, times their classes' weights into an array."""

    def make(g: np.ndarray) -> None:
        lo = group[0][1]
        for c, i, j in group:
            np.matmul(z[i:j], u2[c], out=g[i - lo : j - lo])

    return make


def sum_of_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x' y, some rows at a time, as BLAS is fastest."""
    return sum(x[i : i + ROWS].T @ y[i : i + ROWS] for i in range(0, len(x), ROWS))


def by_class(kind: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Places in order of their class, but for the last class, and where each class begins among them."""
    edges = np.concatenate(([0], np.cumsum(np.bincount(kind, minlength=CLASSES + 1)[:CLASSES]))).tolist()
    return np.argsort(kind, kind="stable")[: edges[-1]], edges


def groups(edges: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """(class, first row, one behind the last), large classes in several, in groups of at most ROWS rows."""
    held: list[tuple[int, int, int]] = []
    for c, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
        while i < j:
            k = min(j, (held[0][1] if held else i) + ROWS)
            held.append((c, i, k))
            i = k
            if k - held[0][1] == ROWS:
                yield held
                held = []
    if held:
        yield held


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, the place of every word among them, and where each text's words begin and end; null has none."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    first = np.asarray(cut.offsets)
    words = cut.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
    index, distinct, bounds = words.indices.to_numpy(), words.dictionary, (first - first[0]).astype(np.int64)
    empty = pc.index(distinct, "").as_py()  # beside white space at either end of a text
    if empty >= 0:
        full = index != empty
        bounds = np.concatenate(([0], np.cumsum(full)))[bounds]
        index = index[full]
        index = index - (index > empty)
        distinct = pa.concat_arrays([distinct[:empty], distinct[empty + 1 :]])
    return distinct, index, bounds


def spelled_out(e, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many subword ids each word has, and the ids of all words one after the other.

    Closing punctuation behind an ASCII letter or digit is always cut off, so
    words are looked up without it, and what was cut off on its own.
    """
    data, offsets = text_bytes(distinct)
    first, stop = offsets[:-1], offsets[1:].copy()
    while True:
        more = np.flatnonzero((stop > first) & MARK[data[np.maximum(stop - 1, 0)]]) if len(data) else []
        if not len(more):
            break
        stop[more] -= 1
    whole = (stop == first) | ~ALNUM[data[np.maximum(stop - 1, 0)]] if len(data) else np.ones(len(first), bool)
    stop[whole] = offsets[1:][whole]
    both = [sliced(data, x, y).dictionary_encode() for x, y in ((first, stop), (stop, offsets[1:]))]
    got = spellings(e, both[0].dictionary.to_numpy(zero_copy_only=False).tolist()), [e.head(x) if x else b"" for x in both[1].dictionary.to_pylist()]
    sizes = np.fromiter(map(len, [*got[0], *got[1]]), np.int64) // e.dtype.itemsize
    flat, place = np.frombuffer(b"".join([*got[0], *got[1]]), e.dtype), np.empty(2 * len(first), np.int64)
    place[::2], place[1::2] = both[0].indices.to_numpy(), both[1].indices.to_numpy() + len(got[0])
    here = sizes.take(place)
    return here[::2] + here[1::2], flat.take(spans((np.cumsum(sizes) - sizes).take(place), here))


def sliced(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> pa.Array:
    """data[first : stop] of each pair, as texts."""
    size = stop - first
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.concatenate(([0], np.cumsum(size)))), pa.py_buffer(data.take(spans(first, size))))


def spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of every span, one span after the other."""
    kind = np.int32 if begin.max(initial=0) + size.sum() < 1 << 31 else np.int64
    return np.repeat((begin - (np.cumsum(size) - size)).astype(kind), size) + np.arange(size.sum(), dtype=kind)


def laid(here: np.ndarray, flat: np.ndarray, index: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The subword ids of all words in order and an end behind each text; the number of ids of each word; where each text's begin and end."""
    size = here.take(index)
    until, texts = np.concatenate(([0], np.cumsum(size))), np.arange(len(bounds))
    ends = until[bounds] + texts
    own = np.ones(ends[-1], bool)
    own[ends[1:] - 1] = False
    stream = np.full(ends[-1], end, np.int32)
    stream[own] = flat.take(spans((np.cumsum(here) - here).take(index), size))
    return stream, size, ends


def slices(bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Texts from i to j with about `size` words, or one longer text."""
    i = 0
    while i < len(bounds) - 1:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield i, j
        i = j


def streams(e, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The subword ids of texts, an end behind each, and where each text's begin and end; some texts at a time."""
    for batch in batches:
        for some in cut(batch, 0):
            distinct, index, bounds = cut_words(some.column(0))
            stream, _, ends = laid(*spelled_out(e, distinct), index, bounds, end)
            yield stream, ends


def streams_of_blocks(end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of texts that worded() has put into blocks."""
    for batch in batches:
        for data in batch.column(0):
            _, lengths, place, here, flat = opened(data.as_py())
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            for i, j in slices(bounds, SLICE_WORDS):
                stream, _, ends = laid(here, flat, place[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], end)
                yield stream, ends


def counted(file: str):
    """How often texts have each subword id, with an end for each text; in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file)
        size = e.tokenizer.get_vocab_size()
        yield from added_up(np.bincount(stream, minlength=size) for stream, _ in streams(e, size - 1, batches))

    return run


def counted_blocks(size: int):
    """The same of texts in blocks, by the words of their dictionaries."""

    def counts(data: bytes) -> np.ndarray:
        ids, _, place, here, flat = opened(data)
        got = np.bincount(flat, weights=np.repeat(np.bincount(place, minlength=len(here)), here), minlength=size).astype(np.int64)
        got[-1] += len(ids)
        return got

    return lambda batches: added_up(counts(data.as_py()) for batch in batches for data in batch.column(0))


def added_up(some: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sum of vectors, in pieces; nothing if there are none."""
    total = None
    for x in some:
        total = x if total is None else total + x
    if total is not None:
        yield from in_pieces(total, 1)


def in_pieces(x: np.ndarray, weight: float) -> Iterator[pa.RecordBatch]:
    for i, part in enumerate(np.array_split(x, PIECES)):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([float(weight)]), pa.array([pack(part)], pa.binary())], names=["piece", "weight", "data"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted sum of each piece."""
    sums: dict[int, list] = {}
    for batch in batches:
        for i, weight, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            x = unpack(data.as_py())[0] * np.float64(weight)
            sums[i] = [sums[i][0] + weight, sums[i][1] + x] if i in sums else [weight, x]
    for i, (weight, x) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([float(weight)]), pa.array([pack(x)], pa.binary())], names=["piece", "weight", "data"])


def summed(pieces: DataFrame) -> tuple[float, np.ndarray | None]:
    """Sum of the weights, and the weighted sum of all vectors; the driver only gets the sums."""
    got = sorted((r["piece"], r["weight"], r["data"]) for r in pieces.repartition(PIECES, "piece").mapInArrow(tidy(added), PARTS).toLocalIterator())
    return (got[0][1], np.concatenate([unpack(x)[0] for _, _, x in got])) if got else (0.0, None)


PARTS = "piece int, weight double, data binary"


def windows(e, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The windows of texts."""
    return windows_of(end, streams(e, end, batches))


def windows_of(end: int, given: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """All ids of texts laid end to end, an end in front and behind each, as lots of windows with the id behind each; only windows at the end overlap, or are shorter."""
    held, size = [np.array([end], np.int32)], 1
    for some, bounds in given:
        for i, j in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            held.append(some[i:j])
            size += j - i
            if size > LOT * WINDOW:
                stream = np.concatenate(held)
                n = (size - 1) // WINDOW
                yield np.lib.stride_tricks.sliding_window_view(stream, WINDOW + 1)[: n * WINDOW : WINDOW]
                held = [stream[n * WINDOW :].copy()]
                size = len(held[0])
    stream = np.concatenate(held)
    if size > WINDOW:
        views = np.lib.stride_tricks.sliding_window_view(stream, WINDOW + 1)
        yield views[np.append(np.arange(0, size - WINDOW, WINDOW), size - WINDOW - 1)] if (size - 1) % WINDOW else views[::WINDOW]
    elif size > 1:
        yield stream[None, :]


def trained(training: DataFrame, file: str) -> tuple:
    """The model as plain arrays, from all training rows (doc_id, text)."""
    return learned(in_blocks(training.withColumn("held_out", F.lit(False)), file, partitions(training.sparkSession))[0], file)


def learned(blocks: DataFrame, file: str) -> tuple:
    """The model as plain arrays, from the blocks of all training texts."""
    spark, size = blocks.sparkSession, encoder(file).tokenizer.get_vocab_size()
    _, counts = summed(blocks.filter(F.col("kind").between(WORDS, WORDS + ROUNDS - 1)).select("data").mapInArrow(tidy(counted_blocks(size), keep=False), PARTS))
    if counts is None:
        counts = np.zeros(size)
    total = int(counts.sum())
    counts[-1] += 1
    model = Attention.start(len(counts), counts)
    names, slot, share = sorted(model.w), model.slot, model.share
    shapes = [model.w[k].shape for k in names]
    cuts = np.cumsum([model.w[k].size for k in names])[:-1]
    rounds, tasks = (1, 1) if total <= ONE_TASK else (ROUNDS, spark.sparkContext.defaultParallelism)
    passes = max(1, min(STEPS, STEPS * BATCH * WINDOW // max(total, 1)))
    batch = min(LARGE_BATCH, max(BATCH, total // WINDOW // 2000))
    steps = passes * -(-total // (WINDOW * batch)) if rounds == 1 else 0
    for r in range(rounds if total else 0):
        given = spark.sparkContext.broadcast((np.concatenate([model.w[k].ravel() for k in names]), slot, share))

        def fit(batches: Iterator[pa.RecordBatch], given=given, r=r) -> Iterator[pa.RecordBatch]:
            flat, slot, share = given.value
            w = {k: x.reshape(s).copy() for k, x, s in zip(names, np.split(flat, cuts), shapes, strict=True)}
            own = Attention(w, slot, share)
            done = own.train(windows_of(size - 1, streams_of_blocks(size - 1, batches)), passes, batch, 0.02 * (1 - r / rounds), steps, seed=6 + r)
            if done:
                yield from in_pieces(np.concatenate([own.w[k].ravel() for k in names]), done)

        own = F.col("kind").between(WORDS, WORDS + ROUNDS - 1) if rounds == 1 else F.col("kind") == WORDS + r
        dealt = blocks.filter(own).select("data", "block").repartition(tasks).sortWithinPartitions("block")
        weight, flat = summed(dealt.mapInArrow(tidy(fit, keep=False), PARTS))
        given.unpersist()
        del dealt
        free(spark)
        if flat is not None:
            model.w = {k: x.reshape(s) for k, x, s in zip(names, np.split((flat / weight).astype(F4), cuts), shapes, strict=True)}
    return model.w, slot.astype(np.int32), share


def spellings(e, words: list[str]) -> list[bytes]:
    """The subword ids of each word, as after a space."""
    if len(e.new) >= 3 << 17:
        e.old, e.new = e.new, {}
    got = list(map(e.new.get, words))
    if None in got:
        e.resolve({w for w, g in zip(words, got, strict=True) if g is None})
        got = [e.new[w] for w in words]
    return got


def planes(x: np.ndarray) -> np.ndarray:
    """The bytes of unsigned numbers, lowest bytes of all first: they compress better so."""
    return x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.ravel()


def unplaned(x: np.ndarray, kind) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


BLOCKS = "block long, bucket int, kind int, data binary, words long, ends long"
DOCS, ASKED, ANSWERED, TOTALS, WORDS = range(5)  # WORDS + r: words of the training documents of round r; WORDS + ROUNDS: of those held out


def row(block: int, bucket: int, kind: int, data: bytes | None, words: int = 0, ends: int = 0) -> pa.RecordBatch:
    """One row; words and ends are what TOTALS add up."""
    values = ((block, pa.int64()), (bucket, pa.int32()), (kind, pa.int32()), (data, pa.binary()), (words, pa.int64()), (ends, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names=["block", "bucket", "kind", "data", "words", "ends"])


def runs_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[tuple[int, int, bytes]]]:
    """(block, kind, data) of the rows of each key; rows of a key come one after the other."""
    last, held = None, []
    for batch in batches:
        for k, block, kind, data in zip(batch.column(key).to_pylist(), batch.column("block").to_pylist(), batch.column("kind").to_pylist(), batch.column("data"), strict=True):
            if held and k != last:
                yield held
                held = []
            last = k
            held.append((block, kind, data.as_py()))
    if held:
        yield held


def in_blocks(rows: DataFrame, file: str, n: int) -> tuple[DataFrame, str]:
    """What worded() makes of documents (doc_id, held_out, text), and the folder that holds it, with a folder below for each kind."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession)
    part = F.when(F.col("held_out"), ROUNDS).otherwise(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))).cast("int")
    rows.select("doc_id", part.alias("part"), "text").mapInArrow(tidy(worded(file, 2 * n), keep=False), BLOCKS).write.partitionBy("kind").parquet(path)
    return spark.read.schema(BLOCKS).parquet(path).select(*(c.split()[0] for c in BLOCKS.split(", "))), path


def worded(file: str, n: int):
    """Documents (doc_id, part, text) as blocks of one part each: their words as places in the block's dictionary, the words' subword ids, and what the block asks and tells each bucket. Texts are cut and spelled only here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file)
        block = TaskContext.get().partitionId() << 32
        held: list[list[tuple]] = [[] for _ in range(ROUNDS + 1)]

        def flush(part: int) -> Iterator[pa.RecordBatch]:
            nonlocal block
            parts = np.cumsum([0, *(len(x[2]) for x in held[part])])
            ids, lengths, h, index = (np.concatenate(x) for x in zip(*((*x[:3], x[3] + k) for x, k in zip(held[part], parts, strict=False)), strict=True))
            texts = pa.concat_arrays([x[4] for x in held[part]])
            held[part].clear()
            words, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            inverse = inverse.take(index)
            counts = np.bincount(inverse, minlength=len(words))
            order = np.argsort(-counts, kind="stable")  # frequent words get low places
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            words, first, told = words[order], first[order], counts[order] * (part < ROUNDS)
            here, flat = spelled_out(e, texts.take(pa.array(first)))
            yield row(block, -1, WORDS + part, pack(ids, lengths, planes(place.take(inverse)), planes(here.astype(np.uint32)), flat))
            bucket = (words >> np.uint64(8)).astype(np.int64) % n
            by = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(bucket[by], prepend=-1)), len(by)).tolist()
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                o = by[i:j]
                yield row(block, int(bucket[o[0]]), ASKED, pack(words[o], told[o], o.astype(np.uint32)))
            if part < ROUNDS:
                yield row(block, -1, TOTALS, None, len(index), len(ids))
            block += 1

        for batch in batches:
            of = batch.column(1).to_numpy()
            for part in np.unique(of).tolist():
                for some in cut(batch.filter(pa.array(of == part)), 2):
                    distinct, index, bounds = cut_words(some.column(2))
                    held[part].append((ids_of(some.column(0)), np.diff(bounds), word_symbols(*text_bytes(distinct))[0], index.astype(np.int32), distinct))
                    if sum(len(x[3]) for x in held[part]) >= BLOCK_WORDS:
                        yield from flush(part)
        for part in range(ROUNDS + 1):
            if held[part]:
                yield from flush(part)

    return run


def opened(data: bytes) -> tuple[np.ndarray, ...]:
    """A block of WORDS: doc_ids, numbers of words, the words' places in the dictionary, numbers of ids of its words, and their ids."""
    ids, lengths, place, here, flat = unpack(data)
    return ids, lengths, unplaned(place, np.uint32), unplaned(here, np.uint32).astype(np.int64), flat


def spelled(model):
    """Blocks of words as blocks of documents, with the words' spelling probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, slot, share = model.value
        attention, end = Attention(weights, slot.astype(np.int64), share), len(slot) - 1
        for batch in batches:
            for block, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids, lengths, place, here, flat = opened(data.as_py())
                bounds = np.concatenate(([0], np.cumsum(lengths)))
                lp, last = [], []
                for i, j in slices(bounds, SLICE_WORDS):
                    stream, size, ends = laid(here, flat, place[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], end)
                    scores = attention.score(stream, ends).astype(np.float64)
                    sums = np.concatenate(([0.0], np.cumsum(scores)))
                    a = np.cumsum(size) - size + np.repeat(np.arange(j - i), lengths[i:j])
                    lp.append(np.rint(np.maximum(sums[a] - sums[a + size], 0) * STEP).astype(np.uint64))
                    last.append(scores[ends[1:] - 1])
                out = np.full(len(ids), kind == WORDS + ROUNDS)
                yield row(block, -1, DOCS, pack(ids, out, lengths, planes(place), planes(np.concatenate(lp)), np.concatenate(last), np.array([len(here)])))

    return run


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up what a bucket's words count in training documents, and tell every block that asks; bucket by bucket."""
    for held in runs_of(batches, "bucket"):
        asked = [unpack(data) for _, _, data in held]
        words, inverse = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([a[1] for a in asked]), minlength=len(words)).astype(np.int64)
        yield row(-1, -1, TOTALS, None, int((total > 0).sum()))
        at = 0
        for (block, _, _), a in zip(held, asked, strict=True):
            yield row(block, -1, ANSWERED, pack(planes(total[inverse[at : at + len(a[0])]].astype(np.uint64)), planes(a[2])))
            at += len(a[0])


def copied(doc: np.ndarray, place: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, how many words of its text stand before it, and how many of those are the same word."""
    first = np.cumsum(lengths) - lengths
    # digit by digit, as numpy sorts numbers of 16 bits fastest
    order, keys = np.arange(len(place)), [(x >> bits).astype(np.uint16) for x in (place, doc) for bits in range(0, max(int(x.max(initial=0)).bit_length(), 1), 16)]
    for key in keys:
        order = order.take(np.argsort(key.take(order), kind="stable"))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= np.diff(key.take(order)) != 0
    at = np.arange(len(order))
    earlier = np.empty(len(order), np.int64)
    earlier[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return at - np.repeat(first, lengths), earlier


def log_sum(log: np.ndarray, x: np.ndarray) -> np.ndarray:
    """log10(10**log + x), where x may be 0 and 10**log may be less than any float."""
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.log(np.exp(log * math.log(10)) + x) / math.log(10), log)


def combined(n_train: int, n_ends: int, n_types: int):
    """Scores of documents, from their block and the answers to it."""
    log_all = math.log10(n_train + n_types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in runs_of(batches, "block"):  # block by block; the documents come first
            ids, out, lengths, place, lp, last, (size,) = unpack(held[0][2])
            place, lp = unplaned(place, np.uint32), unplaned(lp, np.uint64)
            count = np.zeros(size, np.int64)
            for _, _, x in held[1:]:
                total, at = unpack(x)
                count[unplaned(at, np.uint32)] = unplaned(total, np.uint64)
            count = count.astype(np.float64)
            doc = np.repeat(np.arange(len(ids)), lengths)
            add = lambda x: np.bincount(doc, weights=x, minlength=len(ids))  # noqa: E731, B023
            free = DISCOUNT * n_types / n_train if n_train else 1.0
            part = lambda x: np.maximum(x - DISCOUNT, 0) / max(n_train, 1)
            base = add((np.log10(count + 1) - log_all).take(place)) + (math.log10(n_ends + 1) - log_all)
            seen, earlier = copied(doc, place, lengths)
            copy = COPY * seen / (seen + COPY_AFTER)
            at_end = 1 - COPY * lengths / (lengths + COPY_AFTER)
            spelling = np.log10((1 - copy) * free) - lp.astype(np.float64) / STEP
            score = add(log_sum(spelling, (1 - copy) * part(count).take(place) + copy * earlier / np.maximum(seen, 1))) + log_sum(np.log10(at_end * free) + last, at_end * part(n_ends))
            known = add((count > 0).take(place)).astype(np.int64) + (n_ends > 0)
            columns = [pa.array([None if d == NULL_ID else d for d in ids.tolist()], pa.int64()), pa.array(out.astype(bool)), pa.array(lengths + 1), pa.array(known), pa.array(np.full(len(ids), n_train)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, file: str) -> DataFrame:
    """docs(doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows that aren't held out are learned from. Words are cut at ASCII white
    space after A-Z are lowered; every text, null and empty too, has an end,
    which is a token. base_score is add-one smoothing over words, score the
    model's log10 probability. Without training rows the spelling stands alone.
    Repeated rows each have a row and each count; other columns play no part.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out").cast("boolean").alias("held_out"), F.col("text").cast("string").alias("text"))
    blocks, path = in_blocks(rows, file, n)
    answers = stored(blocks.filter(F.col("kind") == ASKED).repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(answer), BLOCKS))
    delete(spark, f"{path}/kind={ASKED}")
    model = spark.sparkContext.broadcast(learned(blocks, file))
    scored = stored(blocks.filter(F.col("kind") >= WORDS).select("block", "kind", "data").mapInArrow(tidy(spelled(model)), BLOCKS))
    told = F.col("kind") == TOTALS
    n_words, n_ends = (x or 0 for x in blocks.filter(told).agg(F.sum("words"), F.sum("ends")).first())
    types = answers.filter(told).agg(F.sum("words")).first()[0] or 0
    delete(spark, path)
    free(spark)
    parts = scored.union(answers.filter(F.col("kind") == ANSWERED)).repartition(n, "block").sortWithinPartitions("block", "kind")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.mapInArrow(tidy(combined(n_words + n_ends, n_ends, types + (n_ends > 0))), schema)


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs.withColumn("held_out", remainder("doc_id", 7) == 2), public_tokenizers.path("byte_bpe_50k.json"))
