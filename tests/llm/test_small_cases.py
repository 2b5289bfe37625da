"""Every operator over nulls, empty and long texts, ties, repeated rows, clashing names and empty tables, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.llm import decontaminate, language_id, lm_scoring, neighbours, packing, simhash, substring_dedup, suffix_dedup, token_counts, token_store

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, n int, bucket string"


def corpus():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ba", "ti", "Éo", "ne", "ru", "x,"]) for _ in range(rng.randint(1, 3)))
    base = [" ".join(word() for _ in range(rng.randint(5, 90))) for _ in range(12)]
    passage = " ".join(word() for _ in range(40))
    texts = [*base, base[0], base[1], base[2] + " " + passage, passage + " " + base[3], base[4][:200] + passage[10:] + base[5], None, "", "a", "a" * 350, "  \n\t ", "é" * 120, base[6].replace("ba", "ti", 2), base[7].upper(), "zz " * 60, passage]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], ["s0", "s0", None, "s1"][i % 4], None, "clash", 7, "b") for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(t):
    return (t or "").encode().split()


def brute_windows(items_of, length):
    seen, out = set(), {}
    for i, t in corpus():
        items = items_of(t)
        gone = [False] * len(items)
        for at in range(len(items) - length + 1):
            k = tuple(items[at : at + length]) if not isinstance(items, bytes) else items[at : at + length]
            if k in seen:
                gone[at : at + length] = [True] * length
            seen.add(k)
        out[i] = items, gone
    return out


def test_substring_dedup(docs):
    want = brute_windows(words, 20)
    got = substring_dedup.substring_dedup(docs, with_text=True).collect()
    assert len(got) == len(want)
    for r in got:
        items, gone = want[r["doc_id"]]
        kept = b" ".join(w for w, g in zip(items, gone, strict=True) if not g)
        assert (r["n"], r["n_removed"], bytes(r["kept"]), r["kept_sha256"]) == (len(items), sum(gone), kept, hashlib.sha256(kept).hexdigest())


def test_index_keeps_the_first_over_many_batches():
    rng = np.random.default_rng(2)
    n = 4000
    key, context = rng.integers(0, 300, n).astype(np.uint64), rng.integers(0, 4, n).astype(np.uint64)
    doc, pos = np.arange(n) // 7, np.arange(n) % 7
    index = substring_dedup.FingerprintIndex()
    got = np.concatenate([index.ingest(*(x[a : a + 111] for x in (key, context, doc, pos))) for a in range(0, n, 111)])
    seen, want = set(), []
    for k in zip(key, context, strict=True):
        want.append(k in seen)
        seen.add(k)
    assert got.tolist() == want and len(index.runs()) < 12


def test_incremental_index(spark, docs, tmp_path):
    index = substring_dedup.SubstringIndex(spark, str(tmp_path / "index"), buckets=5)
    got = {}
    for lo in range(0, 40, 8):
        for r in index.ingest(docs.filter(f"doc_id >= {lo} and doc_id < {lo + 8}")).collect():
            got[r["doc_id"]] = r["n_removed"]
    assert got == {i: sum(gone) for i, (_, gone) in brute_windows(words, 20).items()}
    state = index.state()
    assert sorted(level for level, _ in state["runs"]) == [0, 1] and len(state["texts"]) == 5  # five batches, four of their runs compacted
    with pytest.raises(ValueError, match="must lie above"):
        index.ingest(docs)
    # the history is joined where it lies: only the batch is exchanged
    plan = index._met(spark.range(9).select(F.col("id").alias("key")), [state["runs"][0][1]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_a_broken_batch_leaves_no_trace(spark, tmp_path, monkeypatch):
    t = [" ".join(f"{w}{i}" for i in range(30)) for w in ("a", "b")]
    frame = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    index = substring_dedup.SubstringIndex(spark, str(tmp_path / "index"), buckets=3)
    index.ingest(frame((1, t[0])))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(substring_dedup.SubstringIndex, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        index.ingest(frame((2, t[1])))
    again = substring_dedup.SubstringIndex(spark, str(tmp_path / "index"))
    assert [(r["doc_id"], r["n_removed"]) for r in again.ingest(frame((2, t[0]), (3, t[1]))).orderBy("doc_id").collect()] == [(2, 30), (3, 0)]


def test_suffix_dedup(docs):
    want = brute_windows(lambda t: (t or "").encode(), 100)
    for r in suffix_dedup.suffix_dedup(docs, with_text=True).collect():
        raw, gone = want[r["doc_id"]]
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        assert (r["n"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(raw), sum(gone), spans, kept)


def test_repeated_and_missing_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, "x")], "doc_id long, text string")
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["sub"], r["n_removed"]) for r in substring_dedup.substring_dedup(df).collect())
    assert got == [(-1, 0, 0), (1, 0, 30), (1, 1, 30), (2, 0, 0)]


def test_long_documents_go_in_slices(spark, monkeypatch):
    from tabulon.llm import repeats

    monkeypatch.setattr(repeats, "GROUP", 500)
    rng = random.Random(3)
    raw = bytes(rng.choice(b"abcdefgh ") for _ in range(4000))
    raw = raw[:3000] + raw[200:900] + raw[3000:]
    w = repeats.Windows(100, 24, repeats.byte_symbols)
    data = np.frombuffer(raw, np.uint8)
    parts = list(w.all_anchors(data, np.array([0, len(raw)])))
    assert len(parts) > 3
    got = {int(p): (int(h), int(c)) for _, place, hh, cc in parts for p, h, c in zip(place, hh, cc, strict=True)}
    sym, so = repeats.byte_symbols(data, np.array([0, len(raw)]))
    _, place, h, c = w.anchors(sym, so)
    assert got == {int(p): (int(a), int(b)) for p, a, b in zip(place, h, c, strict=True)}


def test_loser_tree_merges_with_common_prefixes():
    rng = random.Random(5)
    every = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(400))
    lists = [sorted(every[i::7]) for i in range(7)]
    coded = [suffix_dedup.front_coded(x) for x in lists]
    got = list(suffix_dedup.merged([suffix_dedup.decoded(*c) for c in coded]))
    assert [s for _, s, _ in got] == every
    for (_, a, _), (_, b, k) in zip(got, got[1:], strict=False):
        assert k == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_simhash(docs):
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {i: simhash.fingerprint(t) for i, t in corpus()}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{f:016x}", find(i)) for i, f in fps.items()}


def test_links_are_whole_in_large_groups(spark):
    rng = random.Random(7)
    centre = rng.getrandbits(64)
    near = {centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(900)} | {rng.getrandbits(64) for _ in range(300)}
    fps = np.array(sorted(near), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(df).collect()]
    root = {int(x): int(x) for x in fps.view(np.int64)}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3
        root[find(a)] = find(b)
    d = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    for i, j in zip(*np.nonzero(d), strict=True):
        assert find(int(fps.view(np.int64)[i])) == find(int(fps.view(np.int64)[j]))


def test_decontaminate(spark, docs):
    import re

    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    texts = dict(corpus())
    items = [(10, texts[14][-120:]), (9, "a"), (8, texts[7]), (7, None), (6, ""), (5, "nothing like it at all"), (4, " ".join(texts[0].split()[2:9])), (4, " ".join(texts[0].split()[2:9]))]
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, t in texts.items():
        w = cut(t)
        hit, found = set(), set()
        for k, it in items:
            v = cut(it)
            n = min(len(v), 13)
            for a in range(len(v) - n + 1) if v else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit |= set(range(b, b + n))
                        found.add(str(k))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"]) == (len(w), len(hit), sorted(found))


def test_token_store(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    file = P.path("byte_bpe_50k.json")
    token_store.write(docs, file, str(tmp_path / "store"))
    t, at = Tokenizer.from_file(file), 0
    got = {r["doc_id"]: r for r in token_store.read(spark, str(tmp_path / "store")).collect()}
    crc = {r["doc_id"]: r for r in token_store.digests(spark, str(tmp_path / "store")).collect()}
    for i, text in corpus():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["ids"]) == (at, ids)
        assert crc[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and crc[i]["n_tokens"] == len(ids)
        at += len(ids)
    few = {r["doc_id"]: r["ids"] for r in token_store.lookup(spark, str(tmp_path / "store"), [3, 17, 99]).collect()}
    assert few == {3: got[3]["ids"], 17: [0]}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_tokenizer(name):
    from tabulon.llm.encoding import Encoder

    e = Encoder(P.path(name))
    rng = random.Random(1)
    bits = [" ", " ", "  ", "\n", "\t", "a", "B", "é", "É", "'s", "'", ".", ",", "!?", "1", "<|endoftext|>", "́", "ß", "İ", "中", " ", "x.y", "can't", "don't.", "\r\n", "\x1c"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for t, ids in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(ids, e.dtype).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_packing(docs):
    from tokenizers import Tokenizer

    file = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(file)
    want = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in corpus()}
    rows = packing.pieces(docs, file, length=256).collect()
    seen: dict = {}
    for r in rows:
        assert bytes(r["ids"]) == want[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes() and r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["doc_tokens"] == len(want[r["doc_id"]])
        seen.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, ids in want.items():
        spans = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, n in spans) == len(ids) and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
    for spans in seen.values():
        spans.sort()
        total = sum(n for _, n in spans)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and total <= 256 and (total == 256 or total & (total - 1) == 0)
    assert sorted(seen) == list(range(len(seen)))


def test_windows_keep_to_the_mixture():
    shares, left = np.array([0.7, 0.3]), np.array([7000, 3000])
    owed = np.zeros(2)
    for size, took in packing.fill([100] * 90, shares, owed, left):
        assert size == 100 and dict(took)[0] == 70
    assert packing.windows(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1]


def test_token_counts(docs):
    initial, continuing = map(set, token_counts.vocabulary(P.path("piece_bpe_32k.model")))

    def greedy(word):
        s, n, at = "▁" + word, 0, 0
        while at < len(s):
            book = continuing if at else initial
            end = next((e for e in range(len(s), at, -1) if s[at:e] in book), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, P.path("piece_bpe_32k.model")).collect()}
    for i, t in corpus():
        n = [greedy(w.decode()) for w in words(t)]
        assert (got[i]["n_words"], got[i]["n_tokens"], got[i]["n_unknown"]) == (len(n), sum(n) + n.count(0), n.count(0))


def test_longest_match_falls_back_along_failures():
    c = token_counts.PieceCounter(["a", "abcd", "b"], ["b", "bc", "c", "de", "cd"])
    assert [c.count(w) for w in ("abcd", "abc", "abcde", "ab", "x", "bcd", "abcx")] == [1, 2, 0, 2, 0, 2, 0]


def test_language_id(spark):
    rng = random.Random(2)
    make = lambda s: " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(60))
    rows = [(i, make(["ba", "ti", "no"]) if i % 2 else make(["ku", "we", "zy"]), "aa" if i % 2 else "bb") for i in range(80)] + [(90, None, "aa"), (91, "12 34", "bb"), (92, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language_id.learn(df.filter("doc_id < 40"))
    got = {r["doc_id"]: r for r in language_id.identify(df, learned).collect()}
    assert all(got[i]["lang_pred"] == ("aa" if i % 2 else "bb") and 0 <= got[i]["score"] <= 1 for i in range(80))
    assert all(got[i]["lang_pred"] == "und" for i in (90, 91, 92))
    assert language_id.learn(df.filter("false")) == () and {r["lang_pred"] for r in language_id.identify(df, ()).collect()} == {"und"}


def phrase_count(text, labelled, stretch):
    """Greedy longest matches, ended after every stretch of characters; a character that never occurs is one of its own."""
    n = 0
    for i in range(0, len(text), stretch):
        part, at = text[i : i + stretch], 0
        while at < len(part):
            at = next((e for e in range(len(part), at, -1) if part[at:e] in labelled), at + 1)
            n += 1
    return n


def test_cross_parsing_counts_longest_matches(monkeypatch):
    labelled = "abcabd", "bbxa a"
    p = language_id.Parser(tuple(zip("xy", labelled, strict=True)))
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdxz ") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    points, sizes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.array([len(t) for t in texts])
    for stretch, lanes in ((4096, 1024), (7, 13)):
        monkeypatch.setattr(language_id, "STRETCH", stretch)
        monkeypatch.setattr(language_id, "LANES", lanes)
        assert p.phrases(points, sizes).tolist() == [[phrase_count(t, x, stretch) for x in labelled] for t in texts]


def test_predictions_are_those_of_a_plain_cross_parser(docs):
    import math

    learned = language_id.learn(docs.filter("doc_id % 2 = 0"), chars=600)
    assert len(learned) == 2 and all(" " in text.strip() for _, text in learned)  # phrases can span words
    got = {r["doc_id"]: r for r in language_id.identify(docs, learned).collect()}
    assert len(got) == len(corpus())
    for i, t in corpus():
        if not any(c.isalpha() for c in t or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        parsed = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        need = [phrase_count(parsed, x, 4096) * math.log2(len(x) + 2) for _, x in learned]
        best, second = sorted(need)
        assert got[i]["lang_pred"] == learned[need.index(best)][0] and got[i]["score"] == pytest.approx(second / (best + second))


def test_lm_scoring(docs):
    import math
    from collections import Counter

    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    held = docs.withColumn("held_out", F.col("doc_id") % 4 == 1)
    got = {r["doc_id"]: r for r in lm_scoring.score(held, P.path("byte_bpe_50k.json")).collect()}
    tokens = {i: [*(t or "").encode().translate(lower).split(), None] for i, t in corpus()}
    c = Counter(w for i, ws in tokens.items() if i % 4 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) and r["score"] < 0


def test_lm_scoring_of_long_words(spark):
    rng = random.Random(3)
    cjk = lambda n: "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(n))
    texts = ["a plain text to learn from"] * 4 + [cjk(60), cjk(600), cjk(10_000)]
    rows = spark.createDataFrame([(i, t, i > 3) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(rows, P.path("byte_bpe_50k.json")).collect()}
    # an unknown word's score goes on with its length: a like part for each character, far beyond what 16 bits or a float's exponent hold
    assert got[6] < -10_000 and got[5] / 600 == pytest.approx(got[6] / 10_000, rel=0.2) and got[4] < -100


def test_attention_learns_from_all_training_texts(spark, monkeypatch):
    import math
    from collections import Counter

    from tabulon.llm.encoding import encoder

    file = P.path("byte_bpe_50k.json")
    # 700 texts; what is to be learned, "kiwi" after "lemon", stands only behind the first 4000 characters
    texts = [f"w{i} " + "pad " * 1000 + "lemon kiwi " * 60 for i in range(700)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    e = encoder(file)
    count = Counter(w for t in texts for w in t.split())
    want = np.zeros(e.tokenizer.get_vocab_size())
    for w, ids in zip(count, lm_scoring.spellings(e, list(count)), strict=True):
        np.add.at(want, np.frombuffer(ids, e.dtype), count[w])
    want[-1] += len(texts)
    assert lm_scoring.summed(rows.select("text").mapInArrow(lm_scoring.counted(file), lm_scoring.PARTS))[1].tolist() == want.tolist()
    ids = np.frombuffer(b"".join(lm_scoring.spellings(e, ["lemon", "kiwi"] * 20)), e.dtype).astype(np.int64)
    monkeypatch.setattr(lm_scoring, "LOT", 256)
    monkeypatch.setattr(lm_scoring, "ONE_TASK", 1 << 14)  # rounds and averages, too
    for some in (rows, rows.limit(5)):
        w, slot, share = lm_scoring.trained(some, file)
        m = lm_scoring.Attention(w, slot.astype(np.int64), share)
        assert m.score(ids, np.array([0, len(ids)]))[4:].mean() > math.log10(0.5)


def test_windows_hold_every_id_once():
    class Spelled:
        dtype, new, old = np.dtype("<u2"), {str(i): np.array([i], "<u2").tobytes() for i in range(900)}, {}

    import pyarrow as pa

    rng, want = random.Random(4), [999]
    texts = [[rng.randrange(900) for _ in range(rng.choice([0, 3, 47, 48, 200]))] for _ in range(60)]
    for t in texts:
        want += [*t, 999]
    for lot in (1, 5, 1 << 16):
        lm_scoring.LOT, kept = lot, lm_scoring.LOT
        got = list(lm_scoring.windows(Spelled, 999, iter([pa.RecordBatch.from_arrays([pa.array([" ".join(map(str, t)) for t in texts])], names=["text"])])))
        lm_scoring.LOT = kept
        *whole, last = [r.tolist() for x in got for r in x]
        body = [i for r in whole for i in r[1:]]
        assert body == want[1 : len(body) + 1] and last == want[-len(last) :] and len(want) - len(last) <= len(body)


def test_attention_gradients_and_windows():
    rng = np.random.default_rng(0)
    m = lm_scoring.Attention.start(300, rng.integers(0, 50, 300).astype(float))
    x, y = rng.integers(0, 300, (2, 12)), rng.integers(0, 300, (2, 12))
    loss, g, rows = m.gradients(x, y)
    assert rows.tolist() == np.unique(x).tolist()
    of_e = np.zeros_like(m.w["e"])
    of_e[rows] = g["e"]
    g["e"] = of_e
    for name in ("q", "o", "u", "e"):
        w = m.w[name]
        at = np.unravel_index(np.argmax(np.abs(g[name])), w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = m.gradients(x, y)[0]
        w[at] = old - 1e-2
        down = m.gradients(x, y)[0]
        w[at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g[name][at]), rel=0.1, abs=2e-3)
    m = lm_scoring.Attention(m.w, m.slot, m.share)
    ids = rng.integers(0, 300, 230)
    one = m.score(ids, np.array([0, 0, 30, 230]))
    # the first window of a text sees all that is before; its ids are scored as by a plain forward pass
    before = np.concatenate(([299], ids[:29]))[None, :]
    w = m.w
    e = w["e"][before] + w["p"][:30]
    a = (e @ w["q"]) @ (e @ w["k"]).transpose(0, 2, 1) / 4 + m.mask[:30, :30]
    a = np.exp(a)
    z = e + (a / a.sum(-1, keepdims=True)) @ (e @ w["v"]) @ w["o"]
    soft = lambda t: t - np.log(np.exp(t).sum(-1, keepdims=True))
    first = soft(z @ w["u"] + w["b"])[0, np.arange(30), m.of[ids[:30]]]
    second = np.array([soft(z[0, i] @ w["u2"][m.of[k]] + w["b2"][m.of[k]])[m.at[k]] if m.of[k] < lm_scoring.CLASSES else m.share[k] * np.log(10) for i, k in enumerate(ids[:30])])
    assert np.allclose(one[:30], (first + second) / np.log(10), atol=1e-3)


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:220] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, [1.0]), (None, [1.0] * 16), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit("x"))
    got: dict = {}
    for r in neighbours.neighbours(df, F.col("vec_id") % 20 == 0, least=64, share=0.1).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y, hit = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, 600, 20))
    for q, found in got.items():
        found.sort()
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:20]
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(abs(s[v] - z) < 1e-9 for _, v, z in found)
        assert [(-z, v) for _, v, z in found] == sorted((-z, v) for _, v, z in found)
        hit += len(set(best.tolist()) & {v for _, v, _ in found})
    assert hit >= 0.9 * 20 * len(got)


def test_recall_of_the_shipped_parameters(spark, monkeypatch):
    """20,000 vectors without any clusters, several stretches and tiles; ties and repeated rows are in the test above."""
    rng = np.random.default_rng(2)
    n, dims = 20_000, 64
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7::2000] = x[7]
    monkeypatch.setattr(neighbours, "GROUP", 300)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got: dict = {}
    for r in neighbours.neighbours(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y, hit = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, n, 20))
    for q, found in got.items():
        found.sort()
        s = y @ y[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(n), -s))[:20]
        assert len({v for _, v, _ in found}) == 20 and all(abs(s[v] - z) < 1e-9 for _, v, z in found)
        hit += len(set(best.tolist()) & {v for _, v, _ in found})
    assert hit >= 0.9 * 20 * len(got), hit / (20 * len(got))
    print("recall", hit / (20 * len(got)))


def test_hilbert_is_a_walk():
    side = 8
    cells = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    order = np.argsort(neighbours.hilbert(cells, 3))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    file = P.path("word_bpe_49k.json")
    assert substring_dedup.substring_dedup(none).count() == suffix_dedup.suffix_dedup(none).count() == 0
    assert simhash.near_duplicates(none).count() == packing.pieces(none, file).count() == 0
    assert token_counts.token_counts(none, P.path("piece_bpe_32k.model")).count() == 0
    assert decontaminate.contamination(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert lm_scoring.score(none.withColumn("held_out", F.lit(False)), P.path("byte_bpe_50k.json")).count() == 0
    assert neighbours.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_copied_counts_earlier_words_of_a_text():
    rng = np.random.default_rng(0)
    lengths = np.array([0, 5, 1, 0, 40])
    doc = np.repeat(np.arange(5), lengths)
    place = rng.integers(0, 6, len(doc)).astype(np.uint32)
    seen, earlier = lm_scoring.copied(doc, place, lengths)
    for i in range(len(doc)):
        before = [j for j in range(i) if doc[j] == doc[i]]
        assert (seen[i], earlier[i]) == (len(before), sum(place[j] == place[i] for j in before))


def test_neighbours_in_turns(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)))], "vec_id long, embedding array<double>")
    found = [sorted(map(tuple, neighbours.neighbours(df, F.col("vec_id") % 20 == 0, least=64, curves=4, held=held).collect())) for held in (neighbours.HELD, 1)]
    assert len(found[0]) == 600 and found[0] == found[1]


def test_lm_scoring_reads_each_text_once(spark):
    rows = spark.createDataFrame([(i, f"Some words, {i} of them. " * 20, i % 7 == 2) for i in range(60)], "doc_id long, text string, held_out boolean").repartition(3)
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    assert lm_scoring.score(rows.mapInArrow(told, rows.schema), P.path("byte_bpe_50k.json")).count() == 60
    assert read.value == 60


def test_attention_works_in_parts():
    import tracemalloc

    rng = np.random.default_rng(0)
    m = lm_scoring.Attention.start(9000, rng.integers(0, 50, 9000).astype(float))
    ids = rng.integers(0, 9000, (256, 49))
    m.gradients(ids[:, :-1], ids[:, 1:])
    tracemalloc.start()
    m.gradients(ids[:, :-1], ids[:, 1:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # all probabilities of a batch take 65 numbers of 4 bytes for each id; no array of that kind is made, let alone several
    assert peak < 256 * 48 * 65 * 4 * 2


def test_attention_of_large_numbers():
    rng = np.random.default_rng(0)
    m = lm_scoring.Attention.start(300, rng.integers(1, 50, 300).astype(float))
    ids = rng.integers(0, 300, 100)
    for name, by in (("q", 400), ("u", 300), ("u2", 300)):
        w = {k: v * by if k == name else v for k, v in m.w.items()}
        large = lm_scoring.Attention(w, m.slot, m.share)
        exact = lm_scoring.Attention({k: v.astype(np.float64) for k, v in w.items()}, m.slot, m.share)
        got = large.score(ids, np.array([0, 100]))
        want = []
        for i in range(lm_scoring.WINDOW):
            x = np.append(299, ids[:i])
            e = exact.w["e"][x] + exact.w["p"][: i + 1]
            a = (e[-1] @ exact.w["q"]) @ (e @ exact.w["k"]).T / 4
            a = np.exp(a - a.max())
            z = e[-1] + a / a.sum() @ (e @ exact.w["v"]) @ exact.w["o"]
            soft = lambda t: t - t.max() - np.log(np.exp(t - t.max()).sum())
            c = m.of[ids[i]]
            want.append((soft(z @ exact.w["u"] + exact.w["b"])[c] + soft(z @ exact.w["u2"][c] + exact.w["b2"][c])[m.at[ids[i]]]) / np.log(10))
        assert np.isfinite(got).all() and np.allclose(got[: lm_scoring.WINDOW], want, rtol=1e-2, atol=2e-2)
        loss, g, _ = large.gradients(np.append(299, ids[:47])[None], ids[:48][None])
        assert np.isfinite(loss) and all(np.isfinite(v).all() for v in g.values())


def test_blocks_hold_the_ids_of_whole_texts(spark):
    from tabulon.llm.encoding import encoder

    file, lower = P.path("byte_bpe_50k.json"), bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    texts = [None, "", " ", "a", "  A,b. c!? x... ...", "É, é. 中文, ok! a\x0bb\x0cc\x1cd\x85e\xa0f AB;;;;;;;;;; don't. 9. 9,9, (x), '", "x\t\ny ", *(f"word{i}, word{i % 7}! Und {i}." for i in range(40))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    e = encoder(file)
    end, got = len(e.bytes) - 1, {}
    blocks, path = lm_scoring.in_blocks(rows.withColumn("held_out", F.col("doc_id") % 5 == 2), file, 4)
    import pyarrow as pa

    for r in blocks.filter(F.col("kind") >= lm_scoring.WORDS).collect():
        ids, lengths, *_ = lm_scoring.opened(bytes(r["data"]))
        assert all((i % 5 == 2) == (r["kind"] == lm_scoring.WORDS + lm_scoring.ROUNDS) for i in ids)
        ((stream, bounds),) = lm_scoring.streams_of_blocks(end, iter([pa.RecordBatch.from_arrays([pa.array([bytes(r["data"])])], names=["data"])]))
        got.update((i, (n, stream[a:b].tolist())) for i, n, a, b in zip(ids.tolist(), lengths.tolist(), bounds, bounds[1:], strict=False))
    for i, t in enumerate(texts):
        words = [w.decode() for w in (t or "").encode().translate(lower).split()]
        want = [x for w in words for x in e.tokenizer.encode(" " + w, add_special_tokens=False).ids]
        assert got[i] == (len(words), [*want, end])
