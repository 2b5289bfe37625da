"""The registered queries on small tables: columns and types of their contracts, every row, against brute force; nulls, repeats and empty tables."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from test_small_cases import P, brute_windows, corpus, words

from tabulon.llm import catalog, lm_scoring, simhash
from tabulon.llm.encoding import encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, path, docs, items, vectors):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    docs = [(i, t, ["en", "fr", None][i % 3], ["s0", None][i % 2], None) for i, t in corpus()]
    texts = dict(corpus())
    items = [(10, texts[14][-120:]), (9, texts[8]), (5, "nothing like it at all"), (4, None)]
    rng = np.random.default_rng(3)
    vectors = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(120, 8)))] + [(500, None, 0)]
    return tables(spark, tmp_path_factory.mktemp("sf"), docs, items, vectors)


CONTRACT = {
    "op2_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op3_decontaminate": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op4_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op5_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op6_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op7_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op9_lm_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op10_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_columns_and_empty_tables(spark, sf, tmp_path, name):
    got = dict(catalog.QUERIES[name](spark, sf).dtypes)
    for column in CONTRACT.get(name, "").split(", "):
        assert not column or got[column.split()[0]] == column.split()[1]
    assert catalog.QUERIES[name](spark, tables(spark, tmp_path, [], [], [])).count() == 0


def rows_of(spark, sf, name):
    return [r.asDict() for r in catalog.QUERIES[name](spark, sf).collect()]


def test_op2_and_op8(spark, sf):
    for name, items_of, size, join in (("op2_substring_dedup", words, 20, b" ".join), ("op8_suffix_dedup", lambda t: (t or "").encode(), 100, lambda x: bytes(x))):
        want = brute_windows(items_of, size)
        got = rows_of(spark, sf, name)
        assert len(got) == len(want)
        for r in got:
            items, gone = want[r["doc_id"]]
            kept = join([w for w, g in zip(items, gone, strict=True) if not g])
            assert (r["n_words" if size == 20 else "n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(items), sum(gone), hashlib.sha256(kept).hexdigest())


def test_op3(spark, sf):
    import re

    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    texts = dict(corpus())
    items = {"10": cut(texts[14][-120:]), "9": cut(texts[8]), "5": cut("nothing like it at all")}
    got = {r["doc_id"]: r for r in rows_of(spark, sf, "op3_decontaminate")}
    for i, t in texts.items():
        w, hit, found = cut(t), set(), set()
        for k, v in items.items():
            n = min(len(v), 13)
            for a in range(len(v) - n + 1):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit |= set(range(b, b + n))
                        found.add(k)
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"]) == (len(w), len(hit), len(found), names)
        assert got[i]["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    assert {r["contaminated"] for r in got.values()} == {True, False}


def test_op4_and_op10(spark, sf):
    from tokenizers import Tokenizer

    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    t, at = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0
    got = {r["doc_id"]: r for r in rows_of(spark, sf, "op4_token_files")}
    for i, text in corpus():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = rows_of(spark, sf, "op10_packing")
    for i, text in corpus():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        mine = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) == len(ids) and all(r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]]) for r in mine)


def test_op5_and_op7(spark, sf):
    got = {r["doc_id"]: r for r in rows_of(spark, sf, "op5_simhash")}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{simhash.fingerprint(t):016x}" for i, t in corpus()}
    assert got[12]["component_id"] == 0 and got[13]["component_id"] == 1  # exact copies
    for r in rows_of(spark, sf, "op7_language_id"):
        text = dict(corpus())[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text or "")))


def test_op6(spark, sf):
    x = {r["vec_id"]: np.array(r["embedding"], np.float32).astype(float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r["embedding"]}
    got = rows_of(spark, sf, "op6_neighbours")
    for q in range(0, 120, 20):
        best = sorted(((-float(x[q] @ v), i) for i, v in x.items() if i != q))[:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in mine] == [i for _, i in best] and all(abs(s + b) < 1e-9 for (_, _, s), (b, _) in zip(mine, best, strict=True))
    assert len(got) == 6 * 20


def plain_spelling(m, stream):
    """log10 of the probability of each id, by the formulas of attention, one id after the other."""
    w, end, out = m.w, len(m.slot) - 1, []
    soft = lambda t: t - np.log(np.exp(t).sum())
    for i, y in enumerate(stream):
        see = 0 if i < lm_scoring.WINDOW else lm_scoring.WINDOW + (i - lm_scoring.WINDOW) // lm_scoring.STRIDE * lm_scoring.STRIDE - (lm_scoring.WINDOW - lm_scoring.STRIDE)
        before = [end, *stream[:-1]][see : i + 1]
        e = w["e"][before] + w["p"][: len(before)]
        a = (e[-1] @ w["q"]) @ (e @ w["k"]).T / math.sqrt(lm_scoring.WIDTH)
        a = np.exp(a - a.max())
        z = e[-1] + (a / a.sum()) @ (e @ w["v"]) @ w["o"]
        c = m.of[y]
        inside = soft(z @ w["u2"][c] + w["b2"][c])[m.at[y]] / math.log(10) if c < lm_scoring.CLASSES else m.share[y]
        out.append(soft(z @ w["u"] + w["b"])[c] / math.log(10) + inside)
    return out


def test_op9_by_plain_formulas(spark, sf):
    file, lower = P.path("byte_bpe_50k.json"), bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in corpus()}
    assert set(held.values()) == {True, False}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    training = docs.filter(lm_scoring.remainder("doc_id", 7) != 2).selectExpr("cast(doc_id as long) doc_id", "text")
    weights, slot, share = lm_scoring.trained(training, file)
    m, e = lm_scoring.Attention(weights, slot.astype(np.int64), share), encoder(file)
    texts = {i: [w.decode() for w in (t or "").encode().translate(lower).split()] for i, t in corpus()}
    count = Counter(w for i, ws in texts.items() if not held[i] for w in [*ws, None])
    n, types = sum(count.values()), len(count)
    free, part = lm_scoring.DISCOUNT * types / n, lambda c: max(c - lm_scoring.DISCOUNT, 0) / n
    got = {r["doc_id"]: r for r in rows_of(spark, sf, "op9_lm_scoring")}
    for i, ws in texts.items():
        r, tokens = got[i], [*ws, None]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + types + 1)) for w in tokens))
        ids = [np.frombuffer(x, e.dtype).tolist() for x in lm_scoring.spellings(e, ws)]
        each = iter(plain_spelling(m, [y for x in ids for y in x] + [len(m.slot) - 1]))
        want = 0.0
        for j, (w, x) in enumerate(zip(tokens, [*ids, [0]], strict=True)):
            spelled = sum(next(each) for _ in x)
            copy = lm_scoring.COPY * j / (j + lm_scoring.COPY_AFTER)
            again = ws[:j].count(w) / max(j, 1) if w is not None else 0.0
            want += math.log10((1 - copy) * (free * 10**spelled + part(count[w])) + copy * again)
        assert r["score"] == pytest.approx(want, abs=0.002 * len(tokens) + 1e-3)


def test_null_and_repeated_ids(spark, tmp_path):
    t = " ".join(f"w{i}" for i in range(30))
    docs = [(1, t, "en", "s", 1), (1, t, "en", "s", 1), (None, t, None, None, None), (None, None, "fr", "s", 1), (2, "x", "fr", None, None), (3, " ".join(f"v{i % 700}" for i in range(20_000)), "en", "s", 1)]
    sf = tables(spark, tmp_path, docs, [(1, t)], [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (20, [0.5, 0.5], 0), (0, [0.0, 0.0], 0)])
    for name in catalog.QUERIES:
        got = rows_of(spark, sf, name)
        ids = Counter(r["query_id" if name == "op6_neighbours" else "doc_id"] for r in got)
        if name == "op6_neighbours":
            assert [(r["query_id"], r["vec_id"]) for r in got] == [(20, 1)]
        elif name == "op10_packing":
            assert sum(r["length"] for r in got if r["doc_id"] == 1) == 2 * next(r["doc_tokens"] for r in got if r["doc_id"] == 1) and set(ids) == {1, 2, 3, None}
        else:
            assert ids == {1: 2, None: 2, 2: 1, 3: 1}, name
