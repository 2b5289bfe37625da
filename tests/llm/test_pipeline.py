"""The pipeline against a plain version of each stage."""

import re

import pytest

import corpus_pipeline
from tabulon.llm.repeats import without
from tabulon.llm.simhash import fingerprint

P = pytest.importorskip("public_tokenizers")


def brute(docs, items):
    from tokenizers import Tokenizer

    kept = {i: t for i, t in docs if t and any(c.isalpha() for c in t)}
    # near copies: components over links of three bits or fewer
    fps, root = {i: fingerprint(t) for i, t in kept.items()}, {i: i for i in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {i: t for i, t in sorted(kept.items()) if find(i) == i}
    # repeated stretches of 100 bytes, narrowed to whole characters
    seen, out = set(), {}
    for i, t in kept.items():
        raw = t.encode()
        gone = [False] * len(raw)
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                gone[at : at + 100] = [True] * 100
            seen.add(raw[at : at + 100])
        text, at = "", 0
        for c in t:
            n = len(c.encode())
            text += "" if all(gone[at : at + n]) else c
            at += n
        if text:
            out[i] = text
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))

    def bad(t):
        w, hit = cut(t), set()
        for it in items:
            v = cut(it)
            n = min(len(v), 13)
            for a in range(len(v) - n + 1) if v else ():
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit |= set(range(b, b + n))
        return bool(hit) and 20 * len(hit) >= len(w)

    out = {i: t for i, t in out.items() if not bad(t)}
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in out.items()}


def test_pipeline(spark, tmp_path):
    from test_small_cases import corpus

    docs = corpus()
    items = [docs[14][1][-120:], docs[9][1], "nothing like it at all"]
    data = [(i, t, ["en", "fr", None][i % 3], f"s{i % 3}", len(t or "")) for i, t in docs]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got: dict = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    want = brute(docs, items)
    assert {i: p[0][2] for i, p in got.items()} == want
    assert all(sum(n for _, n, _ in p) == want[i] for i, p in got.items())
    assert 5 < len(want) < len(docs) - 5


def test_narrowed_to_characters():
    assert without("éaéb".encode(), [(1, 5)]) == "é" + "b" and without(b"abcdefg", [(1, 5)]) == "afg" and without(b"", []) == ""


def test_texts_stay_where_no_row_has_a_language(spark):
    rows = [(1, "a text", None), (2, None, None), (3, "12 34", None), (4, "日本語", None), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["text"] for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {"a text", "日本語", "x"}


def test_language_is_renewed(spark):
    rows = [(i, " ".join(("haus", "baum", "und")[(i + j) % 3] if i % 2 else ("tree", "with", "the")[(i + j) % 3] for j in range(30)), "de" if i % 2 else "en") for i in range(40)]
    rows += [(40, "haus und baum und haus", None), (41, "the tree with the tree", "de"), (42, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert got == {i: "de" if i % 2 else "en" for i in range(40)} | {40: "de", 41: "en"}


CLASH = ["sub", "spans", "rest", "language", "score", "kind", "block", "bucket", "fp", "node", "key", "hd", "ht", "h", "f", "n", "task", "seq", "component_id", "fingerprint", "a.b"]


def test_stages_with_clashing_columns_repeated_rows_and_nulls(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en"), (1, text, "en"), (2, text[:200] + " and more of it " * 3, None), (None, "a b c", None), (3, None, None), (4, "", "en"), (5, "x" * 30_000, None)]
    docs = spark.createDataFrame([(*r, "s", len(r[1] or ""), *CLASH) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))
    spark.createDataFrame([(0, "nothing of the kind")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        last = name == "packing"
        assert last or got.dtypes == docs.dtypes
        assert got.count() == {"language_id": 5, "near_dedup": 5, "suffix_array_dedup": 4, "benchmark_decontamination": 7}.get(name, got.count())
        if not last:
            assert all(list(r)[5:] == CLASH for r in got.collect())
        assert stage(spark, none, str(tmp_path)).count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.packing(spark, docs, str(tmp_path)).collect()} == {1, 2, 3, 4, 5, None}


def test_documents_without_an_id(spark, tmp_path):
    texts = [" ".join(f"{w}{i}" for i in range(40)) for w in ("ab", "cd", "ef")]
    rows = [(1, texts[0]), (2, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    want = [(1, texts[0]), (None, texts[1]), (None, texts[2])]
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[1]) == want
    spark.createDataFrame([(0, texts[2])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.benchmark_decontamination(spark, spark.createDataFrame(want, docs.schema), str(tmp_path))
    assert sorted(map(tuple, clean.collect()), key=lambda r: r[1]) == want[:2]
