"""Benchmark decontamination by winnowing, in DataFrame operations only.

A word window of an item that occurs in a document shares with it the least
k-gram hash of every sliding window over k-grams, so of a document only those
least hashes (its fingerprints) need to meet the k-grams of the benchmark. The
hits are extended: documents with a hit have their windows compared with the
items' windows by two hashes. Every shared window is found. Items shorter than
a window are windows of their own; documents show all their word sequences of
just those lengths that occur among such items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, GRAM = 13, 5
#: The benchmark's side of a join is broadcast up to this many rows of two or three longs, and shuffled beyond.
BROADCAST_ROWS = 200_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """body(value) with value computed once; a plain column may be put in place of each use, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: str) -> Column:
    """Lower-cased (A-Z only) words of a text column; null has none."""
    cut = F.split(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.filter(cut, lambda w: w != "")


def gram(h: Column, i: Column, n: int, *salt: int) -> Column:
    """Hash of n numbers of the array h from place i (0 is first)."""
    return F.xxhash64(*map(F.lit, salt), *(F.get(h, i + j) for j in range(n)))


def grams(h: Column, n: int, of=lambda i, g: g, *salt: int) -> Column:
    """of(place, hash) of all n-grams of the array h."""
    last = F.size(h) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: of(i, gram(h, i, n, *salt))))


def winnowed(h: Column, window: int, k: int) -> Column:
    """The distinct least hashes of the k-grams of every window of words; none for a text shorter than a window."""
    span = window - k + 1
    places = F.sequence(F.lit(1), F.greatest(F.size(h) - window + 1, F.lit(1)))
    return F.when(F.size(h) >= window, let(grams(h, k), lambda g: F.array_distinct(F.transform(places, lambda i: F.array_min(F.slice(g, i, span))))))


def covered(spans: Column) -> Column:
    """How many places ranges (first, size), sorted, cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, s: Column) -> Column:
        to = s["first"] + s["size"]
        return F.struct(F.greatest(acc["end"], to).alias("end"), (acc["n"] + F.greatest(to - F.greatest(acc["end"], s["first"]), F.lit(0))).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def bounded(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if it is small."""
    return F.broadcast(df) if df.count() <= limit else df


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids) for each row of docs(doc_id, text), given items(item_id, text).

    Words are runs of digits, letters and all characters beyond ASCII, A-Z in
    lower case. A window is `window` consecutive words of an item, or all words
    of a shorter one; items and documents without words (null, empty) have
    none. n_hit counts words inside any occurrence of a window; item_ids are
    the items with an occurring window, null ids left out, sorted as strings.
    Repeated rows of docs each have a row and equal results; repeated items
    count once. Rows with a null doc_id are matched like others. Other columns
    play no part.
    """
    hashes = F.transform(words("text"), lambda w: F.xxhash64(w))
    b = items.select(F.col("item_id").cast("string").alias("item_id"), hashes.alias("h")).filter(F.size("h") > 0)
    size = F.least(F.size("h"), F.lit(window))
    short = sorted(r[0] for r in b.filter(F.size("h") < window).select(F.size("h").alias("n")).distinct().collect())  # at most window - 1 numbers
    lengths = [*short, window]

    def windows(df: DataFrame, *keep: str) -> DataFrame:
        """(keep, first, size, w1, w2): all windows of the lengths in question."""

        def pair(h: Column, n: int) -> Column:
            of = lambda i, g: F.struct(i.alias("first"), F.lit(n).alias("size"), g.alias("w1"), gram(h, i, n, 1).alias("w2"))
            return F.coalesce(grams(h, n, of), F.array().cast("array<struct<first:int,size:int,w1:bigint,w2:bigint>>"))

        every = let(F.col("h"), lambda h: F.concat(*(pair(h, n) for n in lengths)))
        return df.select(*keep, F.explode(every).alias("w")).select(*keep, "w.*")

    item_windows = windows(b.withColumn("n", size), "item_id", "n").filter("size = n").select("item_id", "size", "w1", "w2").distinct()
    whole = b.filter(F.size("h") >= window).select(F.explode(let(F.col("h"), lambda h: grams(h, k))).alias("f"))
    parts = b.select("h", size.alias("n")).filter(F.col("n") < window)
    tiny = [parts.filter(F.col("n") == n).select(gram(F.col("h"), F.lit(0), n, n).alias("f")) for n in short]
    sought = reduce(DataFrame.union, [whole, *tiny]).distinct()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def prints(h: Column) -> Column:
        found = [winnowed(h, window, k), *(F.array_distinct(grams(h, n, lambda i, g: g, n)) for n in short)]
        return F.concat(*(F.coalesce(x, F.array().cast("array<bigint>")) for x in found))

    marked = d.select("doc_id", F.xxhash64("text").alias("t"), F.explode(let(hashes, prints)).alias("f"))
    hit = marked.join(bounded(sought, broadcast_rows), "f", "left_semi").select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("hd"), F.col("t").alias("ht")).distinct()

    rows = d.withColumn("hd", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("ht", F.xxhash64("text"))
    near = rows.join(hit, ["hd", "ht"], "left_semi").dropDuplicates(["hd", "ht"]).select("hd", "ht", hashes.alias("h"))
    distinct_windows = item_windows.select("size", "w1", "w2").distinct()
    found = windows(near, "hd", "ht").join(bounded(distinct_windows, broadcast_rows), ["size", "w1", "w2"])
    spans = found.groupBy("hd", "ht").agg(F.array_sort(F.collect_list(F.struct("first", "size"))).alias("spans"), F.collect_set(F.struct("size", "w1", "w2")).alias("ws"))
    reached = spans.select("hd", "ht", F.explode("ws").alias("w")).select("hd", "ht", "w.*").join(bounded(item_windows, broadcast_rows), ["size", "w1", "w2"])
    names = reached.groupBy("hd", "ht").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    result = spans.select("hd", "ht", covered(F.col("spans")).alias("n_hit")).join(names, ["hd", "ht"])
    counted = rows.select("doc_id", "hd", "ht", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long").alias("n_words"))
    return counted.join(result, ["hd", "ht"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """The rule for a document to go: hit words make up a twentieth of it or more."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    got = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') AS w
  FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i) WHERE len(ws) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, ns WHERE len(ws) >= n)),
hits AS (SELECT DISTINCT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw USING (n, w)),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
