"""Labels to concepts: a closed dictionary, looked up exactly and then by similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.similarity import grams, may_reach, nearest, ratio
from tabulon.functions.text import digits, label_candidates, skeleton

#: Above this many rows a dictionary, which is closed and written by hand, is joined by a shuffle instead of a broadcast.
BROADCAST_ROWS = 100_000
#: Up to this many aliases every open label is compared with all of them in one pass over the labels; beyond, only with those that common characters let reach the cutoff.
COMPARED_ROWS = 10_000


def dictionary(alias: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """(skeleton, concept, ordinal, by_digits): the first concept of aliases without digits, and of those with digits the first by the digits.

    Where some alias of a skeleton holds digits, by_digits is not NULL and labels need the same digits.
    """
    rows = alias.filter(F.col("alias").isNotNull() & F.col("concept").isNotNull()).select(skeleton("alias").alias("skeleton"), digits("alias").alias("digits"), F.trim("concept").alias("concept"), F.col(ordinal).alias("ordinal")).filter("skeleton != ''")
    keys = rows.groupBy("skeleton", "digits").agg(F.min_by("concept", "ordinal").alias("concept"), F.min("ordinal").alias("ordinal"))
    free, entry = F.col("digits") == "", F.struct("digits", "concept")
    out = keys.groupBy("skeleton").agg(F.max(F.when(free, F.col("concept"))).alias("concept"), F.max(F.when(free, F.col("ordinal"))).alias("ordinal"), F.collect_list(F.when(~free, entry)).alias("e"))
    return out.select("skeleton", "concept", "ordinal", F.when(F.size("e") > 0, F.map_from_entries("e")).alias("by_digits"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def clashes(alias: DataFrame) -> DataFrame:
    """(skeleton, digits, concepts) of keys that stand for several concepts."""
    return alias.groupBy(skeleton("alias").alias("skeleton"), digits("alias").alias("digits")).agg(F.array_sort(F.collect_set("concept")).alias("concepts")).filter(F.size("concepts") > 1)


def match(labels: DataFrame, alias: DataFrame, key: list[str], label: str = "label", prefixes: str | None = None, section: str | None = None, cutoff: float = voc.FUZZY_CUTOFF, keep: list[str] | None = None) -> DataFrame:
    """(key, concept, match_score, label_used, keep) for each of labels, which are unique by key; other columns asked for are carried along, which saves a join.

    Exact first: of a label's forms, the first that the dictionary has, with
    score 1; a skeleton that is bound to digits needs them equal, and is left
    out here and below. Else the best ratio of any form with any alias without
    digits, ties to the earlier form and then the earlier alias; below the
    cutoff there is no concept, and the best score is told all the same, except
    with a dictionary of more than COMPARED_ROWS, where it is NULL.
    """
    book = dictionary(alias)
    known = book.filter("concept IS NOT NULL AND by_digits IS NULL").select("skeleton", "concept", "ordinal")
    listed = known.orderBy("ordinal", "skeleton").limit(COMPARED_ROWS + 1).collect()
    few = len(listed) <= COMPARED_ROWS
    given = {"label": F.col(label)} | {n: F.col(c) for n, c in (("prefixes", prefixes), ("section", section)) if c}
    asked = labels.select(*key, *(c.alias(n) for n, c in given.items()), F.struct(*(F.col(c) for c in keep or [label])).alias("kept"))
    forms = asked.withColumn("f", label_candidates("label", prefixes and "prefixes", section and "section")).select(*key, "label", "kept", F.posexplode_outer("f").alias("place", "form"))
    forms = forms.withColumn("skeleton", skeleton("form")).withColumn("digits", digits("form"))
    met = forms.join(small(book.select("skeleton", "concept", "by_digits")), "skeleton", "left")
    bound = F.col("by_digits").isNotNull()
    hit = F.when(bound, F.col("by_digits")[F.col("digits")]).otherwise(F.col("concept"))
    open_ = F.when(~bound & (F.col("skeleton") != ""), F.struct("place", "skeleton", "form"))
    one = met.groupBy(*key).agg(F.first("label").alias("label"), F.first("kept").alias("kept"), F.min_by(F.struct(hit.alias("concept"), "form"), F.when(hit.isNotNull(), F.col("place"))).alias("exact"), F.array_sort(F.collect_list(open_)).alias("open"))
    one = one.withColumn("exact", F.when(F.col("exact.concept").isNotNull(), F.col("exact"))).withColumn("open", F.when(F.col("exact").isNull(), F.col("open")))
    if few:
        near = nearest(F.transform("open", lambda f: f["skeleton"]), [r["skeleton"] for r in listed])
        concepts = F.array(*(F.lit(r["concept"]) for r in listed)) if listed else F.array().cast("array<string>")
        scored = one.withColumn("near", F.when(F.col("open").isNotNull(), near)).withColumn("c", F.get(concepts, F.col("near.alias"))).withColumn("f", F.get("open", F.col("near.place"))["form"])
        score = F.coalesce("near.r", F.lit(0.0))
    else:
        asked = one.filter("open IS NOT NULL").select(*key, F.explode("open").alias("o")).select(*key, "o.*")
        pairs = asked.select("skeleton").distinct().withColumn("g", F.explode(grams("skeleton", cutoff))).join(known.select(F.col("skeleton").alias("known"), "concept", "ordinal", F.explode(grams("skeleton", cutoff)).alias("g")), "g")
        pairs = pairs.drop("g").distinct().filter(may_reach("skeleton", "known", cutoff)).withColumn("r", ratio("skeleton", "known")).filter(F.col("r") >= cutoff)
        best = pairs.groupBy("skeleton").agg(F.max(F.struct("r", (-F.col("ordinal")).alias("o"), "concept")).alias("b"))
        found = asked.join(best, "skeleton").groupBy(*key).agg(F.max(F.struct(F.col("b.r").alias("r"), (-F.col("place")).alias("p"), F.col("b.concept").alias("c"), F.col("form").alias("f"))).alias("near"))
        scored = one.join(found, key, "left").withColumn("c", F.col("near.c")).withColumn("f", F.col("near.f"))
        score = F.col("near.r")
    good = F.col("near.r") >= cutoff
    return scored.select(
        *key,
        F.coalesce("exact.concept", F.when(good, F.col("c"))).alias("concept"),
        F.when(F.col("exact").isNotNull(), 1.0).otherwise(score).alias("match_score"),
        F.coalesce("exact.form", F.when(good, F.col("f")), "label").alias("label_used"),
        *(F.col(f"kept.{c}").alias(c) for c in keep or []),
    )


def truth_concepts(truth: DataFrame, alias: DataFrame, key: list[str], cutoff: float = voc.TRUTH_CUTOFF) -> DataFrame:
    """Concepts of hand-keyed items: the same lookup with a stricter cutoff, without prefixes; a blank section counts as none."""
    has = "section" if "section" in truth.columns else None
    truth = truth.withColumn("section", F.trim("section")) if has else truth
    return match(truth, alias, key, "item", section=has, cutoff=cutoff)


def canonical(items: DataFrame, alias: DataFrame, item: str = "item") -> DataFrame:
    """items with the dictionary's spelling of the same skeleton, or their own."""
    book = alias.withColumn("_s", skeleton("alias")).groupBy("_s").agg(F.min_by("alias", "ordinal").alias("canonical"))
    return items.withColumn("_s", skeleton(item)).join(small(book), "_s", "left").withColumn("canonical", F.coalesce("canonical", item)).drop("_s")
