"""Roll-forwards: opening balance and movements must give the closing balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon import vocabulary as voc
from tabulon.functions.text import bones, skeleton
from tabulon.functions.tokens import bound


def is_balance(label, names: list[str] | None = None) -> Column:
    """Whether a label begins as one of a balance."""
    sk = skeleton(label)
    out = F.lit(False)
    for n in names if names is not None else voc.BALANCE:
        out = out | sk.startswith(bones(n))
    return out


def blocks(df: DataFrame, partition: list[str], order: str, balance: Column, to: str = "block") -> DataFrame:
    """Two balance rows to a block; other rows belong to the one before, rows before any to the first. odd: the partition's balances don't pair up."""
    w = Window.partitionBy(*partition).orderBy(order)
    seen = F.sum(balance.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    odd = F.sum(balance.cast("int")).over(Window.partitionBy(*partition)) % 2 == 1
    return df.withColumn(to, F.greatest(F.floor((seen - 1) / 2), F.lit(0)).cast("int")).withColumn("odd", odd)


def collapsed(movements: Column, tol: float = voc.ROLL_TOL, guarded: bool = True) -> Column:
    """(movement, hits, named) of movements (value, total) in order: a subtotal takes the place of the most values before it that it sums up.

    The stack of values is kept as its prefix sums, so that the sum of its last k values is one difference.
    """
    start = F.struct(F.array(F.lit(0.0)).alias("sums"), F.lit(0).alias("hits"), F.lit(0).alias("named"))

    def step(acc: Column, m: Column) -> Column:
        x, whole = m["value"], F.element_at(acc["sums"], -1)
        before = F.slice(acc["sums"], 1, F.size(acc["sums"]) - 1)
        at = F.when(x != 0, F.array_position(F.transform(before, lambda p: F.abs(whole - p - x) <= tol), True)).otherwise(F.lit(0).cast("long"))

        def put(at: Column) -> Column:
            found = at > 0
            use = found & m["total"] if guarded else found
            kept = F.slice(acc["sums"], 1, F.when(use, at.cast("int")).otherwise(F.size(acc["sums"])))
            return F.struct(F.concat(kept, F.array(F.element_at(kept, -1) + x)).alias("sums"), (acc["hits"] + found.cast("int")).alias("hits"), (acc["named"] + (found & m["total"]).cast("int")).alias("named"))

        return bound(at, put)

    return F.aggregate(movements, start, step, lambda acc: F.struct(F.element_at(acc["sums"], -1).alias("movement"), acc["hits"].alias("hits"), acc["named"].alias("named")))


def _groups(cells: DataFrame, group: list[str], order: str, value: str, balance: str, item: str, total: str) -> DataFrame:
    """(group, opening, closing, m): of groups with two balances or more, the first and the last, and the movements between them. Totals are told by the name as it is written."""
    named = F.coalesce(F.contains(F.col(item), F.lit(total)), F.lit(False))
    row = F.struct(F.col(order).alias("o"), F.col(balance).alias("b"), F.col(value).cast("double").alias("v"), named.alias("t"))
    g = cells.groupBy(*group).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    g = g.withColumn("balances", F.filter("rows", lambda r: r["b"])).filter(F.size("balances") >= 2)
    g = g.withColumn("first", F.get("balances", F.lit(0))).withColumn("last", F.element_at("balances", -1))
    between = F.filter("rows", lambda r: (r["o"] > F.col("first.o")) & (r["o"] < F.col("last.o")) & ~r["b"])
    moved = F.transform(between, lambda r: F.struct(F.coalesce(r["v"], F.lit(0.0)).alias("value"), r["t"].alias("total")))
    return g.select(*group, F.col("first.v").alias("opening"), F.col("last.v").alias("closing"), moved.alias("m"))


def check(cells: DataFrame, group: list[str], order: str = "row_index", value: str = "value", balance: str = "is_balance", item: str = "item", tol: float = voc.ROLL_TOL, total: str = voc.TOTAL) -> DataFrame:
    """(group, opening, movement, closing, diff, ok) for groups with two balances or more; groups without any number are left out."""
    g = _groups(cells, group, order, value, balance, item, total).withColumn("movement", collapsed(F.col("m"), tol)["movement"])
    g = g.filter(~(F.col("opening").isNull() & F.col("closing").isNull() & (F.col("movement") == 0)))
    diff = F.coalesce("opening", F.lit(0.0)) + F.col("movement") - F.coalesce("closing", F.lit(0.0))
    return g.withColumn("diff", diff).withColumn("ok", F.abs("diff") <= tol).select(*group, "opening", "movement", "closing", "diff", "ok")


def audit(cells: DataFrame, group: list[str], order: str = "row_index", value: str = "value", balance: str = "is_balance", item: str = "item", tol: float = voc.ROLL_TOL, total: str = voc.TOTAL) -> DataFrame:
    """(hit_all, hit_named): how often movements between balances sum up what stands before them, and how often such a value is named a total."""
    f = _groups(cells, group, order, value, balance, item, total).select(collapsed(F.col("m"), tol, guarded=False).alias("f"))
    return f.agg(F.coalesce(F.sum("f.hits"), F.lit(0)).alias("hit_all"), F.coalesce(F.sum("f.named"), F.lit(0)).alias("hit_named"))
