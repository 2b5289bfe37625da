"""All queries over the fixture tables by name, and the SQL that expresses them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.functions import similarity, tokens
from tabulon.functions import text as tx
from tabulon.operators import columns, equations, evaluate, matching, pages, quality, reports, rollforward, select, statement
from tabulon.registry import ORACLE, QUERIES, query, t

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_ORDER = ", ".join(LINE)
LATIN = "bcdfghjklmnpqrstvwxyz"


# --- scans and projections


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity IS NOT NULL")
def scan_trace_view(spark, sf):
    df = t(spark, sf, "lineitem").withColumnsRenamed({"l_returnflag": "company", "l_linestatus": "statement", "l_quantity": "concept"})
    return reports.trace(df, "R", "F", {"l_orderkey": "order_id", "l_linenumber": "line", "concept": "quantity", "no_such_column": "x"}, mapped_only=True)


@query("SELECT p_partkey, p_size FROM part")
def guarded_columns(spark, sf):
    return reports.present(t(spark, sf, "part"), ["p_partkey", "item", "p_size"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem WHERE NOT (l_discount = 0 AND l_tax = 0)")
def drop_all_null(spark, sf):
    df = t(spark, sf, "lineitem").withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})
    return pages.with_values(df, ["l_discount", "l_tax"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax")


@query("SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_acctbal AS balance, 'text' AS reader, CAST(NULL AS VARCHAR) AS nation FROM customer UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, 'ocr', CAST(s_nationkey AS VARCHAR) FROM supplier")
def union_provenance(spark, sf):
    a = t(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("ocr").alias("reader"), F.col("s_nationkey").cast("string").alias("nation"))
    return reports.union(a, b)


@query("SELECT c_custkey AS id FROM customer")
def not_scanned(spark, sf):
    a = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    b = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("ocr").alias("reader"))
    return reports.not_scanned(reports.union(a, b)).select("id")


# --- picking rows


@query("SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F')::INT, o_totalprice DESC, o_orderkey) = 1")
def pick_best_row(spark, sf):
    df = t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return select.pick_rows(df, ("o_custkey",), values=["o_totalprice"], score="o_totalprice", concept="o_orderstatus", last=F.col("o_orderstatus") == "F", ordinal=("o_orderkey",))


@query(
    f"""WITH x AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem)
SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM x QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY
(l_quantity IS NOT NULL)::INT + (l_extendedprice IS NOT NULL)::INT + (l_discount IS NOT NULL)::INT + (l_tax IS NOT NULL)::INT DESC, {LINE_ORDER.replace("l_discount, l_tax", "l_discount NULLS FIRST, l_tax NULLS FIRST")}) = 1"""
)
def pick_row_completeness(spark, sf):
    df = t(spark, sf, "lineitem").withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})
    return select.pick_rows(df, ("l_partkey",), values=MEASURES, score=None, concept="l_orderkey", ordinal=tuple(LINE)).select("l_partkey", "l_orderkey", "l_linenumber", *MEASURES)


@query("SELECT l_orderkey, l_linenumber, l_partkey, col, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME col VALUE value)")
def lut_unpivot(spark, sf):
    df = t(spark, sf, "lineitem").withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})
    return select.unpivot(df, ["l_orderkey", "l_linenumber", "l_partkey"], MEASURES)


@query("SELECT p_brand, p_type, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1")
def first_seen_template(spark, sf):
    return select.first_seen(t(spark, sf, "part"), ["p_brand", "p_type"], "p_partkey").select("p_brand", "p_type", "p_partkey", "p_name")


@query(
    """SELECT o_custkey, arg_min(priority, o_orderkey) FILTER (priority IS NOT NULL) AS priority, arg_min(price, o_orderkey) FILTER (price IS NOT NULL) AS price, string_agg(status, ',' ORDER BY o_orderkey) AS pages, min(o_orderkey) AS first_order
FROM (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority, CASE WHEN o_totalprice > 200000 THEN NULL ELSE o_totalprice END AS price, o_orderstatus AS status FROM orders) GROUP BY o_custkey"""
)
def merge_first_filled(spark, sf):
    df = t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"), F.when(F.col("o_totalprice") <= 200000, F.col("o_totalprice")).alias("price"), F.col("o_orderstatus").alias("pages"))
    out = select.first_filled(df, ["o_custkey"], ["priority", "price"], "pages", "o_orderkey")
    return out.select("o_custkey", "priority", "price", "pages", F.col("o_orderkey").alias("first_order"))


@query(
    """WITH a AS (SELECT p_brand, p_type, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) <= greatest(2, 10 // 11 + 1))
SELECT p_brand, p_type, p_partkey FROM a QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= 10"""
)
def stratified_head(spark, sf):
    return select.stratified(t(spark, sf, "part").select("p_brand", "p_type", "p_partkey"), "p_brand", "p_type", 10, 11, [F.asc("p_partkey")])


# --- equations


EQS = [("revenue", ["net", "?tax_part"], "gross", None), ("status", ["open", "closed"], "all", ["con_cur"])]
LUT_SQL = """p AS (SELECT l_orderkey % 100 AS k, sum(round(l_extendedprice * (1 - l_discount))) AS net, sum(round(l_extendedprice)) AS gross, sum(round(l_extendedprice)) - sum(round(l_extendedprice * (1 - l_discount))) AS tax_part,
  sum(CASE WHEN l_linestatus = 'O' THEN 1.0 END) AS open, sum(CASE WHEN l_linestatus = 'F' THEN 1.0 END) AS closed, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1),
lut AS (SELECT k, 'net' AS concept, net AS value FROM p UNION ALL SELECT k, 'gross', gross FROM p WHERE k % 7 <> 0 UNION ALL SELECT k, 'tax_part', tax_part FROM p WHERE k % 2 = 0
  UNION ALL SELECT k, 'open', open FROM p UNION ALL SELECT k, 'closed', closed FROM p WHERE k % 5 <> 0 UNION ALL SELECT k, 'all', n FROM p),
w AS (SELECT k, max(CASE WHEN concept = 'net' THEN value END) net, max(CASE WHEN concept = 'gross' THEN value END) gross, max(CASE WHEN concept = 'tax_part' THEN value END) tax_part,
  max(CASE WHEN concept = 'open' THEN value END) op, max(CASE WHEN concept = 'closed' THEN value END) cl, max(CASE WHEN concept = 'all' THEN value END) al FROM lut GROUP BY k),
v AS (SELECT k, 'revenue' AS eq_id, coalesce(net, 0) + coalesce(tax_part, 0) AS addends_sum, gross AS total, net IS NULL AS missing FROM w
  UNION ALL SELECT k, 'status', coalesce(op, 0) + coalesce(cl, 0), al, op IS NULL OR cl IS NULL FROM w),
verdict AS (SELECT k, eq_id, addends_sum, total, CASE WHEN total IS NULL OR missing THEN 'skip' WHEN abs(addends_sum - total) < 1 THEN 'pass' ELSE 'fail' END AS verdict FROM v)"""


def _lut(spark, sf):
    li = t(spark, sf, "lineitem")
    k = (F.col("l_orderkey") % 100).alias("k")
    net, gross = F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")))), F.sum(F.round("l_extendedprice"))
    one = lambda s: F.sum(F.when(F.col("l_linestatus") == s, F.lit(1.0)))
    p = li.groupBy(k).agg(net.alias("net"), gross.alias("gross"), (gross - net).alias("tax_part"), one("O").alias("open"), one("F").alias("closed"), F.count("*").cast("double").alias("all"))
    p = p.withColumn("gross", F.when(F.col("k") % 7 != 0, F.col("gross"))).withColumn("tax_part", F.when(F.col("k") % 2 == 0, F.col("tax_part"))).withColumn("closed", F.when(F.col("k") % 5 != 0, F.col("closed")))
    return select.unpivot(p, ["k"], ["net", "gross", "tax_part", "open", "closed", "all"], "concept").withColumn("col", F.lit("con_cur"))


@query(f"WITH {LUT_SQL} SELECT * FROM verdict")
def equation_check(spark, sf):
    return equations.verdicts(_lut(spark, sf), EQS, company="k", cols=["con_cur"]).select("k", "eq_id", "addends_sum", "total", "verdict")


@query(
    f"""WITH {LUT_SQL}, c AS (SELECT CAST(k AS VARCHAR) AS k, sum((verdict = 'pass')::INT) AS n_pass, sum((verdict = 'fail')::INT) AS n_fail, sum((verdict = 'skip')::INT) AS n_skip FROM verdict GROUP BY GROUPING SETS ((k), ()))
SELECT k, CAST(n_pass AS BIGINT) AS n_pass, CAST(n_fail AS BIGINT) AS n_fail, CAST(n_skip AS BIGINT) AS n_skip, n_pass + n_fail = 0 AS blind FROM c"""
)
def equation_summary(spark, sf):
    return equations.summary(equations.verdicts(_lut(spark, sf), EQS, company="k", cols=["con_cur"]), "k")


@query("SELECT count(*) AS n, CAST(sum((abs(a.o_totalprice - b.p) <= 0.5)::INT) AS BIGINT) AS n_agree FROM orders a JOIN (SELECT o_orderkey, o_totalprice + o_orderkey % 3 AS p FROM orders) b USING (o_orderkey)")
def lut_agreement(spark, sf):
    a = t(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    return quality.agreement(a, a.select("o_orderkey", (F.col("value") + F.col("o_orderkey") % 3).alias("value")), ["o_orderkey"])


# --- evaluation


CELLS_SQL = """s AS (SELECT l_orderkey, sum(floor(l_extendedprice)) AS price, CAST(count(*) AS DOUBLE) AS n FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1),
g AS (SELECT o_orderkey, o_orderpriority AS trap, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice) END AS price, CASE WHEN o_orderkey % 3 = 0 THEN 4.0 END AS n FROM orders),
m AS (SELECT o_orderkey, trap, 'price' AS col, g.price AS want, CASE WHEN o_orderkey % 4 = 0 THEN g.price ELSE s.price END AS have, l_orderkey IS NOT NULL AS there FROM g LEFT JOIN s ON o_orderkey = l_orderkey
  UNION ALL SELECT o_orderkey, trap, 'n', g.n, s.n, l_orderkey IS NOT NULL FROM g LEFT JOIN s ON o_orderkey = l_orderkey),
cells AS (SELECT o_orderkey, trap, col, want, CASE WHEN there THEN have END AS have, CASE WHEN want IS NULL AND (NOT there OR have IS NULL) THEN 'ok_empty' WHEN NOT there THEN 'miss' WHEN have IS NULL THEN 'wrong_empty' WHEN want IS NULL THEN 'extra_value' WHEN abs(want - have) < 0.005 THEN 'ok' ELSE 'wrong' END AS status FROM m)"""


def _cells(spark, sf):
    li = t(spark, sf, "lineitem").filter("l_orderkey % 11 <> 0")
    s = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.floor("l_extendedprice").cast("double")).alias("price"), F.count("*").cast("double").alias("n"))
    o = t(spark, sf, "orders")
    g = o.select("o_orderkey", F.col("o_orderpriority").alias("trap"), F.when(F.col("o_orderkey") % 5 != 0, F.floor("o_totalprice").cast("double")).alias("price"), F.when(F.col("o_orderkey") % 3 == 0, F.lit(4.0)).alias("n"))
    right = s.join(g.select("o_orderkey", F.col("price").alias("_want")), "o_orderkey").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("_want")).otherwise(F.col("price")).alias("price"), "n")
    return g, evaluate.cells(g, right, ["o_orderkey"], ["price", "n"], ["trap"])


@query(f"WITH {CELLS_SQL} SELECT * FROM cells")
def evaluate_cells(spark, sf):
    return _cells(spark, sf)[1]


@query(f"WITH {CELLS_SQL} SELECT status, count(*) AS n FROM cells GROUP BY 1")
def status_histogram(spark, sf):
    return evaluate.histogram(_cells(spark, sf)[1])


@query(f"WITH {CELLS_SQL} SELECT trap, CAST(sum((status IN ('ok', 'ok_empty'))::INT) AS BIGINT) AS n_ok, count(*) AS n, round(100.0 * sum((status IN ('ok', 'ok_empty'))::INT)::DOUBLE / count(*), 1) AS pct FROM cells WHERE trap IS NOT NULL GROUP BY 1")
def accuracy_by_group(spark, sf):
    return evaluate.accuracy(_cells(spark, sf)[1], "trap", half_even=False)


@query(f"WITH {CELLS_SQL}, c AS (SELECT avg((price IS NOT NULL)::INT::DOUBLE) AS coverage FROM g), a AS (SELECT avg((status IN ('ok', 'ok_empty'))::INT::DOUBLE) AS accuracy FROM cells) SELECT round(coverage, 9) AS coverage, round(accuracy, 9) AS accuracy, round(coverage * accuracy, 9) AS weighted FROM c, a")
def coverage_weighted(spark, sf):
    g, found = _cells(spark, sf)
    return evaluate.coverage(g, found, "price").select(*(F.round(c, 9).alias(c) for c in ("coverage", "accuracy", "weighted")))


@query(f"WITH {CELLS_SQL} SELECT o_orderkey, col, status FROM cells WHERE status NOT IN ('ok', 'ok_empty') ORDER BY o_orderkey, col LIMIT 25")
def top_mismatch(spark, sf):
    return evaluate.mismatches(_cells(spark, sf)[1], ["o_orderkey", "col"], 25).select("o_orderkey", "col", "status")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, min(event_id) OVER (PARTITION BY user_id) AS m FROM events WHERE event_type = 'purchase') WHERE event_id = m")
def opening_row(spark, sf):
    e = t(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") == "purchase", "balance"))
    return evaluate.opening_rows(e, ["user_id"], "kind", "event_id").select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, CAST(sum((NOT coalesce(abs(value - p) <= 1.0, false))::INT) AS BIGINT) AS n_differ, count(*) AS n, sum((NOT coalesce(abs(value - p) <= 1.0, false))::INT) > 0 AS caught FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY 1")
def shift_power(spark, sf):
    return evaluate.shift_power(t(spark, sf, "events"), ["user_id"], "event_id")


MATRIX_SQL = "m AS (SELECT o_custkey, o_orderkey, o_totalprice AS value_gt, CASE WHEN o_custkey % 3 = 0 THEN o_totalprice + 5 WHEN o_orderkey % 4 > 0 THEN o_totalprice + 0.5 END AS value_ex FROM orders), k AS (SELECT *, coalesce(abs(value_gt - value_ex) <= 1, value_gt IS NULL AND value_ex IS NULL) AS ok FROM m)"


def _matrix(spark, sf):
    o = t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("value"))
    ex = o.withColumn("value", F.when(F.col("o_custkey") % 3 == 0, F.col("value") + 5).when(F.col("o_orderkey") % 4 > 0, F.col("value") + 0.5))
    return evaluate.matrix_cells(o, ex, ["o_custkey", "o_orderkey"])


@query(f"WITH {MATRIX_SQL} SELECT * FROM k")
def matrix_truth(spark, sf):
    return _matrix(spark, sf)


@query(f"WITH {MATRIX_SQL} SELECT o_custkey, CAST(sum(ok::INT) AS BIGINT) AS n_ok, count(*) AS n, sum((NOT ok)::INT) = count(*) AS shifted FROM k GROUP BY 1")
def shifted_pages(spark, sf):
    return evaluate.by_page(_matrix(spark, sf), ["o_custkey"])


# --- quality


MODE_SQL = """x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE o_orderpriority END AS unit FROM orders),
c AS (SELECT o_custkey, unit, count(*) AS n FROM x WHERE unit <> 'unknown' GROUP BY 1, 2), b AS (SELECT o_custkey, unit AS m FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, unit) = 1)"""


def _units(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 == 0, "unknown").otherwise(F.col("o_orderpriority")).alias("unit"))


@query(f"WITH {MODE_SQL} SELECT o_orderkey, x.o_custkey, CASE WHEN unit = 'unknown' THEN coalesce(m, unit) ELSE unit END AS unit FROM x LEFT JOIN b USING (o_custkey)")
def mode_fill(spark, sf):
    return quality.fill_mode(_units(spark, sf), "unit", by=["o_custkey"])


@query(f"WITH {MODE_SQL}, g AS (SELECT unit AS m FROM (SELECT unit, count(*) AS n FROM x WHERE unit <> 'unknown' GROUP BY 1) ORDER BY n DESC, unit LIMIT 1) SELECT o_orderkey, o_custkey, CASE WHEN unit = 'unknown' THEN m ELSE unit END AS unit FROM x, g")
def mode_fill_global(spark, sf):
    return quality.fill_mode(_units(spark, sf), "unit")


@query(f"WITH {MODE_SQL} SELECT DISTINCT x.o_custkey FROM x LEFT JOIN b USING (o_custkey) WHERE unit = 'unknown' AND m IS NULL")
def still_unknown(spark, sf):
    return quality.still_unknown(quality.fill_mode(_units(spark, sf), "unit", by=["o_custkey"]), "unit", "o_custkey")


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS n, arg_min(o_orderpriority, o_orderkey) AS first FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def mixed_attr(spark, sf):
    return quality.mixed(t(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, CAST(count(DISTINCT (l_quantity, l_tax)) AS INTEGER) AS n_distinct FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT (l_quantity, l_tax)) > 1")
def dup_conflict(spark, sf):
    return quality.conflicts(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return quality.duplicates(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_returnflag, CAST(sum((nullif(l_discount, 0) IS NOT NULL)::INT + (nullif(l_tax, 0) IS NOT NULL)::INT) AS BIGINT) AS n_filled, CAST(count(*) * 2 AS BIGINT) AS n_cells FROM lineitem GROUP BY 1")
def filled_cells(spark, sf):
    df = t(spark, sf, "lineitem").withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})
    return quality.cells_filled(df, ["l_discount", "l_tax"], ["l_returnflag"])


@query("SELECT * FROM (VALUES ('no_such_event')) v(event_type)")
def missing_values(spark, sf):
    return quality.missing_values(t(spark, sf, "events"), "event_type", ["purchase", "signup", "error", "no_such_event"])


@query("SELECT DISTINCT c_custkey AS o_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def anti_missing(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return quality.known_only(c, t(spark, sf, "orders").filter("o_totalprice > 100000").select("o_custkey"), "o_custkey")[1]


@query("SELECT count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_l_suppkey, count(DISTINCT l_partkey) AS n_l_partkey, count(DISTINCT l_returnflag) AS n_l_returnflag FROM lineitem")
def distinct_counts(spark, sf):
    return reports.counts(t(spark, sf, "lineitem"), ["l_suppkey", "l_partkey", "l_returnflag"])


@query(
    """WITH p AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents), a AS (SELECT doc_id, w, count(*) AS n FROM p GROUP BY 1, 2)
SELECT a.doc_id, CAST(sum(least(a.n, coalesce(b.n, 0))) AS BIGINT) AS n_hit, CAST(sum(a.n - least(a.n, coalesce(b.n, 0))) AS BIGINT) AS n_extra FROM a LEFT JOIN a AS b ON b.doc_id = a.doc_id - 1 AND b.w = a.w GROUP BY 1"""
)
def multiset_hit_extra(spark, sf):
    """Words of each document against those of the one before it."""
    words = t(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return quality.multiset(words, words.withColumn("doc_id", F.col("doc_id") + 1), ["doc_id"], "w")


@query("SELECT user_id, CAST(sum(least(a, coalesce(b, 0))) AS BIGINT) AS n_hit, CAST(sum(a - least(a, coalesce(b, 0))) AS BIGINT) AS n_extra FROM (SELECT user_id, event_type, count(*) AS a FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2) LEFT JOIN (SELECT user_id, event_type, count(*) AS b FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2) USING (user_id, event_type) GROUP BY 1")
def multiset_events(spark, sf):
    e = t(spark, sf, "events")
    return quality.multiset(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"), ["user_id"], "event_type")


@query("SELECT l_suppkey, list_sort(list(l_quantity))[len(list(l_quantity)) // 2 + 1] AS med FROM lineitem GROUP BY 1")
def upper_median(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_suppkey").agg(quality.upper_median("l_quantity").alias("med"))


@query(
    """WITH f AS (SELECT avg((event_type <> 'error')::INT::DOUBLE) AS mapped, max((event_type = 'purchase')::INT) AS bs, max((event_type = 'unknown')::INT) AS u FROM events), p AS (SELECT avg((source = 'src0')::INT::DOUBLE) AS strong FROM documents),
v AS (SELECT CAST(sum((o_orderstatus = 'O')::INT) AS BIGINT) AS n_pass, CAST(sum((o_orderstatus = 'P')::INT) AS BIGINT) AS n_fail FROM orders)
SELECT round(mapped, 9) AS mapped, round(strong, 9) AS strong, n_pass, n_fail, mapped >= 0.5 AS mapped_ok, strong >= 0.5 AS pages_ok, bs = 1 AS balance_ok, n_pass >= 1 AND n_fail = 0 AS equations_ok, u = 0 AS unit_ok,
mapped >= 0.5 AND strong >= 0.5 AND bs = 1 AND n_pass >= 1 AND n_fail = 0 AND u = 0 AS passed FROM f, p, v"""
)
def gate_signals(spark, sf):
    facts = t(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("event_type")).alias("concept"), F.when(F.col("event_type") == "purchase", "BS").otherwise("IS").alias("statement"), F.col("event_type").alias("unit"))
    pg = t(spark, sf, "documents").select(F.when(F.col("source") == "src0", "title").otherwise("alike").alias("page_how"))
    v = t(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "O", "pass").when(F.col("o_orderstatus") == "P", "fail").otherwise("skip").alias("verdict"))
    return quality.gate(facts, pg, v).withColumns({"mapped": F.round("mapped", 9), "strong": F.round("strong", 9)})


@query("SELECT source, count(*) AS n, CASE WHEN avg((lang = 'en')::INT) >= 0.6 THEN 'good' WHEN avg((lang = 'en')::INT) >= 0.4 THEN 'fair' ELSE 'poor' END AS bucket FROM documents GROUP BY 1")
def share_buckets(spark, sf):
    return t(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), quality.share_bucket(F.avg((F.col("lang") == "en").cast("double"))).alias("bucket"))


# --- reports


@query("SELECT o_orderpriority, CAST(sum((o_orderstatus = 'F')::INT) AS BIGINT) AS F, CAST(sum((o_orderstatus = 'O')::INT) AS BIGINT) AS O, CAST(sum((o_orderstatus = 'P')::INT) AS BIGINT) AS P, CAST(sum((o_orderstatus IN ('F', 'O', 'P'))::INT) AS BIGINT) AS total FROM orders GROUP BY 1")
def pivot_counts_total(spark, sf):
    return reports.pivot_counts(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS n, l_returnflag = 'R' AS default FROM lineitem GROUP BY 1")
def nunique_rank(spark, sf):
    return reports.spread(t(spark, sf, "lineitem"), "l_returnflag", "l_suppkey", ["X", "R", "A"])


@query("SELECT o_orderkey, o_totalprice, o_totalprice * CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1000 ELSE 1000000 END AS normalised FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def unit_normalise(spark, sf):
    return reports.comparable(t(spark, sf, "orders"), "o_totalprice", "o_orderpriority", {"1-URGENT": 1.0, "2-HIGH": 1000.0, "3-MEDIUM": 1e6}).select("o_orderkey", "o_totalprice", "normalised")


@query("SELECT p_partkey, p_name, p_size FROM part QUALIFY row_number() OVER (ORDER BY p_size DESC, p_partkey) <= 20")
def top_k(spark, sf):
    return reports.top(t(spark, sf, "part"), [F.desc("p_size"), F.asc("p_partkey")], 20).select("p_partkey", "p_name", "p_size")


# --- order-dependent operators


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS section FROM events")
def section_ffill(spark, sf):
    df = t(spark, sf, "events").withColumn("s", F.when(F.col("event_type") == "signup", F.col("event_id").cast("string")))
    return pages.fill_forward(df, "s", ["user_id"], "event_id", "section").select("event_id", "section")


@query(
    """WITH e AS (SELECT *, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ep0 FROM events), f AS (SELECT *, coalesce(ep0, 0) AS ep FROM e),
g AS (SELECT event_id, list(event_id) FILTER (event_type = 'click') OVER (PARTITION BY user_id, ep ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM f)
SELECT event_id, coalesce(array_to_string(list_slice(l, greatest(len(l) - 2, 1), len(l)), ','), '') AS prefixes FROM g"""
)
def prefix_memory(spark, sf):
    df = t(spark, sf, "events").withColumn("kept", F.when(F.col("event_type") == "click", F.col("event_id").cast("string"))).withColumn("reset", F.col("event_type") == "purchase")
    return pages.memory(df, ["user_id"], "event_id", "kept", "reset").select("event_id", F.array_join("prefixes", ",").alias("prefixes"))


@query("SELECT event_id, coalesce(max((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS after_error FROM events")
def after_marker(spark, sf):
    return pages.after(t(spark, sf, "events"), F.col("event_type") == "error", ["user_id"], "event_id", "after_error").select("event_id", "after_error")


@query("SELECT event_id, CASE WHEN event_type = 'click' AND coalesce(max((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'click_AFTER' ELSE event_type END AS concept_eq FROM events")
def adjustment_after(spark, sf):
    return pages.adjustment_after(t(spark, sf, "events"), ["user_id"], "event_id", "event_type", "error", ["click"]).select("event_id", "concept_eq")


@query("SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup') AND lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) IS NOT NULL THEN event_type || '_BEFORE_ITEMS' ELSE event_type END AS event_type FROM events")
def before_items(spark, sf):
    return pages.before_items(t(spark, sf, "events"), ["user_id"], "event_id", ["purchase", "signup"], "event_type").select("event_id", "event_type")


@query(
    """WITH e AS (SELECT user_id, event_id, epoch(ts)::BIGINT AS s, epoch(ts)::BIGINT - lag(epoch(ts)::BIGINT) OVER (PARTITION BY user_id ORDER BY epoch(ts)::BIGINT, event_id) AS d FROM events)
SELECT event_id, CAST(sum(CASE WHEN d > 43200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM e"""
)
def gap_cluster(spark, sf):
    df = t(spark, sf, "events").withColumn("s", F.rint(F.col("ts").cast("timestamp").cast("double")).cast("long"))  # the nearest second, as SQL casts
    return columns.gap_clusters(df, ["user_id"], "s", 43200).select("event_id", "cluster")


@query(
    """WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2), g AS (SELECT *, sum(CASE WHEN p_size - lag_ > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_size) AS cluster FROM (SELECT *, lag(p_size) OVER (PARTITION BY p_brand ORDER BY p_size) AS lag_ FROM c)),
r AS (SELECT p_brand, CAST(cluster AS BIGINT) AS cluster, CAST(sum(n) AS BIGINT) AS score, arg_max(p_size, n * 1000 + p_size) AS pos FROM g GROUP BY 1, 2)
SELECT * FROM r QUALIFY score >= 0.25 * max(score) OVER (PARTITION BY p_brand)"""
)
def cluster_representative(spark, sf):
    c = t(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return columns.representatives(columns.gap_clusters(c, ["p_brand"], "p_size", 2), ["p_brand"], "cluster", "p_size", "n")


@query("SELECT event_id, CAST(greatest(floor((sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 1) / 2.0), 0) AS INTEGER) AS block, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id) % 2 = 1 AS odd FROM events")
def block_id(spark, sf):
    return rollforward.blocks(t(spark, sf, "events"), ["user_id"], "event_id", F.col("event_type") == "purchase").select("event_id", "block", "odd")


# the rule as a fold over a stack: a value that is not 0 and sums up the last k of the stack, k as large as possible, takes their place
FOLD_SQL = """e AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) % 7 AS DOUBLE) END AS value, event_type = 'purchase' AS is_balance, event_type IN ('signup', 'click') AS named FROM events),
b AS (SELECT *, greatest(floor((sum(is_balance::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 1) / 2.0), 0)::INTEGER AS block FROM e),
g AS (SELECT user_id, block, min(event_id) FILTER (is_balance) AS f, max(event_id) FILTER (is_balance) AS l, count(*) FILTER (is_balance) AS n FROM b GROUP BY 1, 2 HAVING count(*) FILTER (is_balance) >= 2),
m AS (SELECT b.user_id, b.block, coalesce(value, 0) AS x, named, row_number() OVER (PARTITION BY b.user_id, b.block ORDER BY event_id) AS i FROM b JOIN g USING (user_id, block) WHERE event_id > f AND event_id < l AND NOT is_balance),
fold AS (SELECT user_id, block, CAST(0 AS BIGINT) AS i, CAST([] AS DOUBLE[]) AS stack, 0 AS hits, 0 AS hits_named FROM g
  UNION ALL SELECT user_id, block, i, CASE WHEN k IS NOT NULL AND (GUARD) THEN list_append(stack[1:len(stack) - k], x) ELSE list_append(stack, x) END, hits + (k IS NOT NULL)::INT, hits_named + (k IS NOT NULL AND named)::INT
  FROM (SELECT f.user_id, f.block, m.i, f.stack, f.hits, f.hits_named, m.x, m.named, CASE WHEN m.x <> 0 THEN list_max(list_filter(range(1, len(f.stack) + 1), lambda k: abs(list_sum(f.stack[len(f.stack) - k + 1:len(f.stack)]) - m.x) <= 1)) END AS k
    FROM fold f JOIN m ON m.user_id = f.user_id AND m.block = f.block AND m.i = f.i + 1)),
last AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY user_id, block ORDER BY i DESC) = 1),
ends AS (SELECT user_id, block, o.value AS opening, coalesce(list_sum(stack), 0) AS movement, c.value AS closing, hits, hits_named FROM last JOIN g USING (user_id, block) JOIN e o ON o.event_id = f JOIN e c ON c.event_id = l)"""


def _roll(spark, sf):
    kind = F.col("event_type")
    name = F.when(kind == "signup", "รวมสินทรัพย์").when(kind == "click", "กำไรเบ็ดเสร็จรวมสำหรับงวด").otherwise("บริษัทร่วม")  # the last sounds like a total and is none
    e = t(spark, sf, "events").select("user_id", "event_id", F.when(kind != "error", F.floor("value") % 7).cast("double").alias("value"), (kind == "purchase").alias("is_balance"), name.alias("item"))
    return rollforward.blocks(e, ["user_id"], "event_id", F.col("is_balance"))


@query(f"WITH RECURSIVE {FOLD_SQL} SELECT user_id, block, opening, movement, closing, coalesce(opening, 0) + movement - coalesce(closing, 0) AS diff, abs(coalesce(opening, 0) + movement - coalesce(closing, 0)) <= 1 AS ok FROM ends WHERE NOT (opening IS NULL AND closing IS NULL AND movement = 0)".replace("GUARD", "named"))
def roll_forward(spark, sf):
    return rollforward.check(_roll(spark, sf), ["user_id", "block"], "event_id")


@query(f"WITH RECURSIVE {FOLD_SQL} SELECT CAST(coalesce(sum(hits), 0) AS BIGINT) AS hit_all, CAST(coalesce(sum(hits_named), 0) AS BIGINT) AS hit_named FROM ends".replace("GUARD", "true"))
def collapse_audit(spark, sf):
    return rollforward.audit(_roll(spark, sf), ["user_id", "block"], "event_id")


@query(
    """WITH e AS (SELECT user_id, event_id, event_type, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS block FROM events), h AS (SELECT user_id, block, min(event_id) AS f FROM e GROUP BY 1, 2), y AS (SELECT user_id, block, 2400 + f % 5 AS yr FROM h),
p AS (SELECT user_id, block, yr, row_number() OVER (PARTITION BY user_id ORDER BY yr DESC, block DESC) AS period FROM y) SELECT event_id, CAST(period AS INTEGER) AS period, CAST(yr AS INTEGER) AS block_year FROM e JOIN p USING (user_id, block) WHERE period <= 2"""
)
def year_block_pick(spark, sf):
    e = t(spark, sf, "events").withColumn("label", (2400 + F.col("event_id") % 5).cast("string"))
    found = statement.year_blocks(e, ["user_id"], "event_id", "label", F.col("event_type") == "signup")
    return statement.periods(found, ["user_id"]).select("event_id", "period", "block_year")


@query(
    """WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT a.event_id, (SELECT min_by(b.value, b.rn) FROM w b WHERE b.user_id = a.user_id AND b.rn BETWEEN a.rn + 1 AND a.rn + 3 AND b.event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM w c WHERE c.user_id = a.user_id AND c.rn BETWEEN a.rn + 1 AND b.rn AND c.event_type = 'error')) AS next_value FROM w a"""
)
def asof_forward(spark, sf):
    e = t(spark, sf, "events")
    return pages.next_within(e, ["user_id"], "event_id", F.col("event_type") == "purchase", "value", 3, F.col("event_type") == "error", "next_value").select("event_id", "next_value")


@query(
    """WITH a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id) AS m FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, count(*) OVER (PARTITION BY user_id) AS m FROM events WHERE event_type = 'error')
SELECT user_id, event_id, value AS spill FROM a LEFT JOIN b USING (user_id, n, m)"""
)
def positional_spill(spark, sf):
    e = t(spark, sf, "events")
    rows, other = e.filter("event_type = 'purchase'").select("user_id", "event_id"), e.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("o"), "value")
    return statement.attach_spill(rows, other, ["user_id"], "event_id", "o", "value", "spill")


@query(
    """WITH c AS (SELECT o_custkey, o_orderpriority, arg_min(o_totalprice, o_orderkey) AS v FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2), p AS (SELECT o_custkey, o_orderpriority, arg_min(o_totalprice, o_orderkey) AS v FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority, c.v AS current, p.v AS previous FROM c FULL JOIN p USING (o_custkey, o_orderpriority)"""
)
def full_outer_prev_cur(spark, sf):
    o = t(spark, sf, "orders").withColumn("label", F.translate("o_orderpriority", "12345", "กขคงจ"))
    o = select.first_by(o.withColumn("period", (F.col("o_orderkey") % 2 + 1).cast("int")), ["o_custkey", "o_orderpriority", "period"], [F.asc("o_orderkey")])
    return statement.side_by_side(o, ["o_custkey"], "o_orderpriority", "label", "o_totalprice", "o_orderkey").select("o_custkey", "o_orderpriority", "current", "previous")


# --- nearest and range lookups


FIXED = [5, 12, 20, 33, 41]


@query(
    """WITH d AS (SELECT p_partkey, i, least(abs(p_size - c), CASE WHEN p_partkey % 2 = 0 THEN abs(p_size - 1 - c) ELSE 99 END) AS d FROM part, (VALUES (0, 5), (1, 12), (2, 20), (3, 33), (4, 41)) v(i, c))
SELECT p_partkey, CAST(arg_min(i, d * 10 + i) AS INTEGER) AS idx, CAST(min(d) AS INTEGER) AS dist FROM d GROUP BY p_partkey HAVING min(d) <= 4"""
)
def nearest_column(spark, sf):
    """A closing parenthesis may stand behind the column."""
    tok = F.struct(F.lit(0).alias("start"), F.col("p_size").alias("end"), F.when(F.col("p_partkey") % 2 == 0, "(1)").otherwise("1").alias("tok"))
    n = tokens.nearest(tok, F.array(*map(F.lit, FIXED)))
    return t(spark, sf, "part").select("p_partkey", n.alias("n")).select("p_partkey", "n.idx", "n.dist").filter("dist <= 4")


@query(
    """WITH d AS (SELECT p_partkey, i, least(abs(p_size - c), CASE WHEN p_partkey % 2 = 0 THEN abs(p_size - 1 - c) ELSE 99 END) AS d FROM part, (VALUES (0, 5), (1, 12), (2, 20), (3, 33), (4, 41)) v(i, c)),
r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, i) AS r FROM d) SELECT a.p_partkey, CAST(a.i AS INTEGER) AS idx FROM r a JOIN r b USING (p_partkey) WHERE a.r = 1 AND b.r = 2 AND a.d <= least(8.0, b.d / 2.0)"""
)
def adaptive_nearest(spark, sf):
    toks = F.array(F.struct(F.lit(0).alias("start"), F.col("p_size").alias("end"), F.when(F.col("p_partkey") % 2 == 0, "(1)").otherwise("1").alias("tok")))
    hit = tokens.adaptive(toks, F.array(*map(F.lit, FIXED)))
    return t(spark, sf, "part").select("p_partkey", F.explode(hit).alias("h")).select("p_partkey", F.col("h.idx").alias("idx"))


@query("WITH b AS (SELECT col_index, coalesce(lag(pos) OVER (ORDER BY pos) + 4, 0) AS lo, pos + 4 AS hi FROM (VALUES (0, 900), (1, 1200), (2, 1500), (3, 1900)) v(col_index, pos)) SELECT p_brand, col_index, string_agg(p_name, ' ' ORDER BY p_partkey, p_name) AS name FROM part JOIN b ON p_retailprice >= lo AND p_retailprice < hi GROUP BY 1, 2")
def range_header(spark, sf):
    p = t(spark, sf, "part")
    toks = p.select("p_brand", F.col("p_partkey").alias("line_no"), F.col("p_retailprice").alias("start"), F.col("p_retailprice").alias("end"), F.col("p_name").alias("tok"))
    grid = p.select("p_brand").distinct().select("p_brand", F.posexplode(F.array(*map(F.lit, (900, 1200, 1500, 1900)))).alias("col_index", "pos"))
    return columns.header_names(toks, grid, ["p_brand"])


# --- text


@query(f"SELECT doc_id, regexp_replace(text, '[^{LATIN}]', '', 'g') AS skeleton FROM documents")
def skeleton_text(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.skeleton("text", LATIN).alias("skeleton"))


@query("SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents")
def digits_text(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.digits("text").alias("digits"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ' tail' WHEN 1 THEN p_name || ' 4,500' ELSE p_name || '7,5 8' END AS label FROM part")
def clean_label(spark, sf):
    """A digit after a letter goes, and white space beside it; a number behind a space, or before a comma, stays."""
    k = F.col("p_partkey") % 3
    x = F.concat("p_name", F.when(k == 0, "7  tail ").when(k == 1, "  4,500").otherwise("7,5 \t8"))
    return t(spark, sf, "part").select("p_partkey", tx.clean_label(x, "a-z").alias("label"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' - current' END AS label FROM part")
def strip_suffix(spark, sf):
    x = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" - net"))).otherwise(F.concat("p_name", F.lit(" - current")))
    return t(spark, sf, "part").select("p_partkey", tx.strip_suffix(x, ["net"], "a-z").alias("label"))


@query(
    """SELECT p_partkey, trim(regexp_replace(label, '[\\s.]+[0-9]+([.][0-9]+)?(\\s*(,|and)\\s*[0-9]+([.][0-9]+)?)*\\s*$', '')) AS label
FROM (SELECT p_partkey, p_type || CASE p_partkey % 6 WHEN 0 THEN ' 6, 10' WHEN 1 THEN ' 4 and 5.3 ' WHEN 2 THEN '. 7' WHEN 3 THEN '7, 8' WHEN 4 THEN ' 1,234 x' ELSE ' 2 3, ' || p_size END AS label FROM part)"""
)
def strip_note_ref(spark, sf):
    k = F.col("p_partkey") % 6
    tail = F.when(k == 0, " 6, 10").when(k == 1, " 4 and 5.3 ").when(k == 2, ". 7").when(k == 3, "7, 8").when(k == 4, " 1,234 x").otherwise(F.concat(F.lit(" 2 3, "), F.col("p_size").cast("string")))
    return t(spark, sf, "part").select("p_partkey", tx.strip_note_ref(F.concat("p_type", tail), "and").alias("label"))


@query("SELECT p_partkey, p_type || CASE WHEN p_partkey % 2 = 0 THEN ' (loss) rest' ELSE ' rest' END AS label FROM part")
def strip_period(spark, sf):
    x = F.concat("p_type", F.when(F.col("p_partkey") % 2 == 0, " (loss) rest").otherwise(" (31 December 2025: 7) rest"))
    return t(spark, sf, "part").select("p_partkey", tx.strip_period_paren(x, ["december"], "a-z").alias("label"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CASE WHEN l_linenumber = 1 THEN -floor(l_extendedprice) WHEN l_linenumber = 2 THEN NULL ELSE floor(l_extendedprice) END AS value FROM lineitem")
def parse_number(spark, sf):
    n = F.format_number(F.floor("l_extendedprice"), 0)
    tok = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("("), n, F.lit(")"))).when(F.col("l_linenumber") == 2, "-").otherwise(n)
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", tx.to_number(tok).alias("value"))


@query(
    r"""WITH h AS (SELECT doc_id, len(regexp_extract_all(text, '\d{1,3}(,\d{3})+')) >= 1 AS table_, regexp_replace(lower(array_to_string(list_slice(string_split(text, chr(10)), 1, 3), ' ')), '[^a-z]', '', 'g') AS sk FROM documents)
SELECT doc_id, table_, CASE WHEN contains(sk, 'lorem') THEN NULL WHEN contains(sk, 'license') THEN 'license' WHEN contains(sk, 'http') THEN 'link' WHEN contains(sk, 'the') THEN 'text' END AS kind FROM h"""
)
def classify_page(spark, sf):
    kind = tx.page_kind(F.lower("text"), titles=[("license", "license"), ("link", "http"), ("text", "the")], notes="lorem", least=0, lines=3, chars="a-z")
    return t(spark, sf, "documents").select("doc_id", tx.has_table("text", 1).alias("table_"), kind.alias("kind"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'thousand' WHEN 1 THEN 'million' WHEN 2 THEN 'baht' WHEN 3 THEN 'thousand' WHEN 4 THEN 'unknown' WHEN 5 THEN 'million' WHEN 6 THEN 'baht' WHEN 7 THEN 'unknown' ELSE 'unknown' END AS unit,
CASE WHEN o_orderkey % 2 = 0 THEN 'million' ELSE 'baht' END AS first_wins FROM orders"""
)
def detect_unit(spark, sf):
    """Named units before bracketed ones before bare words, whatever else the page says."""
    k = F.col("o_orderkey") % 9
    page = F.when(k == 0, "หน่วย : พันบาท").when(k == 1, "งบ (ล้านบาท)").when(k == 2, "หมายเหตุ   บาท   บาท").when(k == 3, "หน ่ วย：พัน บาท (ล้านบาท)").when(k == 4, "หุ้นละ 5 บาท 5 บาท")
    page = page.when(k == 5, "x\nหมายเหตุ ล้านบาท ล้านบาท").when(k == 6, "（บาท）").when(k == 7, "รวม พันบาท บาท").otherwise(F.concat(F.repeat(F.lit("\n"), 60), F.lit("x บาท บาท")))
    first = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "(พันบาท) หน่วย ล้านบาท").otherwise("พันบาท พันบาท (บาท)"), F.lit("\n"), F.col("o_orderpriority"))
    return t(spark, sf, "orders").select("o_orderkey", tx.detect_unit(page).alias("unit"), tx.detect_unit(first).alias("first_wins"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CASE WHEN d IS NULL AND q IS NULL THEN 'dash_empty' WHEN q <> floor(q) OR d <> floor(d) THEN 'decimal' WHEN q IS NULL OR d IS NULL THEN 'dash_empty' ELSE 'small_num' END AS trap FROM (SELECT *, nullif(l_discount, 0) AS d, CASE WHEN l_quantity > 25 THEN NULL ELSE l_quantity END AS q FROM lineitem)")
def ordered_case_label(spark, sf):
    df = t(spark, sf, "lineitem").withColumn("d", F.nullif("l_discount", F.lit(0.0))).withColumn("q", F.when(F.col("l_quantity") <= 25, F.col("l_quantity")))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", tx.trap("l_returnflag", ["q", "d"]).alias("trap"))


@query("SELECT p_partkey, 'B' || p_brand AS concept, 1.0 AS match_score FROM part")
def exact_alias(spark, sf):
    """Labels whose skeleton is one for all brands and bound to digits."""
    p = t(spark, sf, "part")
    names = p.select("p_brand").distinct().select(F.concat(F.lit("B"), "p_brand").alias("concept"), F.concat(F.lit("กขค "), F.regexp_replace("p_brand", "[^0-9]", "")).alias("alias"), F.col("p_brand").alias("ordinal"))
    labels = p.select("p_partkey", F.concat(F.lit("ก ข.ค "), F.regexp_replace("p_brand", "[^0-9]", "")).alias("label"))
    return matching.match(labels, names, ["p_partkey"]).select("p_partkey", "concept", "match_score")


@query("SELECT p_partkey, CASE WHEN 2.0::DOUBLE * length(p_type) / (2 * length(p_type) + 1) >= 0.9 THEN p_type END AS concept, CAST(2 * length(p_type) AS DOUBLE) / (2 * length(p_type) + 1) AS match_score FROM part")
def fuzzy_alias(spark, sf):
    """Each label is an alias with one letter more, which the ratio is known of."""
    p = t(spark, sf, "part")
    th = lambda c: F.translate(F.lower(c), "abcdefghijklmnopqrstuvwxyz", "กขคฆงจฉชซญฎฏฐฑฒณดตถทธนบปผฝ")
    alias = p.groupBy("p_type").agg(F.min("p_partkey").alias("ordinal")).select(F.col("p_type").alias("concept"), th("p_type").alias("alias"), "ordinal")
    labels = p.select("p_partkey", F.concat(th("p_type"), F.lit("ฮ")).alias("label"))
    return matching.match(labels, alias, ["p_partkey"]).select("p_partkey", "concept", "match_score")


@query("SELECT regexp_replace(p_type, '[^A-Z]', '', 'g') AS skeleton, list_sort(list(DISTINCT p_brand)) AS concepts FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def alias_clash(spark, sf):
    p = t(spark, sf, "part").select(F.regexp_replace("p_type", "[^A-Z]", "").alias("s"), F.col("p_brand").alias("concept"))
    th = F.translate("s", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "กขคฆงจฉชซญฎฏฐฑฒณดตถทธนบปผฝ")
    got = matching.clashes(p.withColumn("alias", th))
    return got.select(F.translate("skeleton", "กขคฆงจฉชซญฎฏฐฑฒณดตถทธนบปผฝ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("skeleton"), "concepts")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'SCB' WHEN page_id % 3 = 1 THEN 'AIS' END AS company FROM pages")
def file_key_regex(spark, sf):
    name = F.concat_ws("/", F.lit("/data/scb"), F.when(F.col("page_id") % 3 == 0, "q1_scb-2025.pdf").when(F.col("page_id") % 3 == 1, "AIS.pdf").otherwise("scbx.pdf"))
    return t(spark, sf, "pages").select("page_id", tx.company_of(name, ["AIS", "SCB"]).alias("company"))


@query(
    """SELECT doc_id, CAST(i - 1 AS INTEGER) AS place, CASE WHEN length(b) > 0 AND 2 * length(regexp_replace(b, '[^0-9]', '', 'g')) >= length(b) AND NOT regexp_matches(w, '[ก-๛]') THEN translate(w, 'OolI|', '00111') ELSE w END AS tok
FROM (SELECT doc_id, i, w, regexp_replace(w, '[(),.\\s-]', '', 'g') AS b FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents))"""
)
def normalise_digits(spark, sf):
    words = t(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("place", "w"))
    return words.select("doc_id", "place", tx.normalise_digits("w").alias("tok"))


@query("SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'TRUE' ELSE trim(n_name) END AS company FROM nation")
def company_name(spark, sf):
    x = F.when(F.col("n_nationkey") % 2 == 0, F.lit(True).cast("string")).otherwise(F.concat(F.lit("  "), "n_name", F.lit(" ")))
    return t(spark, sf, "nation").select("n_nationkey", "n_name", tx.company_name(x).alias("company"))


@query("SELECT p_partkey, CAST(2 * length(p_name) AS DOUBLE) / (2 * length(p_name) + p_size) AS ratio, 0.0::DOUBLE AS none FROM part")
def similarity_ratio(spark, sf):
    """A name and the same with some letters behind it, which the ratio is known of; tests hold others against the published function."""
    longer = F.concat("p_name", F.repeat(F.lit("~"), F.col("p_size")))
    return t(spark, sf, "part").select("p_partkey", similarity.ratio("p_name", longer).alias("ratio"), similarity.ratio("p_name", F.lit("~")).alias("none"))


@query(
    """WITH r AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS INTEGER) AS line_no, 'item ' || l_partkey AS label, floor(l_extendedprice) AS a, CASE WHEN l_linenumber % 3 = 0 THEN -floor(l_quantity) WHEN l_linenumber % 3 = 1 THEN floor(l_quantity) END AS b FROM lineitem),
y AS (SELECT *, b IS NULL AND (a BETWEEN 2400 AND 2700 OR a BETWEEN 1990 AND 2100) AS years FROM r) SELECT l_orderkey, line_no, CASE WHEN NOT years THEN label END AS label, CASE WHEN NOT years THEN a END AS a, b FROM y"""
)
def layout_lines(spark, sf):
    """Lines of generated layout pages as labels and cells: numbers, numbers in parentheses and dashes; a line of years only is no data."""
    li = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))).alias("r"))
    amount = lambda x: F.format_number(F.floor(x["l_quantity"]), 0)
    cell = lambda x: F.when(x["l_linenumber"] % 3 == 0, F.concat(F.lit("("), amount(x), F.lit(")"))).when(x["l_linenumber"] % 3 == 1, amount(x)).otherwise("-")
    line = lambda x: F.concat(F.rpad(F.concat(F.lit("item "), x["l_partkey"].cast("string")), 30, " "), F.lpad(F.format_number(F.floor(x["l_extendedprice"]), 0), 12, " "), F.lpad(cell(x), 12, " "))
    pg = li.select("l_orderkey", F.array_join(F.transform("r", line), "\n").alias("text"))
    lines = columns.with_tokens(pages.lines(pg))
    return lines.select("l_orderkey", "line_no", tokens.parsed("line", "toks", F.array(F.lit(42), F.lit(54))).alias("p")).select("l_orderkey", "line_no", "p.label", F.get("p.values", F.lit(0)).alias("a"), F.get("p.values", F.lit(1)).alias("b"))


from tabulon import catalog_layout  # noqa: E402, F401 - registers the queries over generated pages and labels
