"""Queries over pages, labels and tables that are made of the fixture tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import similarity, tokens
from tabulon.functions import text as tx
from tabulon.operators import columns, equations, matching, ocr, pages, quality, reports, rollforward, select, statement
from tabulon.plans import extract
from tabulon.registry import query, t
from tabulon.session import work_path
from tabulon.sources import layout, tables

LATIN, THAI = "abcdefghijklmnopqrstuvwxyz", "กขคฆงจฉชซญฎฏฐฑฒณดตถทธนบปผฝ"
TH_SQL = f"translate(lower({{}}), '{LATIN}', '{THAI}')"


def th(c) -> Column:
    """Latin letters as consonants."""
    return F.translate(F.lower(c), LATIN, THAI)


def case(c: Column, *values) -> Column:
    """values[i] where c is i, the last one elsewhere."""
    out = None
    for i, v in enumerate(values[:-1]):
        out = F.when(c == i, v) if out is None else out.when(c == i, v)
    return out.otherwise(values[-1])


# --- pages


PAGES_SQL = "p AS (SELECT 's' || doc_id % 60 AS source, CAST(doc_id // 60 + 1 AS INTEGER) AS page, lower(text) AS text FROM documents)"


def _pages(spark, sf) -> DataFrame:
    return t(spark, sf, "documents").select(F.concat(F.lit("s"), F.col("doc_id") % 60).alias("source"), (F.floor(F.col("doc_id") / 60) + 1).cast("int").alias("page"), F.lower("text").alias("text"))


KINDS_SQL = f"""{PAGES_SQL}, h AS (SELECT source, page, regexp_replace(array_to_string(string_split(text, chr(10))[1:2], chr(10)), '[^a-z]', '', 'g') AS sk, regexp_replace(text, '[^a-z]', '', 'g') AS body FROM p WHERE page <= 20),
s AS (SELECT *, CASE WHEN contains(sk, 'lorem') THEN NULL WHEN contains(sk, 'license') THEN 'A' WHEN contains(sk, 'thatthe') THEN 'B' END AS strict FROM h),
k AS (SELECT source, page, CASE WHEN max(strict) OVER (PARTITION BY source) IS NULL THEN CASE WHEN NOT contains(sk, 'lorem') AND contains(body, 'tion') THEN 'BS' END ELSE strict END AS kind FROM s)"""


def _kinds(spark, sf) -> DataFrame:
    return pages.classify(_pages(spark, sf), 20, titles=[("A", "license"), ("B", "that the")], notes="lorem", loose=["tion"], least=0, lines=2, chars="a-z")


@query(f"WITH {KINDS_SQL} SELECT source, page, kind FROM k")
def classify_fallback(spark, sf):
    """Sources without any title are judged by their bodies; pages beyond the limit are not looked at."""
    return _kinds(spark, sf).select("source", "page", "kind")


@query(f"WITH {KINDS_SQL} SELECT source, page, kind FROM k WHERE kind IN ('B', 'BS')")
def statement_filter(spark, sf):
    return pages.of_statements(_kinds(spark, sf), ["B", "BS"]).select("source", "page", "kind")


@query(f"WITH {PAGES_SQL}, b AS (SELECT *, min(CASE WHEN page % 7 = 4 AND source > 's3' THEN page END) OVER (PARTITION BY source) AS b FROM p) SELECT source, page FROM b WHERE b IS NULL OR page < b")
def until_blank(spark, sf):
    p = _pages(spark, sf)
    blank = (F.col("page") % 7 == 4) & (F.col("source") > "s3")
    return pages.until_blank(p.withColumn("text", F.when(blank, " \n ").otherwise(F.col("text")))).select("source", "page")


@query(f"WITH {PAGES_SQL} SELECT source, coalesce(sum(CASE WHEN page <= 2 THEN length(regexp_replace(text, '[^a-z]', '', 'g')) END), 0) < 3000 AS scanned FROM p GROUP BY 1")
def scanned_sources(spark, sf):
    return pages.scanned(_pages(spark, sf), 3000, 2, "a-z")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'")
def strict_pages(spark, sf):
    how = F.when(F.col("o_orderpriority") == "2-HIGH", "title").when(F.col("o_orderpriority") == "5-LOW", "alike 0.80")
    return pages.by_title_only(t(spark, sf, "orders").withColumn("page_how", how)).select("o_orderkey")


@query(
    f"""WITH {PAGES_SQL}, s AS (SELECT source, page, CASE WHEN (page + length(source)) % 3 = 0 AND source LIKE '%1%' THEN 'con' WHEN source LIKE '%1%' OR source LIKE '%2' AND page > 1 THEN 'sep' END AS s FROM p),
w AS (SELECT *, bool_and(s IS NOT NULL) OVER (PARTITION BY source) AND count(DISTINCT s) OVER (PARTITION BY source) = 2 OR count(*) OVER (PARTITION BY source) = 1 AS ok, row_number() OVER (PARTITION BY source ORDER BY page) AS n FROM s)
SELECT source, page, CASE WHEN ok THEN s WHEN n = 1 THEN 'con' ELSE 'sep' END AS side FROM w"""
)
def page_sides(spark, sf):
    """Titles are believed where every page of a source has one and both sides occur; a page with both marks is a separate one."""
    one, two = F.col("source").contains("1"), F.col("source").endswith("2") & (F.col("page") > 1)
    con = ((F.col("page") + F.length("source")) % 3 == 0) & one
    mark = F.when(con, "งบการเงินรวม\n").when(one | two, "งบการเงินรวม และงบเฉพาะกิจการ\n").otherwise("\n" * 16 + "งบเฉพาะกิจการ\n")
    return pages.sides(_pages(spark, sf).withColumn("text", F.concat(mark, "text"))).select("source", "page", "side")


@query(
    """WITH w AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page, event_type FROM events)
SELECT a.user_id, a.event_id, (SELECT (min(b.event_id) + 1000) || ',-2000,3000' FROM w b WHERE b.user_id = a.user_id AND b.page BETWEEN a.page + 1 AND a.page + 3 AND b.event_type = 'purchase'
  AND NOT EXISTS (SELECT 1 FROM w c WHERE c.user_id = a.user_id AND c.page BETWEEN a.page + 1 AND b.page AND c.event_type = 'error') HAVING count(*) > 0) AS spill FROM w a"""
)
def spill_pages(spark, sf):
    """Values of a column that went to one of the next three pages, before any page with a statement; page numbers and dashes aside."""
    e = t(spark, sf, "events")
    column = F.concat(F.lit("รวม\n"), F.format_number(F.col("event_id") + 1000, 0), F.lit("\n (2,000)\n -\n3,000\n 17"))
    p = e.select("user_id", "event_id", F.col("event_id").alias("page"), F.when(F.col("event_type") == "purchase", column).otherwise("ข้อความ 1,000").alias("text"), F.when(F.col("event_type") == "error", "BS").alias("kind"))
    return pages.spills(p, by=["user_id"]).select("user_id", "event_id", F.array_join(F.col("spill").cast("array<bigint>"), ",").alias("spill"))


@query(
    """SELECT o_custkey, CASE WHEN count(*) + 2 <= 24 AND count(*) FILTER (o_orderstatus <> 'P') >= 3 THEN string_agg(CAST(floor(o_totalprice) AS BIGINT), ',' ORDER BY o_orderkey) FILTER (o_orderstatus <> 'P') END AS spill FROM orders GROUP BY 1"""
)
def spilled_values(spark, sf):
    line = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    page = t(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("x")))), lambda r: r["x"]), "\n").alias("x"))
    return page.select("o_custkey", F.array_join(tokens.spill_values(F.concat(F.lit("  รวมส่วนของ\n\n"), "x", F.lit("\n 6 "))).cast("array<bigint>"), ",").alias("spill"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'BS' WHEN 3 THEN 'CF' WHEN 4 THEN 'CF' WHEN 6 THEN 'IS' END AS kind,
CASE o_orderkey % 7 WHEN 0 THEN 'title' WHEN 1 THEN 'none' WHEN 2 THEN 'notes' WHEN 3 THEN 'content' WHEN 4 THEN 'alike 0.94' WHEN 5 THEN 'none' ELSE 'content' END AS how FROM orders"""
)
def ocr_page_kind(spark, sf):
    """Title, table, notes, likeness of the title, words of the body, in this order."""
    k = F.col("o_orderkey") % 7
    table = F.repeat(F.lit("\n1,234 5,678"), 8)
    head = case(k, "งบฐานะการเงิน", "เงินสดสุทธิใช้ไปใน", "หมายเหตุประกอบ เงินสดสุทธิใช้ไปใน", "ข้อความ", "งบกระแสเงินส", "ข้อความ", "ข้อความ")
    body = case(k, "", "", "", "เงินสดสุทธิใช้ไปใน กำไรต่อหุ้น", "กำไรต่อหุ้น", "", "กำไรต่อหุ้น รวมหนี้สิน")
    page = F.concat(head, F.repeat(F.lit("\n"), 12), body, F.when(k == 1, "").otherwise(table))
    return t(spark, sf, "orders").select("o_orderkey", similarity.page_kind_alike(page).alias("p")).select("o_orderkey", "p.kind", "p.how")


@query("SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'h' || o_custkey ELSE '?' END AS page_how FROM orders")
def page_origin(spark, sf):
    """How the first of a row's pages was read."""
    rows = t(spark, sf, "orders").select("o_orderkey", F.lit("x").alias("source"), F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("page"))
    read = t(spark, sf, "orders").select("o_custkey").distinct().filter("o_custkey % 2 = 0").select(F.lit("x").alias("source"), F.col("o_custkey").cast("string").alias("page"), F.concat(F.lit("h"), "o_custkey").alias("page_how"))
    return statement.page_how(rows, read).select("o_orderkey", "page_how")


@query(
    """SELECT l_orderkey, string_agg(CASE WHEN n % 5 = 4 THEN 'item' ELSE rpad('item', 20, ' ') || CAST(l_quantity AS INTEGER) || CASE WHEN l_quantity >= 10 THEN '.10' ELSE '.lO' END END, chr(10) ORDER BY n) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS n FROM lineitem) GROUP BY 1"""
)
def ocr_layout(spark, sf):
    """Word boxes to lines: what was read badly goes, letters in numbers become digits, words stand at their columns, pieces that touch are joined."""
    li = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))).alias("r"))
    rows = li.select("l_orderkey", F.posexplode("r").alias("n", "x")).withColumn("n", F.col("n") + 1)
    number = F.concat(F.col("x.l_quantity").cast("int").cast("string"), F.lit(".lO"))
    conf = F.when(F.col("n") % 5 == 4, 10.0).otherwise(90.0)
    word = lambda text, x, dy, w, c: F.struct(text.alias("text"), F.lit(x).alias("x"), (F.col("n") * 40 + dy).cast("int").alias("y"), w.cast("int").alias("w"), c.alias("conf"))
    boxes = F.array(word(F.lit("it"), 0, 0, F.lit(20), F.lit(95.0)), word(F.lit("em"), 22, 2, F.lit(20), F.lit(95.0)), word(number, 200, 3, F.length(number) * 10, conf))
    found = rows.select(F.col("l_orderkey").cast("string").alias("source"), F.lit(1).alias("page"), F.explode(boxes).alias("b")).select("source", "page", "b.*", F.lit(10).alias("h"))
    return ocr.layout(found).select(F.col("source").cast("long").alias("l_orderkey"), "text")


# --- lines and columns


TABLE_SQL = "r AS (SELECT l_orderkey, 5 + length(CAST(l_partkey AS VARCHAR)) AS e, floor(l_extendedprice) AS price, floor(l_quantity) AS qty FROM lineitem)"


def _table(spark, sf) -> DataFrame:
    """Lines of layout text by order: a label with a number in it, and two columns of numbers that end at 42 and 54."""
    li = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))).alias("r"))
    number = lambda c: F.lpad(F.format_number(F.floor(c), 0), 12, " ")
    line = lambda x: F.concat(F.rpad(F.concat(F.lit("item "), x["l_partkey"].cast("string")), 30, " "), number(x["l_extendedprice"]), number(x["l_quantity"]))
    return columns.with_tokens(pages.lines(li.select("l_orderkey", F.array_join(F.transform("r", line), "\n").alias("text"))))


@query(
    f"""WITH {TABLE_SQL}, c AS (SELECT l_orderkey, pos, count(*) AS n FROM (SELECT l_orderkey, unnest([e, 42, 54]) AS pos FROM r) GROUP BY 1, 2 HAVING count(*) >= 3),
g AS (SELECT *, sum((d > 6)::INT) OVER (PARTITION BY l_orderkey ORDER BY pos) AS g FROM (SELECT *, coalesce(pos - lag(pos) OVER (PARTITION BY l_orderkey ORDER BY pos), 0) AS d FROM c)),
s AS (SELECT l_orderkey, g, sum(n) AS score, arg_max(pos, n * 100 + pos) AS pos FROM g GROUP BY 1, 2), k AS (SELECT * FROM s QUALIFY score >= 0.25 * max(score) OVER (PARTITION BY l_orderkey))
SELECT l_orderkey, list(CAST(pos AS INTEGER) ORDER BY pos) AS columns FROM k GROUP BY 1"""
)
def column_ends(spark, sf):
    """Where cells end three times or more, clustered, each cluster by its busiest place."""
    return columns.find_columns(_table(spark, sf), ["l_orderkey"])


@query(
    f"""WITH {TABLE_SQL} SELECT l_orderkey, [round(avg((price >= 1000)::INT::DOUBLE), 9), 0.0] AS comma_shares, round(avg((price < 100)::INT::DOUBLE), 9) AS short_share FROM r GROUP BY 1"""
)
def column_shares(spark, sf):
    lines = _table(spark, sf)
    fixed = lines.select("l_orderkey").distinct().withColumn("columns", F.array(F.lit(42), F.lit(54)))
    got = columns.column_stats(lines, fixed, ["l_orderkey"])
    return got.select("l_orderkey", F.transform("comma_shares", lambda x: F.round(x, 9)).alias("comma_shares"), F.round("short_share", 9).alias("short_share"))


@query(
    """WITH c AS (SELECT p_partkey, list_transform(range(1, p_size % 8 + 2), lambda i: CAST(i * 10 AS INTEGER)) AS cols, list_transform(range(1, p_size % 8 + 2), lambda i: (i * p_partkey % 10) / 10.0) AS shares, p_partkey % 10 >= 7 AS short FROM part),
m AS (SELECT *, list_transform(list_filter(range(1, len(cols) + 1), lambda i: shares[i] >= 0.4), lambda i: cols[i]) AS money FROM c),
s AS (SELECT *, CASE WHEN len(money) >= 2 THEN money WHEN short THEN cols[2:] ELSE cols END AS kept FROM m)
SELECT p_partkey, CASE WHEN len(cols) <= 4 THEN cols WHEN len(kept) <= 4 THEN kept WHEN len(kept) % 2 = 1 THEN kept[len(kept) - 3:] ELSE [kept[1], kept[len(kept) // 2], kept[len(kept) // 2 + 1], kept[len(kept)]] END AS columns FROM s"""
)
def value_columns(spark, sf):
    i = F.sequence(F.lit(1), F.col("p_size") % 8 + 1)
    cols, shares = F.transform(i, lambda x: x * 10), F.transform(i, lambda x: (x * F.col("p_partkey") % 10) / 10.0)
    return t(spark, sf, "part").select("p_partkey", tokens.value_columns(cols, shares, (F.col("p_partkey") % 10) / 10.0).cast("array<int>").alias("columns"))


@query("SELECT p_partkey, p_size % 3 = 0 AS years, p_size % 3 = 0 AND p_size % 2 = 0 AS thai_years FROM part")
def year_rows(spark, sf):
    """A row of years is a header: of either calendar, or Thai ones only; a day of the month is no year."""
    v = F.array(F.when(F.col("p_size") % 3 == 0, 2500 + F.col("p_size")).otherwise(F.col("p_size")), F.when(F.col("p_size") % 2 == 0, F.lit(None).cast("int")).otherwise(F.lit(2020)))
    v = F.transform(v, lambda x: x.cast("double"))
    return t(spark, sf, "part").select("p_partkey", tokens.is_years(v).alias("years"), tokens.is_years(v, western=False).alias("thai_years"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CASE WHEN l_linenumber % 4 < 3 THEN 'item ' || l_partkey || ' ' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) END AS label, CASE WHEN l_linenumber % 4 < 3 THEN floor(l_quantity) END AS value FROM lineitem"""
)
def total_column(spark, sf):
    """The rightmost column, or, where nothing ends there, the line's last number not too far from it."""
    number = lambda c: F.lpad(F.format_number(F.floor(c), 0), 12, " ")
    line = F.concat(F.rpad(F.concat(F.lit("item "), F.col("l_partkey").cast("string")), 30, " "), number("l_extendedprice"), number("l_quantity"))
    df = t(spark, sf, "lineitem").withColumn("line", line).withColumn("toks", tokens.tokens("line"))
    p = tokens.parsed_total("line", "toks", F.array(F.lit(20), F.lit(54) + (F.col("l_linenumber") % 4) * 6))
    return df.withColumn("p", p).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "p.label", F.get("p.values", F.lit(0)).alias("value"))


@query(
    """WITH c AS (SELECT user_id, event_id % 9 AS idx, CASE WHEN event_type <> 'error' THEN CASE WHEN event_id % 9 < 4 THEN CASE event_id % 3 WHEN 0 THEN 2400 + event_id % 300 ELSE 1 + event_id % (28 + user_id % 6) END ELSE floor(value) END END AS v FROM events),
k AS (SELECT user_id, idx, coalesce(bool_and(v BETWEEN 1 AND 31 OR v BETWEEN 2400 AND 2700), false) AS d FROM c GROUP BY 1, 2),
l AS (SELECT *, bool_and(d) OVER (PARTITION BY user_id ORDER BY idx) AND row_number() OVER (PARTITION BY user_id ORDER BY idx) <= count(*) OVER (PARTITION BY user_id) - 3 AS lead FROM k) SELECT user_id, idx FROM l WHERE NOT lead"""
)
def date_columns(spark, sf):
    """Columns of days and years at the left go, as long as three columns stay; one without values is no column of dates."""
    i, e = F.col("event_id"), t(spark, sf, "events")
    v = F.when(i % 9 < 4, F.when(i % 3 == 0, 2400 + i % 300).otherwise(1 + i % (28 + F.col("user_id") % 6)).cast("double")).otherwise(F.floor("value").cast("double"))
    cells = e.select("user_id", (i % 9).alias("idx"), F.when(F.col("event_type") != "error", v).alias("v"))
    return columns.strip_dates(cells, ["user_id"], "idx", "v").select("user_id", "idx").distinct()


MERGED_SQL = """n AS (SELECT user_id, event_id % 5 AS idx, 10 + (event_id % 5) * (7 + user_id % 9) AS pos, list(DISTINCT event_id % 20) AS lines FROM events GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS i FROM n),
f AS (SELECT user_id, i, [{'pos': pos, 'lines': lines}] AS acc FROM o WHERE i = 1 UNION ALL
  SELECT f.user_id, o.i, CASE WHEN o.pos - acc[-1].pos > 12 OR list_has_any(o.lines, acc[-1].lines) THEN list_append(acc, {'pos': o.pos, 'lines': o.lines}) WHEN len(o.lines) > len(acc[-1].lines) THEN list_append(acc[1:len(acc) - 1], {'pos': o.pos, 'lines': o.lines}) ELSE acc END
  FROM f JOIN o ON o.user_id = f.user_id AND o.i = f.i + 1)"""


@query(f"WITH RECURSIVE {MERGED_SQL} SELECT user_id, list_transform(acc, lambda x: CAST(x.pos AS BIGINT)) AS columns FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1")
def merge_columns(spark, sf):
    """Neighbouring columns that never share a line become the busier one."""
    i = F.col("event_id")
    per = t(spark, sf, "events").groupBy("user_id", (10 + (i % 5) * (7 + F.col("user_id") % 9)).alias("pos")).agg(F.collect_set(i % 20).alias("lines"))
    c = per.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("pos", "lines"))).alias("c"))
    return c.select("user_id", F.transform(columns.merge_adjacent(F.col("c")), lambda x: x["pos"]).alias("columns"))


@query(
    """WITH g AS (SELECT *, p_partkey % 20 AS line_no, p_partkey AS s, p_size * 2 AS e FROM part WHERE p_partkey % 20 < 14 AND p_partkey % 20 >= 4),
d AS (SELECT p_brand, line_no, s, e, p_name, i, c, row_number() OVER (PARTITION BY p_brand, line_no, s ORDER BY abs(e - c), i) AS r FROM g, (VALUES (0, 20), (1, 50), (2, 85)) v(i, c))
SELECT p_brand, CAST(i AS INTEGER) AS col_index, string_agg(p_name, ' ' ORDER BY line_no, s, p_name) AS name FROM d WHERE r = 1 AND abs(e - c) <= 14 GROUP BY 1, 2"""
)
def header_groups(spark, sf):
    """Words of the ten lines above the data, each to the column whose right edge is nearest."""
    p = t(spark, sf, "part")
    groups = p.select("p_brand", (F.col("p_partkey") % 20).alias("line_no"), F.col("p_partkey").alias("start"), (F.col("p_size") * 2).alias("end"), F.col("p_name").alias("tok"), F.lit(14).alias("first_data"))
    grid = p.select("p_brand").distinct().select("p_brand", F.posexplode(F.array(*map(F.lit, (20, 50, 85)))).alias("col_index", "pos"))
    return columns.header_nearest(groups, grid, ["p_brand"])


@query(
    """WITH e AS (SELECT user_id, event_id, event_type, event_type IN ('purchase', 'view') AS has, min(CASE WHEN event_type IN ('purchase', 'view') THEN event_id END) OVER (PARTITION BY user_id) AS f,
  CASE event_type WHEN 'click' THEN 'กข ' || event_id WHEN 'view' THEN 'ฉช' WHEN 'error' THEN 'งจ ' || event_id ELSE '' END AS label FROM events),
g AS (SELECT *, coalesce(sum(has::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ep FROM e),
l AS (SELECT *, list(label) FILTER (NOT has AND label <> '' AND event_id >= f) OVER (PARTITION BY user_id, ep ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pre FROM g)
SELECT event_id, CASE WHEN label = '' AND len(pre) > 0 THEN array_to_string(pre[greatest(len(pre) - 1, 1):], ' ') ELSE label END AS item FROM l WHERE has"""
)
def continued_labels(spark, sf):
    """A row without a label takes the two lines with letters before it, not across a row with values nor from above the data."""
    kind, e = F.col("event_type"), t(spark, sf, "events")
    n = F.col("event_id").cast("string")
    label = F.when(kind == "click", F.concat(F.lit("กข "), n)).when(kind == "view", "ฉช").when(kind == "error", F.concat(F.lit("งจ "), n)).otherwise("")
    from pyspark.sql import Window

    has = kind.isin("purchase", "view")
    first = F.min(F.when(has, F.col("event_id"))).over(Window.partitionBy("user_id"))
    return pages.continued(e.withColumn("label", label).withColumn("f", first), ["user_id"], "event_id", "label", has, "f").filter(has).select("event_id", "item")


# --- labels


LABELS_SQL = "l AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'ก 12' WHEN 2 THEN 'กิข' WHEN 3 THEN 'กขค' ELSE p_name END AS label, p_partkey % 3 = 0 AS pre FROM part)"


def _labels(spark, sf) -> DataFrame:
    label = case(F.col("p_partkey") % 5, "", "ก 12", "กิข", "กขค", F.col("p_name"))
    pre = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return t(spark, sf, "part").select("p_partkey", label.alias("label"), pre.alias("prefixes"))


@query(f"WITH {LABELS_SQL} SELECT p_partkey FROM l WHERE regexp_matches(label, '[ก-ฮ]') OR pre")
def unnamed_rows(spark, sf):
    return pages.with_label(_labels(spark, sf)).select("p_partkey")


@query(f"WITH {LABELS_SQL} SELECT p_partkey FROM l WHERE length(regexp_replace(label, '[^ก-ฮ]', '', 'g')) >= 3")
def short_labels(spark, sf):
    return pages.long_enough(_labels(spark, sf), "label").select("p_partkey")


@query(f"WITH {LABELS_SQL} SELECT p_partkey, length(regexp_replace(label, '[^ก-ฮ]', '', 'g')) >= 2 AS starts FROM l")
def label_starts(spark, sf):
    return _labels(spark, sf).select("p_partkey", pages.starts_label("label").alias("starts"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority IN ('2-HIGH', '5-LOW') THEN NULL ELSE o_orderpriority END AS concept, CASE o_orderpriority WHEN '1-URGENT' THEN 'SE_DIVIDEND_DECLARED' ELSE o_orderpriority END AS remapped FROM orders")
def equity_concepts(spark, sf):
    """Concepts of cash flows go on other statements; one means another on statements of equity."""
    o = t(spark, sf, "orders").withColumn("kind", F.when(F.col("o_orderstatus") == "F", "CF").otherwise("BS"))
    given = {"2-HIGH": "CASH_END", "5-LOW": "CF_INVESTING", "1-URGENT": "DIVIDEND_PAYABLE"}
    back = F.create_map(*(F.lit(x) for k, v in given.items() if k != "1-URGENT" for x in (v, k)), F.lit("DIVIDEND_PAYABLE"), F.lit("1-URGENT"))
    table = F.create_map(*(F.lit(x) for kv in given.items() for x in kv))
    o = o.withColumn("concept", F.coalesce(table[F.col("o_orderpriority")], "o_orderpriority"))
    named = lambda c: F.coalesce(back[c], c)
    return o.select("o_orderkey", named(statement.cash_flow_only("kind", "concept")).alias("concept"), named(statement.remapped("concept")).alias("remapped"))


@query("SELECT p_partkey, p_partkey % 5 IN (0, 1) AS balance FROM part")
def balance_rows(spark, sf):
    label = case(F.col("p_partkey") % 5, F.concat(F.lit("ยอดคงเหลือ ณ วันที่ "), F.col("p_size").cast("string")), "ยอ ดย กมา 1", "รวมยอดคงเหลือ", "กำไร", F.col("p_name"))
    return t(spark, sf, "part").select("p_partkey", rollforward.is_balance(label).alias("balance"))


@query(
    f"""SELECT regexp_replace({TH_SQL.format("p_type")}, '[^ก-ฮ]', '', 'g') AS skeleton, arg_min(p_brand, p_partkey) FILTER (p_partkey % 5 <> 0 OR p_size < 0) AS concept, CAST(count(DISTINCT p_size) FILTER (p_partkey % 5 = 0) AS INTEGER) AS n_bound,
arg_min(p_brand, p_partkey) FILTER (p_partkey % 5 = 0 AND p_size = 7) AS bound_to_7 FROM part GROUP BY 1"""
)
def alias_dictionary(spark, sf):
    """The first concept of each skeleton without digits, and of each with its digits."""
    p = t(spark, sf, "part")
    alias = p.select(F.col("p_brand").alias("concept"), F.concat(th("p_type"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise("")).alias("alias"), F.col("p_partkey").alias("ordinal"))
    return matching.dictionary(alias).select("skeleton", "concept", F.coalesce(F.size("by_digits"), F.lit(0)).alias("n_bound"), F.col("by_digits")["7"].alias("bound_to_7"))


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'PLAIN' WHEN 1 THEN NULL WHEN 2 THEN 'FIVE' END AS concept, CASE WHEN p_partkey % 4 IN (0, 2) THEN 1.0 ELSE 0.0 END AS match_score FROM part"""
)
def bound_labels(spark, sf):
    """A skeleton that some alias binds to digits needs them: without or with others it has no concept, not even by likeness."""
    alias = spark.createDataFrame([("PLAIN", "ฮฮฮฮ", 0), ("BARE", "กขค", 1), ("FIVE", "กขค 5", 2)], "concept string, alias string, ordinal int")
    labels = t(spark, sf, "part").select("p_partkey", case(F.col("p_partkey") % 4, "ฮฮ ฮฮ 3", "ก ข ค", "กขค (5)", "กขค 6").alias("label"))
    return matching.match(labels, alias, ["p_partkey"]).select("p_partkey", "concept", "match_score")


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN {TH_SQL.format('p_name')} ELSE {TH_SQL.format('p_type')} END AS canonical FROM part")
def canonical_names(spark, sf):
    p = t(spark, sf, "part")
    alias = p.groupBy("p_type").agg(F.min("p_partkey").alias("ordinal")).select(th("p_type").alias("alias"), "ordinal")
    items = p.select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, th("p_name")).otherwise(F.concat(th("p_type"), F.lit("ะ 7"))).alias("item"))
    return matching.canonical(items, alias).select("p_partkey", "canonical")


@query("SELECT p_partkey, CASE WHEN p_name IN ('red widget', 'hot gear', 'blue bolt') THEN p_name END AS section FROM part")
def section_headers(spark, sf):
    """A line is a header if all of its letters are those of a section."""
    return t(spark, sf, "part").select("p_partkey", pages.section_of(F.concat(F.lit(" "), "p_name", F.lit(" : 12")), ["red widget", "hot gear", "blue bolt"], "a-z").alias("section"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'S:' ELSE 'A:' END || p_type AS concept FROM part")
def truth_lookup(spark, sf):
    """Items keyed by hand: with their section first, a blank one aside."""
    p = t(spark, sf, "part")
    one = p.groupBy("p_type").agg(F.min("p_partkey").alias("ordinal"))
    alias = one.select(F.concat(F.lit("A:"), "p_type").alias("concept"), th("p_type").alias("alias"), "ordinal").union(one.select(F.concat(F.lit("S:"), "p_type"), F.concat(F.lit("ฮฮ "), th("p_type")), "ordinal"))
    truth = p.select("p_partkey", th("p_type").alias("item"), case(F.col("p_partkey") % 3, "ฮ.ฮ", "  ", F.lit(None).cast("string")).alias("section"))
    return matching.truth_concepts(truth, alias, ["p_partkey"]).select("p_partkey", "concept")


@query(
    """WITH x AS (SELECT p_partkey, p_partkey % 4 AS k, p_partkey % 2 = 0 AS s FROM part), l AS (SELECT *, 'กก - สุทธิ' AS l, ['ขข', 'คค', 'งง'][1:k] AS pre FROM x),
j AS (SELECT *, list_concat(CASE WHEN k = 3 THEN ['ขข คค งง ' || l] ELSE [] END, CASE WHEN k >= 2 THEN [pre[k - 1] || ' ' || pre[k] || ' ' || l] ELSE [] END, list_transform(list_reverse(pre), lambda p: p || ' ' || l), [l]) AS joins FROM l)
SELECT p_partkey, array_to_string(list_concat(CASE WHEN s THEN list_transform(joins, lambda j: 'จจ ' || j) ELSE [] END, flatten(list_transform(joins, lambda j: [j, replace(j, ' - สุทธิ', '')]))), '|') AS forms FROM j"""
)
def label_forms(spark, sf):
    """Forms of a label from the most to the least specific, each once."""
    k = F.col("p_partkey") % 4
    pre = F.slice(F.array(F.lit("ขข"), F.lit("คค"), F.lit("งง")), F.lit(1), k.cast("int"))
    section = F.when(F.col("p_partkey") % 2 == 0, "จจ")
    return t(spark, sf, "part").select("p_partkey", F.array_join(tx.label_candidates(F.lit(" กก  - สุทธิ"), pre, section), "|").alias("forms"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 2 THEN p_name || ' 2568' WHEN 4 THEN p_name || '-x' WHEN 5 THEN '- 5' ELSE p_name END AS label FROM part")
def component_labels(spark, sf):
    """A label ends before the first number with commas or lone dash; a year, or a dash within words, does not end it."""
    tail = case(F.col("p_partkey") % 6, " 1,234 x", "  -  5 1,000", " 2568 (2,000) -", " (1,000,000)", "-x", "")
    label = F.when(F.col("p_partkey") % 6 == 5, "- 5").otherwise(F.concat(F.lit(" "), "p_name", tail))
    return t(spark, sf, "part").select("p_partkey", tx.component_label(label).alias("label"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' ' || (2500 + p_size) WHEN 1 THEN p_name || ' 2499' ELSE p_name END AS label FROM part")
def reattached_years(spark, sf):
    """The first year of a label comes back, unless one is left; longer numbers are no years."""
    year = (2500 + F.col("p_size")).cast("string")
    label = case(F.col("p_partkey") % 4, F.concat("p_name", F.lit(" "), year, F.lit(" (2599) 3")), F.concat("p_name", F.lit(" "), year), F.concat("p_name", F.lit(" 12568")), F.col("p_name"))
    short = F.when(F.col("p_partkey") % 4 == 1, F.concat("p_name", F.lit(" 2499"))).otherwise(F.col("p_name"))
    return t(spark, sf, "part").select("p_partkey", tx.reattach_year(label, short).alias("label"))


@query("SELECT o_orderkey, CAST(round_even((o_orderkey % 64) / 16.0, 3) AS DOUBLE) AS score FROM orders")
def rounded_scores(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", tx.rounded((F.col("o_orderkey") % 64) / 16.0).alias("score"))


@query("SELECT o_custkey, '  ' || 'C' || o_custkey || ' [con_cur] balance: ' || format('{:,}', CAST(sum(floor(o_totalprice)) AS BIGINT)) || ' != ' || format('{:,}', CAST(sum(floor(o_totalprice)) + 5 AS BIGINT)) AS message FROM orders GROUP BY 1".replace("'  ' || ", ""))
def failure_messages(spark, sf):
    """Verdicts over names with white space around them: the check is not blind to them."""
    sums = t(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice").cast("double")).alias("a"))
    lut = sums.select(F.concat(F.lit("  C"), F.col("o_custkey"), F.lit(" ")).alias("company"), F.explode(F.array(*(F.struct(F.lit(n).alias("concept"), v.alias("value")) for n, v in (("TOTAL_LIABILITIES", F.col("a")), ("TOTAL_EQUITY", F.lit(0.0)), ("TOTAL_LIAB_EQUITY", F.col("a") + 5))))).alias("x")).select("company", "x.*", F.lit("con_cur").alias("col"))
    found = equations.verdicts(lut, companies=lut.select(F.trim("company").alias("company")))
    return found.filter("verdict = 'fail'").select(F.expr("cast(substr(company, 2) as long)").alias("o_custkey"), "message")


# --- selection


@query("SELECT CAST(o_custkey % 50 AS VARCHAR) AS company, o_orderstatus AS statement, o_orderpriority AS concept, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 50, o_orderstatus, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1")
def view_rows(spark, sf):
    """One row for each company, statement and concept."""
    o = t(spark, sf, "orders").select((F.col("o_custkey") % 50).cast("string").alias("company"), F.col("o_orderstatus").alias("statement"), F.col("o_orderpriority").alias("concept"), F.col("o_totalprice").alias("match_score"), "o_orderkey")
    return select.view_rows(o, values=["match_score"], ordinal=("o_orderkey",)).select("company", "statement", "concept", "o_orderkey")


@query(
    """WITH f AS (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type, p_size ORDER BY p_partkey) = 1), a AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) <= 2)
SELECT p_brand AS company, p_type AS trap, p_partkey AS ordinal, CAST(NULL AS VARCHAR) AS con_cur FROM a QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= 8"""
)
def template_rows(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_brand").alias("company"), F.col("p_type").alias("trap"), F.col("p_size").alias("page"), F.col("p_partkey").alias("ordinal"))
    return reports.template(p, ["company", "trap", "page"], 8, [F.asc("ordinal")]).select("company", "trap", "ordinal", "con_cur")


@query("SELECT * FROM (VALUES ('section'), ('trap')) v(name)")
def missing_columns(spark, sf):
    found = quality.missing_columns(t(spark, sf, "part"), ["p_partkey", "section", "p_name", "trap"])
    return spark.createDataFrame([(c,) for c in found], "name string")


# --- sources


@query("SELECT c_custkey, c_name || ', \"' || c_mktsegment || '\"' AS name, -floor(c_acctbal) AS balance, CAST(NULL AS VARCHAR) AS section FROM customer")
def csv_round_trip(spark, sf):
    """Two tables with their columns in another order, written with byte order marks and read as one by the names in their headers."""
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), name.alias("item"), F.concat(F.lit("("), F.format_number(F.floor("c_acctbal"), 0), F.lit(")")).alias("con_cur"))
    path = work_path(spark, "csv")
    tables.write_table(c.filter("id % 2 = 0"), f"{path}/a", csv=True)
    tables.write_table(c.filter("id % 2 = 1").select("con_cur", "id", "item"), f"{path}/b", csv=True)
    got = tables.read_csv(spark, f"{path}/*", "id long, item string, con_cur string, section string")
    neg = F.regexp_replace("con_cur", "[(),]", "")
    return got.select(F.col("id").alias("c_custkey"), F.col("item").alias("name"), F.when(F.contains("con_cur", F.lit("-")), -neg.cast("double")).otherwise(tx.to_number("con_cur")).alias("balance"), "section")


@query(f"WITH {PAGES_SQL}, n AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY page) AS page, text FROM p) SELECT source || ' ü%+/.txt' AS source, CAST(page AS INTEGER) AS page, text FROM n".replace("%+/", "%+"))
def layout_round_trip(spark, sf):
    """Pages written as layout text, a file for each source, and read back."""
    path = work_path(spark, "layout")
    layout.write_layout(_pages(spark, sf).withColumn("source", F.concat("source", F.lit(" ü%+.txt"))), path)
    return layout.read_layout(spark, path).select("source", "page", "text")


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '5-LOW' THEN 'LOW' END AS company FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def known_sources(spark, sf):
    """Files of companies that are not known go, by their names alone."""
    pg = t(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("q1_"), F.lower("o_orderpriority"), F.lit(".txt")).alias("source"))
    return layout.known_sources(pg, ["LOW", "URGENT", "SPECI"]).select("o_orderkey", "company")


# --- whole jobs over generated statements


def _line(label, *values) -> Column:
    number = lambda v: F.when(v.isNull(), "-").when(v < 0, F.concat(F.lit("("), F.format_number(-v, 0), F.lit(")"))).otherwise(F.format_number(v, 0))
    return F.concat(F.rpad(label if isinstance(label, Column) else F.lit(label), 60, " "), *(F.lpad(number(v), 14, " ") for v in values))


def _text(*lines) -> Column:
    return F.concat_ws("\n", *(F.lit(x) if isinstance(x, str) else x for x in lines))


BS = [("TOTAL_CURRENT_ASSETS", "รวมสินทรัพย์หมุนเวียน"), ("TOTAL_NONCURRENT_ASSETS", "รวมสินทรัพย์ไม่หมุนเวียน"), ("TOTAL_ASSETS", "รวมสินทรัพย์"), ("RECEIVABLE", "ลูกหนี้การค้า")]


@query(
    """WITH v AS (SELECT s_suppkey, 'S' || s_suppkey AS company, unnest([{'c': 'TOTAL_CURRENT_ASSETS', 'x': 1000 + s_suppkey}, {'c': 'TOTAL_NONCURRENT_ASSETS', 'x': 5000}, {'c': 'TOTAL_ASSETS', 'x': 6000 + s_suppkey + (s_suppkey % 4 = 0)::INT * 9}, {'c': 'RECEIVABLE', 'x': -(2000 + s_suppkey)}, {'c': NULL, 'x': 7000}]) AS v FROM supplier)
SELECT company, v.c AS concept, 'BS' AS statement, CASE WHEN s_suppkey % 3 = 0 THEN 'thousand' ELSE 'baht' END AS unit, CAST(v.x AS DOUBLE) AS con_cur, CAST(v.x + 1 AS DOUBLE) AS con_prev, CAST(v.x * 2 AS DOUBLE) AS sep_cur, CAST(NULL AS DOUBLE) AS sep_prev, CASE WHEN v.c = 'RECEIVABLE' THEN 'สินทรัพย์หมุนเวียน' ELSE '' END AS section FROM v"""
)
def statement_facts(spark, sf):
    """Balance sheets from text to facts: title, unit, columns beside one of notes, sections, labels over two lines, dashes."""
    return _statement_facts(spark, sf).select("company", "concept", "statement", "unit", "con_cur", "con_prev", "sep_cur", "sep_prev", "section")


def _statement_facts(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    x = [1000 + k, F.lit(5000), 6000 + k + F.when(k % 4 == 0, 9).otherwise(0), -(2000 + k), F.lit(7000)]
    four = [(v, v + 1, v * 2, F.lit(None).cast("long")) for v in x]
    note = lambda label, n: F.concat(F.rpad(F.lit(label), 50, " "), F.lpad(F.lit(str(n)), 5, " "))
    unit = F.when(k % 3 == 0, "หน่วย: พันบาท").otherwise("หน่วย: บาท")
    text = _text("บริษัท", "งบแสดงฐานะการเงิน", unit, "                    2569    2568", "", _line(note(BS[0][1], 4), *four[0]), _line(note(BS[1][1], 5), *four[1]), _line(BS[2][1], *four[2]), "สินทรัพย์หมุนเวียน", "  ลูกหนี้", _line(note("การค้า", 6), *four[3]), "ส่วนของผู้ถือหุ้น", "", _line("รายการอื่นอย่างหนึ่ง", *four[4]))
    pg = t(spark, sf, "supplier").select(F.concat(F.lit("S"), k).alias("company"), F.concat(F.lit("s"), k, F.lit(".txt")).alias("source"), F.lit(1).alias("page"), text.alias("text"))
    alias = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(BS)], "concept string, alias string, ordinal int")
    return extract.facts(pg, alias, ["BS"]).withColumn("section", F.when(F.col("section") == "ส่วนของผู้ถือหุ้น", "").otherwise(F.col("section")))


@query("SELECT 'S' || s_suppkey AS company, col, CASE WHEN col = 'sep_prev' THEN 'skip' WHEN s_suppkey % 4 = 0 OR col <> 'con_cur' AND false THEN 'fail' WHEN col = 'con_prev' THEN 'fail' ELSE 'pass' END AS verdict FROM supplier, (VALUES ('con_cur'), ('con_prev'), ('sep_cur'), ('sep_prev')) v(col)")
def statement_crosscheck(spark, sf):
    """Assets of generated balance sheets: right, one off in each of two addends, or wrong by nine."""
    return extract.crosscheck(_statement_facts(spark, sf)).filter("eq_id = 'assets'").select("company", "col", "verdict")


EQUITY = [("SE_OPENING", "ยอดคงเหลือ ณ วันที่ 1 มกราคม"), ("SE_PROFIT", "กำไรสำหรับงวด"), ("DIVIDEND_PAYABLE", "เงินปันผลจ่าย"), ("SE_CLOSING", "ยอดคงเหลือ ณ วันที่ 31 มีนาคม")]


def _equity_page(k: Column, side: str, *blocks) -> Column:
    head = F.concat(F.rpad(F.lit(""), 60, " "), *(F.lpad(F.lit(x), 14, " ") for x in ("ทุน", "สำรอง", "-", "รวม")))
    lines = [F.concat(F.rpad(F.lit(label), 60, " "), F.lit("")) if v is None else _line(F.lit(label) if isinstance(label, str) else label, *v) for label, v in (row for b in blocks for row in b)]
    return _text("บริษัท", "งบแสดงการเปลี่ยนแปลงส่วนของผู้ถือหุ้น", side, "(หน่วย: พันบาท)", "", head, *lines)


def _block(k: Column, year: int, base, more=None) -> list:
    """Opening, profit, dividend, perhaps one row more, and closing: three components and their sum."""
    a, b, c = base + k, 2 * base + k, 3 * base - k
    d = F.lit(-1000)
    rows = [(f"ยอดคงเหลือ ณ วันที่ 1 มกราคม {year}", (a, b, c, a + b + c)), ("กำไรสำหรับงวด", (F.lit(1000), 2000 + k, F.lit(None).cast("long"), 3000 + k)), ("เงินปันผลจ่าย", (d, d, d, d * 3))]
    total = a + b + c + 3000 + k - 3000
    if more:
        rows.append((more, (F.lit(1500), F.lit(1500), F.lit(1500), F.lit(4500))))
        total = total + 4500
    last = (a + F.lit(0 + (1500 if more else 0)), b + 1000 + k + (1500 if more else 0), c - 1000 + (1500 if more else 0), total)
    return [*rows, (f"ยอดคงเหลือ ณ วันที่ 31 มีนาคม {year}", last)]


def _equity_pages(spark, sf, separate=30_000) -> DataFrame:
    """Three pages a supplier: notes, and consolidated and separate statements; separate: the base of the latter's first block."""
    k = F.col("s_suppkey")
    con = _equity_page(k, "งบการเงินรวม", _block(k, 2568, 10_000, "ออกหุ้นเพิ่มทุน"), _block(k, 2569, 20_000))
    sep = _equity_page(k, "งบการเงินเฉพาะกิจการ", _block(k, 2568, separate), _block(k, 2569, 40_000))
    other = F.lit("หมายเหตุ")
    pg = t(spark, sf, "supplier").select(F.concat(F.lit("S"), k).alias("company"), F.concat(F.lit("s"), k, F.lit(".txt")).alias("source"), F.posexplode(F.array(other, con, sep)).alias("page", "text"))
    return pg.withColumn("page", F.col("page") + 1)


@query(
    """WITH v AS (SELECT s_suppkey AS k, unnest([{'c': 'SE_OPENING', 'a': 120000 + s_suppkey, 'b': 60000 + s_suppkey, 'x': 240000 + s_suppkey, 'y': 180000 + s_suppkey, 'n': 2}, {'c': 'SE_PROFIT', 'a': 3000 + s_suppkey, 'b': 3000 + s_suppkey, 'x': 3000 + s_suppkey, 'y': 3000 + s_suppkey, 'n': 2},
  {'c': 'SE_DIVIDEND_DECLARED', 'a': -3000, 'b': -3000, 'x': -3000, 'y': -3000, 'n': 2}, {'c': 'SE_CLOSING', 'a': 120000 + 2 * s_suppkey, 'b': 64500 + 2 * s_suppkey, 'x': 240000 + 2 * s_suppkey, 'y': 180000 + 2 * s_suppkey, 'n': 2}, {'c': NULL, 'a': NULL, 'b': 4500, 'x': NULL, 'y': NULL, 'n': 1}]) AS v FROM supplier)
SELECT 'S' || k AS company, v.c AS concept, CAST(v.a AS DOUBLE) AS con_cur, CAST(v.b AS DOUBLE) AS con_prev, CAST(v.x AS DOUBLE) AS sep_cur, CAST(v.y AS DOUBLE) AS sep_prev, CASE WHEN v.n = 2 THEN '2,3' ELSE '2' END AS page, CASE WHEN v.n = 2 THEN 'งบรวม+งบเฉพาะกิจการ' ELSE 'งบรวม' END AS section FROM v"""
)
def equity_facts(spark, sf):
    """Statements of equity: totals of two periods and two pages as one row for each item, one item in the earlier period only."""
    alias = spark.createDataFrame([(c, a, i) for i, (c, a) in enumerate(EQUITY)], "concept string, alias string, ordinal int")
    got = extract.facts(_equity_pages(spark, sf), alias, ["SE"])
    return got.select("company", "concept", "con_cur", "con_prev", "sep_cur", "sep_prev", "page", "section")


CELLS_SQL = """b AS (SELECT s_suppkey AS k, unnest([{'page': 2, 'block': 0, 'base': 10000, 'm': 1500, 'f': 6}, {'page': 2, 'block': 1, 'base': 20000, 'm': 0, 'f': 11}, {'page': 3, 'block': 0, 'base': 30000, 'm': 0, 'f': 6}, {'page': 3, 'block': 1, 'base': 40000, 'm': 0, 'f': 10}]) AS b FROM supplier),
r AS (SELECT k, b.page, b.block, unnest([{'i': b.f, 'kind': 'balance', 'v': [b.base + k, 2 * b.base + k, 3 * b.base - k]}, {'i': b.f + 1, 'kind': 'movement', 'v': [1000, 2000 + k, NULL]}, {'i': b.f + 2, 'kind': 'movement', 'v': [-1000, -1000, -1000]},
  {'i': b.f + 3, 'kind': 'movement', 'v': [b.m, b.m, b.m]}, {'i': b.f + 3 + (b.m > 0)::INT, 'kind': 'balance', 'v': [b.base + k + b.m, 2 * b.base + 2 * k + 1000 + b.m, 3 * b.base - k - 1000 + b.m]}]) AS r FROM b),
w AS (SELECT * FROM r WHERE NOT (r.kind = 'movement' AND coalesce(r.v[1], 1) = 0)),
cells AS (SELECT 'S' || k AS company, page, block, r.i AS row_index, r.kind AS kind, unnest([{'c': 0, 'v': r.v[1], 'n': 'ทุน'}, {'c': 1, 'v': r.v[2], 'n': 'สำรอง'}, {'c': 2, 'v': r.v[3], 'n': 'คอลัมน์ 3'}, {'c': 3, 'v': r.v[1] + r.v[2] + coalesce(r.v[3], 0), 'n': 'รวม'}]) AS x FROM w)"""


@query(f"WITH {CELLS_SQL} SELECT company, CAST(page AS INTEGER) AS page, CAST(block AS INTEGER) AS block, CAST(row_index AS INTEGER) AS row_index, kind, CAST(x.c AS INTEGER) AS col_index, x.n AS equity_component, x.c = 3 AS is_total_col, CAST(x.v AS DOUBLE) AS value FROM cells")
def equity_matrix(spark, sf):
    """All cells of generated statements of equity, by page, block, row and column."""
    got = extract.equity_cells(_equity_pages(spark, sf))
    return got.select("company", "page", "block", "row_index", "kind", "col_index", "equity_component", "is_total_col", "value")


@query("SELECT 'S' || s_suppkey AS company, CAST(p AS INTEGER) AS page, CAST(b AS INTEGER) AS block, count(*) AS n, CAST(sum(1) AS BIGINT) AS n_ok FROM supplier, (VALUES (2), (3)) p(p), (VALUES (0), (1)) b(b), range(4) GROUP BY 1, 2, 3")
def equity_rollforward(spark, sf):
    """Every column of every block of the generated statements rolls forward."""
    got = extract.check_rollforward(extract.equity_cells(_equity_pages(spark, sf)))["checks"]
    return got.groupBy("company", "page", "block").agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("n_ok"))


@query(f"WITH {CELLS_SQL}, o AS (SELECT DISTINCT company, page FROM cells) SELECT company, CAST(page AS INTEGER) AS page, CASE WHEN page = 3 THEN 0 ELSE 4 END AS n_ok, 4 AS n, page = 3 AS shifted FROM o")
def equity_truth(spark, sf):
    """Opening balances against a truth that is right on one page and moved by one column on the other, where no two columns are alike for any key."""
    k = F.col("s_suppkey")
    base = lambda b: [b + k, 2 * b + k, 3 * b - k, 6 * b + k]
    apart = 30_000 + 4 * k  # with a fixed base the second and third column meet at half of it
    right, moved = base(10_000), [F.lit(-7), *base(apart)[:3]]
    rows = F.array(*(F.struct(F.lit(p).alias("page"), F.lit(i).alias("col_index"), v.cast("double").alias("value")) for p, vs in ((2, right), (3, moved)) for i, v in enumerate(vs)))
    truth = t(spark, sf, "supplier").select(F.concat(F.lit("S"), k).alias("company"), F.explode(rows).alias("x")).select("company", "x.*")
    got = extract.evaluate_matrix(truth, extract.equity_cells(_equity_pages(spark, sf, apart)))["pages"]
    return got.select("company", "page", F.col("n_ok").cast("int").alias("n_ok"), F.col("n").cast("int").alias("n"), "shifted")
