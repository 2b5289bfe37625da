import math
import random
from difflib import SequenceMatcher
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon import catalog
from tabulon.functions.text import bones
from tabulon.operators import columns, equations, matching, ocr, pages, quality, rollforward, select, statement
from tabulon.plans.extract import crosscheck, equity_cells, facts, order_invariant, truth_template, validate

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    v = v.tolist() if hasattr(v, "tolist") else v
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(repr([plain(v) for v in r]) for r in df.values.tolist())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.skipif(not Path(DATA).exists(), reason="no fixture tables here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_gives_what_sql_gives(spark, duck, name):
    assert rows(catalog.QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(catalog.ORACLE[name]).df())


EXTRACTED = "company string, statement string, concept string, concept_eq string, match_score double, con_cur double, con_prev double, sep_cur double, sep_prev double, ordinal int"


def test_picking_rows(spark):
    data = [
        ("A", "SE", "X", "X", 1.0, -7.0, None, None, None, 0),
        ("A", "BS", "X", "X", 1.0, 100.0, None, None, None, 1),
        ("A", "BS", "Y", "Y", 0.9, 1.0, None, None, None, 2),
        ("A", "BS", "Y", "Y", 0.9, 50.0, 2.0, 3.0, 4.0, 3),
        ("A", "BS", None, "Z", 1.0, 9.0, None, None, None, 4),
        (" A ", "BS", "Q", "Q", None, 8.0, None, None, None, 5),
    ]
    df = spark.createDataFrame(data, EXTRACTED)
    lut, _ = select.lookup_table(df)
    got = {(r["company"], r["concept"], r["col"]): r["value"] for r in lut.collect()}
    assert got[("A", "X", "con_cur")] == 100.0 and got[("A", "Y", "con_cur")] == 50.0 and got[("A", "Q", "con_cur")] == 8.0
    assert not any(k[1] == "Z" for k in got)
    assert order_invariant(df, lambda d: select.lookup_table(d)[0]).count() == 0


def test_equations_have_three_verdicts(spark):
    data = [("A", "TOTAL_LIABILITIES", 1.0), ("A", "TOTAL_EQUITY", 2.0), ("A", "TOTAL_LIAB_EQUITY", 3.0), ("B", "TOTAL_LIABILITIES", 1.0), ("B", "TOTAL_EQUITY", 5.0), ("B", "TOTAL_LIAB_EQUITY", 7.0), ("C", "TOTAL_EQUITY", 1.0)]
    lut = spark.createDataFrame(data, "company string, concept string, value double").withColumn("col", F.lit("con_cur"))
    got = equations.verdicts(lut)
    found = {(r["company"], r["eq_id"], r["col"]): r["verdict"] for r in got.collect()}
    assert [found[(c, "balance", "con_cur")] for c in "ABC"] == ["pass", "fail", "skip"]
    assert not any(k[1] == "equity_closing" and k[2] == "con_prev" for k in found)
    totals = {r["company"]: (r["n_pass"], r["n_fail"], r["blind"]) for r in equations.summary(got).collect()}
    assert totals["A"] == (1, 0, False) and totals["C"] == (0, 0, True) and totals[None] == (1, 1, False)
    told = {r["message"] for r in got.collect()} - {None}
    assert told == {"B [con_cur] balance: 6 != 7"}


def test_equations_are_not_blind_to_padded_names(spark):
    data = [("  ACME ", "BS", c, c, 1.0, v, None, None, None, i) for i, (c, v) in enumerate([("TOTAL_LIABILITIES", 1.0), ("TOTAL_EQUITY", 2.0), ("TOTAL_LIAB_EQUITY", 3.0)])]
    got = crosscheck(spark.createDataFrame(data, EXTRACTED))
    totals = {r["company"]: (r["n_pass"], r["n_fail"], r["blind"]) for r in equations.summary(got).collect()}
    assert totals["ACME"] == (1, 0, False) and set(totals) == {"ACME", None}


def test_optional_terms_count_if_there(spark):
    eq = [("e", ["a", "?b"], "t", None)]
    lut = spark.createDataFrame([("A", "a", 1.0), ("A", "b", 2.0), ("A", "t", 3.0), ("B", "a", 1.0), ("B", "t", 1.0)], "company string, concept string, value double").withColumn("col", F.lit("c"))
    assert {r["verdict"] for r in equations.verdicts(lut, eq, cols=["c"]).collect()} == {"pass"}


def fold(moves, tol=1.0, guarded=True):
    stack = []
    for x, total in moves:
        best = 0
        for k in range(1, len(stack) + 1):
            if x != 0 and abs(sum(stack[-k:]) - x) <= tol:
                best = k
        if best and (total or not guarded):
            del stack[-best:]
        stack.append(x)
    return stack


def test_roll_forward_fold(spark):
    rng = random.Random(4)
    data, want = [], {}
    for g in range(60):
        moves = []
        for _ in range(rng.randint(0, 6)):
            if moves and rng.random() < 0.4:
                k = rng.randint(1, len(moves))
                moves.append((sum(v for v, _ in moves[-k:]), rng.random() < 0.8))
            else:
                moves.append((float(rng.randint(-50, 50)), False))
        start = float(rng.randint(0, 100))
        end = start + sum(fold(moves)) + (0 if g % 3 else 7)
        data += [(g, 0, True, start, "ยอดคงเหลือ")] + [(g, i + 1, False, v, "รวม" if t else "x") for i, (v, t) in enumerate(moves)] + [(g, len(moves) + 1, True, end, "ยอดคงเหลือ")]
        want[g] = (sum(fold(moves)), bool(g % 3))
    df = spark.createDataFrame(data, "g int, row_index int, is_balance boolean, value double, item string")
    got = {r["g"]: (r["movement"], r["ok"]) for r in rollforward.check(df, ["g"]).collect()}
    assert got == want
    assert order_invariant(df, lambda d: rollforward.check(d, ["g"])).count() == 0


def test_totals_are_told_by_the_written_name(spark):
    rows = [(0, 0, True, 100.0, "ยอดคงเหลือ"), (0, 1, False, 10.0, "กำไร"), (0, 2, False, 10.0, "บริษัทร่วม"), (0, 3, True, 120.0, "ยอดคงเหลือ"), (0, 4, False, 10.0, "x"), (0, 5, False, 10.0, "รวม"), (1, 0, True, 1.0, "ยอดคงเหลือ"), (1, 1, False, 5.0, "a"), (1, 2, False, 5.0, "รวม")]
    df = spark.createDataFrame(rows, "g int, row_index int, is_balance boolean, value double, item string")
    assert [(r["g"], r["movement"], r["ok"]) for r in rollforward.check(df, ["g"]).collect()] == [(0, 20.0, True)]
    # only what stands between two balances counts, by number once and never by name
    assert tuple(rollforward.audit(df, ["g"]).first()) == (1, 0)


def test_matching(spark, monkeypatch):
    alias = spark.createDataFrame([("RECEIVABLE", "ลูกหนี้การค้า", 0), ("STOCK", "สินค้าคงเหลือ", 1), ("SHARES", "หุ้นสามัญ 5 หุ้น", 2), ("AGAIN", "ลูกหนี้การค้า", 3)], "concept string, alias string, ordinal int")
    labels = ["ลกู หน้กีารคา้", "สินค้าคงเหลือ - สุทธิ", "สินค้าคงเหลอืือก", "หุ้นสามัญ 6 หุ้น", "หุ้นสามัญ 5 หุ้น", "อย่างอื่นทั้งหมด"]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, label string")
    got = {r["id"]: r for r in matching.match(df, alias, ["id"], cutoff=0.8).collect()}
    assert [got[i]["concept"] for i in range(6)] == ["RECEIVABLE", "STOCK", "STOCK", None, "SHARES", None]
    assert got[0]["match_score"] == got[1]["match_score"] == 1.0 and got[1]["label_used"] == "สินค้าคงเหลือ"
    known = [bones("ลูกหนี้การค้า"), bones("สินค้าคงเหลือ")]
    assert got[2]["match_score"] == pytest.approx(max(SequenceMatcher(None, bones(labels[2]), k).ratio() for k in known))
    assert got[5]["match_score"] == pytest.approx(max(SequenceMatcher(None, bones(labels[5]), k).ratio() for k in known))
    monkeypatch.setattr(matching, "COMPARED_ROWS", 1)  # as with a dictionary too large to compare with
    large = {r["id"]: (r["concept"], r["label_used"]) for r in matching.match(df, alias, ["id"], cutoff=0.8).collect()}
    assert large == {i: (r["concept"], r["label_used"]) for i, r in got.items()}


def test_digits_bind_a_skeleton(spark):
    alias = spark.createDataFrame([("BARE", "กขค", 0), ("FIVE", "กขค 5", 1), ("AGAIN", "กขค 5", 2)], "concept string, alias string, ordinal int")
    df = spark.createDataFrame([(0, "กขค"), (1, "กขค 5"), (2, "กขค 6"), (3, None), (4, "")], "id int, label string")
    got = {r["id"]: (r["concept"], r["match_score"]) for r in matching.match(df, alias, ["id"]).collect()}
    assert got == {0: (None, 0.0), 1: ("FIVE", 1.0), 2: (None, 0.0), 3: (None, 0.0), 4: (None, 0.0)}


def test_columns_of_a_page(spark):
    def line(label, *values):
        return label.ljust(30) + "".join(v.rjust(12) for v in values)

    text = "\n".join([line("item " + "abcdef"[i], f"{i + 1},000", "-" if i == 2 else f"({i},500)") for i in range(6)])
    lines = columns.with_tokens(pages.lines(spark.createDataFrame([("a", 1, text)], "source string, page int, text string")))
    got = columns.find_columns(lines, ["source", "page"]).first()["columns"]
    assert got == [42, 54]


def test_merge_fold_and_dates(spark):
    df = spark.createDataFrame([([(10, [1, 2]), (15, [3]), (40, [1])],)], "c array<struct<pos:int,lines:array<int>>>")
    got = df.select(columns.merge_adjacent(F.col("c")).alias("m")).first()["m"]
    assert [(x["pos"], sorted(x["lines"])) for x in got] == [(10, [1, 2]), (40, [1])]
    # the busier one keeps its own lines: 22 is compared with 20's, not with those of all that went into it
    df = spark.createDataFrame([([(10, [1]), (20, [2, 3]), (22, [1, 4, 5])],)], "c array<struct<pos:int,lines:array<int>>>")
    assert [x["pos"] for x in df.select(columns.merge_adjacent(F.col("c")).alias("m")).first()["m"]] == [22]
    cells = [(1, 0, 31.0), (1, 1, None), (1, 2, 5.0), (1, 3, 900.0), (1, 4, 1.0), (2, 0, 2568.0), (2, 1, 2.0), (2, 2, 900.0), (2, 3, 2.0), (2, 4, 3.0)]
    df = spark.createDataFrame(cells, "p int, i int, v double")
    kept = {(r["p"], r["i"]) for r in columns.strip_dates(df, ["p"], "i", "v").collect()}
    assert kept == {(1, i) for i in (1, 2, 3, 4)} | {(2, i) for i in (2, 3, 4)}


def test_sections_and_memory(spark):
    data = [(1, "a", False), (2, "b", False), (3, "c", False), (4, "d", False), (5, None, True), (6, "e", False), (7, None, True)]
    df = spark.createDataFrame(data, "n int, label string, reset boolean").withColumn("p", F.lit(1))
    got = {r["n"]: r["prefixes"] for r in pages.memory(df, ["p"], "n", "label", "reset").collect()}
    assert got[5] == ["b", "c", "d"] and got[7] == ["e"] and got[6] == []


def test_sides_and_spills(spark):
    data = [("a", 1, "งบการเงินรวม"), ("a", 2, "งบการเงินเฉพาะกิจการ"), ("b", 1, "x"), ("b", 2, "y")]
    df = spark.createDataFrame(data, "source string, page int, text string")
    got = {(r["source"], r["page"]): r["side"] for r in pages.sides(df, ["งบการเงินเฉพาะกิจการ"], "งบการเงินรวม").collect()}
    assert got == {("a", 1): "con", ("a", 2): "sep", ("b", 1): "con", ("b", 2): "sep"}


def test_pages_of_equity(spark):
    prev = [("s", "C1", "ก", 1.0, 0, 2), ("s", None, "ข", 2.0, 1, 2), ("s", None, "ค", 3.0, 2, 2), ("s", None, "ค 5", 4.0, 3, 2)]
    cur = [("s", "C1", "ง", 10.0, 4, 1), ("s", None, "ข", 20.0, 5, 1)]
    df = spark.createDataFrame(prev + cur, "s string, concept string, label string, value double, o int, period int")
    got = [(r["label"], r["current"], r["previous"]) for r in statement.side_by_side(df, ["s"], "concept", "label", "value", "o").collect()]
    # of two earlier rows with one skeleton the first
    assert sorted(got) == sorted([("ง", 10.0, 1.0), ("ข", 20.0, 2.0), ("ก", None, 1.0), ("ค", None, 3.0)])


def test_of_blocks_without_a_year_the_last_is_current(spark):
    df = spark.createDataFrame([(1, 1, "มกราคม"), (1, 2, "ก"), (1, 3, "มกราคม"), (1, 4, "ข")], "p int, n int, label string")
    got = statement.periods(statement.year_blocks(df, ["p"], "n", "label"), ["p"])
    assert {r["n"]: r["period"] for r in got.collect()} == {1: 2, 2: 2, 3: 1, 4: 1}


def test_ocr_words_to_layout(spark):
    data = [("f", 1, "total", 0, 10, 50, 10, 90.0), ("f", 1, "1,000", 200, 11, 50, 10, 90.0), ("f", 1, "next", 0, 40, 40, 10, 90.0), ("f", 1, "dirt", 99, 40, 40, 10, 10.0)]
    df = spark.createDataFrame(data, "source string, page int, text string, x int, y int, w int, h int, conf double")
    assert ocr.layout(df).first()["text"] == "total" + " " * 15 + "1,000\nnext"
    assert ocr.assemble(pd.DataFrame(columns=["text", "x", "y", "w", "h"])) == ""
    # a wide word of letters does not change the width of a character, and a word that meets its column needs no space more
    words = pd.DataFrame([("wide", 0, 0, 200, 10), ("12", 300, 0, 20, 10), ("34", 340, 0, 20, 10), ("ab", 365, 0, 10, 10)], columns=["text", "x", "y", "w", "h"])
    assert ocr.assemble(words) == "wide" + " " * 26 + "12  34ab"


def test_quality(spark):
    df = spark.createDataFrame([("a", "baht"), ("a", "unknown"), ("b", "x"), ("b", "y"), ("b", "unknown"), ("c", "unknown")], "company string, unit string")
    got = sorted((r["company"], r["unit"]) for r in quality.fill_mode(df, "unit", by=["company"]).collect())
    assert got == [("a", "baht"), ("a", "baht"), ("b", "x"), ("b", "x"), ("b", "y"), ("c", "unknown")]
    assert [r["company"] for r in quality.still_unknown(quality.fill_mode(df, "unit", by=["company"]), "unit", "company").collect()] == ["c"]


def test_from_pages_to_verdicts(spark):
    def line(label, *values):
        return label.ljust(40) + "".join(v.rjust(14) for v in values)

    names = ["รวมสินทรัพย์หมุนเวียน", "รวมสินทรัพย์ไม่หมุนเวียน", "รวมสินทรัพย์", "ลูกหนี้การค้า", "สินค้าคงเหลือ"]
    values = [600, 400, 1000, 250, 350]
    text = "\n".join(["งบแสดงฐานะการเงิน", "หน่วย : พันบาท", ""] + [line(n, *[f"{v},000" for _ in range(4)]) for n, v in zip(names, values, strict=True)])
    df = spark.createDataFrame([("ACME", "acme.txt", 1, text)], "company string, source string, page int, text string")
    alias = spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(zip(["TOTAL_CURRENT_ASSETS", "TOTAL_NONCURRENT_ASSETS", "TOTAL_ASSETS", "RECEIVABLE", "INVENTORY"], names, strict=True))], "concept string, alias string, ordinal int")
    got = facts(df, alias)
    found = {r["concept"]: (r["con_cur"], r["unit"], r["statement"]) for r in got.collect()}
    assert found["TOTAL_ASSETS"] == (1_000_000.0, "thousand", "BS") and found["INVENTORY"][0] == 350_000.0 and len(found) == 5
    v = {(r["eq_id"], r["col"]): r["verdict"] for r in crosscheck(got).collect()}
    assert all(v[("assets", c)] == "pass" for c in ("con_cur", "con_prev", "sep_cur", "sep_prev"))


def test_pages_read_by_ocr(spark):
    def line(label, *values):
        return label.ljust(40) + "".join(f"{v:,}".rjust(14) for v in values)

    rows = [("รวมสินทรัพย์", 6000), ("ลูกหนี้การค้า", 2800), ("สินค้าคงเหลือ", 3500), ("รายการอื่น", 1500)]
    page = lambda title: "\n".join([title, "", *(line(n, v, v + 1, v + 2, v + 3) for n, v in rows)])
    pages_ = [("A", "a.txt", 1, page("งบฐานะการเงิน\nหน่วย: พันบาท")), ("A", "a.txt", 2, page("งบกำไรขาดทุ")), ("A", "a.txt", 3, page("หมายเหตุประกอบ")), ("B", "b.txt", 1, page("ข้อความ\nหนี้สินและส่วนของเจ้าของ"))]
    df = spark.createDataFrame(pages_, "company string, source string, page int, text string")
    alias = spark.createDataFrame([("TOTAL_ASSETS", "รวมสินทรัพย์", 0), ("RECEIVABLE", "ลูกหนี้การค้า", 1), ("INVENTORY", "สินค้าคงเหลือ", 2)], "concept string, alias string, ordinal int")
    got = facts(df, alias, classifier="ocr")
    seen = {(r["source"], r["page"]): (r["statement"], r["page_how"], r["unit"]) for r in got.collect()}
    # units are filled over all companies
    assert seen == {("a.txt", "1"): ("BS", "title", "thousand"), ("a.txt", "2"): ("IS", "alike 0.88", "thousand"), ("b.txt", "1"): ("BS", "content", "thousand")} and got.count() == 12
    strict = facts(df, alias, classifier="ocr", strict=True, unit="baht").collect()
    assert {(r["source"], r["page"], r["unit"]) for r in strict} == {("a.txt", "1", "baht")} and len(strict) == 4
    bs = facts(df.filter("company = 'A'"), alias, ["BS"])
    blank = truth_template(bs, alias, per_company=3).collect()
    assert [(r["company"], r["item"], r["con_cur"], r["_concept_hint"], r["_note"]) for r in blank] == [("A", n, "", c, "") for n, c in (("รวมสินทรัพย์", "TOTAL_ASSETS"), ("ลูกหนี้การค้า", "RECEIVABLE"), ("สินค้าคงเหลือ", "INVENTORY"))]
    truth = spark.createDataFrame([("f", 0, "A", "รวมสินทรัพย์", 6000.0, 6001.0, None, 6003.0, "subtotal"), ("f", 1, "A", "ลูกหนี้การค้า", 9.0, 2801.0, 2802.0, 2803.0, "normal"), ("f", 2, "A", "ไม่มีในพจนานุกรม", 1.0, None, None, None, None)], "file string, ordinal int, company string, item string, con_cur double, con_prev double, sep_cur double, sep_prev double, trap string")
    found = validate(truth, bs, alias)
    assert {(r["concept"], r["col"]): r["status"] for r in found["cells"].collect() if r["status"] != "ok"} == {("TOTAL_ASSETS", "sep_cur"): "extra_value", ("RECEIVABLE", "con_cur"): "wrong"}
    assert {r["trap"]: (r["n_ok"], r["n"]) for r in found["by_trap"].collect()} == {"subtotal": (3, 4), "normal": (3, 4)}
    assert found["coverage"].first()["coverage"] == pytest.approx(2 / 3)


def test_matrix_of_a_page_without_a_table_is_empty(spark):
    df = spark.createDataFrame([("A", "a", 1, "งบการเปลี่ยนแปลงส่วนของผู้ถือหุ้น\n" + "1,000 " * 20), ("B", "b", 1, "  ")], "company string, source string, page int, text string")
    assert equity_cells(df).count() == 0


def test_gaps_of_parts_of_seconds(spark, tmp_path):
    """Seconds are the nearest ones, as SQL casts them; rows of one second are in one cluster."""
    sql = "SELECT * FROM (VALUES (1, 1, TIMESTAMP '2024-01-01 00:00:00.4'), (2, 1, TIMESTAMP '2024-01-01 12:00:00.6'), (3, 2, TIMESTAMP '2024-01-01 00:00:00.6'), (4, 2, TIMESTAMP '2024-01-01 12:00:01.4'), (5, 3, TIMESTAMP '2024-01-01 00:00:00.5'), (6, 3, TIMESTAMP '2024-01-01 12:00:01.2')) v(event_id, user_id, ts)"
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS {sql}")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    got = catalog.QUERIES["gap_cluster"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(catalog.ORACLE["gap_cluster"]).df())
    assert dict(zip(got["event_id"], got["cluster"], strict=True)) == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_moved_truth_is_wrong_at_every_key(spark, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE TABLE supplier AS SELECT CAST(unnest([0, 1, 14999, 15000, 15001, 30000, 59999]) AS BIGINT) AS s_suppkey")
    con.execute(f"COPY supplier TO '{tmp_path}/supplier.parquet'")
    assert rows(catalog.QUERIES["equity_truth"](spark, str(tmp_path)).toPandas()) == rows(con.execute(catalog.ORACLE["equity_truth"]).df())


def test_pages_are_never_broadcast_for_column_stats(spark):
    lines = spark.createDataFrame([(1, [(0, 3, "1,0")]), (2, [(0, 2, "17")])], "page int, toks array<struct<start int, end int, tok string>>")
    where = spark.range(1, 4).select(F.col("id").cast("int").alias("page"), F.array(F.get(F.array(F.lit(3), F.lit(2), F.lit(9)), F.col("id").cast("int") - 1)).alias("columns"))  # known to be small
    got = columns.column_stats(lines, where, ["page"])
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, [3], [1.0], 0.0), (2, [2], [0.0], 1.0), (3, [9], [0.0], 0.0)]


def test_layout_takes_many_pages_at_once(spark):
    boxes = [(f"s{p}", p % 3, w, x, y, 10 * len(w), 10, 90.0) for p in range(500) for w, x, y in (("total", 0, 40), ("1,O00", 200, 41), (f"n{p}", 0, 80))]
    df = spark.createDataFrame(boxes, "source string, page int, text string, x int, y int, w int, h int, conf double").repartition(7)
    got = ocr.layout(df)
    assert "FlatMapGroupsInPandas" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted((f"s{p}", p % 3, "total" + " " * 15 + f"1,000\nn{p}") for p in range(500))
