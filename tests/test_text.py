import pytest
from pyspark.sql import functions as F

from tabulon.functions import similarity, tokens
from tabulon.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("a,b", [("ลูกหนี้การค้า", "ลกู หน้กีารคา้"), ("อืน8", "อื่น")])
def test_skeleton_survives_noise(spark, a, b):
    assert one(spark, tx.skeleton(F.lit(a))) == one(spark, tx.skeleton(F.lit(b))) == tx.bones(a)


@pytest.mark.parametrize(
    "given,wanted",
    [("องค์ประกอบอืน8 ของส่วน", "องค์ประกอบอืน ของส่วน"), ("หุ้นสามัญ 441,453,555 หุ้น", "หุ้นสามัญ 441,453,555 หุ้น"), ("  ก  ข ", "ก ข"), ("", "")],
)
def test_clean_label(spark, given, wanted):
    assert one(spark, tx.clean_label(F.lit(given))) == wanted


@pytest.mark.parametrize("given,wanted", [("อุปกรณ์ - สุทธิ", "อุปกรณ์"), ("สินค้าคงเหลือ สุทธิ", "สินค้าคงเหลือ"), ("ลูกหนี้ - หมุนเวียน", "ลูกหนี้ - หมุนเวียน"), ("ลูกหนี้ - ไม่หมุนเวียน", "ลูกหนี้ - ไม่หมุนเวียน"), ("รวมสินทรัพย์หมุนเวียน", "รวมสินทรัพย์หมุนเวียน")])
def test_strip_suffix(spark, given, wanted):
    assert one(spark, tx.strip_suffix(F.lit(given))) == wanted


def test_note_refs_and_periods(spark):
    assert one(spark, tx.strip_note_ref(F.lit("หุ้นกู้ 6, 10"))) == "หุ้นกู้"
    assert one(spark, tx.strip_note_ref(F.lit("เงินปันผลรับ 4 และ 5.3"))) == "เงินปันผลรับ"
    assert one(spark, tx.strip_period_paren(F.lit("ทุน (31 ธันวาคม 2568: หุ้น 5) บาท"))) == "ทุน บาท"
    assert one(spark, tx.strip_period_paren(F.lit("กำไร (ขาดทุน) ต่อหุ้น"))) == "กำไร (ขาดทุน) ต่อหุ้น"


@pytest.mark.parametrize("given,wanted", [("(2,036,264)", -2036264.0), ("-", None), ("", None), ("0.50", 0.5), ("(123", 123.0), ("(-5)", 5.0), ("5.", None), ("๑๒", None), ("1,234", 1234.0)])
def test_to_number(spark, given, wanted):
    assert one(spark, tx.to_number(F.lit(given))) == wanted


def test_candidates_are_specific_first(spark):
    got = one(spark, tx.label_candidates(F.lit("ก - สุทธิ"), F.array(F.lit("x"), F.lit("y")), F.lit("s")))
    assert got[:4] == ["s x y ก - สุทธิ", "s y ก - สุทธิ", "s x ก - สุทธิ", "s ก - สุทธิ"]
    assert got[4:6] == ["x y ก - สุทธิ", "x y ก"] and got[-2:] == ["ก - สุทธิ", "ก"]
    assert len(got) == len(set(got))


def test_pages(spark):
    table = "\n".join(["1,234 5,678"] * 8)
    kind = lambda head, **o: one(spark, tx.page_kind(F.lit(f"{head}\n{table}"), **o))
    assert kind("งบฐานะการเงิน") == "BS" and kind("งบกำไรขาดทุนเบ็ดเสร็จ") == "IS" and kind("งบกระแสเงินสด") == "CF"
    assert kind("งบการเปลี่ยนแปลงส่วนของผู้ถือหุ้น") == "SE" and kind("หมายเหตุประกอบงบกระแสเงินสด") is None
    assert kind("สินทรัพย์") is None and kind("สินทรัพย์", strict=False) == "BS"
    assert one(spark, tx.page_kind(F.lit("งบกระแสเงินสด"))) is None
    alike = lambda page: tuple(one(spark, similarity.page_kind_alike(F.lit(page))))
    assert alike(f"งบกระแสเงินสด\n{table}") == ("CF", "title") and alike("งบกระแสเงินส") == (None, "none")
    assert alike(f"งบกระแสเงินส\n{table}") == ("CF", "alike 0.94") and alike(f"หมายเหตุประกอบ กำไรต่อหุ้น\n{table}") == (None, "notes")
    assert alike(f"ข้อความ\n{table}\nกำไรต่อหุ้น") == ("IS", "content") and alike(f"ข้อความ\n{table}") == (None, "none")


@pytest.mark.parametrize("given,wanted", [("หน่วย : พันบาท", "thousand"), ("(ล้านบาท)", "million"), ("หมายเหตุ  บาท  บาท", "baht"), ("หุ้นละ 5 บาท หุ้นละ 5 บาท", "unknown"), ("", "unknown")])
def test_units(spark, given, wanted):
    assert one(spark, tx.detect_unit(F.lit(given))) == wanted


def test_lines(spark):
    line = "หุ้นสามัญ 441,453,555 หุ้น มูลค่าหุ้นละ 1 บาท      441,454   (441,454)"
    end = [line.index("441,454 ") + 7, len(line) - 1]
    toks = tokens.tokens(F.col("line"))
    df = spark.createDataFrame([(line,), ("ปี   2569   2568",)], "line string").withColumn("toks", toks)
    got = df.select(tokens.parsed("line", "toks", F.array(*map(F.lit, end))).alias("p")).collect()
    assert got[0]["p"]["label"] == "หุ้นสามัญ 441,453,555 หุ้น มูลค่าหุ้นละ 1 บาท" and got[0]["p"]["values"] == [441454.0, -441454.0]
    years = spark.createDataFrame([("ปี   2569   2568",)], "line string").withColumn("toks", toks)
    assert years.select(tokens.parsed("line", "toks", F.array(F.lit(9), F.lit(16))).alias("p")).first()["p"] is None


def test_ratio_is_the_published_one(spark):
    from difflib import SequenceMatcher

    pairs = [("abcd", "bcde"), ("", "a"), ("กขค", "กค"), ("private", "privacy")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r["r"] for r in df.select(similarity.ratio("a", "b").alias("r")).collect()] == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_traps_in_order(spark):
    cases = [(("รวม", 1.0, 2.0), "subtotal"), (("x", None, None), "dash_empty"), (("x", 1.5, -1.0), "decimal"), (("x", -1.0, None), "parentheses"), (("x" * 36, 1.0, 2.0), "long_name"), (("x", 2e8, 1.0), "long_num"), (("x", 5000.0, None), "dash_empty"), (("x", 5.0, 6.0), "small_num"), (("x", 5000.0, 6.0), "normal")]
    df = spark.createDataFrame([c for c, _ in cases], "item string, a double, b double")
    assert [r["t"] for r in df.select(tx.trap("item", ["a", "b"]).alias("t")).collect()] == [w for _, w in cases]


def test_spilled_columns_and_sides(spark):
    page = "ยอดรวม\nรวม\n  1,000\n  (2,000)\n  -\n  3,000\n 12"
    assert one(spark, tokens.spill_values(F.lit(page))) == [1000.0, -2000.0, 3000.0]  # a dash is no value, the page's own number neither
    assert one(spark, tokens.spill_values(F.lit("รวม\n1,000\n2,000"))) is None
    assert one(spark, tokens.spill_values(F.lit("ข้อความ\n1,000\n2,000\n3,000"))) is None


def test_value_columns(spark):
    pick = lambda cols, shares, short: one(spark, tokens.value_columns(F.array(*map(F.lit, cols)), F.array(*map(F.lit, shares)), F.lit(short)))
    assert pick([10, 20, 30, 40], [0.0] * 4, 1.0) == [10, 20, 30, 40]
    assert pick([5, 10, 20, 30, 40], [0.0, 0.0, 0.0, 0.0, 0.9], 0.9) == [10, 20, 30, 40]
    assert pick([1, 2, 3, 4, 5, 6], [0.9, 0.9, 0.1, 0.9, 0.9, 0.1], 0.0) == [1, 2, 4, 5]
    assert pick([1, 2, 3, 4, 5, 6], [0.9] * 6, 0.0) == [1, 3, 4, 6]
    assert pick([1, 2, 3, 4, 5], [0.9] * 5, 0.0) == [2, 3, 4, 5]


def test_small_text_functions(spark):
    assert one(spark, tx.company_of(F.lit("/a/FS_AIS-2025.pdf"), ["SCB", "AIS"])) == "AIS"
    assert one(spark, tx.company_of(F.lit("/scb/xaisx.pdf"), ["SCB", "AIS"])) is None
    assert one(spark, tx.component_label(F.lit("ทุน 1,234 5,678"))) == "ทุน"
    assert one(spark, tx.reattach_year(F.lit("ยอด 2568"), F.lit("ยอด"))) == "ยอด 2568"
    for given, wanted in [("1O,l00", "10,100"), ("lOO", "lOO"), ("(1,0O)", "(1,00)"), ("(,.)", "(,.)"), ("1กO", "1กO"), ("-1.O", "-1.0")]:
        assert one(spark, tx.normalise_digits(F.lit(given))) == wanted
    assert one(spark, tx.component_label(F.lit("หุ้น 5 บาท"))) == "หุ้น 5 บาท" and one(spark, tx.component_label(F.lit(" - 5"))) == "- 5"
    assert one(spark, tx.reattach_year(F.lit("ยอด 2568 (2567)"), F.lit("ยอด"))) == "ยอด 2568" and one(spark, tx.reattach_year(F.lit("ยอด 12568"), F.lit("ยอด"))) == "ยอด"
    assert one(spark, tx.same(F.lit(None).cast("double"), F.lit(None).cast("double"))) and not one(spark, tx.same(F.lit(1.0), F.lit(None).cast("double")))
    assert one(spark, tx.rounded(F.lit(0.0625), 3)) == 0.062
    assert one(spark, tx.failure_message(F.lit(1234.5), F.lit(2.0), F.lit("x"))) == "x: 1,234 != 2"
    assert one(spark, tx.failure_message(F.lit(5.0), F.lit(2000.0), F.lit("x"), F.lit("A"), F.lit("con_cur"))) == "A [con_cur] x: 5 != 2,000"


def test_adaptive_places_look_behind_a_parenthesis(spark):
    """(1,201,527,893) ends nine behind the column with its parenthesis and eight without."""
    tok = F.array(F.struct(F.lit(0).alias("start"), F.lit(49).alias("end"), F.lit("(1,201,527,893)").alias("tok")))
    got = one(spark, tokens.adaptive(tok, F.array(F.lit(40), F.lit(80))))
    assert [(h["idx"], h["value"]) for h in got] == [(0, -1201527893.0)]
    assert one(spark, tokens.adaptive(tok, F.array(F.lit(39), F.lit(80)))) == []


def test_rows_of_wide_tables(spark):
    line = "ยอด 5".ljust(20) + "1,000".rjust(10) + "-".rjust(10) + "(7)".rjust(10)
    df = spark.createDataFrame([(line,), ("2567".rjust(30) + "2568".rjust(10) + "2569".rjust(10),), ("14".rjust(30) + "15".rjust(10) + "16".rjust(10),), ("ข้อความ",)], "line string")
    got = [r["p"] for r in df.withColumn("toks", tokens.tokens("line")).select(tokens.matrix_row("line", "toks", F.array(*map(F.lit, (30, 40, 50)))).alias("p")).collect()]
    assert (got[0]["label"], got[0]["values"], got[0]["filled"], got[0]["data"]) == ("ยอด 5", [1000.0, None, -7.0], 3, True)
    assert got[1]["data"] is False and got[2]["data"] is True and got[3] is None  # years are a header, days are not


def test_common_characters_lose_no_match(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(5)
    words = list({"".join(rng.choice("กขคงจ") for _ in range(rng.randint(1, 12))) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "w string").withColumn("g", similarity.grams("w", 0.8))
    grams = {r["w"]: set(r["g"]) for r in df.collect()}
    for a in words:
        for b in words:
            if SequenceMatcher(None, a, b).ratio() >= 0.8:
                assert grams[a] & grams[b]
