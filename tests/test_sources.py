import pytest

from tabulon.sources import layout, tables
from tabulon.streaming.pages import classified, stream_pages


def test_layout_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "AIS-q1.txt").write_text("page one\fpage two", encoding="utf-8")
    (tmp_path / "in" / "other.txt").write_text("x", encoding="utf-8")
    got = layout.read_layout(spark, str(tmp_path / "in"))
    assert sorted((r["source"], r["page"], r["text"]) for r in got.collect()) == [("AIS-q1.txt", 1, "page one"), ("AIS-q1.txt", 2, "page two"), ("other.txt", 1, "x")]
    known = layout.known_sources(got, ["AIS"])
    assert {r["company"] for r in known.collect()} == {"AIS"}
    assert {r["company"] for r in layout.known_sources(got, ["AIS"], every=True).collect()} == {"AIS", "OTHER"}
    layout.write_layout(got, str(tmp_path / "out"))
    text = spark.createDataFrame([("007", 1, "a\nb"), ("007", 2, ""), ("x =%2F+ü.txt", 1, None), ("x =%2F+ü.txt", 2, "c\n")], "source string, page int, text string")
    layout.write_layout(text.union(got), str(tmp_path / "out"))
    back = sorted((r["source"], r["page"], r["text"]) for r in layout.read_layout(spark, str(tmp_path / "out")).collect())
    assert back == sorted([*((r["source"], r["page"], r["text"] or "") for r in text.collect()), *((r["source"], r["page"], r["text"]) for r in got.collect())])
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception):  # noqa: B017 - whatever the file system says
        layout.check_writable(spark, str(tmp_path / "file"))


def test_csv_keeps_text_and_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿item,company,con_cur,_note\n"a, b",TRUE,"(1,164)",nan\nc,TRUE,-,x\n', encoding="utf-8")
    got = tables.read_truth(spark, str(tmp_path / "t.csv")).orderBy("ordinal").collect()
    assert [r["company"] for r in got] == ["TRUE", "TRUE"] and [r["con_cur"] for r in got] == [-1164.0, None]
    assert got[0]["item"] == "a, b" and got[0]["_note"] is None and got[0]["section"] is None


def test_files_with_headers_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿company,item,con_cur\nA,x,1\nA,\"two\nlines\",2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("section,con_cur,company,item, trap \nS2,3,B,y,t\n", encoding="utf-8")
    got = {(r["company"], r["item"]): (r["con_cur"], r["section"], r["trap"], r["file"], r["ordinal"]) for r in tables.read_truth(spark, str(tmp_path)).collect()}
    assert got == {("A", "x"): (1.0, None, None, "a.csv", 0), ("A", "two\nlines"): (2.0, None, None, "a.csv", 1), ("B", "y"): (3.0, "S2", "t", "b.csv", 0)}


def test_csv_begins_with_a_mark(spark, tmp_path):
    tables.write_table(spark.range(2).coalesce(1), str(tmp_path / "c"), csv=True)
    (file,) = (tmp_path / "c").glob("part-*.csv")
    assert file.read_bytes().startswith("﻿id".encode()) and tables.read_csv(spark, str(tmp_path / "c"), "id long").count() == 2


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        tables.write_table(spark.range(0), str(tmp_path / "x"))
    tables.write_table(spark.range(3), str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3
    assert tables.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "x")]) == str(tmp_path / "x")
    with pytest.raises(FileNotFoundError):
        tables.first_existing(spark, [str(tmp_path / "no")])


def test_outside_tools_fail_softly():
    assert layout.run_text(["no-such-command-here"]) == ""
    assert layout.tool_hint("python3") is None and "missing" in layout.tool_hint("no-such-command-here")


def test_stream_of_pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("งบกระแสเงินสด\n" + "1,234 " * 20 + "\fหน่วย : บาท", encoding="utf-8")
    q = classified(stream_pages(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("pages_seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r["page"]: (r["kind"], r["unit"]) for r in spark.table("pages_seen").collect()}
    assert got == {1: ("CF", "unknown"), 2: (None, "baht")}
