from datetime import datetime

import pytest
from pyspark.sql import functions as F

from inkfall.llm import splitting, survivorship

ITEMS = "paper_id string, item_id string, stage string, item_text string, piece_text string"
LIMITS = "stage string, item_limit int, overlap_tokens int"


def pieces(spark, rows, limits=(("s", 10, 2),)):
    df = splitting.split_oversized(spark.createDataFrame(rows, ITEMS), spark.createDataFrame(list(limits), LIMITS))
    return sorted(df.collect(), key=lambda r: (r.item_id, r.piece_index))


def test_round_trip_limits_and_overlap(spark):
    texts = ["One two three. " * 30, "字" * 500, "x" * 1000, "a\n\nb c, d. " * 40, "é" * 300, "word " * 5000]
    rows = pieces(spark, [("P", f"{i}", "s", t, "clash") for i, t in enumerate(texts)])
    for i, t in enumerate(texts):
        own = [r for r in rows if r.item_id == f"{i}"]
        assert len(own) > 1 and own[0].char_start == 0 and own[-1].char_end == len(t)
        assert all(r.piece_text == t[r.char_start : r.char_end] and r.piece_tokens <= 10 for r in own)
        assert all(a.char_end - b.char_start == 8 for a, b in zip(own, own[1:], strict=False))


def test_overlaps_below_and_above_half_the_limit(spark):
    for over in (4, 5, 6, 9):
        own = pieces(spark, [("P", "1", "s", "One two three, four. " * 40, None)], (("s", 10, over),))
        assert all(a.char_end - b.char_start == min(4 * over, a.char_end) for a, b in zip(own, own[1:], strict=False))
        assert own[-1].char_end == 840 and all(r.piece_tokens <= 10 for r in own)
    with pytest.raises(Exception, match="an overlap of 10 tokens does not go with a limit of 10"):
        pieces(spark, [("P", "1", "s", "x" * 99, None)], (("s", 10, 10),))


def test_running_sums(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 2, 3, 10, 101)], "x array<int>")
    got = [r.y for r in df.select(splitting._running(F.col("x")).alias("y")).collect()]
    assert got == [[sum(range(i + 1)) for i in range(n)] for n in (0, 1, 2, 3, 10, 101)]


def test_cuts_at_sentences(spark):
    rows = pieces(spark, [("P", "1", "s", "Twenty five letters here. And then some more text.", None)])
    assert rows[0].piece_text == "Twenty five letters here. "


def test_defined_for_odd_rows(spark):
    rows = pieces(spark, [("P", "1", "s", None, None), ("P", "2", "s", "", None), ("P", "3", None, "x" * 99, None), ("P", "4", "t", "x" * 99, None), ("P", "5", "s", "x" * 43, None), ("P", "5", "s", "x" * 43, None)])
    assert [(r.item_id, r.n_pieces, r.piece_text) for r in rows[:2]] == [("1", 1, None), ("2", 1, "")]
    assert len(rows) == 6 and all(r.n_pieces == 1 for r in rows)
    assert pieces(spark, []) == []


def survivors(spark, rows):
    df = spark.createDataFrame(rows, "record_id bigint, k string, v string, c string, at timestamp, value string")
    out = survivorship.surviving(df, ["k"], {"v": survivorship.has_value(F.col("v"))}, survivorship.trust_rank(F.col("c")), F.col("at"), F.col("record_id"))
    return {r.k: (r.first_record_id, r.v and (r.v.value, r.v.record_id), r.several) for r in out.collect()}


def test_trust_then_time_then_id(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, "a", "x", "low", b, "z"), (2, "a", "y", "H ", a, "z"), (3, "b", "x", "m", a, "z"), (4, "b", "y", "m", b, "z"), (6, "c", "y", "m", b, "z"), (5, "c", "x", "m", b, "z")]
    rows += [(7, "d", "NR", "h", b, "z"), (8, "d", None, None, None, "z"), (9, "e", "x", "h", None, "z"), (9, "e", "x", "h", None, "z"), (10, None, "x", "h", a, "z")]
    assert survivors(spark, rows) == {"a": (1, ("y", 2), True), "b": (3, ("y", 4), True), "c": (5, ("x", 5), True), "d": (7, None, True), "e": (9, ("x", 9), False)}
    assert survivors(spark, []) == {}


def test_ids_of_any_kind_and_papers_by_file(spark, monkeypatch):
    a = datetime(2024, 1, 1)
    df = spark.createDataFrame([("r2", "a", "x", "m", a), ("r1", "a", "y", "m", a), ("r3", "a", "z", "l", a)], "record_id string, k string, v string, c string, at timestamp")
    r = survivorship.surviving(df, ["k"], {"v": F.lit(True)}, survivorship.trust_rank(F.col("c")), F.col("at"), F.col("record_id")).first()
    assert (r.first_record_id, r.v.value, r.v.record_id, r.several) == ("r1", "y", "r1", True)
    papers = spark.createDataFrame([("P1", "Aa_1.pdf"), ("P0", "aa 1.PDF"), ("P2", "b.pdf"), ("P3", None)], "paper_id string, source_pdf string")
    rows = spark.createDataFrame([(1, None, "x/aa-1.pdf", "k"), (2, "P9", "b.pdf", "k"), (3, None, "zz.pdf", "k"), (4, None, None, "k"), (1, None, "x/aa-1.pdf", "k")], "record_id int, paper_id string, source_pdf string, _paper string")
    for small in (500_000, 0):
        monkeypatch.setattr(survivorship, "SMALL", small)
        got = sorted((r.record_id, r.paper_id or "") for r in survivorship.with_paper(rows.drop("_paper"), papers).collect())
        assert got == [(1, "P0"), (1, "P0"), (2, "P9"), (3, ""), (4, "")]


def test_no_value_in_many_ways(spark):
    rows = ["nr", "N.A.", "n/a", "Not stated.", "—", "-", "?", "", " ", "null", "not reported", "0", "narrow", "none at all"]
    got = spark.createDataFrame([(x,) for x in rows], "x string").select(survivorship.has_value(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [False] * 11 + [True] * 3


def test_file_keys(spark):
    names = ["Narv_2016_01.pdf", "NARV_2016_01", "inbox/narv-2016-01 (1).pdf", "uploads\\Narv 2016 01.PDF", "Narv%202016%2001.pdf", "narv.2016.01.pdf?download=1", " Narv_2016_01 - Copy.pdf "]
    got = spark.createDataFrame([(x,) for x in names], "x string").select(survivorship.file_key(F.col("x")).alias("y")).collect()
    assert {r.y for r in got} == {"narv_2016_01"}
