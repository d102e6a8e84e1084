import hashlib
import random

import pytest
from pyspark.sql import functions as F

from inkfall.functions import text as T
from inkfall.operators import branches, evidence, fields, pages, reconcile, runs, search, validation
from inkfall.sources import files
from inkfall.sources.tei import coords, first_segment, tei_blocks, tei_passages, tei_year
from inkfall.streaming.incremental import new_files


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_normal_forms(spark):
    for text in ("ΟΔΟΣ  ﬁne", " Straße\t№ 5 ", "ǰ İzmir ẞ ΐ", "Ꭰꭰ ſ µ ϐ", "plain ASCII", ""):
        assert one(spark, T.fold_whitespace, text) == " ".join(text.casefold().split())
    assert one(spark, T.fold_aggressive, "Δοκιμή—ΝΈΟΣ (α’) ÉTÉ_1") == "δοκιμήνέοσ α été_1"
    assert one(spark, T.heal_lines, "one\ntwo\nThree") == "one two\nThree"
    assert one(spark, T.nfkc, "ﬁ ①") == "fi 1" and one(spark, T.nfc, "é  ﬁ") == "é ﬁ"
    assert one(spark, T.collapse, "") == ""
    assert one(spark, T.collapse, None) is None and one(spark, T.fold_whitespace, None) is None


def test_control_characters_part_no_words(spark):
    assert one(spark, T.clean_ocr, "ab\x01cd\ufffd e\nf\t\x0bg") == "abcd e f g"
    assert one(spark, T.without_control, "a\x00\tb\r\n") == "a\tb\r\n"
    assert one(spark, T.scanned_text, "ﬁrst\x02 line") == "first line"


def test_named_normalizers(spark):
    assert one(spark, T.normalizer("whitespace"), "A  B") == "a b"
    with pytest.raises(ValueError, match="no normalizer 'other'"):
        T.normalizer("other")


def test_years(spark):
    def year(*values):
        names = ("h", "m", "p", "n")
        row = spark.createDataFrame([values], ", ".join(f"{x} string" for x in names)).select(T.resolved_year(*[F.col(x) for x in names]).alias("y")).first()["y"]
        return tuple(row)

    assert year("2011-03", "D:2012", "2013", "a_2014.pdf") == ("2011", "h", "tei_header")
    assert year(None, "D:20120101", "2013", "a_2014.pdf") == ("2012", "h", "pdf_metadata")
    assert year("", "none", "in 2014", "a_2014.pdf") == ("2014", "h", "first_page_text")
    assert year(None, None, "in 2013", "a-2014.pdf") == ("2013", "m", "first_page_text")
    assert year(None, None, "x" * 2000 + "2013", "a2014b 1999.pdf") == ("1999", "m", "filename_pattern")
    assert year(None, None, None, "a2014b.pdf") == ("nr", "nr", "")


def test_block_kinds(spark):
    for text, kind in (("[3] Smith and", "other"), ("12 Smith", "other"), ("1.2 Study Design", "section"), ("  Results ", "section"), ("RESULTS of the: trial", "paragraph"), ("", "other"), (None, "other")):
        assert one(spark, lambda x: T.block_kind(F.lit(None).cast("string"), x), text) == kind, text
    assert one(spark, lambda x: T.block_kind(F.lit("table"), x), "Results") == "table"


def test_json_text(spark):
    assert one(spark, T.json_text, 'here:\n```json\n{"a": 1}\n``` ok') == '{"a": 1}'
    assert one(spark, T.json_text, 'so {"a": 1} it is') == '{"a": 1}'
    assert one(spark, T.json_text, " [1] ") == "[1]"


def test_noise(spark):
    for x in ("[12] Smith", "1. Smith", "see doi:10.1", "a@b.org", "— 42 —", "3.2 Study design"):
        assert one(spark, T.is_noise, x)
    assert not one(spark, T.is_noise, "Patients were enrolled.")


def test_similarity(spark):
    row = spark.createDataFrame([("abc", "abd"), ("", ""), ("", "a")], "a string, b string").select(T.similarity("a", "b").alias("s")).collect()
    assert [round(r.s, 4) for r in row] == [0.6667, 1.0, 0.0]


def test_greedy_budget_passes_over(spark):
    rows = [("P", f"S{i}", "x" * n, 0) for i, n in enumerate((4, 9, 2))]
    df = spark.createDataFrame(rows, "paper_id string, item_id string, item_text string, rank_score int")
    assert sorted(r.item_id for r in evidence.within_budget(df, 150, 7).collect()) == ["S0", "S2"]


def test_containing_range_is_end_exclusive(spark):
    ranges = spark.createDataFrame([("P", 0, 0, 5), ("P", 1, 7, 2000)], "paper_id string, range_index int, start int, end int")
    points = spark.createDataFrame([(1, "P", 0), (2, "P", 5), (3, "P", 1999), (4, "P", None), (5, "P", -1)], "id int, paper_id string, at int")
    assert {r.id: r.range_index for r in evidence.containing_range(points, ranges).collect()} == {1: 0, 3: 1}


def test_merge_conflict_and_agreement(spark):
    rows = [("P", 1, "a  b", "m", ["S2"]), ("P", 1, "a b", "h", ["S1"]), ("P", 2, "a", "l", None), ("P", 2, "b", "h", None), ("P", 3, "nr", "nr", [])]
    df = spark.createDataFrame(rows, "paper_id string, field_index int, extracted_value string, confidence string, loc array<string>")
    got = {r.field_index: (r.merged_value, r.merged_confidence, r.locations, r.conflict) for r in fields.merged(df).collect()}
    assert got == {1: ("a b", "h", "S1,S2", False), 2: (None, "nr", "", True), 3: ("nr", "nr", "", False)}


def test_page_stages(spark):
    rows = [("P", 0, "  ", 1, 0.0, 1.0), ("P", 1, "word " * 60, 1, 0.9, 1.0), ("Q", 0, "word " * 60, 1, 0.1, 1.0)]
    df = spark.createDataFrame(rows, "paper_id string, page_index int, page_text string, font_count int, image_area double, page_area double")
    got = {(r.paper_id, r.page_index): r.reason for r in pages.route_pages(pages.classify_pages(df)).collect()}
    assert got == {("P", 0): "stage_1_empty_text", ("P", 1): "stages_5", ("Q", 0): "all_native"}


def test_nearest_ties_take_the_lower_id(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0])], "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in search.nearest(df, df.filter("vec_id = 0")).collect()] == [1]


TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt><sourceDesc><biblStruct><monogr><imprint><date when="2012-05"/></imprint></monogr></biblStruct></sourceDesc></fileDesc>
<profileDesc><abstract><p coords="1;1,2,3,4">A</p></abstract></profileDesc></teiHeader><text><body><div><head>H</head><p coords="2;10,20,30,40"><s coords="3;1,1,2,2">P one.</s><s>P two. <formula>x</formula></s></p><formula>E</formula>
<note place="foot">N</note><note>M</note><figure coords="4;0,0,1,1"><figDesc>F</figDesc><p>in</p></figure></div></body><back><div type="funding"><p>G</p><p>g</p></div><div type="other"><p>O</p></div>
<listBibl><biblStruct><analytic><title>Study</title><author><persName><surname>Meyer</surname></persName></author><author><persName><surname>Ruiz</surname></persName></author></analytic><monogr><title>Journal</title><imprint><date type="published" when="2009"/></imprint></monogr></biblStruct>
<biblStruct><note type="raw_reference">As it  was cited</note></biblStruct></listBibl></back></text></TEI>"""


def test_tei(spark):
    df = spark.createDataFrame([("a", TEI), ("b", "<bad"), ("c", None)], "doc_id string, tei_xml string")
    rows = sorted(tei_blocks(df).collect(), key=lambda r: r.block_index)
    want = [("title", "T"), ("paragraph", "A")] if rows[1].block_type == "paragraph" else [("title", "T"), ("abstract", "A")]
    want += [("section", "H"), ("paragraph", "P one.P two. x"), ("formula", "E"), ("note", "N"), ("figure", "F"), ("funding", "Gg"), ("reference", "Meyer Ruiz Study (2009)"), ("reference", "As it was cited")]
    assert [(r.block_type, r.text) for r in rows] == want
    got = sorted((r.doc_id, r.block_index, r.page_index, r.text) for r in tei_passages(df).collect())
    assert [(p, t) for d, _, p, t in got if d == "a"] == [(0, "A"), (2, "P one."), (1, "P two. x"), (3, "F"), (0, "H")]
    assert [(p, t) for d, _, p, t in got if d == "b"] == [(0, "<bad")]
    assert {r.doc_id: r.y for r in df.select("doc_id", tei_year("tei_xml").alias("y")).collect()} == {"a": "2012", "b": "", "c": ""}


def test_coords(spark):
    texts = ["1;10,20,30,40", "2;10,20,30,40 2;5,25,20,60 3;0,0,99,99", "1;10,20,30", "1;10,20,30,40 x", "1,10,20,30,40", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select(coords(F.col("x")).alias("c"), first_segment(F.col("x")).alias("f")).collect()
    assert [r.c and (r.c.page_index, r.c.bbox) for r in rows] == [(0, [10.0, 20.0, 30.0, 40.0]), (1, [5.0, 20.0, 30.0, 60.0]), None, None, None, None, None]
    assert (rows[3].f.page, rows[3].f.coords) == (1, [10.0, 20.0, 30.0, 40.0]) and rows[2].f.page is None


def test_files(spark, tmp_path):
    for name, data in (("in/b.pdf", b"%PDF-1"), ("in/sub/a.PDF", b"%PDF-22"), ("in/z/b.pdf", b"%PDF-333"), ("in/c.pdf", b"no"), ("in/d.pdf", b""), ("none/x.txt", b"x")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    rows = files.pdf_files(spark, f"{tmp_path}/in").collect()
    assert [(r.name, r.length) for r in rows] == [("a.PDF", 7), ("b.pdf", 8)] and len({r.id for r in rows}) == 2
    assert {(r.path[-5:], r.reason) for r in files.rejected_files(spark, f"{tmp_path}/in").collect()} == {("c.pdf", "not_a_pdf")}
    with pytest.raises(ValueError, match="is no PDF"):
        files.pdf_files(spark, f"{tmp_path}/none/x.txt")
    with pytest.raises(FileNotFoundError):
        files.pdf_files(spark, f"{tmp_path}/none")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None), (3, "x")], "record_id int, v string")
    errors = spark.createDataFrame([(2, "v"), (1, "")], "record_id int, errors string")
    good, bad = files.save_checked(df, errors, f"{tmp_path}/s")
    assert sorted(r.record_id for r in spark.read.json(good).collect()) == [1, 3]
    assert [(r.record_id, r.status) for r in spark.read.json(bad).collect()] == [(2, "failed_schema_validation")]
    files.write_csv(df, f"{tmp_path}/c", one_file=True)
    assert spark.read.option("header", "true").option("escape", '"').csv(f"{tmp_path}/c").filter("record_id = 1").first()["v"] == 'a "b", c'
    files.write_json(df, f"{tmp_path}/j", "record_id")
    assert spark.read.json(f"{tmp_path}/j").count() == 3
    rows = files.canonical(df, "record_id").orderBy("key").collect()
    assert rows[1].content == '{"record_id":2,"v":null}' and rows[1].id == hashlib.sha256(rows[1].content.encode()).hexdigest()
    log = files.response_log(df.withColumnRenamed("v", "raw"), most=3).orderBy("record_id").first()
    assert (log.preview, log.n_chars) == ('a "', 8)
    have, make = files.cached(df.selectExpr("record_id as digest"), spark.createDataFrame([(1, "k"), (1, "k")], "digest int, kept string"))
    assert [tuple(r) for r in have.collect()] == [(1, "k")] and sorted(r.digest for r in make.collect()) == [2, 3]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "p.extracted.json").write_text('[{"i": 1, "v": "a"}, {"i": 2, "v": "b"}]')
    (tmp_path / "r" / "q.extracted.json").write_text('{"i": 3, "v": "c"}')
    assert sorted(r.i for r in files.json_results(spark, f"{tmp_path}/r", "i int, v string").collect()) == [1, 2, 3]


def test_agreement_takes_the_best_that_is_free(spark):
    a = ["alpha beta gamma", "one two three four", "alpha beta gamma", "nothing alike"]
    b = ["alpha beta gamma", "one two three fear", "one two three fou", "alpha beta gamme", ""]
    df = lambda x: spark.createDataFrame([("P", i, s) for i, s in enumerate(x)], "paper_id string, ord int, sentence string")
    r = branches.near_agreement(df(a), df(b)).first()
    assert (r.n_primary, r.n_candidate, r.n_exact, r.n_near, r.agreement_rate) == (4, 5, 1, 2, 0.75)
    assert branches.near_agreement(df([]), df(b)).first().agreement_rate == 0.0 and branches.near_agreement(df([]), df([])).count() == 0


def test_alignment(spark):
    rows = [("P", "paragraph", 1, "same text", "same text"), ("P", "paragraph", 2, "abcdefghijklmnopqrst", "abcdefghijklmnopqrsx"), ("P", "paragraph", 3, "abc", "xyz"), ("P", "section", 1, "Methods", "Methods"), ("P", "table_figure", 1, "", "spatial")]
    df = spark.createDataFrame([(*r, 6.0 if r[1] == "section" else 10.0) for r in rows], "paper_id string, kind string, place int, primary_text string, secondary_text string, font_size double")
    got = {(r.kind, r.place): r for r in reconcile.aligned(df).collect()}
    assert [got["paragraph", k].agreement for k in (1, 2, 3)] == ["full", "partial", "divergent"]
    assert abs(got["section", 1].confidence - 0.6) < 1e-9 and got["section", 1].agreement == "partial"
    assert got["table_figure", 1].preferred_reading == "spatial" and got["table_figure", 1].confidence == 1.0
    best = {r.source: (r.place, r.rationale) for r in reconcile.best_of(reconcile.aligned(df)).collect()}
    assert best["text_fidelity"] == (1, "least edit distance: 0.000") and best["section_verification"] == (1, "highest confidence: 0.600")


def test_chunk_outputs(spark):
    ok = '{"i": 1, "v": "x", "loc": ["S000001"], "c": "h"}'
    raws = {
        1: f"[{ok}]", 2: f'Sure:\n```json\n{{"items": [{ok}]}}\n```', 3: "[1, 2", 4: f"[{ok}, {ok}]", 5: "[7]", 6: '[{"i": 1, "v": "x", "c": "h"}]', 7: '[{"i": 1, "v": "x", "loc": [], "c": "h", "z": 1}]',
        8: ok.replace('"h"', '"H"').join("[]"), 9: ok.replace('1,', '"1",', 1).join("[]"), 10: ok.replace('["S000001"]', "[3]").join("[]"), 11: ok.replace("S000001", "S9").join("[]"), 12: ok.replace('"i": 1', '"i": 2').join("[]"), 13: ok.replace('"x"', "5").replace('["S000001"]', "[]").join("[]"), 14: None, 15: "{}",
    }
    outputs = spark.createDataFrame([("P", k, r) for k, r in raws.items()], "paper_id string, chunk int, raw string")
    expected = spark.createDataFrame([("P", k, 1) for k in raws], "paper_id string, chunk int, field_index int")
    got = {r.chunk: r.error for r in validation.chunk_errors(outputs, expected, spark.createDataFrame([("P", "S000001")], "paper_id string, item_id string")).collect()}
    assert got == {1: None, 2: None, 3: "parse", 4: "count", 5: "0:no_object", 6: "0:missing_keys", 7: "0:unexpected_keys", 8: "0:confidence", 9: "0:index", 10: "0:locations", 11: "0:unknown_location", 12: "indices", 13: None, 14: "parse", 15: "parse"}


def test_unknown_fields_and_domains_are_errors(spark):
    compact = spark.createDataFrame([(1, "P", 99, "v", ["S1"], "h")], "key int, paper_id string, i int, v string, loc array<string>, c string")
    fields_ = spark.createDataFrame([(1, "1. A", "n")], "field_index int, domain_group string, field_name string")
    with pytest.raises(Exception, match="no field 99"):
        validation.reconstructed(compact, fields_, spark.createDataFrame([("P", "S1", "t")], "paper_id string, item_id string, item_text string")).collect()
    with pytest.raises(Exception, match="no domain 14. Z"):
        runs.chunk_ranges(fields_.withColumn("domain_group", F.lit("14. Z"))).collect()


def test_schema_messages(spark):
    rows = spark.createDataFrame([(0, "", ["S1", "x"], "q"), (7, None, None, "h"), (3, "ok", [], "h")], "n int, name string, loc array<string>, c string")
    schema = {"required": ["name", "gone"], "properties": {"n": {"type": "integer", "minimum": 1, "maximum": 5}, "name": {"type": "string", "minLength": 1, "pattern": "^o"}, "loc": {"type": "array", "items": {"enum": ["S1"]}}, "c": {"type": "number", "enum": ["h"]}}}
    got = [[m.split("$.")[1] for m in r.m] for r in rows.select(validation.schema_messages(rows, schema).alias("m")).collect()]
    assert got == [["gone | is required", "c | is no number", "loc | has an item that is none of the values", "n | is less than 1", "name | is too short", "name | does not match"], ["name | is required", "gone | is required", "c | is no number", "n | is more than 5"], ["gone | is required", "c | is no number"]]


def test_budget_choice_is_that_of_the_plain_loop(spark):
    rng = random.Random(2)
    rows = [(f"P{p}", f"S{i:03}", None if i % 17 == 3 else "x" * rng.choice((0, 1, 3, 3, 5, 8, 40)), rng.randrange(4)) for p in range(6) for i in range(60)]
    df = spark.createDataFrame(rows, "paper_id string, item_id string, item_text string, rank_score int")
    for items, chars in ((150, 30), (7, 100), (5, 4)):
        want = set()
        for p in range(6):
            used = n = 0
            for _, i, t, _ in sorted((r for r in rows if r[0] == f"P{p}"), key=lambda r: (-r[3], r[1])):
                if n < items and used + len(t or "") <= chars:
                    used, n = used + len(t or ""), n + 1
                    want.add((f"P{p}", i))
        assert {(r.paper_id, r.item_id) for r in evidence.within_budget(df, items, chars).collect()} == want


def test_needles_in_blocks(spark):
    reports = spark.createDataFrame([(1, "P", "a", "The  Quick—brown fox JUMPS over it."), (2, "P", "b", None), (3, None, "a", "x")], "report_id int, paper_id string, source string, full_pdf_text string")
    checks = [(k, "P", "a", n) for k, n in enumerate(("quick—brown fox", "quickbrown, fox", "short", "", None, "no such thing here", "THE QUICK—BROWN"))] + [(90, "P", "b", "quick—brown fox"), (91, None, "a", "quick—brown fox"), (92, "Q", "a", "quick—brown fox"), (0, "P", "a", "quick—brown fox")]
    df = spark.createDataFrame(checks, "check_id int, paper_id string, source string, needle string")
    for block in (1, 2, 500):
        got = {r.check_id: r.confidence for r in search.lexical_checks(df, reports, block=block).collect()}
        assert got == {0: 1.0, 1: 0.9, 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0, 6: 1.0, 90: 0.0, 91: 0.0, 92: 0.0}


def test_nearest_in_blocks(spark):
    rng = random.Random(3)
    vec = [(i, [float(rng.randrange(-3, 4)) for _ in range(4)]) for i in range(60)] + [(99, None), (5, None)]
    df = spark.createDataFrame(vec, "vec_id bigint, embedding array<float>").filter("vec_id <> 5 or embedding is not null")
    known = {i: e for i, e in vec if e}
    want = {q: max((sum(a * b for a, b in zip(known[q], e, strict=True)), -i) for i, e in known.items() if i != q) for q in range(0, 60, 7)}
    for block in (3, 1000):
        got = {r.query_id: (r.score, -r.vec_id) for r in search.nearest(df, df.filter("vec_id % 7 = 0 and vec_id < 60"), block).collect()}
        assert got == want
    assert search.nearest(df.limit(0), df).count() == 0 and search.nearest(df.filter("vec_id = 1"), df.filter("vec_id = 1")).count() == 0


def test_only_new_files(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        new_files(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/out", f"{tmp_path}/check")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
