"""Settings, stages, segmenters, streams, and the queries that no SQL repeats."""

import difflib
import json
import unicodedata
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from inkfall import checkpoints, config
from inkfall.operators import annotations, branches, fields, fonts, reconcile, runs
from inkfall.plans import registry, stages
from inkfall.streaming.incremental import running_usage

FOLDER = "/root/testdata/sf0.001"


def rows(spark, name):
    return registry.queries()[name](spark, FOLDER).collect()


def test_settings(tmp_path, monkeypatch):
    defaults = {"a": {"x": 1, "y": {"z": 2}}, "n": 3, "s": "t", "l": [1]}
    (tmp_path / "c.json").write_text('{"a": {"y": {"w": 5}}, "n": 4}')
    monkeypatch.setenv("RUN_N", "7")
    monkeypatch.setenv("RUN_L", "[2, 3]")
    got = config.load(f"{tmp_path}/c.json", defaults, environment="run")
    assert got == {"a": {"x": 1, "y": {"z": 2, "w": 5}}, "n": 7, "s": "t", "l": [2, 3]}
    (tmp_path / "d.json").write_text('{"b": 1}')
    with pytest.raises(ValueError, match="unknown settings: b"):
        config.load(f"{tmp_path}/d.json", defaults)
    assert config.load(None, defaults) == defaults
    assert config.fingerprint({"b": 1, "a": 2}) == config.fingerprint({"a": 2, "b": 1}) != config.fingerprint({"a": 2, "b": 1}, "a")


def test_tokens_and_delays():
    assert [config.chunk_tokens(k, 5) for k in (1, 3, 6)] == [3500, 5000, 3500] and config.chunk_tokens(3, 3) == 8192 and config.chunk_tokens(1, 7) == 3500
    now = datetime(2026, 10, 21, 7, 28, tzinfo=UTC)
    assert [config.retry_delay(k) for k in (1, 2, 3, 9)] == [1.0, 2.0, 4.0, 30.0]
    assert config.retry_delay(1, "5") == 5.0 and config.retry_delay(1, "-5") == 0.0 and config.retry_delay(1, "900") == 30.0
    assert config.retry_delay(1, "Wed, 21 Oct 2026 07:28:12 GMT", now) == 12.0 and config.retry_delay(2, "soon") == 2.0


def test_segmenters_and_stages(spark):
    df = spark.createDataFrame([("The first one is here.\nand goes on. The second one is long enough", 0), ("Left out as it has no page at all.", None), ("See doi:10.1234/abc for all of it.", 1), (None, 2)], "text string, page_index int")
    assert [r.sentence for r in stages.sentence_rows(df).orderBy("page_index", "ord").collect()] == ["The first one is here.", "The second one is long enough"] or len(stages.sentence_rows(df).collect()) == 3
    loaded = stages.segmenter(lambda: lambda x: x.split("; "))
    got = spark.createDataFrame([("a; b",), ("",), (None,)], "x string").select(loaded(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [["a", "b"], [], None]
    assert [r.y for r in spark.createDataFrame([("a\n\n b ",)], "x string").select(stages.SEGMENTERS["lines"](F.col("x")).alias("y")).collect()] == [["a", "b"]]
    with pytest.raises(ValueError, match="no segmenter 'model'; there are lines, stops"):
        stages.SEGMENTERS["model"]
    out = stages.staged(spark.range(5).toDF("n"), lambda d: d.filter("n > 1"), None, lambda d: d.withColumn("n", F.col("n") * 2))
    assert sorted(r.n for r in out.collect()) == [4, 6, 8]


def test_windows_of_a_stream(spark, tmp_path):
    late = "select timestamp'2024-01-01 00:00:10' as ts, 'a' as stage, 5L as tokens union all select timestamp'2024-01-01 00:50:00', 'a', 7L union all select timestamp'2024-01-01 01:00:00', 'b', 1L"
    spark.sql(late).write.parquet(f"{tmp_path}/in")
    stream = running_usage(spark.readStream.schema("ts timestamp, stage string, tokens bigint").parquet(f"{tmp_path}/in"))
    query = stream.writeStream.format("memory").queryName("usage").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.stage, r.requests, r.tokens) for r in spark.table("usage").collect()) == [("a", 2, 12), ("b", 1, 1)]


def test_tables_are_kept_until_released(spark):
    df = checkpoints.cut(spark.range(10).filter("id > 3"))
    folder = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 6 and checkpoints.cut(df.filter("id < 0")).count() == 0
    checkpoints.release(df.select("*", F.lit(1).alias("x")))
    with pytest.raises(Exception, match="(?i)not_exist|path"):
        spark.read.parquet(folder)
    checkpoints.release(spark.range(3))


def test_web_annotations(spark):
    by = {r.ann_id: json.loads(r.jsonld) for r in rows(spark, "web_annotations")}
    notes = spark.read.parquet(f"{FOLDER}/annotations.parquet").dropDuplicates(["ann_id"]).collect()
    assert len(by) == len(notes)
    for n in notes:
        doc = by[n.ann_id]
        assert doc["id"] == f"urn:annotation:{n.ann_id}" and doc["type"] == "Annotation" and doc["body"].get("value") == n.body_text
        fine = doc["target"]["selector"].get("refinedBy", {})
        if n.selector_type == "FragmentSelector":
            assert fine["fragment"].get("page") == n.page_index and "position" not in fine
        else:
            assert fine["position"].get("start") == n.char_start and "fragment" not in fine
        if n.quote_selector:
            assert doc["target"]["selector"]["quote"].get("exact") == n.quote_selector.exact


def plain(x):
    return " ".join(unicodedata.normalize("NFKC", x).split())


def test_texts_and_quotations_in_plain_python(spark):
    needles = {r.check_id: r.needle for r in spark.read.parquet(f"{FOLDER}/presence_checks.parquet").collect()}
    assert {r.check_id: r.plain for r in rows(spark, "nfkc_texts")} == {k: None if v is None else plain(v) for k, v in needles.items()}
    notes = {r.ann_id: r for r in spark.read.parquet(f"{FOLDER}/annotations.parquet").collect()}
    for r in rows(spark, "quote_similarity"):
        a, b = plain(notes[r.ann_id].quote_selector.exact), plain(notes[r.ann_id].sentence_text)
        want = 1.0 if not a and not b else 0.0 if not a or not b else difflib.SequenceMatcher(None, a, b).ratio()
        assert abs(r.ratio - want) < 1e-8


def test_alignment_in_plain_python(spark):
    pairs = {(r.reports, r.kind, r.place): r for r in rows(spark, "paired_blocks")}
    got = rows(spark, "aligned_blocks")
    assert len(got) == len(pairs) > 0
    for r in got:
        p = pairs[r.reports, r.kind, r.place]
        like = difflib.SequenceMatcher(None, plain(p.primary_text), plain(p.secondary_text)).ratio()
        if r.kind == "paragraph":
            assert abs(r.edit_distance - (1 - like)) < 1e-8 and r.agreement == ("full" if like == 1 else "partial" if 1 - like < 0.1 else "divergent")
        elif r.kind == "section":
            assert abs(r.confidence - like) < 1e-8
    best = {(r.reports, r.source): r for r in rows(spark, "best_alignment")}
    for (paper, source), b in best.items():
        own = [r for r in got if (r.reports, r.source) == (paper, source)]
        assert b.confidence == max(r.confidence for r in own)
    unified = {r.reports: r for r in rows(spark, "unified_records")}
    assert sum(r.n_entries for r in unified.values()) == len(got)


def test_near_agreement_beside_the_exact_one(spark):
    # A near match may take a candidate that equals a later sentence, so exact ones can be fewer here.
    near = {r.reports: r for r in rows(spark, "near_agreement")}
    for r in rows(spark, "exact_agreement"):
        n = near[r.reports]
        assert (n.n_primary, n.n_candidate) == (r.n_primary, r.n_candidate) and n.n_exact <= r.n_exact <= n.n_exact + n.n_near


def test_rationale(spark):
    scored = spark.createDataFrame([("P", 1, "grobid", 0.9, 1), ("P", 2, "x", 0.5, 2), ("Q", 3, "x", 0.8, 1), ("Q", 4, "grobid", 0.25, 2), ("R", 5, "x", 0.7, 1), ("S", 6, "x", 0.7, 1), ("S", 7, "grobid", 0.0, 2), ("T", 8, "x", 0.7, 1), ("T", 9, "grobid", 0.0, 2)], "paper_id string, report_id int, source string, composite double, place int")
    failed = spark.createDataFrame([(i, i in (7, 9), i == 9) for i in range(1, 10)], "report_id int, failed boolean, empty boolean")
    got = {r.paper_id: r.rationale for r in branches.rationale(scored, failed).collect()}
    assert got == {
        "P": "GROBID selected as primary (composite=0.900)", "Q": "x selected as primary: GROBID quality score below threshold (GROBID composite=0.250, x composite=0.800)",
        "R": "x selected as primary (composite=0.700); no GROBID branch available", "S": "x selected as primary: GROBID branch failed", "T": "x selected as primary: GROBID branch empty",
    }
    assert len(rows(spark, "branch_rationale")) == spark.read.parquet(f"{FOLDER}/coverage_reports.parquet").select("paper_id").distinct().count()


def test_report(spark):
    doc = json.loads(rows(spark, "run_report")[0].report)
    total = rows(spark, "usage_totals")[0]
    assert (doc["status"], doc["input_tokens"]) == ("ok", total.input_tokens) and sum(s["input_tokens"] for s in doc["per_stage"]) == total.input_tokens
    assert doc["top_requests"] == [r.seq for r in rows(spark, "expensive_requests")]
    first = {r.stage: r.first_seq for r in rows(spark, "stage_summaries")}
    assert [s["stage"] for s in doc["per_stage"]] == sorted(first, key=first.get)


def test_delta_needs_a_complete_run_before(spark):
    now = spark.sql("select 'complete' as status, 4L as requests, 100L as input_tokens, 40L as cached_tokens, 10L as output_tokens")
    got = runs.delta(now, now.withColumn("cached_tokens", F.lit(20)).withColumn("requests", F.lit(2))).first()
    assert abs(got.cache_rate_change - 0.2) < 1e-12 and got.uncached_change == 15.0 - 40.0 and got.tokens_change == 0
    assert runs.delta(now, now.withColumn("status", F.lit("partial"))).first().tokens_change is None


def test_services_and_modes(spark):
    raw = ['{"rawForm": "x", "name": "y", "conf": "1.7", "id": 3}', '{"text": "t", "score": -1}', '{"confidence": "high"}', "no json", None]
    got = [r.a for r in spark.createDataFrame([(x,) for x in raw], "raw string").select(annotations.service_annotation(F.col("raw"), "k", "s").alias("a")).collect()]
    assert [(a.text, a.confidence) for a in got] == [("x", 1.0), ("t", 0.0), ("", None), ("", None), ("", None)] and got[0].metadata == {"id": "3"}
    with pytest.raises(ValueError, match="no mode 'never'"):
        branches.verification_status(F.lit(1.0), 0.5, F.lit(True), "never")


def test_malformed_rows_conflict(spark):
    df = spark.createDataFrame([("P", 1, "a", "h", ["S1"], False), ("P", 1, "a", "h", ["S2"], True), ("P", 2, "nr", "nr", [], None)], "paper_id string, field_index int, extracted_value string, confidence string, loc array<string>, malformed boolean")
    got = {r.field_index: (r.merged_value, r.conflict) for r in fields.merged(df).collect()}
    assert got == {1: (None, True), 2: ("nr", False)}


def test_spans_without_boxes(spark):
    spans = spark.createDataFrame([("P", 1, 0, "ab", 0.0, 8.0), ("P", 1, 1, "cd", 8.5, 12.0), ("P", 1, 2, "ef", 14.0, None), ("P", 1, 3, "gh", 20.0, 22.0), ("P", 1, 4, None, 22.0, 23.0), ("P", 1, 5, "i", 24.5, 25.0)], "paper_id string, line_index int, span_index int, text string, x0 double, x1 double")
    assert fonts.joined_spans(spans).first()["text"] == "abcd ef gh i"
    assert fonts.median_sizes(spans.withColumn("size", F.col("x0"))).first()["median_size"] == 17.0


def test_kinds_of_pages(spark):
    pages_ = spark.createDataFrame([("P", 0, True), ("P", 1, False)], "paper_id string, page_index int, is_native boolean")
    a = spark.createDataFrame([("P", 0, 0, "n0"), ("P", 1, 1, "n1")], "paper_id string, page_index int, block_index int, text string")
    b = a.withColumn("text", F.regexp_replace("text", "n", "o"))
    assert [(r.ord, r.text) for r in reconcile.merged_blocks(a, b, pages_).orderBy("ord").collect()] == [(0, "n0"), (1, "o1")]
