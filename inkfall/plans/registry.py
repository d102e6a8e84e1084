"""Named queries over the run's tables and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfall.functions import text as T
from inkfall.operators import annotations, branches, budget, coverage, evidence, fields, fonts, pages, reconcile, runs, search, validation
from inkfall.plans import stages
from inkfall.plans.oracles import ORACLE_SQL
from inkfall.sources import files
from inkfall.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    _ALL[fn.__name__] = fn
    return fn


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.unique_items(table(spark, folder, "evidence_items"))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "field_records").dropDuplicates(["record_id"])


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    blocks = _items(spark, folder).select("paper_id", F.col("item_text").alias("text"), (F.col("coords").isNotNull() | F.col("page").isNotNull()).alias("located"))
    return coverage.coverage_metrics(table(spark, folder, "coverage_reports"), blocks)


@query
def coverage_metrics(spark, folder):
    return _metrics(spark, folder).withColumn("computed_value", F.round("computed_value", 9))


@query
def branch_status(spark, folder):
    return coverage.borderline(_metrics(spark, folder))


@query
def adjudicated(spark, folder):
    return branches.adjudicated(table(spark, folder, "coverage_reports"))


@query
def pairwise_agreement(spark, folder):
    return branches.pairwise_agreement(table(spark, folder, "coverage_reports"))


@query
def branch_scores(spark, folder):
    return branches.branch_scores(table(spark, folder, "coverage_reports"), table(spark, folder, "papers"))


def _sentences(spark: SparkSession, folder: str) -> DataFrame:
    """The sentences of every report: cut from its text by stops."""
    rows = table(spark, folder, "coverage_reports").filter(F.col("full_pdf_text").isNotNull())
    return rows.select("report_id", F.posexplode(T.sentences(F.col("full_pdf_text"))).alias("ord", "s")).select("report_id", "ord", T.collapse(F.col("s")).alias("sentence"))


def _both(spark: SparkSession, folder: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of reports as those of either side of every two reports of a paper; ``paper_id`` is the pair, smaller report first."""
    r = table(spark, folder, "coverage_reports").filter("full_pdf_text is not null").select("paper_id", "report_id")
    pairs = r.alias("a").join(r.alias("b"), (F.col("a.paper_id") == F.col("b.paper_id")) & (F.col("a.report_id") < F.col("b.report_id")))
    pairs = pairs.select(F.concat_ws("|", "a.report_id", "b.report_id").alias("paper_id"), F.col("a.report_id").alias("a"), F.col("b.report_id").alias("b"))
    side = lambda c: pairs.select("paper_id", F.col(c).alias("report_id")).join(rows.drop("paper_id"), "report_id")
    return side("a"), side("b")


@query
def exact_agreement(spark, folder):
    return branches.exact_agreement(*_both(spark, folder, _sentences(spark, folder))).withColumnRenamed("paper_id", "reports")


@query
def zipped_sentences(spark, folder):
    return branches.zipped(*_both(spark, folder, _sentences(spark, folder))).withColumnRenamed("paper_id", "reports")


@query
def page_routing(spark, folder):
    rows = pages.route_pages(pages.classify_pages(table(spark, folder, "page_texts")))
    return rows.select("page_id", "is_native", F.array_join("triggered_stages", ",").alias("stages"), "selected_extractor", "reason")


@query
def page_summary(spark, folder):
    return pages.page_summary(table(spark, folder, "page_texts"))


@query
def preceding_section(spark, folder):
    heads = _items(spark, folder).filter("section_path is not null and page is not null").select("paper_id", "page", F.col("item_id").alias("ord"), "section_path")
    points = table(spark, folder, "annotations").filter("page_index is not null and paper_id is not null").select("paper_id", (F.col("page_index") + 1).alias("page"))
    return pages.preceding_section(points, heads)


@query
def noise_sentences(spark, folder):
    return _items(spark, folder).filter(T.is_noise(F.col("item_text"))).select("paper_id", "item_id")


@query
def numbered_items(spark, folder):
    return evidence.numbered(_items(spark, folder)).select("paper_id", "item_id", "new_id")


@query
def carried_sections(spark, folder):
    return evidence.carried_sections(_items(spark, folder)).select("paper_id", "item_id", "section")


@query
def section_scores(spark, folder):
    return evidence.scored(_items(spark, folder)).select("paper_id", "item_id", "rank_score")


def _chosen(spark: SparkSession, folder: str) -> DataFrame:
    tokens = evidence.field_tokens(table(spark, folder, "extraction_map"))
    return evidence.within_budget(evidence.ranked(_items(spark, folder), tokens))


@query
def evidence_within_budget(spark, folder):
    return _chosen(spark, folder).select("paper_id", "item_id")


@query
def kept_prefix(spark, folder):
    held = _records(spark, folder).filter("lower(trim(confidence)) in ('h', 'high')").select("paper_id", F.explode("loc").alias("item_id"))
    return evidence.kept_prefix(_items(spark, folder), held, 10_000).select("paper_id", "item_id", "running")


@query
def provenance(spark, folder):
    return evidence.provenance(_records(spark, folder).filter("paper_id is not null"), _items(spark, folder))


@query
def unresolved_locations(spark, folder):
    loc = _records(spark, folder).filter("paper_id is not null").select("record_id", "paper_id", F.explode("loc").alias("item_id")).distinct()
    # Ids of every kind are asked for: those of figures and tables are not in every paper.
    asked = loc.withColumn("item_id", F.explode(F.array("item_id", F.regexp_replace("item_id", "^S", "F"), F.regexp_replace("item_id", "^S", "T")))).distinct()
    return asked.join(_items(spark, folder).select("paper_id", "item_id"), ["paper_id", "item_id"], "left_anti")


@query
def annotation_sentences(spark, folder):
    """Of every annotation and report of its paper the recorded sentence that holds where it begins."""
    reports = table(spark, folder, "coverage_reports")
    ranges = reports.select(F.col("report_id").alias("paper_id"), F.posexplode("sentence_to_char_range").alias("range_index", "r")).select("paper_id", "range_index", F.col("r.char_start").alias("start"), F.col("r.char_end").alias("end"))
    points = table(spark, folder, "annotations").dropDuplicates(["ann_id"]).select("ann_id", "paper_id", F.col("char_start").alias("at")).join(reports.select("paper_id", "report_id"), "paper_id")
    found = evidence.containing_range(points.select(F.struct("ann_id", "report_id").alias("id"), F.col("report_id").alias("paper_id"), "at"), ranges)
    return found.select("id.ann_id", "id.report_id", "range_index")


@query
def sentence_offsets(spark, folder):
    rows = table(spark, folder, "coverage_reports").select("report_id", F.coalesce("full_pdf_text", F.lit("")).alias("t"), F.posexplode("sentence_records").alias("ord", "s"))
    at = F.call_function("instr", F.col("t"), F.col("s.sentence")) - 1
    return rows.select("report_id", "ord", at.alias("char_start"), F.when(at >= 0, at + F.length("s.sentence")).otherwise(-1).alias("char_end"))


@query
def quote_context(spark, folder):
    """What stands around an annotation's sentence in every report of its paper that has it."""
    notes = table(spark, folder, "annotations").dropDuplicates(["ann_id"]).select("ann_id", "paper_id", "sentence_text")
    texts = table(spark, folder, "coverage_reports").filter("full_pdf_text is not null").select("paper_id", "report_id", "full_pdf_text")
    both = notes.join(texts, "paper_id").filter("sentence_text <> ''").withColumn("at", F.call_function("instr", F.col("full_pdf_text"), F.col("sentence_text"))).filter("at > 0")
    prefix = F.substring(F.col("full_pdf_text"), F.greatest(F.col("at") - 20, F.lit(1)), F.least(F.col("at") - 1, F.lit(20)))
    return both.select("ann_id", "report_id", prefix.alias("prefix"), F.substring(F.col("full_pdf_text"), F.col("at") + F.length("sentence_text"), F.lit(20)).alias("suffix"))


@query
def merged_fields(spark, folder):
    return fields.merged(_records(spark, folder))


@query
def every_field(spark, folder):
    return fields.every_field(fields.merged(_records(spark, folder)), table(spark, folder, "extraction_map"))


@query
def ranked_candidates(spark, folder):
    return fields.ranked_candidates(_records(spark, folder))


@query
def flagged_fields(spark, folder):
    c = F.lower(F.trim("confidence"))
    return _records(spark, folder).filter(c.isin("l", "nr")).select("record_id", "paper_id", "field_index", c.alias("confidence")).orderBy("field_index", "paper_id", "record_id")


@query
def not_reported(spark, folder):
    return fields.not_reported(_records(spark, folder))


def field_names(spark: SparkSession, folder: str) -> list[str]:
    """The field map's names in order; the map is a configuration table of one row per field."""
    return [r[0] for r in table(spark, folder, "extraction_map").orderBy("field_index").select("field_name").collect()]


@query
def wide_export(spark, folder):
    kept = field_names(spark, folder)
    out = fields.wide(_records(spark, folder), kept)
    return out.select("paper_id", F.concat_ws("|", *[F.col(f"`{n}`") for n in kept]).alias("row_text"))


@query
def record_problems(spark, folder):
    return fields.problems(_records(spark, folder))


def _usage(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    tokens = F.floor(F.abs("value") * 10).cast("bigint")
    return e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("stage"), tokens.alias("input_tokens"), F.floor(tokens / 2).alias("cached_tokens"), F.floor(tokens / 3).alias("output_tokens"), (F.col("user_id") % 3).alias("version"), (F.col("user_id") % 7).alias("prefix"))


@query
def stage_summaries(spark, folder):
    return runs.stage_summaries(_usage(spark, folder)).withColumn("cache_rate", F.round("cache_rate", 9))


@query
def low_cache(spark, folder):
    return runs.low_cache(runs.stage_summaries(_usage(spark, folder))).select("stage", "requests")


@query
def prefix_drift(spark, folder):
    return runs.drifting(_usage(spark, folder))


@query
def usage_totals(spark, folder):
    return runs.totals(_usage(spark, folder)).withColumn("cache_rate", F.round("cache_rate", 9)).withColumn("output_ratio", F.round("output_ratio", 9))


@query
def expensive_requests(spark, folder):
    u = _usage(spark, folder)
    return u.select("seq", (F.col("input_tokens") + F.col("output_tokens")).alias("total")).orderBy(F.desc("total"), "seq").limit(5)


@query
def pending_papers(spark, folder):
    p = table(spark, folder, "papers")
    done = p.filter("n_pages > 2")
    return runs.pending(p, done)


@query
def pending_by_identity(spark, folder):
    """All five hashes: papers whose language stands for the configuration went through the run before with another one."""
    p = table(spark, folder, "papers")
    now = runs.identities(p, F.lit("fields 1-62"), F.coalesce("route", F.lit("")))
    before = runs.identities(p.filter("n_pages > 2"), F.lit("fields 1-62"), F.when(F.col("lang") == "en", F.coalesce("route", F.lit(""))).otherwise("other"))
    return runs.pending(now, before, identity=(*runs.IDENTITY, "map_hash", "config_hash", "prompt_hash"))


@query
def chunk_ranges(spark, folder):
    ranges = [runs.chunk_ranges(table(spark, folder, "extraction_map"), n).withColumn("chunks", F.lit(n)) for n in (3, 4, 5, 8)]
    return ranges[0].unionByName(ranges[1]).unionByName(ranges[2]).unionByName(ranges[3])


@query
def chunk_fields(spark, folder):
    return runs.chunk_fields(table(spark, folder, "extraction_map"))


@query
def budget_checks(spark, folder):
    return budget.checked(_items(spark, folder), table(spark, folder, "stage_budgets"))


@query
def web_annotations(spark, folder):
    return runs.web_annotations(table(spark, folder, "annotations").dropDuplicates(["ann_id"]))


@query
def lexical_checks(spark, folder):
    return search.lexical_checks(table(spark, folder, "presence_checks"), table(spark, folder, "coverage_reports"))


@query
def nearest_vectors(spark, folder):
    v = table(spark, folder, "embeddings")
    return search.nearest(v, v.filter("vec_id % 100 = 0")).withColumn("score", F.round("score", 6))


@query
def text_functions(spark, folder):
    x = F.col("item_text")
    return _items(spark, folder).select(
        "paper_id", "item_id", T.collapse(x).alias("collapsed"), T.estimated_tokens(x).alias("tokens"), F.size(T.words(x)).alias("n_words"), T.weird_chars(x).alias("n_weird"), T.snippet(T.collapse(x)).alias("snippet"),
        F.size(F.regexp_extract_all(x, F.lit(T.QUANTITY), F.lit(0))).alias("n_quantities"), F.array_join(F.slice(F.regexp_extract_all(x, F.lit(T.ENTITY), F.lit(0)), 1, 10), "|").alias("entities"), F.size(T.sentences(x)).alias("n_sentences"),
    )


@query
def file_years(spark, folder):
    return table(spark, folder, "papers").select("paper_id", T.first_year(F.col("source_pdf")).alias("year"))


@query
def payload_labels(spark, folder):
    c = table(spark, folder, "candidates").dropDuplicates(["candidate_id"])
    return c.select("candidate_id", F.try_variant_get(F.try_parse_json(T.json_text(F.coalesce("payload", F.lit("")))), "$.label", "string").alias("label"))


@query
def nfkc_texts(spark, folder):
    return table(spark, folder, "presence_checks").dropDuplicates(["check_id"]).select("check_id", T.nfkc(F.col("needle")).alias("plain"))


@query
def quote_similarity(spark, folder):
    n = table(spark, folder, "annotations").dropDuplicates(["ann_id"]).filter("quote_selector.exact <> sentence_text")
    return n.select("ann_id", F.round(T.similarity(F.col("quote_selector.exact"), F.col("sentence_text")), 9).alias("ratio"))


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.classified(reconcile.text_blocks(table(spark, folder, "coverage_reports")))


@query
def evidence_packages(spark, folder):
    """What a package is made of; its bytes are compared by what does not depend on how numbers are written."""
    packed = evidence.packages(_chosen(spark, folder).withColumn("coords", F.lit(None).cast("array<double>")))
    return packed.select("paper_id", "evidence_count", F.length("package").alias("n_chars"), F.sha2("package", 256).alias("digest"))


@query
def evidence_reduction(spark, folder):
    packed = evidence.packages(_chosen(spark, folder).withColumn("coords", F.lit(None).cast("array<double>")))
    texts = _items(spark, folder).groupBy("paper_id").agg(F.sum(F.length(F.coalesce("item_text", F.lit("")))).alias("n_chars"))
    return evidence.reduction(packed, texts).withColumn("reduction", F.round("reduction", 9))


@query
def item_offsets(spark, folder):
    return evidence.offsets(_items(spark, folder))


@query
def keyword_overlaps(spark, folder):
    tokens = evidence.field_tokens(table(spark, folder, "extraction_map"))
    return _items(spark, folder).select("paper_id", "item_id", F.coalesce(evidence.keyword_overlap(F.col("item_text"), tokens), F.lit(0)).alias("overlap"))


@query
def enriched_quantities(spark, folder):
    """Offsets of a service are stood in for by every 37th character place of a paper."""
    items = _items(spark, folder)
    ends = evidence.offsets(items).groupBy("paper_id").agg(F.max("end").alias("end"))
    answers = ends.select("paper_id", F.explode(F.sequence(F.lit(0), F.col("end"), F.lit(997))).alias("at"))
    answers = answers.select(F.concat_ws("/", "paper_id", "at").alias("id"), "paper_id", "at", F.concat(F.lit("q"), F.col("at").cast("string")).alias("text"))
    found = annotations.enriched(items, answers, "quantities", "service")
    return found.select("paper_id", "item_id", F.size("found").alias("n_found"), F.coalesce(F.get("found", F.lit(0))["source"], F.lit("")).alias("source"))


@query
def service_annotations(spark, folder):
    """The candidates' payloads as the answers of a service."""
    raw = F.to_json(F.struct(F.col("source").alias("rawForm"), F.col("payload").alias("name"), (F.col("cand_index") / 2.0).alias("score"), F.col("status").alias("state")))
    rows = table(spark, folder, "candidates").dropDuplicates(["candidate_id"]).select("candidate_id", annotations.service_annotation(raw, "entity", "service").alias("a"))
    return rows.select("candidate_id", "a.text", "a.type", "a.confidence", F.element_at("a.metadata", "state").alias("state"))


def _outputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Records as compact model outputs, fenced, one per paper and group; and the fields expected of each."""
    rows = _records(spark, folder).filter("paper_id is not null and domain_group is not null and field_index is not null")
    item = F.struct(F.col("record_id").alias("o"), F.struct(F.col("field_index").alias("i"), F.col("extracted_value").alias("v"), "loc", F.trim("confidence").alias("c")).alias("x"))
    packed = rows.groupBy("paper_id", F.col("domain_group").alias("chunk")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda r: r["x"]).alias("xs"))
    raw = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(F.col("xs").alias("extractions"))), F.lit("\n```"))
    raw = F.when(F.col("chunk") % 5 == 0, F.substring(raw, 1, 40)).otherwise(raw)
    return packed.select("paper_id", "chunk", raw.alias("raw")), rows.select("paper_id", F.col("domain_group").alias("chunk"), "field_index").distinct()


@query
def chunk_errors(spark, folder):
    outputs, expected = _outputs(spark, folder)
    return validation.chunk_errors(outputs, expected, _items(spark, folder))


@query
def reconstructed_fields(spark, folder):
    compact = _records(spark, folder).filter("paper_id is not null and field_index is not null").select(F.col("record_id").alias("key"), "paper_id", F.col("field_index").alias("i"), F.col("extracted_value").alias("v"), "loc", F.col("confidence").alias("c"))
    return validation.reconstructed(compact, table(spark, folder, "extraction_map"), _items(spark, folder))


@query
def cross_references(spark, folder):
    """A record's first location is its own; what was resolved for all of them is held against it."""
    rows = _records(spark, folder).select("record_id", "field_index", F.slice("loc", 1, 1).alias("location"), F.array_append("loc", F.lit("unresolved")).alias("metadata"))
    return rows.select("record_id", F.array_join(validation.cross_references(rows), "\n").alias("errors"))


@query
def record_messages(spark, folder):
    rows = _records(spark, folder)
    return rows.select("record_id", F.array_join(validation.schema_messages(rows, validation.FINAL_RECORD), "\n").alias("messages"))


@query
def prompt_mitigation(spark, folder):
    """Limits a hundredth of the given ones, so that prompts of the test data exceed them."""
    small = table(spark, folder, "stage_budgets").withColumn("budget_limit", F.floor(F.col("budget_limit") / 100).cast("int"))
    others = table(spark, folder, "papers").select("paper_id", (F.coalesce("n_pages", F.lit(0)) * 40).alias("other_chars"))
    return budget.mitigated(_items(spark, folder), others, small, 20, 3_000)


@query
def stage_limits(spark, folder):
    given = table(spark, folder, "stage_budgets").withColumn("budget_limit", F.when(F.col("stage") == "synthesis", -1).otherwise(F.col("budget_limit")))
    return budget.limits(given)


@query
def prompt_sections(spark, folder):
    parts = F.map_from_arrays(F.array(F.lit("zeta"), F.lit("evidence"), F.lit("system"), F.lit("alpha")), F.array(*[F.coalesce(c, F.lit("")) for c in ("definition", "reviewer_question", "field_name", "format")]))
    rows = table(spark, folder, "extraction_map")
    order = F.array_join(F.transform(budget.ordered_sections(parts), lambda s: s["name"]), ",")
    top = F.array_join(F.transform(budget.top_sections(parts), lambda s: F.concat_ws(":", s["name"], s["tokens"].cast("string"))), ",")
    return rows.select("field_index", order.alias("sections"), top.alias("top"))


@query
def block_kinds(spark, folder):
    return reconcile.layers(_blocks(spark, folder)).select("report_id", "block_index", "kind", "layer")


@query
def paired_blocks(spark, folder):
    return reconcile.paired(*_both(spark, folder, _blocks(spark, folder))).withColumnRenamed("paper_id", "reports")


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    pairs = reconcile.paired(*_both(spark, folder, _blocks(spark, folder)))
    return reconcile.aligned(pairs).withColumn("confidence", F.round("confidence", 9)).withColumn("edit_distance", F.round("edit_distance", 9))


@query
def aligned_blocks(spark, folder):
    return _aligned(spark, folder).withColumnRenamed("paper_id", "reports")


@query
def best_alignment(spark, folder):
    return reconcile.best_of(_aligned(spark, folder)).withColumnRenamed("paper_id", "reports")


@query
def block_segments(spark, folder):
    return reconcile.segments(_blocks(spark, folder)).select("report_id", "block_index", "segment_id")


@query
def block_pages(spark, folder):
    items = _items(spark, folder).select("paper_id", (F.col("page") - 1).alias("page_index"), F.col("item_id").alias("block_index"), F.col("item_text").alias("text"))
    return reconcile.pages(items)


@query
def merged_pages(spark, folder):
    """Native and scanned pages as blocks of their own kind of page, in reading order."""
    pages_ = pages.classify_pages(table(spark, folder, "page_texts")).dropDuplicates(["paper_id", "page_index"]).select("paper_id", "page_index", "is_native")
    rows = table(spark, folder, "page_texts").select("paper_id", "page_index", F.col("page_id").alias("block_index"), "source")
    out = reconcile.merged_blocks(rows.filter("source <> 'paddleocr'"), rows.filter("source = 'paddleocr'"), pages_)
    return out.select("paper_id", "page_index", "block_index", "ord")


@query
def char_ranges(spark, folder):
    return reconcile.char_ranges(table(spark, folder, "coverage_reports"))


@query
def near_agreement(spark, folder):
    found = branches.near_agreement(*_both(spark, folder, _sentences(spark, folder))).withColumnRenamed("paper_id", "reports")
    return found.withColumn("agreement_rate", F.round("agreement_rate", 9))


@query
def checks_until_verified(spark, folder):
    checks = table(spark, folder, "presence_checks").dropDuplicates(["check_id"]).filter("paper_id is not null")
    return branches.until_verified(checks.select("paper_id", F.col("check_id").alias("ord"), F.coalesce(F.col("status") == "verified", F.lit(False)).alias("verified")))


@query
def check_statuses(spark, folder):
    rows = table(spark, folder, "presence_checks").dropDuplicates(["check_id"])
    return rows.select("check_id", branches.verification_status(F.col("score"), 0.95, F.col("source") != "paddleocr", "degrade").alias("status"))


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    """Items as spans of text; their scores stand for font sizes."""
    return _items(spark, folder).filter("page is not null").select("paper_id", F.col("page"), F.col("item_id").alias("span_index"), F.col("score").cast("double").alias("size"), F.coalesce("section_path", F.lit("")).alias("text"))


@query
def median_sizes(spark, folder):
    return fonts.median_sizes(_spans(spark, folder))


@query
def found_locations(spark, folder):
    notes = table(spark, folder, "annotations").filter("paper_id is not null and page_index is not null").select("paper_id", F.col("page_index").alias("page")).distinct()
    return fonts.locations(notes.withColumn("claimed", F.lit("P.1 ")), _spans(spark, folder))


@query
def line_pages(spark, folder):
    """Lines of scanned pages, with boxes by line number and length."""
    lines = table(spark, folder, "page_texts").filter("source = 'paddleocr'").dropDuplicates(["paper_id", "page_index"]).select("paper_id", "page_index", "ocr_confidence", F.posexplode(F.split(F.coalesce("page_text", F.lit("")), "\n")).alias("line_index", "text"))
    rows = lines.select("paper_id", "page_index", "line_index", "text", F.lit(10.0).alias("x0"), (F.col("line_index") * 20.0).alias("y0"), (10.0 + F.length("text")).alias("x1"), (F.col("line_index") * 20.0 + 18.0).alias("y1"), F.col("ocr_confidence").alias("confidence"))
    out = fonts.line_pages(rows)
    return out.select("paper_id", "page_index", "text", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1", "confidence")])


@query
def joined_spans(spark, folder):
    """The words of section paths as spans, parted by gaps that differ by place."""
    words = _items(spark, folder).filter("section_path is not null").select("paper_id", F.col("item_id").alias("line_index"), F.posexplode(F.split("section_path", " ")).alias("span_index", "text"))
    x0 = F.col("span_index") * 100.0
    x1 = F.when(F.col("span_index") % 3 == 2, F.lit(None).cast("double")).otherwise(x0 + 100.0 - F.col("span_index") % 2)
    return fonts.joined_spans(words.select("*", x0.alias("x0"), x1.alias("x1")))


@query
def croppable_items(spark, folder):
    return _items(spark, folder).filter(fonts.croppable(F.col("item_type"), F.col("coords"), F.col("page"))).select("paper_id", "item_id")


@query
def lexical_places(spark, folder):
    return search.lexical_places(table(spark, folder, "presence_checks"), table(spark, folder, "coverage_reports"))


@query
def normalised_vectors(spark, folder):
    v = search.normalised(table(spark, folder, "embeddings"))
    return v.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x), 9).alias("squares"), F.round(F.get("embedding", F.lit(0)), 9).alias("first"))


@query
def near_vectors(spark, folder):
    """Nearest vectors by cosine above a threshold."""
    v = search.normalised(table(spark, folder, "embeddings"))
    return search.nearest(v, v.filter("vec_id % 100 = 0"), least=0.3).withColumn("score", F.round("score", 6))


@query
def run_delta(spark, folder):
    u = _usage(spark, folder)
    part = lambda rows: rows.agg(F.lit("complete").alias("status"), F.count("*").alias("requests"), *[F.sum(c).alias(c) for c in ("input_tokens", "cached_tokens", "output_tokens")])
    out = runs.delta(part(u.filter("seq % 2 = 0")), part(u.filter("seq % 2 = 1")))
    return out.withColumn("cache_rate_change", F.round("cache_rate_change", 9)).withColumn("uncached_change", F.round("uncached_change", 6))


@query
def resolved_years(spark, folder):
    first = table(spark, folder, "page_texts").filter("page_index = 0").groupBy("paper_id").agg(F.min_by("page_text", "page_id").alias("first"))
    p = table(spark, folder, "papers").join(first, "paper_id", "left")
    year = T.resolved_year(F.when(F.col("n_pages") == 3, F.col("ingested_at").cast("string")), F.when(F.col("n_pages") == 4, F.concat(F.lit("D:"), F.date_format("ingested_at", "yyyyMMdd"))), F.col("first"), F.col("source_pdf"))
    return p.select("paper_id", year.alias("y")).select("paper_id", "y.*")


@query
def item_keywords(spark, folder):
    return _items(spark, folder).select("paper_id", "item_id", F.array_join(T.keywords(F.col("item_text")), " ").alias("keywords"))


@query
def short_hashes(spark, folder):
    return table(spark, folder, "papers").select("paper_id", T.short_hash(F.col("source_pdf"), "pdf").alias("cache_key"))


@query
def folded_needles(spark, folder):
    return table(spark, folder, "presence_checks").dropDuplicates(["check_id"]).select("check_id", T.fold_whitespace(F.col("needle")).alias("plain"), T.fold_aggressive(F.col("needle")).alias("bare"), T.clean_ocr(F.col("needle")).alias("clean"))


@query
def evidence_types(spark, folder):
    return _items(spark, folder).groupBy("item_type").agg(F.count("*").alias("n"))


@query
def merged_with_malformed(spark, folder):
    """Records without a location list stand for malformed ones."""
    return fields.merged(_records(spark, folder).withColumn("malformed", F.col("loc").isNull()))


@query
def papers_without_conflict(spark, folder):
    return fields.runs_without_conflict(fields.merged(_records(spark, folder)))


@query
def conflict_candidates(spark, folder):
    records = _records(spark, folder)
    return fields.conflict_candidates(records, fields.merged(records), _items(spark, folder))


@query
def synthesis_fields(spark, folder):
    return fields.synthesis_fields(fields.merged(_records(spark, folder)), table(spark, folder, "extraction_map"), 12)


def _prefilled(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "papers")
    values = p.select("paper_id", F.lit(1).alias("field_index"), F.col("lang").alias("value")).unionByName(p.select("paper_id", F.lit(2).alias("field_index"), T.first_year(F.col("source_pdf")).alias("value"))).unionByName(p.select("paper_id", F.lit(99).alias("field_index"), F.lit("x").alias("value")))
    return fields.prefilled(values, table(spark, folder, "extraction_map"))


@query
def prefilled_fields(spark, folder):
    return _prefilled(spark, folder)


@query
def left_to_ask(spark, folder):
    return fields.left_to_ask(table(spark, folder, "papers"), table(spark, folder, "extraction_map"), _prefilled(spark, folder).filter("confidence = 'h'"))


@query
def protected_items(spark, folder):
    records = _records(spark, folder).filter("paper_id is not null").withColumn("confidence", F.lower(F.trim("confidence")))
    best = fields.merged(records).select("paper_id", F.col("merged_confidence").alias("confidence"), F.split("locations", ",").alias("loc")).filter("size(loc) > 0 and loc[0] <> ''")
    return fields.protected(best, records.select("paper_id", "confidence", "loc"))


@query
def report_totals(spark, folder):
    return fields.report_totals(_records(spark, folder))


@query
def sentence_rows(spark, folder):
    blocks = _items(spark, folder).select("paper_id", "item_id", F.col("page").alias("page_index"), F.col("item_text").alias("text"))
    return stages.sentence_rows(blocks).select("paper_id", "item_id", "sentence")


@query
def points_outside_tables(spark, folder):
    """Items whose corner lies in no table of their page."""
    items = _items(spark, folder).filter("page is not null and size(coords) = 4")
    boxes = items.filter("item_type = 'table'").groupBy("paper_id", "page").agg(F.collect_list("coords").alias("boxes"))
    rows = items.filter("item_type <> 'table'").join(boxes, ["paper_id", "page"], "left")
    return rows.filter(fonts.outside(F.get("coords", F.lit(0)), F.get("coords", F.lit(1)), F.col("boxes"))).select("paper_id", "item_id")


@query
def annotation_records(spark, folder):
    notes = table(spark, folder, "annotations").dropDuplicates(["ann_id"]).filter("paper_id is not null and sentence_text is not null")
    rows = notes.select("paper_id", F.col("ann_id").alias("ord"), F.col("sentence_text").alias("sentence"), "page_index", F.coalesce("ocr_derived", F.lit(False)).alias("ocr"), F.when(F.col("char_end") > 0, F.col("char_start")).alias("start"), F.when(F.col("char_end") > 0, F.col("char_end")).alias("end"))
    boxes = _items(spark, folder).filter("size(coords) = 4 and page is not null").select("paper_id", (F.col("page") - 1).alias("page_index"), F.col("item_id").alias("block_index"), *[F.floor(F.get("coords", F.lit(k))).cast("double").alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])
    out = reconcile.annotation_records(rows, boxes)
    return out.withColumn("n_xywh", F.size(F.split("xywh", ","))).drop("xywh")


@query
def unified_records(spark, folder):
    a, b = _both(spark, folder, _blocks(spark, folder))
    return reconcile.unified(a, b, reconcile.aligned(reconcile.paired(a, b))).withColumnRenamed("paper_id", "reports")


@query
def branch_rationale(spark, folder):
    reports = table(spark, folder, "coverage_reports")
    empty = F.trim(F.coalesce("full_pdf_text", F.lit(""))) == ""
    failed = reports.select("report_id", (empty | F.coalesce(F.col("status") == "fail", F.lit(False))).alias("failed"), empty.alias("empty"))
    return branches.rationale(branch_scores(spark, folder), failed)


@query
def run_report(spark, folder):
    return runs.run_report(_usage(spark, folder))


@query
def canonical_papers(spark, folder):
    return files.canonical(table(spark, folder, "papers").select("paper_id", "n_pages", "lang"), "paper_id")


@query
def response_log(spark, folder):
    return files.response_log(table(spark, folder, "candidates").dropDuplicates(["candidate_id"]).select("candidate_id", F.col("payload").alias("raw")), most=12)


@query
def spaced_texts(spark, folder):
    return pages.spaced_text(table(spark, folder, "page_texts"))


@query
def final_fields(spark, folder):
    """The best synthesised record of each field stands for the synthesis."""
    records = _records(spark, folder)
    rank = T.confidence_rank(F.lower(F.trim("confidence")))
    best = records.filter("paper_id is not null and run_stage = 'synthesis'").groupBy("paper_id", "field_index").agg(F.max(F.struct(rank.alias("r"), (-F.col("record_id")).alias("o"), F.col("extracted_value").alias("value"), "confidence")).alias("b"))
    return fields.final_fields(fields.merged(records), best.select("paper_id", "field_index", "b.value", "b.confidence"))


@query
def chunk_choice(spark, folder):
    m = table(spark, folder, "extraction_map")
    chunk = runs.chunk_of(F.split_part("domain_group", F.lit("."), F.lit(1)).cast("int"))
    return evidence.chunk_choice(_items(spark, folder), m.withColumn("chunk", chunk), 20, 3_000)


@query
def valid_papers(spark, folder):
    """A paper is done if every one of its chunks is valid."""
    outputs, expected = _outputs(spark, folder)
    errors = validation.chunk_errors(outputs, expected, _items(spark, folder))
    return errors.groupBy("paper_id").agg(F.bool_and(F.col("error").isNull()).alias("ok"), F.count("*").alias("n_chunks"))


@query
def cached_papers(spark, folder):
    """Papers of the odd years stand for those that were made before."""
    key = F.concat_ws("_", "paper_id", F.coalesce("pdf_content_hash", F.lit("nohash")), F.lit("map"))
    p = table(spark, folder, "papers").select("paper_id", "n_pages", key.alias("digest"))
    have, make = files.cached(p.select("paper_id", "digest"), p.filter("n_pages % 2 = 1").select("digest", F.lit(True).alias("kept")))
    return have.select("paper_id", "kept").unionByName(make.select("paper_id", F.lit(False).alias("kept")))


@query
def expected_indices(spark, folder):
    m = table(spark, folder, "extraction_map")
    chunk = runs.chunk_of(F.split_part("domain_group", F.lit("."), F.lit(1)).cast("int"))
    return m.groupBy(chunk.alias("chunk")).agg(F.array_join(F.array_sort(F.collect_list("field_index")), ",").alias("indices"))


@query
def exported_values(spark, folder):
    """Values as they are exported, by the normalizer of that name."""
    return _records(spark, folder).select("record_id", T.normalizer("aggressive")(F.col("extracted_value")).alias("value"))


@query
def block_sentences(spark, folder):
    """The sentences of paragraphs, where a branch recorded none."""
    blocks = _blocks(spark, folder).filter("kind = 'paragraph'")
    return blocks.select("report_id", "block_index", F.posexplode(stages.SEGMENTERS["stops"](F.col("text"))).alias("ord", "sentence"))


@query
def prompt_texts(spark, folder):
    m = table(spark, folder, "extraction_map")
    chunk = runs.chunk_of(F.split_part("domain_group", F.lit("."), F.lit(1)).cast("int"))
    lines = budget.field_lines(m.withColumn("chunk", chunk))
    parts = F.map_from_arrays(F.array(F.lit("tail"), F.lit("field_definitions"), F.lit("system")), F.array(F.lit("\nAnswer in JSON."), F.col("field_definitions"), F.lit("Read.\n")))
    return lines.select("chunk", budget.prompt_text(parts).alias("prompt"))


@query
def manifests(spark, folder):
    """Papers of native route stand for those of the new run."""
    rows = table(spark, folder, "papers").select("paper_id", "status", "model_id", F.col("ingested_at").alias("at"))
    new = table(spark, folder, "papers").filter("route = 'native'").select("paper_id", F.lit("complete").alias("status"), F.lit("m2").alias("model_id"), F.col("ingested_at").alias("at"))
    return runs.manifest(rows, new).select("paper_id", "status", "model_id")


@query
def block_messages(spark, folder):
    rows = _items(spark, folder).select("paper_id", "item_id", F.col("item_text").alias("text"), (F.col("page") - 2).alias("page_index"), F.col("coords").alias("bbox"))
    return rows.select("paper_id", "item_id", F.array_join(validation.schema_messages(rows, validation.BLOCK), ";").alias("messages"))


@query
def first_sentences(spark, folder):
    return stages.first_rows(_sentences(spark, folder), "report_id", "ord", 5)


def queries() -> dict[str, QueryFn]:
    return dict(_ALL)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
