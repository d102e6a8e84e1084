"""Queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfall.llm import consensus, encoding, language, leakage, lookalikes, scan_repair, sentences, splitting, survivorship
from inkfall.sources.tables import table


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "evidence_items").select("paper_id", "item_id", "stage", "item_text").distinct()
    return splitting.split_oversized(items, table(spark, folder, "stage_budgets"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_pieces(spark, folder).filter("n_pieces > 1").select("paper_id", "item_id").distinct()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    checks, reports = table(spark, folder, "presence_checks"), table(spark, folder, "coverage_reports")
    needles = lookalikes.presence(checks, reports).select(F.lit("needle").alias("kind"), F.col("check_id").alias("ref_id"))
    notes = table(spark, folder, "annotations")
    quotes = lookalikes.same_look(notes, "ann_id", F.col("quote_selector.exact"), F.col("sentence_text"))
    return needles.unionByName(quotes.select(F.lit("quote").alias("kind"), F.col("ann_id").alias("ref_id")))


def p2_texts(spark: SparkSession, folder: str) -> DataFrame:
    def texts(kind: str, rows: DataFrame, key: str, text: str) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.col(key).alias("ref_id"), F.col(text).alias("t")).filter("t is not null")

    notes = table(spark, folder, "annotations")
    every = texts("needle", table(spark, folder, "presence_checks"), "check_id", "needle")
    every = every.unionByName(texts("report", table(spark, folder, "coverage_reports"), "report_id", "full_pdf_text"))
    for kind, part in (("quote", "exact"), ("prefix", "prefix"), ("suffix", "suffix")):
        every = every.unionByName(texts(kind, notes, "ann_id", f"quote_selector.{part}"))
    return lookalikes.by_look(every.dropDuplicates(["kind", "ref_id"]), ["kind", "ref_id"], "t").select("kind", "ref_id", F.col("look").alias("text"))


def _p3(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rated = consensus.latest_ratings(table(spark, folder, "candidates"), ["paper_id", "field_index"])
    return consensus.fit_consensus(rated, ["paper_id", "field_index"])


def p3_consensus(spark: SparkSession, folder: str) -> DataFrame:
    return _p3(spark, folder)[0].select("paper_id", "field_index", "label", "confidence", "agreement")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _p3(spark, folder)[0].filter("disagreed").select("paper_id", "field_index", "label")


def p3_reliability(spark: SparkSession, folder: str) -> DataFrame:
    return _p3(spark, folder)[1].drop("confusion")


_SURVIVING = ("extracted_value", "evidence", "section_path", "page")


def _sentences(reports: DataFrame) -> DataFrame:
    return sentences.split_sentences(reports.select("report_id", "full_pdf_text"), "report_id", "full_pdf_text").drop("sentence_index").distinct()


def p4_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return _sentences(table(spark, folder, "coverage_reports"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _sentences(table(spark, folder, "coverage_reports").filter("source = 'grobid'"))


def _pages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, folder, "page_texts").select("page_id", "paper_id", "page_index", "source", F.col("page_text").alias("text"))
    return pages.filter("source = 'paddleocr'"), pages.filter("source <> 'paddleocr'")


def _repair(spark: SparkSession, folder: str) -> scan_repair.Repair:
    return scan_repair.examine(*_pages(spark, folder))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return scan_repair.found(_repair(spark, folder))


def p5_pages(spark: SparkSession, folder: str) -> DataFrame:
    return scan_repair.reflowed(_repair(spark, folder))


def p5_texts(spark: SparkSession, folder: str) -> DataFrame:
    reports = table(spark, folder, "coverage_reports").filter("source = 'paddleocr'")
    reports = reports.select("report_id", "paper_id", F.col("full_pdf_text").alias("text"), F.col("page_texts").alias("own"))
    notes = table(spark, folder, "annotations").filter("ocr_derived").select("ann_id", "paper_id", "page_index", F.col("sentence_text").alias("text"))
    return scan_repair.repaired_texts(reports, notes, *_pages(spark, folder))


def p6_survivors(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "field_records").select(
        "record_id", "paper_id", "source_pdf", "field_index", *_SURVIVING, "confidence", "updated_at"
    )
    named = survivorship.with_paper(records, table(spark, folder, "papers"))
    valid = {c: survivorship.has_value(F.col(c)) for c in _SURVIVING[:3]} | {"page": F.col("page") >= 0}
    rank = survivorship.trust_rank(F.col("confidence"))
    return survivorship.surviving(named, ["paper_id", "field_index"], valid, rank, F.col("updated_at"), F.col("record_id"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = p6_survivors(spark, folder).filter("several")
    parts = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c)["record_id"].alias("record_id")) for c in _SURVIVING])
    long = rows.select("first_record_id", F.explode(parts).alias("p")).select("first_record_id", "p.*")
    return long.filter("record_id is not null")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode(table(spark, folder, "documents").select("doc_id", "text"))


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.decode(p7_ids(spark, folder))


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leakage.find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"), least=False)
    return found.select("doc_id", "item_id")


def p9_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.segments(docs, language.fit_profiles(docs))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return language.wrong_labels(table(spark, folder, "documents"), language.languages(p9_segments(spark, folder)))


QUERIES = {
    "p1_found": p1_found,
    "p1_pieces": p1_pieces,
    "p2_found": p2_found,
    "p2_texts": p2_texts,
    "p3_consensus": p3_consensus,
    "p3_found": p3_found,
    "p3_reliability": p3_reliability,
    "p4_found": p4_found,
    "p4_sentences": p4_sentences,
    "p5_found": p5_found,
    "p5_pages": p5_pages,
    "p5_texts": p5_texts,
    "p6_found": p6_found,
    "p6_survivors": p6_survivors,
    "p7_ids": p7_ids,
    "p7_decoded": p7_decoded,
    "p8_found": p8_found,
    "p8_leaks": p8_leaks,
    "p9_found": p9_found,
    "p9_segments": p9_segments,
}

ORACLE_SQL = {
    "p1_found": """
        select distinct i.paper_id, i.item_id
        from evidence_items i join stage_budgets b on i.stage = b.stage
        where length(i.item_text) // 4 > b.item_limit
    """,
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
