"""Eight coverage metrics per report branch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T


@dataclass(frozen=True)
class Thresholds:
    min_chars: int = 100
    ratio: float = 0.6
    long_words: int = 120
    long_share: float = 0.12
    sections: tuple[str, ...] = ("abstract", "introduction", "methods", "results")
    coordinates: float = 0.1
    references: float = 0.05
    weird: float = 0.05


def coverage_metrics(reports: DataFrame, blocks: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """``report_id``, ``metric_name``, ``computed_value``, ``threshold``, ``triggered``: eight rows per report.

    ``blocks`` (paper_id, text, located) are the text blocks of a paper. A page's native text is the text of the same page
    in the paper's other reports, joined by line ends in report order. Sentence and text metrics are expressions on
    the report's own row; only pages and blocks are aggregated, with partial sums before the shuffle. Of pages nothing but
    their lengths is shuffled: the others' length is the page's sum less its own.
    """
    L = limits
    base = reports.select("report_id", "paper_id", "full_pdf_text", "sentence_records")
    pages = reports.select("report_id", "paper_id", F.explode("page_texts").alias("p")).select("report_id", "paper_id", "p.page", F.length(F.coalesce("p.page_text", F.lit(""))).alias("own"))
    same = Window.partitionBy("paper_id", "page")
    mine = Window.partitionBy("paper_id", "page", "report_id")
    others = F.count("*").over(same) - F.count("*").over(mine)
    native = pages.withColumn("native", F.when(others > 0, F.sum("own").over(same) - F.sum("own").over(mine) + others - 1).otherwise(0))
    native = native.select("report_id", "page", "own", "native").distinct()
    per = native.groupBy("report_id").agg(
        F.count(F.when((F.col("own") < L.min_chars) & (F.col("native") > L.min_chars), 1)).alias("short_pages"),
        F.avg(F.when(F.col("native") > 0, F.col("own") / F.col("native"))).alias("ratio"),
    )
    own = blocks.groupBy("paper_id").agg(F.avg((~F.col("located")).cast("double")).alias("missing"))
    sents = F.transform("sentence_records", lambda s: F.coalesce(s["sentence"], F.lit("")))
    n = F.size(sents)
    share = lambda test: F.when(n > 0, F.size(F.filter(sents, test)) / n).otherwise(0.0)
    text = F.coalesce("full_pdf_text", F.lit(""))
    low = F.lower(text)
    present = sum((F.contains(low, F.lit(s)).cast("int") for s in L.sections), F.lit(0))
    found = F.regexp_extract_all(text, F.lit(r"\b(?:Table|Figure)\s+\d+"), F.lit(0))
    refs = F.size(found)
    # A reference is captioned if a block of the paper has it: the distinct ones are looked for, once per block.
    wanted = base.select("report_id", "paper_id", F.explode(F.array_distinct(F.transform(found, F.lower))).alias("ref"))
    wanted = wanted.join(blocks.select("paper_id", F.lower("text").alias("block")), "paper_id").filter(F.contains("block", F.col("ref")))
    captions = wanted.select("report_id").distinct().withColumn("captioned", F.lit(True))
    rows = base.join(per, "report_id", "left").join(own, "paper_id", "left").join(captions, "report_id", "left")

    def row(name: str, value, threshold, fired):
        return F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("computed_value"), F.lit(threshold).cast("double").alias("threshold"), F.coalesce(fired, F.lit(False)).alias("triggered"))

    ratio, missing = F.coalesce("ratio", F.lit(1.0)), F.coalesce("missing", F.lit(0.0))
    shortp = F.coalesce("short_pages", F.lit(0))
    long_ = share(lambda s: F.size(T.words(s)) > L.long_words)
    leak = share(lambda s: F.lower(s).rlike(r"references|bibliography|et al\.|\[1\]|\(1\)"))
    weird = F.when(F.length(text) > 0, T.weird_chars(text) / F.length(text)).otherwise(0.0)
    metrics = F.array(
        row("min_chars_per_page", shortp, L.min_chars, shortp > 0),
        row("extraction_coverage_ratio", ratio, L.ratio, ratio < L.ratio),
        row("long_sentence_fraction", long_, L.long_share, long_ > L.long_share),
        row("section_coverage", present, len(L.sections), (text != "") & (present < len(L.sections))),
        row("caption_table_figure_coverage", refs, None, (refs > 0) & F.col("captioned").isNull()),
        row("coordinate_availability", missing, L.coordinates, missing > L.coordinates),
        row("references_in_body", leak, L.references, leak > L.references),
        row("weird_char_ratio", weird, L.weird, weird > L.weird),
    )
    return rows.select("report_id", F.explode(metrics).alias("m")).select("report_id", "m.*")


def borderline(metrics: DataFrame) -> DataFrame:
    """``report_id``, ``status``, ``borderline``: pass while at most half the metrics fire; borderline at one or two."""
    fired = F.count(F.when(F.col("triggered"), 1))
    return metrics.groupBy("report_id").agg(
        F.when(fired / F.count("*") <= 0.5, "pass").otherwise("fail").alias("status"), fired.between(1, 2).alias("borderline"), fired.alias("n_triggered")
    )
