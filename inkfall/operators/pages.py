"""Page classification and routing, page summaries, positional and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T


def classify_pages(pages: DataFrame, least_words: int = 50, least_alpha: float = 0.60, most_image: float = 0.85) -> DataFrame:
    """Five stages per page: blank (which ends it), few words, few letters, no fonts, an image over the page; native if none fires."""
    text = F.coalesce("page_text", F.lit(""))
    blank = F.trim(F.regexp_replace(text, r"(?U)\s+", "")) == ""
    n_words = F.size(T.words(text))
    cleaned = F.regexp_replace(T.clean_ocr(text), r"(?U)\s", "")
    alpha = F.when(F.length(cleaned) > 0, F.length(F.regexp_replace(cleaned, r"\P{L}", "")) / F.length(cleaned)).otherwise(0.0)
    image = F.when(F.col("page_area") > 0, F.col("image_area") / F.col("page_area")).otherwise(0.0)
    stages = F.when(blank, F.array(F.lit(1))).otherwise(
        F.array_compact(F.array(F.when(n_words < least_words, 2), F.when(alpha < least_alpha, 3), F.when(F.col("font_count") == 0, 4), F.when(image > most_image, 5)))
    )
    return pages.withColumn("triggered_stages", stages).withColumn("is_native", F.size("triggered_stages") == 0)


def route_pages(classified: DataFrame) -> DataFrame:
    """``selected_extractor`` and ``reason`` of every page; a paper without scanned pages is all native."""
    mixed = F.max((~F.col("is_native")).cast("int")).over(Window.partitionBy("paper_id")) == 1
    reason = (
        F.when(F.col("is_native"), F.when(mixed, "mixed_native_page").otherwise("all_native"))
        .when(F.get("triggered_stages", F.lit(0)) == 1, "stage_1_empty_text")
        .otherwise(F.concat(F.lit("stages_"), F.array_join(F.transform("triggered_stages", lambda s: s.cast("string")), "_")))
    )
    return classified.withColumn("selected_extractor", F.when(F.col("is_native"), "native").otherwise("ocr")).withColumn("reason", reason)


def page_summary(pages: DataFrame) -> DataFrame:
    """Per paper the pages with text, joined by line ends in page order, and their number."""
    filled = pages.filter("page_text is not null and page_text <> ''").dropDuplicates(["paper_id", "page_index"])
    return filled.groupBy("paper_id").agg(
        F.count("*").alias("n_pages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "page_text"))), lambda p: p["page_text"]), "\n").alias("full_text"),
    )


def spaced_text(pages: DataFrame) -> DataFrame:
    """Per paper the texts of all pages joined by single blanks in page order; pages without text keep their place."""
    one = pages.filter("page_index is not null").dropDuplicates(["paper_id", "page_index"]).select("paper_id", "page_index", F.coalesce("page_text", F.lit("")).alias("t"))
    return one.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "t"))), lambda p: p["t"]), " ").alias("full_text"))


def preceding_section(points: DataFrame, headings: DataFrame) -> DataFrame:
    """As-of join: for every (paper_id, page) the section of the last heading at or before that page.

    Both sides become one stream of events per paper and a running ``last`` carries the section forward; nothing is paired.
    """
    heads = headings.groupBy("paper_id", "page").agg(F.max(F.struct("ord", "section_path"))["section_path"].alias("section_path"))
    a = heads.select("paper_id", "page", F.lit(0).alias("side"), "section_path")
    b = points.select("paper_id", "page").distinct().select("paper_id", "page", F.lit(1).alias("side"), F.lit(None).cast("string").alias("section_path"))
    w = Window.partitionBy("paper_id").orderBy("page", "side").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("section_path", F.last("section_path", ignorenulls=True).over(w)).filter("side = 1").drop("side")
