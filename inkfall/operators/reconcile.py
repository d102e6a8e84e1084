"""Two branches of a document brought together: blocks by kind, aligned, with how far they agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T

#: From this confidence two headings agree in full.
FULL = 0.8
#: Below this distance texts agree in part; font sizes below this one less the tolerance cost confidence.
PARTIAL = 0.10
FONT_SIZE, FONT_TOLERANCE = 12.0, 2.0


def text_blocks(reports: DataFrame) -> DataFrame:
    """``report_id``, ``paper_id``, ``source``, ``block_index``, ``text`` of the blocks that empty lines part."""
    parts = F.posexplode(F.filter(F.split("full_pdf_text", r"\n\s*\n"), lambda x: F.trim(x) != "")).alias("block_index", "text")
    return reports.filter("full_pdf_text is not null").select("report_id", "paper_id", "source", parts)


def classified(blocks: DataFrame) -> DataFrame:
    """Blocks with their ``kind``; an own ``block_type`` comes first."""
    explicit = F.col("block_type") if "block_type" in blocks.columns else F.lit(None).cast("string")
    return blocks.withColumn("kind", T.block_kind(explicit, F.col("text")))


def segments(blocks: DataFrame) -> DataFrame:
    """Every block of a report with a running segment id."""
    w = Window.partitionBy("report_id").orderBy("block_index")
    return blocks.withColumn("segment_id", F.concat(F.lit("seg-"), (F.row_number().over(w) - 1).cast("string")))


def layers(blocks: DataFrame) -> DataFrame:
    """The semantic layer: sections, paragraphs, and everything else as references."""
    layer = F.when(F.col("kind") == "section", "sections").when(F.col("kind") == "paragraph", "paragraphs").otherwise("references")
    return blocks.withColumn("layer", layer)


def structure(blocks: DataFrame) -> DataFrame:
    """The structural layer: tables, figures and plain blocks."""
    return blocks.withColumn("layer", F.when(F.col("kind").isin("table", "figure"), F.concat("kind", F.lit("s"))).otherwise("blocks"))


def paired(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The i-th block of a kind of one branch beside the i-th of that kind of the other, as far as both go.

    Tables and figures count as one kind. ``paper_id``, ``kind``, ``place``, ``primary_text``, ``secondary_text``.
    """
    group = F.when(F.col("kind").isin("table", "figure"), "table_figure").otherwise(F.col("kind"))
    w = Window.partitionBy("paper_id", "kind").orderBy("report_id", "block_index")

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.select("paper_id", group.alias("kind"), "report_id", "block_index", "text").filter("kind <> 'other'")
        return rows.withColumn("place", F.row_number().over(w)).select("paper_id", "kind", "place", F.col("text").alias(name))

    return side(primary, "primary_text").join(side(secondary, "secondary_text"), ["paper_id", "kind", "place"])


def fidelity(similarity: Column, threshold: float = PARTIAL) -> Column:
    """How far two readings of a text agree, by the share of characters that differ."""
    d = 1.0 - similarity
    agreement = F.when(d == 0.0, "full").when(d < threshold, "partial").otherwise("divergent")
    return F.struct(d.alias("edit_distance"), agreement.alias("agreement"), (1.0 - d).alias("confidence"))


def heading_confidence(similarity: Column, font_size: Column, size: float = FONT_SIZE, tolerance: float = FONT_TOLERANCE) -> Column:
    """The likeness of two headings, less if the font is smaller than headings are."""
    least = size - tolerance
    f = F.coalesce(font_size.cast("double"), F.lit(size))
    penalty = F.when(f >= least, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (least - f) / least)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), similarity * (1.0 - penalty)))


def aligned(pairs: DataFrame) -> DataFrame:
    """Pairs with ``source``, ``agreement``, ``confidence``, ``edit_distance`` and ``preferred_reading``.

    Paragraphs by their text, headings by likeness and font size (``font_size``, 10 if not given), tables and figures as
    present with the caption, or the other side's text where it is empty.
    """
    like = pairs.withColumn("s", T.similarity(F.col("primary_text"), F.col("secondary_text")))
    fid = fidelity(F.col("s"))
    font = F.col("font_size") if "font_size" in pairs.columns else F.lit(10.0)
    conf = heading_confidence(F.col("s"), font)
    by = lambda para, sec, tab: F.when(F.col("kind") == "paragraph", para).when(F.col("kind") == "section", sec).otherwise(tab)
    return like.select(
        "paper_id", "kind", "place",
        by(F.lit("text_fidelity"), F.lit("section_verification"), F.lit("table_figure_merge")).alias("source"),
        by(fid["agreement"], F.when(conf >= FULL, "full").otherwise("partial"), F.lit("present")).alias("agreement"),
        by(fid["confidence"], conf, F.lit(1.0)).alias("confidence"),
        by(fid["edit_distance"], F.lit(None).cast("double"), F.lit(None).cast("double")).alias("edit_distance"),
        by(F.col("secondary_text"), F.col("secondary_text"), F.coalesce(F.nullif("primary_text", F.lit("")), F.col("secondary_text"))).alias("preferred_reading"),
    )


def best_of(entries: DataFrame, source: str = "source") -> DataFrame:
    """Per paper and concern the best entry: the least edit distance of texts, the highest confidence of others, the first on ties."""
    score = F.when(F.col("edit_distance").isNotNull(), -F.col("edit_distance")).otherwise(F.col("confidence"))
    top = F.max(F.struct(score.alias("s"), (-F.col("place")).alias("o"), "confidence", "preferred_reading"))
    out = entries.groupBy("paper_id", source).agg(top.alias("b"))
    words = F.when(F.col(source) == "text_fidelity", F.format_string("least edit distance: %.3f", -F.col("b.s"))).otherwise(F.format_string("highest confidence: %.3f", F.col("b.confidence")))
    return out.select("paper_id", source, (-F.col("b.o")).alias("place"), F.col("b.confidence").alias("confidence"), words.alias("rationale"))


def pages(blocks: DataFrame, page: str = "page_index") -> DataFrame:
    """Per paper and page the texts of its blocks by line and their number; a page that is no number is page 0."""
    p = F.coalesce(F.col(page).try_cast("int"), F.lit(0)).alias("page_index")
    rows = blocks.select("paper_id", p, "block_index", F.coalesce("text", F.lit("")).alias("text"))
    per = rows.groupBy("paper_id", "page_index").agg(F.count("*").alias("block_count"), F.array_sort(F.collect_list(F.struct("block_index", "text"))).alias("b"))
    return per.select("paper_id", "page_index", F.array_join(F.transform("b", lambda x: x["text"]), "\n").alias("text"), "block_count")


def merged_blocks(native: DataFrame, scanned: DataFrame, pages_: DataFrame) -> DataFrame:
    """Native blocks of native pages and scanned ones of scanned pages (paper_id, page_index, is_native), in reading order."""
    keep = lambda df, flag, rank: df.join(pages_.filter(F.col("is_native") == flag).select("paper_id", "page_index"), ["paper_id", "page_index"], "left_semi").withColumn("rank", F.lit(rank))
    both = keep(native, True, 0).unionByName(keep(scanned, False, 1))
    w = Window.partitionBy("paper_id").orderBy("page_index", "rank", "block_index")
    return both.withColumn("ord", F.row_number().over(w) - 1).drop("rank")


def char_ranges(reports: DataFrame) -> DataFrame:
    """Where each recorded sentence first stands in its report's text, and whether it is there at all."""
    rows = reports.select("report_id", F.coalesce("full_pdf_text", F.lit("")).alias("t"), F.posexplode("sentence_records").alias("ord", "s")).filter("s.sentence is not null")
    at = F.call_function("instr", F.col("t"), F.col("s.sentence")) - 1
    return rows.select("report_id", "ord", at.alias("start"), F.when(at >= 0, at + F.length("s.sentence")).otherwise(-1).alias("end"), (at < 0).alias("one_engine_only"))


def annotation_records(sentences: DataFrame, blocks: DataFrame, around: int = 20) -> DataFrame:
    """A record for every sentence (paper_id, ord, sentence, page_index, ocr, start, end) with its quotation and its place.

    The quotation's context is what stands ``around`` its first occurrence in the paper's sentences joined by blanks. A native
    sentence has the range of the last sentence of the same text (0, 0 without one); a scanned one the box of the first
    block (paper_id, page_index, block_index, x0, y0, x1, y1) of its page, as x, y, width and height. Sentences of a paper meet as one
    text in one row, as their context needs.
    """
    per = sentences.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "sentence"))), lambda x: x["sentence"]), " ").alias("full"))
    ranges = sentences.filter("start is not null").groupBy("paper_id", "sentence").agg(F.max_by(F.struct("start", "end"), "ord").alias("r"))
    first = blocks.groupBy("paper_id", "page_index").agg(F.min_by(F.struct("x0", "y0", "x1", "y1"), "block_index").alias("b"))
    rows = sentences.drop("start", "end").join(per, "paper_id").join(ranges, ["paper_id", "sentence"], "left").join(first, ["paper_id", "page_index"], "left")
    at = F.call_function("instr", F.col("full"), F.col("sentence"))
    prefix = F.when(at > 0, F.substring(F.col("full"), F.greatest(at - around, F.lit(1)), F.least(at - 1, F.lit(around)))).otherwise("")
    suffix = F.when(at > 0, F.substring(F.col("full"), at + F.length("sentence"), F.lit(around))).otherwise("")
    zero = F.lit(0.0)
    x0, y0, x1, y1 = (F.coalesce(F.col(f"b.{c}"), zero) for c in ("x0", "y0", "x1", "y1"))
    xywh = F.concat_ws(",", *[c.cast("string") for c in (x0, y0, x1 - x0, y1 - y0)])
    return rows.select(
        "paper_id", "ord", "sentence", F.when(F.col("ocr"), "FragmentSelector").otherwise("TextPositionSelector").alias("selector"),
        F.when(~F.col("ocr"), F.coalesce("r.start", F.lit(0))).alias("start"), F.when(~F.col("ocr"), F.coalesce("r.end", F.lit(0))).alias("end"), F.when(F.col("ocr"), xywh).alias("xywh"), prefix.alias("prefix"), suffix.alias("suffix"),
    )


def unified(primary: DataFrame, secondary: DataFrame, entries: DataFrame) -> DataFrame:
    """One record per paper: how many parts each layer has, how the alignment's entries agree, and where it all comes from."""
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("paper_id").agg(F.count("*").alias(f"n_{name}"), *[F.count(F.when(F.col("layer") == k, 1)).alias(f"{name}_{k}") for k in (("sections", "paragraphs", "references") if name == "semantic" else ("tables", "figures", "blocks"))], F.min("report_id").alias(f"{name}_report"))

    a, b = counts(layers(primary), "semantic"), counts(structure(secondary), "structural")
    agree = entries.groupBy("paper_id").agg(F.count("*").alias("n_entries"), *[F.count(F.when(F.col("agreement") == k, 1)).alias(f"n_{k}") for k in ("full", "partial", "divergent", "present")])
    rows = a.join(b, "paper_id", "left").join(agree, "paper_id", "left").na.fill(0)
    return rows.withColumn("provenance", F.to_json(F.struct(F.col("semantic_report").alias("semantic"), F.col("structural_report").alias("structural"))))
