"""Layout: font sizes, headings before a page, lines and spans put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T

#: A span is a heading if it is this much larger than the document's median.
LARGER = 2.0


def median_sizes(spans: DataFrame) -> DataFrame:
    """The median font size of each paper, between the middle two of an even number."""
    return spans.filter("size is not null").groupBy("paper_id").agg(F.median("size").alias("median_size"))


def heading_spans(spans: DataFrame, larger: float = LARGER) -> DataFrame:
    """The spans that are headings (paper_id, page, span_index, text)."""
    return spans.join(median_sizes(spans), "paper_id").filter(F.col("size") >= F.col("median_size") + larger).select("paper_id", "page", "span_index", F.trim("text").alias("text"))


def heading_before(points: DataFrame, spans: DataFrame) -> DataFrame:
    """As-of join: for every (paper_id, page) the last heading span, in span order, on that page or one before; '' if there is none.

    A running maximum by span order over one stream of headings and points per paper; nothing is paired.
    """
    heads = heading_spans(spans).groupBy("paper_id", "page").agg(F.max(F.struct("span_index", "text")).alias("h"))
    a = heads.select("paper_id", "page", F.lit(0).alias("side"), "h")
    b = points.select("paper_id", "page").distinct().select("paper_id", "page", F.lit(1).alias("side"), F.lit(None).cast(heads.schema["h"].dataType).alias("h"))
    w = Window.partitionBy("paper_id").orderBy("page", "side").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("h", F.max("h").over(w)).filter("side = 1").select("paper_id", "page", F.coalesce("h.text", F.lit("")).alias("heading"))


def locations(points: DataFrame, spans: DataFrame) -> DataFrame:
    """``paper_id``, ``page``, ``found_location`` and whether it differs from the ``claimed`` one; pages count from 0."""
    both = points.join(heading_before(points, spans), ["paper_id", "page"], "left")
    found = T.location_text(F.col("page"), F.col("heading"))
    return both.select("paper_id", "page", "claimed", found.alias("found_location"), T.drifted(found, F.col("claimed")).alias("drift"))


def line_pages(lines: DataFrame, dpi: int = 150) -> DataFrame:
    """Recognised lines (paper_id, page_index, line_index, text, x0, y0, x1, y1, confidence) as one block a page.

    Texts by line, the box around them in points (72 to the inch), the mean confidence; pages without text are no block.
    """
    scale = 72.0 / dpi
    rows = lines.filter("text is not null and text <> ''")
    per = rows.groupBy("paper_id", "page_index").agg(
        F.array_sort(F.collect_list(F.struct("line_index", "text"))).alias("t"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("confidence")
    )
    return per.select("paper_id", "page_index", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"), *[(F.col(c) * scale).alias(c) for c in ("x0", "y0", "x1", "y1")], "confidence")


def joined_spans(spans: DataFrame, keys: tuple[str, ...] = ("paper_id", "line_index")) -> DataFrame:
    """Spans (keys, span_index, text, x0, x1) of a line as one text: a blank where the gap is wider than a quarter of a letter.

    The letter's width is that of the span before on average (1 where it is empty); without boxes there is a blank.
    """
    w = Window.partitionBy(*keys).orderBy("span_index")
    text, before = F.coalesce("text", F.lit("")), F.lag(F.coalesce("text", F.lit(""))).over(w)
    x1, x0 = F.lag("x1").over(w), F.lag("x0").over(w)
    gap = F.col("x0") - x1
    width = F.when(F.length(before) > 0, (x1 - x0) / F.length(before) / 4).otherwise(1.0)
    sep = F.when(before.isNull(), "").when(gap.isNull(), " ").when((gap > 0) & (gap > width), " ").otherwise("")
    per = spans.withColumn("piece", F.concat(sep, text)).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("span_index", "piece"))).alias("p"))
    return per.select(*keys, F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"))


def outside(x: Column, y: Column, boxes: Column) -> Column:
    """Whether a point lies in none of the boxes (arrays of x0, y0, x1, y1)."""
    inside = F.exists(boxes, lambda b: x.between(F.get(b, F.lit(0)), F.get(b, F.lit(2))) & y.between(F.get(b, F.lit(1)), F.get(b, F.lit(3))))
    return ~F.coalesce(inside, F.lit(False))


def croppable(kind: Column, coords: Column, page: Column, kinds: tuple[str, ...] = ("figure_caption", "table")) -> Column:
    """Whether an item can be cut out as a picture: of a wanted kind, with four coordinates and a page."""
    return F.coalesce(kind.isin(*kinds) & (F.size(coords) == 4) & (page > 0), F.lit(False))
