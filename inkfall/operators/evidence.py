"""Evidence items: ids, scores, budgets, provenance and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T


def unique_items(items: DataFrame) -> DataFrame:
    return items.dropDuplicates(["paper_id", "item_id"])


def numbered(items: DataFrame) -> DataFrame:
    """Running ids per paper and type: S, F or T and six digits, in the order of ``item_id``."""
    letter = F.when(F.col("item_type") == "figure_caption", "F").when(F.col("item_type") == "table", "T").otherwise("S")
    w = Window.partitionBy("paper_id", "letter").orderBy("item_id")
    return items.withColumn("letter", letter).withColumn("new_id", F.format_string("%s%06d", "letter", F.row_number().over(w))).drop("letter")


def carried_sections(items: DataFrame) -> DataFrame:
    """A missing section path is that of the item before."""
    w = Window.partitionBy("paper_id").orderBy("item_id").rowsBetween(Window.unboundedPreceding, 0)
    return items.withColumn("section", F.last("section_path", ignorenulls=True).over(w))


def scored(items: DataFrame) -> DataFrame:
    extra = F.when(F.col("item_type") == "figure_caption", 5).when(F.col("item_type") == "table", 10).otherwise(0)
    return items.withColumn("rank_score", T.section_score(F.col("section_path")) + extra)


def field_tokens(fields: DataFrame) -> list[str]:
    """The words of four or more letters a-z in the fields' names, definitions and questions; the field map is a small configuration table."""
    text = F.concat_ws(" ", "field_name", "definition", "reviewer_question")
    words = fields.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")).distinct()
    return sorted(r[0] for r in words.collect())


def keyword_overlap(text: Column, tokens: list[str]) -> Column:
    """How many of the tokens occur in a text, anywhere in it."""
    every = F.array(*[F.lit(t) for t in tokens]).cast("array<string>")
    return T.let(F.lower(text), lambda low: F.size(F.filter(every, lambda t: F.contains(low, t))))


def ranked(items: DataFrame, tokens: list[str]) -> DataFrame:
    """``rank_score`` with three points more for every token of the fields that the item's text has."""
    return scored(items).withColumn("rank_score", F.col("rank_score") + 3 * F.coalesce(keyword_overlap(F.col("item_text"), tokens), F.lit(0)))


def within_budget(items: DataFrame, max_items: int = 150, max_chars: int = 10_000) -> DataFrame:
    """Greedy choice per paper by (-score, id): an item that would exceed ``max_chars`` is passed over, smaller ones still taken.

    The choice is sequential, so a paper's (score, id, length) triples are folded in one array; texts are joined back after it.
    Left out before, as they can't be chosen: items longer than ``max_chars``, and of each length those behind as many as fill the budget.
    """
    w = Window.partitionBy("paper_id").orderBy(F.desc("rank_score"), "item_id")
    n = F.length(F.coalesce("item_text", F.lit("")))
    sized = items.filter("item_id is not null").withColumn("n", n).filter(F.col("n") <= max_chars)
    # If one item of a length is passed over, no later one of that length fits: of those taken all before them were taken too.
    sized = sized.withColumn("ahead", F.row_number().over(w.partitionBy("paper_id", "n"))).filter((F.col("ahead") <= max_items) & ((F.col("n") == 0) | (F.col("ahead") * F.col("n") <= max_chars)))
    sized = sized.select("paper_id", F.struct((-F.col("rank_score")).alias("s"), F.col("item_id").alias("id"), "n").alias("x"))
    per = sized.groupBy("paper_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    zero = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("ids"))

    def take(acc, x):
        fits = (F.size(acc["ids"]) < max_items) & (acc["used"] + x["n"] <= max_chars)
        return F.when(fits, F.struct((acc["used"] + x["n"]).alias("used"), F.concat(acc["ids"], F.array(x["id"])).alias("ids"))).otherwise(acc)

    chosen = per.select("paper_id", F.explode(F.aggregate("xs", zero, take, lambda a: a["ids"])).alias("item_id"))
    return items.join(chosen, ["paper_id", "item_id"])


def packages(chosen: DataFrame) -> DataFrame:
    """Per paper the chosen items as one JSON text in order of their ids, the same bytes whenever the items are the same."""
    item = F.struct(F.col("item_id").alias("id"), F.col("item_type").alias("type"), F.col("section_path").alias("section"), "page", "coords", F.coalesce("item_text", F.lit("")).alias("text"))
    per = chosen.groupBy("paper_id").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    doc = F.struct("paper_id", F.size("evidence").alias("evidence_count"), "evidence")
    return per.select("paper_id", F.size("evidence").alias("evidence_count"), F.to_json(doc, {"ignoreNullFields": "false"}).alias("package"))


def chunk_choice(items: DataFrame, fields: DataFrame, max_items: int = 150, max_chars: int = 10_000) -> DataFrame:
    """The choice within the budget for every chunk by itself (fields: chunk, field_name, definition, reviewer_question): ``chunk`` and ``item_id`` per paper.

    Every item is ranked once per chunk by that chunk's words; chunks are a handful of rows.
    """
    text = F.concat_ws(" ", "field_name", "definition", "reviewer_question")
    words = fields.select("chunk", F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")).distinct()
    tokens = F.broadcast(words.groupBy("chunk").agg(F.collect_list("w").alias("tokens")))
    rows = scored(items).crossJoin(tokens)
    overlap = T.let(F.lower(F.coalesce("item_text", F.lit(""))), lambda low: F.size(F.filter("tokens", lambda t: F.contains(low, t))))
    rows = rows.withColumn("rank_score", F.col("rank_score") + 3 * overlap).select(F.struct("paper_id", "chunk").alias("paper_id"), "item_id", "item_text", "rank_score")
    return within_budget(rows, max_items, max_chars).select("paper_id.paper_id", "paper_id.chunk", "item_id")


def reduction(packed: DataFrame, texts: DataFrame) -> DataFrame:
    """By what share a package is shorter than its paper's text (paper_id, n_chars); 0 if it is not."""
    both = packed.join(texts, "paper_id")
    return both.select("paper_id", F.when(F.col("n_chars") > 0, F.greatest(F.lit(0.0), 1 - F.length("package") / F.col("n_chars"))).otherwise(0.0).alias("reduction"))


def offsets(items: DataFrame, joiner: int = 2) -> DataFrame:
    """Where each item's text lies in its paper's items joined in id order by ``joiner`` characters; empty texts have no place."""
    w = Window.partitionBy("paper_id").orderBy("item_id").rowsBetween(Window.unboundedPreceding, 0)
    filled = items.filter("item_text <> ''").withColumn("n", F.length("item_text"))
    end = F.sum(F.col("n") + joiner).over(w) - joiner
    return filled.select("paper_id", "item_id", (end - F.col("n")).cast("int").alias("start"), end.cast("int").alias("end"))


def kept_prefix(items: DataFrame, protected: DataFrame, max_chars: int) -> DataFrame:
    """Items in id order while their running length fits, and all protected ones."""
    w = Window.partitionBy("paper_id").orderBy("item_id").rowsBetween(Window.unboundedPreceding, 0)
    run = items.withColumn("running", F.sum(F.length("item_text")).over(w))
    marked = run.join(protected.select("paper_id", "item_id").distinct().withColumn("held", F.lit(True)), ["paper_id", "item_id"], "left")
    return marked.filter((F.col("running") <= max_chars) | F.coalesce("held", F.lit(False))).drop("held")


def provenance(fields: DataFrame, items: DataFrame) -> DataFrame:
    """Per record the texts of its located items in order, joined by line ends, and the ids that are unknown."""
    loc = fields.select("record_id", "paper_id", F.posexplode_outer("loc").alias("pos", "item_id"))
    texts = items.select("paper_id", "item_id", "item_text")
    both = loc.join(texts, ["paper_id", "item_id"], "left")
    known = F.when((F.col("item_text") != "") & F.col("item_text").isNotNull(), F.struct("pos", "item_text"))
    return both.groupBy("record_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(known)), lambda t: t["item_text"]), "\n").alias("evidence"),
        F.count(F.when(F.col("item_id").isNotNull() & F.col("item_text").isNull(), 1)).alias("unresolved"),
    )


def containing_range(points: DataFrame, ranges: DataFrame, width: int = 256) -> DataFrame:
    """Interval join: (id, paper_id, at) with the range (paper_id, range_index, start, end) that holds it, start <= at < end; the first on ties.

    Ranges are laid into cells of ``width``, so the join is an equi-join on paper and cell and a long range or paper spreads over its cells.
    """
    cells = ranges.filter("end > start and start >= 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    at = points.filter("at is not null and at >= 0").withColumn("cell", F.floor(F.col("at") / width))
    hit = at.join(cells, ["paper_id", "cell"]).filter("start <= at and at < end")
    return hit.groupBy("id").agg(F.min("range_index").alias("range_index"))
