"""Token budgets of prompts: limits, checks, pruning and what is left over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The stages' limits where none is given, and the order of a prompt's sections.
DEFAULTS = {"extraction_chunk": 100_000, "validation_repair": 20_000, "synthesis": 120_000, "cache_warmup": 10_000}
SECTIONS = ("system", "evidence", "field_definitions", "prior_context")
#: Between evidence items in a prompt.
JOINER = "\n\n"


def limits(budgets: DataFrame) -> DataFrame:
    """``stage`` and ``budget_limit``: the given limit if it is a positive whole number, else the stage's default."""
    base = budgets.sparkSession.createDataFrame(list(DEFAULTS.items()), "stage string, fallback int")
    given = budgets.groupBy("stage").agg(F.max(F.when(F.col("budget_limit").try_cast("int") > 0, F.col("budget_limit").try_cast("int"))).alias("given"))
    both = given.join(F.broadcast(base), "stage", "full")
    return both.select("stage", F.coalesce("given", "fallback", F.lit(DEFAULTS["extraction_chunk"])).alias("budget_limit"))


def with_limit(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Every row with its stage's limit; a stage that is null or unknown has that of an extraction."""
    lim = F.broadcast(limits(budgets))
    return rows.join(lim, "stage", "left").withColumn("budget_limit", F.coalesce("budget_limit", F.lit(DEFAULTS["extraction_chunk"])))


def prompts(items: DataFrame) -> DataFrame:
    """Per paper and stage the length of the evidence as it stands in a prompt (items joined by blank lines) and the number of items."""
    filled = items.select("paper_id", "stage", F.length(F.coalesce("item_text", F.lit(""))).alias("n"))
    return filled.groupBy("paper_id", "stage").agg((F.sum("n") + (F.count("*") - 1) * len(JOINER)).alias("evidence_chars"), F.count("*").alias("n_items"))


def checked(items: DataFrame, budgets: DataFrame) -> DataFrame:
    """The tokens of each paper's and stage's prompt, rounded down once, against the limit."""
    est = F.floor(F.col("evidence_chars") / 4)
    rows = with_limit(prompts(items).withColumn("estimate", est), budgets)
    return rows.select("paper_id", "stage", "estimate", "budget_limit", (F.col("estimate") <= F.col("budget_limit")).alias("within_budget"))


def _cut_down(chars: Column, others: Column, limit: Column) -> Column:
    """Characters that are left after tenths are cut off until the prompt fits; each cut is of a tenth, so 400 of them end any text."""
    def step(n: Column, _: Column) -> Column:
        over = (n > 0) & (F.floor((n + others) / 4) > limit)
        return F.when(over, n - F.greatest(F.lit(1).cast("bigint"), F.floor(n / 10))).otherwise(n)

    return F.aggregate(F.sequence(F.lit(1), F.lit(400)), chars.cast("bigint"), step)


def mitigated(items: DataFrame, others: DataFrame, budgets: DataFrame, max_items: int = 150, max_chars: int = 10_000) -> DataFrame:
    """What each prompt becomes: ``status`` ok, pruned or rejected, with the estimate before and after, items and characters kept.

    ``others`` (paper_id, other_chars) are the characters of the other sections. Over the limit, the first ``max_items`` items
    stay, of these the longest beginning that fits (one at least), of its text ``max_chars`` characters, and of these what is left
    when tenths are cut off until it fits. Only lengths go through the plan; running sums replace trying item by item.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("paper_id", "stage").orderBy("item_id")
    n = F.length(F.coalesce("item_text", F.lit("")))
    run = items.select("paper_id", "stage", "item_id", n.alias("n")).withColumn("place", F.row_number().over(w))
    run = run.withColumn("chars", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) + (F.col("place") - 1) * len(JOINER))
    other = others.select("paper_id", "other_chars")
    run = with_limit(run.join(other, "paper_id", "left").withColumn("other_chars", F.coalesce("other_chars", F.lit(0))), budgets)
    fits = F.floor((F.col("chars") + F.col("other_chars")) / 4) <= F.col("budget_limit")
    kept = (F.col("place") <= max_items) & (fits | (F.col("place") == 1))
    per = run.groupBy("paper_id", "stage").agg(
        F.max("chars").alias("all_chars"), F.max("place").alias("all_items"), F.max(F.when(kept, F.col("chars"))).alias("kept_chars"), F.max(F.when(kept, F.col("place"))).alias("kept_items"),
        F.max("other_chars").alias("other_chars"), F.max("budget_limit").alias("budget_limit"),
    )
    before = F.floor((F.col("all_chars") + F.col("other_chars")) / 4)
    ok = before <= F.col("budget_limit")
    left = _cut_down(F.least(F.col("kept_chars"), F.lit(max_chars)), F.col("other_chars"), F.col("budget_limit"))
    out = per.withColumn("estimate", before).withColumn("chars", F.when(ok, F.col("all_chars")).otherwise(left)).withColumn("n_items", F.when(ok, F.col("all_items")).otherwise(F.col("kept_items")))
    out = out.withColumn("after", F.floor((F.col("chars") + F.col("other_chars")) / 4))
    status = F.when(F.col("estimate") <= F.col("budget_limit"), "ok").when(F.col("after") <= F.col("budget_limit"), "pruned").otherwise("rejected")
    return out.select("paper_id", "stage", status.alias("status"), "estimate", "after", "n_items", "chars", "budget_limit")


def ordered_sections(parts: Column) -> Column:
    """The texts of a prompt's sections (a map): the known ones in their order, then the others by name."""
    rank = lambda name: F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), name), F.lit(0)), F.lit(len(SECTIONS) + 1))
    entries = F.transform(F.map_entries(parts), lambda e: F.struct(rank(e["key"]).alias("rank"), e["key"].alias("name"), e["value"].alias("text")))
    return F.array_sort(entries)


def top_sections(parts: Column, top: int = 3) -> Column:
    """The ``top`` sections with most tokens, the first by name on ties; a report."""
    sized = F.transform(F.map_entries(parts), lambda e: F.struct((-F.floor(F.length(e["value"]) / 4)).alias("minus"), e["key"].alias("name")))
    return F.transform(F.slice(F.array_sort(sized), 1, top), lambda s: F.struct(s["name"].alias("name"), (-s["minus"]).alias("tokens")))


def prompt_text(parts: Column) -> Column:
    """A prompt: its sections' texts in their order, so what does not change stands first."""
    return F.array_join(F.transform(ordered_sections(parts), lambda s: s["text"]), "")


def field_lines(fields: DataFrame, by: str = "chunk") -> DataFrame:
    """The definitions of a chunk's fields as lines in field order: index, name, what is asked and in what form."""
    line = F.concat_ws(" | ", F.col("field_index").cast("string"), "field_name", "definition", "reviewer_question", "format", "categories_or_examples")
    per = fields.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("field_index", line.alias("line")))).alias("l"))
    return per.select(by, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("field_definitions"))
