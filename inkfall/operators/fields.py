"""Merging, ranking, checking and reporting extracted fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfall.functions import text as T

RANK = {"h": 3, "m": 2, "l": 1, "nr": 0}


def merged(records: DataFrame) -> DataFrame:
    """One row per paper and field: value, confidence, locations, and whether the values conflict.

    Values are compared up to blanks; 'nr' and empty ones don't count. One value: it is kept with the best
    confidence and all locations; none: 'nr'; several, or a row that is ``malformed`` (if there is such a column): a conflict. All
    parts are partial aggregates.
    """
    value = T.collapse(F.coalesce("extracted_value", F.lit("")))
    kept = F.when((value != "") & (value != "nr"), value)
    rank = T.confidence_rank(F.lower(F.trim(F.coalesce("confidence", F.lit("nr")))))
    bad = F.coalesce("malformed", F.lit(False)) if "malformed" in records.columns else F.lit(False)
    rows = records.filter("paper_id is not null and field_index is not null").select("paper_id", "field_index", kept.alias("v"), F.when(kept.isNotNull(), rank).alias("r"), F.when(kept.isNotNull(), F.col("loc")).alias("loc"), bad.alias("bad"))
    out = rows.groupBy("paper_id", "field_index").agg(
        F.count_distinct("v").alias("n_values"), F.min("v").alias("v"), F.max("r").alias("r"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("loc")))).alias("locs"), F.bool_or("bad").alias("bad")
    )
    one, none = (F.col("n_values") == 1) & ~F.col("bad"), (F.col("n_values") == 0) & ~F.col("bad")
    names = F.when(F.col("r") == 3, "h").when(F.col("r") == 2, "m").when(F.col("r") == 1, "l").otherwise("nr")
    return out.select(
        "paper_id", "field_index", F.when(one, F.col("v")).when(none, "nr").alias("merged_value"), F.when(one, names).otherwise("nr").alias("merged_confidence"),
        F.when(one, F.array_join("locs", ",")).otherwise("").alias("locations"), ((F.col("n_values") > 1) | F.col("bad")).alias("conflict"), "n_values",
    )


def runs_without_conflict(merged_rows: DataFrame) -> DataFrame:
    """Per paper whether no field conflicts, so nothing is left to be synthesised, and how many do."""
    n = F.count(F.when(F.col("conflict"), 1))
    return merged_rows.groupBy("paper_id").agg((n == 0).alias("skipped_synthesis"), n.alias("n_conflicts"))


def conflict_candidates(records: DataFrame, merged_rows: DataFrame, items: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` candidates of each field that conflicts, best confidence first, with the beginning of their evidence."""
    open_ = merged_rows.filter("conflict").select("paper_id", "field_index")
    best = ranked_candidates(records, top).join(open_, ["paper_id", "field_index"], "left_semi")
    rows = best.join(records.select("record_id", "field_name", F.col("extracted_value").alias("value"), "loc"), "record_id")
    loc = rows.select("record_id", "paper_id", F.posexplode("loc").alias("pos", "item_id")).join(items.select("paper_id", "item_id", "item_text"), ["paper_id", "item_id"]).filter("item_text <> ''")
    text = loc.groupBy("record_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item_text"))), lambda x: x["item_text"]), "\n").alias("t"))
    return rows.join(text, "record_id", "left").select("paper_id", "field_index", "record_id", "place", "field_name", "value", F.array_join(F.coalesce("loc", F.array().cast("array<string>")), ",").alias("evidence_ids"), T.snippet(F.coalesce("t", F.lit(""))).alias("snippet"))


def synthesis_fields(merged_rows: DataFrame, fields: DataFrame, domain: int = 13) -> DataFrame:
    """The fields that a paper's synthesis is asked for: those of its own domain and those that conflict, each once."""
    own = fields.filter(F.split_part("domain_group", F.lit("."), F.lit(1)).cast("int") == domain).select("field_index")
    papers = merged_rows.select("paper_id").distinct()
    every = papers.withColumn("field_index", F.explode(F.lit(sorted(r[0] for r in own.collect())).cast("array<int>")))
    return every.unionByName(merged_rows.filter("conflict").select("paper_id", "field_index")).distinct()


def prefilled(values: DataFrame, fields: DataFrame) -> DataFrame:
    """Values known beforehand (paper_id, field_index, value) as records: sure if there is one, else not reported; unknown fields are left out."""
    v = F.coalesce(F.nullif("value", F.lit("")), F.lit("nr"))
    named = values.join(F.broadcast(fields.select("field_index", "field_name")), "field_index")
    return named.select("paper_id", "field_index", "field_name", v.alias("extracted_value"), F.when(v == "nr", "nr").otherwise("h").alias("confidence"))


def left_to_ask(papers: DataFrame, fields: DataFrame, known: DataFrame) -> DataFrame:
    """Every field of every paper but those known beforehand."""
    every = papers.select("paper_id").distinct().withColumn("field_index", F.explode(F.lit(sorted(r[0] for r in fields.select("field_index").distinct().collect()))))
    return every.join(known.select("paper_id", "field_index"), ["paper_id", "field_index"], "left_anti")


def protected(*parts: DataFrame) -> DataFrame:
    """The items that any sure value (confidence h) of the parts (paper_id, confidence, loc) rests on."""
    rows = [p.filter("confidence = 'h'").select("paper_id", F.explode("loc").alias("item_id")) for p in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.distinct()


def final_fields(merged_rows: DataFrame, synthesised: DataFrame) -> DataFrame:
    """The fields that merged without conflict and, of the others, what was synthesised (paper_id, field_index, value, confidence), in field order."""
    kept = merged_rows.filter("not conflict").select("paper_id", "field_index", F.col("merged_value").alias("value"), F.col("merged_confidence").alias("confidence"))
    open_ = merged_rows.filter("conflict").select("paper_id", "field_index")
    return kept.unionByName(synthesised.join(open_, ["paper_id", "field_index"], "left_semi")).orderBy("paper_id", "field_index")


def report_totals(records: DataFrame) -> DataFrame:
    """One row: papers, fields, those flagged (l or nr) and those not reported."""
    c = F.lower(F.trim("confidence"))
    return records.agg(F.count_distinct("paper_id").alias("n_papers"), F.count("*").alias("n_fields"), F.count(F.when(c.isin("l", "nr"), 1)).alias("n_flagged"), F.count(F.when(F.col("extracted_value") == "nr", 1)).alias("n_missing"))


def every_field(merged_rows: DataFrame, fields: DataFrame) -> DataFrame:
    """A row for every paper and every field of the map, 'nr' where no source gave one."""
    dense = merged_rows.select("paper_id").distinct().withColumn("field_index", F.explode(F.lit(sorted(r[0] for r in fields.select("field_index").distinct().collect()))))
    return dense.join(merged_rows.select("paper_id", "field_index", "merged_value"), ["paper_id", "field_index"], "left").withColumn("merged_value", F.coalesce("merged_value", F.lit("nr")))


def ranked_candidates(records: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` records of each paper and field, by confidence, then in record order."""
    rank = T.confidence_rank(F.lower(F.trim(F.coalesce("confidence", F.lit("nr")))))
    w = Window.partitionBy("paper_id", "field_index").orderBy(F.desc("rank"), "record_id")
    rows = records.filter("paper_id is not null").withColumn("rank", rank).withColumn("place", F.row_number().over(w))
    return rows.filter(F.col("place") <= top).select("paper_id", "field_index", "record_id", "rank", "place")


def not_reported(records: DataFrame, top: int = 10) -> DataFrame:
    """The fields most often 'nr', with their share of all papers in percent; a report of ``top`` rows."""
    total = records.select(F.count_distinct("paper_id").alias("total"))
    counts = records.filter("extracted_value = 'nr'").groupBy("field_index", "field_name").agg(F.count("*").alias("n_missing"))
    return counts.crossJoin(total).select("field_index", "field_name", "n_missing", (F.col("n_missing") * 100.0 / F.col("total")).alias("missing_rate")).orderBy(F.desc("n_missing"), "field_index", "field_name").limit(top)


def wide(records: DataFrame, names: list[str]) -> DataFrame:
    """One row per paper, one column per field name; the latest record's value, '' where there is none."""
    latest = F.max(F.struct("record_id", "extracted_value"))["extracted_value"]
    return records.filter("paper_id is not null").groupBy("paper_id").pivot("field_name", names).agg(latest).na.fill("", names)


def problems(records: DataFrame) -> DataFrame:
    """What is wrong with each final record, as a list of messages; none for a valid one."""
    c = F.lower(F.trim("confidence"))
    checks = F.array_compact(F.array(
        F.when(F.col("paper_id").isNull(), "paper_id"),
        F.when(F.col("field_index").isNull() | (F.col("field_index") < 1), "field_index"),
        F.when(F.col("extracted_value").isNull(), "extracted_value"),
        F.when(c.isNull() | ~c.isin(*RANK), "confidence"),
        F.when(F.exists(F.coalesce("loc", F.array().cast("array<string>")), lambda x: ~x.rlike(r"^[STF]\d{6}$")), "location"),
    ))
    return records.select("record_id", F.array_join(checks, "|").alias("errors"))
