"""Quantities, data sets and entities of evidence items, found by patterns and given by services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfall.functions import text as T
from inkfall.operators import evidence

# Under which keys services give the text and the confidence, the first that is there counting.
TEXT_KEYS = ("rawName", "rawForm", "normalizedForm", "name", "text", "rawValue")
CONFIDENCE_KEYS = ("confidence", "conf", "score", "nerd_score")
#: Named phrases of an item that are kept.
ENTITIES = 10


def by_pattern(text: Column) -> Column:
    """An array of struct<key, text> of what patterns find: quantities, data sets, the first named phrases."""
    def found(key: str, pattern: str, most: int | None = None) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        hits = F.slice(hits, 1, most) if most else hits
        return F.transform(hits, lambda x: F.struct(F.lit(key).alias("key"), x.alias("text")))

    return F.coalesce(F.concat(found("quantities", T.QUANTITY), found("datasets", T.DATASET), found("entities", T.ENTITY, ENTITIES)), F.array().cast("array<struct<key:string,text:string>>"))


def service_annotation(raw: Column, kind: str, source: str) -> Column:
    """One answer of a service (JSON) in the common form: text, type, source, confidence in 0..1, and the rest as metadata."""
    get = lambda k: F.nullif(F.get_json_object(raw, f"$.{k}"), F.lit(""))
    text = F.coalesce(*[get(k) for k in TEXT_KEYS], F.lit(""))
    conf = F.coalesce(*[F.get_json_object(raw, f"$.{k}") for k in CONFIDENCE_KEYS]).try_cast("double")
    rest = F.map_filter(F.from_json(raw, "map<string,string>"), lambda k, _: ~k.isin(*TEXT_KEYS, *CONFIDENCE_KEYS))
    return F.struct(text.alias("text"), F.lit(kind).alias("type"), F.lit(source).alias("source"), F.when(conf.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf))).alias("confidence"), rest.alias("metadata"))


def enriched(items: DataFrame, answers: DataFrame, key: str, source: str) -> DataFrame:
    """``paper_id``, ``item_id`` and ``found`` (text, source) for one key of annotations.

    Answers (id, paper_id, at, text) of a service go to the item in whose text their offset lies, where items are joined by blank
    lines; an item without any keeps what the patterns find. Offsets that are null, negative or between items count nowhere.
    """
    places = evidence.offsets(items).select("paper_id", F.col("item_id").alias("range_index"), "start", "end")
    hits = evidence.containing_range(answers.select("id", "paper_id", "at"), places)
    given = hits.join(answers.select("id", "text"), "id").select(F.col("range_index").alias("item_id"), "id", "text").join(answers.select("id", "paper_id"), "id")
    given = given.groupBy("paper_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("g"))
    own = F.transform(F.filter(by_pattern(F.col("item_text")), lambda x: x["key"] == key), lambda x: F.struct(x["text"].alias("text"), F.lit("heuristic").alias("source")))
    served = F.transform("g", lambda x: F.struct(x["text"].alias("text"), F.lit(source).alias("source")))
    return items.join(given, ["paper_id", "item_id"], "left").select("paper_id", "item_id", F.coalesce(served, own).alias("found"))
