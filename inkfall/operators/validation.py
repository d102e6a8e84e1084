"""Checks of model outputs and of final records."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfall.functions import text as T

# The keys of a compact extraction, its confidences, and the names under which a list of them may come.
KEYS = ("c", "i", "loc", "v")
CONFIDENCE = ("h", "m", "l", "nr")
WRAPPERS = ("extractions", "fields", "items")


def extractions(raw: Column) -> Column:
    """The objects in a model's answer, as JSON texts: a list, or an object that holds one; null if there is none."""
    def found(text: Column) -> Column:
        inner = F.coalesce(*[F.get_json_object(text, f"$.{k}") for k in WRAPPERS])
        # A list of strings keeps the text of each object; what is no JSON gives null.
        return F.when(F.try_parse_json(text).isNotNull(), F.from_json(F.when(text.startswith("["), text).otherwise(inner), "array<string>"))

    return T.let(T.json_text(F.coalesce(raw, F.lit(""))), found)


def item_error(item: Column) -> Column:
    """What is wrong with one extraction, by the first rule that it breaks; null if nothing is."""
    wanted = F.array(*[F.lit(k) for k in KEYS])

    def broken(keys: Column) -> Column:
        kind = lambda key: F.schema_of_variant(F.try_variant_get(F.try_parse_json(item), f"$.{key}", "variant"))
        return (
            F.when(keys.isNull(), "no_object")
            .when(F.size(F.array_except(wanted, keys)) > 0, "missing_keys")
            .when(F.size(F.array_except(keys, wanted)) > 0, "unexpected_keys")
            .when(~F.coalesce(F.get_json_object(item, "$.c").isin(*CONFIDENCE), F.lit(False)), "confidence")
            .when(kind("i") != "BIGINT", "index")
            .when(~kind("loc").isin("ARRAY<STRING>", "ARRAY<VOID>"), "locations")
        )

    return T.let(F.json_object_keys(item), broken)


def chunk_errors(outputs: DataFrame, expected: DataFrame, evidence: DataFrame, keys: tuple[str, ...] = ("paper_id", "chunk")) -> DataFrame:
    """``keys`` and ``error`` of every output (keys, raw): null if it is valid.

    An output is valid if it is a list of as many extractions as fields are expected (keys, field_index), each with the right
    keys and kinds of values and with known locations (``evidence``: paper_id, item_id), and if the fields are the expected
    ones. The error is the first rule broken: parse, count, then by place in the list ``<place>:<rule>``, then indices. Everything
    but the known locations is decided in the row; those are an anti join of the exploded locations.
    """
    want = expected.groupBy(*keys).agg(F.array_sort(F.collect_list("field_index")).alias("want"))
    rows = outputs.join(want, list(keys), "left").withColumn("want", F.coalesce("want", F.array().cast("array<int>"))).withColumn("found", extractions(F.col("raw")))
    rows = rows.withColumn("errors", F.transform("found", item_error))
    loc = rows.select(*keys, F.posexplode("found").alias("at", "x")).select(*keys, "at", F.explode(F.from_json(F.get_json_object("x", "$.loc"), "array<string>")).alias("item_id"))
    unknown = loc.join(evidence.select("paper_id", "item_id"), ["paper_id", "item_id"], "left_anti").groupBy(*keys).agg(F.min("at").alias("unknown_at"))
    rows = rows.join(unknown, list(keys), "left")
    wrong = F.transform("errors", lambda e, i: F.when(e.isNotNull(), F.struct(i.alias("at"), e.alias("rule"))))
    first = F.array_min(F.array_compact(F.array_append(wrong, F.when(F.col("unknown_at").isNotNull(), F.struct(F.col("unknown_at").alias("at"), F.lit("unknown_location").alias("rule"))))))
    got = F.array_sort(F.transform("found", lambda x: F.get_json_object(x, "$.i").try_cast("int")))
    error = (
        F.when(F.col("found").isNull(), "parse")
        .when(F.size("found") != F.size("want"), "count")
        .when(first.isNotNull(), F.concat(first["at"].cast("string"), F.lit(":"), first["rule"]))
        .when(got != F.col("want"), "indices")
    )
    return rows.select(*keys, error.alias("error"))


def reconstructed(compact: DataFrame, fields: DataFrame, evidence: DataFrame) -> DataFrame:
    """Compact extractions (key, paper_id, i, v, loc, c) with their field's name and group and the texts of their locations in order.

    An index that the map does not have is an error of the whole query, as nothing can be said of such a field.
    """
    named = compact.join(F.broadcast(fields.select(F.col("field_index").alias("i"), "domain_group", "field_name", F.lit(True).alias("known"))), "i", "left")
    named = named.withColumn("known", F.coalesce("known", F.raise_error(F.concat(F.lit("no field "), F.col("i").cast("string"))).cast("boolean"))).filter("known")
    loc = compact.select("key", "paper_id", F.posexplode("loc").alias("pos", "item_id")).join(evidence.select("paper_id", "item_id", "item_text"), ["paper_id", "item_id"])
    texts = loc.filter("item_text <> ''").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "item_text"))).alias("t"))
    text = F.coalesce(F.array_join(F.transform("t", lambda x: x["item_text"]), "\n"), F.lit(""))
    return named.join(texts, "key", "left").select("key", F.col("i").alias("field_index"), "domain_group", "field_name", F.col("v").alias("extracted_value"), text.alias("evidence"), F.col("c").alias("confidence"))


def cross_references(records: DataFrame, location: str = "location", metadata: str = "metadata") -> Column:
    """Messages for every metadata id that is neither among the row's locations nor 'unresolved'."""
    known = F.coalesce(location, F.array().cast("array<string>"))
    bad = F.transform(metadata, lambda m, i: F.when(m.isNotNull() & (m != "unresolved") & ~F.array_contains(known, m), F.format_string("field_index=%d | location_metadata[%d].id=%s", "field_index", i, m)))
    return F.array_compact(F.coalesce(bad, F.array().cast("array<string>")))


_KINDS = {"string": ("string",), "integer": ("int", "bigint", "smallint", "tinyint"), "number": ("double", "float", "int", "bigint"), "boolean": ("boolean",)}


def schema_messages(df: DataFrame, schema: dict[str, Any], path: str = "$") -> Column:
    """A column of messages, one for each rule of a JSON schema that a row breaks, in order of the properties.

    Rules: ``required``, and per property ``type`` (of the column), ``minimum``, ``maximum``, ``minLength``, ``enum``, ``pattern`` and, of arrays,
    the ``pattern`` and ``enum`` of their ``items``. The schema is compiled to predicates once; rows are checked in the JVM.
    """
    types, out = dict(df.dtypes), []

    def message(name: str, bad: Column, text: str) -> None:
        out.append(F.when(F.coalesce(bad, F.lit(False)), f"path={path}.{name} | {text}"))

    for name in schema.get("required", ()):
        message(name, F.col(name).isNull() if name in types else F.lit(True), "is required")
    for name, rule in sorted(schema.get("properties", {}).items()):
        if name not in types:
            continue
        c, kind = F.col(name), rule.get("type")
        if kind in _KINDS and types[name] not in _KINDS[kind] or kind == "array" and not types[name].startswith("array"):
            message(name, c.isNotNull(), f"is no {kind}")
            continue
        if "minimum" in rule:
            message(name, c < rule["minimum"], f"is less than {rule['minimum']}")
        if "maximum" in rule:
            message(name, c > rule["maximum"], f"is more than {rule['maximum']}")
        if "minLength" in rule:
            message(name, F.length(c) < rule["minLength"], "is too short")
        if "enum" in rule:
            message(name, ~c.isin(*rule["enum"]), "is none of the values")
        if "pattern" in rule:
            message(name, ~c.rlike(rule["pattern"]), "does not match")
        inner = rule.get("items", {})
        if "pattern" in inner:
            message(name, F.exists(c, lambda x: ~x.rlike(inner["pattern"])), "has an item that does not match")  # noqa: B023
        if "enum" in inner:
            message(name, F.exists(c, lambda x: ~x.isin(*inner["enum"])), "has an item that is none of the values")  # noqa: B023
    return F.array_compact(F.array(*out))


# What a final record must be.
FINAL_RECORD = {
    "required": ["field_index", "domain_group", "field_name", "extracted_value", "confidence"],
    "properties": {
        "field_index": {"type": "integer", "minimum": 1},
        "domain_group": {"type": "integer", "minimum": 1},
        "field_name": {"type": "string", "minLength": 1},
        "extracted_value": {"type": "string"},
        "evidence": {"type": "string"},
        "loc": {"type": "array", "items": {"pattern": r"^[STF]\d{6}$"}},
        "confidence": {"type": "string", "enum": ["h", "m", "l", "nr"]},
    },
}

# What a text block must be.
BLOCK = {"required": ["text", "page_index"], "properties": {"text": {"type": "string", "minLength": 1}, "page_index": {"type": "integer", "minimum": 0}, "bbox": {"type": "array"}}}
