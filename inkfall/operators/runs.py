"""Run reports, usage summaries, manifests and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ("pdf_content_hash", "model_id")


def stage_summaries(usage: DataFrame) -> DataFrame:
    """Per stage the requests, summed tokens and cache rate (0 where nothing came in), and when it was first seen."""
    rate = F.when(F.sum("input_tokens") > 0, F.sum("cached_tokens") / F.sum("input_tokens")).otherwise(0.0)
    return usage.groupBy("stage").agg(
        F.count("*").alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("cached_tokens").alias("cached_tokens"), F.sum("output_tokens").alias("output_tokens"), rate.alias("cache_rate"), F.min("seq").alias("first_seq")
    )


def low_cache(summaries: DataFrame, percent: float = 50.0, least: int = 3) -> DataFrame:
    return summaries.filter((F.col("requests") >= least) & (F.col("cache_rate") * 100 < percent))


def drifting(usage: DataFrame) -> DataFrame:
    """Stages and versions with more than one prefix hash, the hashes in the order first seen."""
    first = usage.groupBy("stage", "version", "prefix").agg(F.min("seq").alias("seq"))
    per = first.groupBy("stage", "version").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("seq", "prefix"))).alias("p"))
    return per.filter("n > 1").select("stage", "version", "n", F.array_join(F.transform("p", lambda x: x["prefix"].cast("string")), ",").alias("prefixes"))


def totals(usage: DataFrame) -> DataFrame:
    """One row of run totals; without any usage the status says so and the figures are null."""
    none = F.count("*") == 0
    inp, out, cached = F.sum("input_tokens"), F.sum("output_tokens"), F.sum("cached_tokens")
    return usage.agg(
        F.when(none, "telemetry_unavailable").otherwise("ok").alias("status"), inp.alias("input_tokens"), out.alias("output_tokens"),
        F.when(inp > 0, cached / inp).when(~none, 0.0).alias("cache_rate"), F.when(inp > 0, out / inp).when(~none, 0.0).alias("output_ratio"),
    )


def identities(inputs: DataFrame, map_text: Column, config: Column) -> DataFrame:
    """The five hashes that say what a result came from: the file, the model, the prompt's and the configuration's text, the field map's."""
    digest = lambda x: F.coalesce(F.sha2(x, 256), F.lit("nohash"))
    return inputs.withColumn("map_hash", digest(map_text)).withColumn("config_hash", digest(config)).withColumn("prompt_hash", digest(F.concat_ws("|", map_text, config)))


def pending(inputs: DataFrame, manifest: DataFrame, key: str = "paper_id", identity: tuple[str, ...] = IDENTITY) -> DataFrame:
    """Inputs without a complete manifest entry of the same identity; an unknown part of the identity never matches."""
    same = F.lit(True)
    for c in identity:
        same = same & F.col(f"i.{c}").isNotNull() & (F.col(f"i.{c}") == F.col(f"m.{c}"))
    done = inputs.alias("i").join(manifest.filter("status = 'complete'").alias("m"), (F.col(f"i.{key}") == F.col(f"m.{key}")) & same, "left_anti")
    return done.select(key).distinct()


def manifest(before: DataFrame, entries: DataFrame, key: str = "paper_id") -> DataFrame:
    """The manifest after a run: of each input its new entry, else the one it had; of several new ones the last by ``at``."""
    cols = [c for c in before.columns if c != key]
    rows = before.withColumn("_new", F.lit(0)).unionByName(entries.select(*before.columns).withColumn("_new", F.lit(1)))
    best = F.max(F.struct("_new", "at", *[c for c in cols if c != "at"]))
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("b")).select(key, *[F.col(f"b.{c}").alias(c) for c in cols])


#: Domains before the last one, which has a chunk of its own.
DOMAINS = 12
# The last domain of each chunk, for three and for five chunks.
CHUNK_ENDS = {5: (3, 5, 9, 12), 3: (5, 12)}


def chunk_of(domain: Column, chunks: int = 5) -> Column:
    """The chunk of a domain (from 1); the domain after the first DOMAINS goes to the last one. Other numbers of chunks share evenly, the first ones more."""
    ends = CHUNK_ENDS.get(chunks)
    if ends is None:
        share, more = divmod(DOMAINS, chunks - 1)
        ends = [(k + 1) * share + min(k + 1, more) for k in range(chunks - 1)]
    out = F.when(domain == DOMAINS + 1, chunks)
    for k, end in enumerate(ends, 1):
        out = out.when(domain.between(1, end), k)
    return out


def chunk_ranges(fields: DataFrame, chunks: int = 5) -> DataFrame:
    """The least and largest field of each chunk; a field of no known domain is an error."""
    domain = F.split_part("domain_group", F.lit("."), F.lit(1)).cast("int")
    chunk = F.coalesce(chunk_of(domain, chunks), F.raise_error(F.concat(F.lit("no domain "), F.col("domain_group"))).cast("int"))
    return fields.select(chunk.alias("chunk"), "field_index").groupBy("chunk").agg(F.min("field_index").alias("lo"), F.max("field_index").alias("hi"), F.count("*").alias("n_fields"))


def chunk_fields(fields: DataFrame, chunks: int = 5) -> DataFrame:
    """Every field with every chunk whose range holds it; ranges that overlap give it more than once."""
    ranges = F.broadcast(chunk_ranges(fields, chunks).select("chunk", "lo", "hi"))  # one row per chunk
    return fields.join(ranges, F.col("field_index").between(F.col("lo"), F.col("hi"))).select("chunk", "field_index")


def delta(now: DataFrame, before: DataFrame) -> DataFrame:
    """How a run's totals differ from those of the run before: cache rate, uncached tokens per request, all tokens; nulls if that one is not complete."""
    uncached = lambda t: F.when(t["requests"] > 0, (t["input_tokens"] - t["cached_tokens"]) / t["requests"]).otherwise(0.0)
    tokens = lambda t: t["input_tokens"] + t["output_tokens"]
    rate = lambda t: F.when(t["input_tokens"] > 0, t["cached_tokens"] / t["input_tokens"]).otherwise(0.0)
    both = now.agg(F.first(F.struct("*")).alias("n")).crossJoin(before.filter("status = 'complete'").agg(F.first(F.struct("*")).alias("b")))  # one row each
    n, b = F.col("n"), F.col("b")
    return both.select((rate(n) - rate(b)).alias("cache_rate_change"), (uncached(n) - uncached(b)).alias("uncached_change"), (tokens(n) - tokens(b)).alias("tokens_change"))


def run_report(usage: DataFrame) -> DataFrame:
    """One row with a run's report as JSON: totals, stages in the order first seen, the five most expensive requests."""
    stages = stage_summaries(usage).agg(F.array_sort(F.collect_list(F.struct("first_seq", "stage", "requests", "input_tokens", "cached_tokens", "output_tokens"))).alias("stages"))
    top = usage.select("seq", (F.col("input_tokens") + F.col("output_tokens")).alias("total")).orderBy(F.desc("total"), "seq").limit(5)
    top = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("o"), "seq"))).alias("top"))
    parts = totals(usage).crossJoin(stages).crossJoin(top)  # one row each
    doc = F.struct("status", "input_tokens", "output_tokens", F.transform("stages", lambda x: x.dropFields("first_seq")).alias("per_stage"), F.transform("top", lambda x: x["seq"]).alias("top_requests"))
    return parts.select(F.to_json(doc).alias("report"))


def web_annotations(notes: DataFrame) -> DataFrame:
    """Annotation records as linked-data JSON with ids made from their keys.

    The target has the quotation with its context and, of a scanned sentence, the place on its page, of another one the character range.
    """
    body = F.struct(F.lit("TextualBody").alias("type"), F.col("body_text").alias("value"))
    quote = F.struct(F.lit("TextQuoteSelector").alias("type"), "quote_selector.exact", "quote_selector.prefix", "quote_selector.suffix")
    range_ = F.struct(F.lit("TextPositionSelector").alias("type"), F.col("char_start").alias("start"), F.col("char_end").alias("end"))
    place = F.struct(F.lit("FragmentSelector").alias("type"), F.concat(F.lit("xywh="), "xywh").alias("value"), F.col("page_index").alias("page"))
    scanned = F.col("selector_type") == "FragmentSelector"
    refined = F.struct(F.when(~scanned, range_).alias("position"), F.when(scanned, place).alias("fragment"))
    target = F.struct(F.col("paper_id").alias("source"), F.struct(quote.alias("quote"), refined.alias("refinedBy")).alias("selector"))
    doc = F.struct(F.lit("http://www.w3.org/ns/anno.jsonld").alias("@context"), F.concat(F.lit("urn:annotation:"), F.col("ann_id")).alias("id"), F.lit("Annotation").alias("type"), body.alias("body"), target.alias("target"))
    return notes.select("ann_id", F.to_json(doc).alias("jsonld"))
