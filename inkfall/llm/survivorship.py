"""Best representative of each duplicate group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ways of saying that nothing was reported, in lower case and without blanks, stops and dashes.
NOTHING = ("", "nr", "n/a", "na", "null", "none", "nan", "nil", "?", "not reported", "not stated", "not available", "not applicable", "unknown", "unreported", "missing")

#: Papers up to which their keys go to all tasks.
SMALL = 500_000

# Confidence by its first letter.
TRUST = {"h": 3, "m": 2, "l": 1}


def has_value(text: Column) -> Column:
    """False for nulls and for texts that say in some way that there is no value."""
    plain = F.lower(F.regexp_replace(text, r"(?U)[\s_]+", " "))
    bare = F.regexp_replace(plain, r"(?U)^[\s\p{Pd}−.…*\"'()\[\]]+|[\s\p{Pd}−.…*\"'()\[\]]+$", "")
    return F.coalesce(~bare.isin(*NOTHING) & ~F.regexp_replace(bare, r"\.\s?", "").isin(*NOTHING) & bare.rlike(r"[^?]"), F.lit(False))


def trust_rank(confidence: Column) -> Column:
    """h 3, m 2, l 1, anything else 0, whatever the spelling."""
    c = F.lower(F.trim(confidence))
    rank = F.lit(0)
    for letter, n in TRUST.items():
        rank = F.when(c.rlike(f"^{letter}"), F.lit(n)).otherwise(rank)
    return rank


def file_key(name: Column) -> Column:
    """A file name without folder, query, copy mark, ending, case and kind of separator."""
    x = F.lower(F.trim(name))
    x = F.regexp_replace(x, r"[?#].*$", "")
    x = F.regexp_replace(x, r"%20|\+", " ")
    x = F.regexp_replace(x, r"%5f", "_")
    x = F.regexp_replace(x, r"%2d", "-")
    x = F.regexp_replace(x, r"%2f|%5c", "/")
    x = F.regexp_replace(x, r"^.*[/\\]", "")
    for _ in range(2):
        x = F.regexp_replace(x, r"\s+$|\.pdf$", "")
        x = F.regexp_replace(x, r"[\s_-]*\(\d+\)$|[\s_-]+copy(?:[\s_-]*\(?\d+\)?)?$", "")
    x = F.regexp_replace(x, r"\.pdf$", "")
    x = F.regexp_replace(x, r"[\s._-]+", "_")
    return F.nullif(F.regexp_replace(x, r"^_+|_+$", ""), F.lit(""))


def with_paper(records: DataFrame, papers: DataFrame) -> DataFrame:
    """Fill a missing ``paper_id`` by the paper whose file the record names; records of no known paper keep a null.

    Only records without an id are looked up; the others carry keys that meet nothing, spread by their files, so the records
    are read once and no key is hot. Of papers with the same file key the smallest id counts.
    """
    known = papers.select(file_key(F.col("source_pdf")).alias("_key"), F.col("paper_id").alias("_paper")).filter("_key is not null")
    known = known.groupBy("_key").agg(F.min("_paper").alias("_paper"))
    asked = F.when(F.col("paper_id").isNull(), file_key(F.col("source_pdf")))
    nothing = F.concat(F.lit("\x00"), F.pmod(F.xxhash64("source_pdf", "paper_id"), F.lit(65_536)).cast("string"))
    keyed = records.withColumn("_key", F.coalesce(asked, nothing))
    few = papers.select("paper_id").count() <= SMALL
    both = keyed.join(F.broadcast(known) if few else known, "_key", "left")
    return both.withColumn("paper_id", F.coalesce("paper_id", "_paper")).select(*records.columns)


def surviving(
    records: DataFrame,
    keys: list[str],
    columns: dict[str, Column],
    rank: Column,
    updated: Column,
    record_id: Column,
) -> DataFrame:
    """One row per group: of every column the best value and the record it comes from.

    ``columns`` names each column with the condition that it has a value. The best value is that of the highest
    ``rank``, then the latest ``updated`` (a null is the earliest), then the smallest ``record_id``; one aggregation
    takes the extreme of a composite struct per column, with partial ones before the shuffle, so a hot group
    costs no more than its map-side partials. Rank and time are negated in it, so ids of any kind settle ties by the smallest. Result: the keys, ``first_record_id``, ``n_records`` (distinct ids) and per column a struct
    ``<column>`` of ``value`` and ``record_id``, null where no record has a value. Rows with a null key form no
    group and are left out; repeated rows change nothing; ties are settled by the record id.
    """
    best = []
    for name, valid in columns.items():
        own = valid & F.col(name).isNotNull()
        # The greatest rank and time, and among those the smallest id: one struct, of which the least is taken.
        late = F.coalesce(-F.unix_micros(updated.cast("timestamp")), F.lit((1 << 63) - 1))
        s = F.struct((-rank).cast("int").alias("rank"), late.alias("at"), record_id.alias("record_id"), F.col(name).alias("value"))
        top = F.min(F.when(own, s))
        best.append(F.when(top.isNotNull(), F.struct(top["value"].alias("value"), top["record_id"].alias("record_id"))).alias(name))
    rows = records.filter(" and ".join(f"`{k}` is not null" for k in keys))
    return rows.groupBy(*keys).agg(F.min(record_id).alias("first_record_id"), F.max(record_id).alias("_last"), *best).withColumn(
        "several", F.col("_last") > F.col("first_record_id")
    ).drop("_last")
