"""Splitting oversized items at natural boundaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of one estimated token.
TOKEN_CHARS = 4

# Boundaries from the strongest to the weakest, each as what must stand before the cut.
BOUNDARIES = (
    r"(?<=\n\r?\n)",
    r"(?<=[.!?…][\"'”’»)\]]{0,2}\s)",
    r"(?<=[。！？।؟][」』”’）]{0,2})",
    r"(?<=\n)",
    r"(?<=[;:,،]\s)",
    r"(?<=[、，；：])",
    r"(?<=\s)",
    r"(?![\p{M}‍])",
)


def estimated_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / TOKEN_CHARS)


def _pattern(least: Column, most: Column) -> Column:
    """Alternatives in order of strength, each taking as much as it can; the last takes plain characters."""
    run = F.concat(F.lit(".{"), least.cast("string"), F.lit(","), most.cast("string"), F.lit("}"))
    rest = F.concat(F.lit(".{1,"), most.cast("string"), F.lit("}"))
    parts = [F.lit("(?s)"), rest, F.lit(r"\z")]
    for b in BOUNDARIES:
        parts += [F.lit("|"), run, F.lit(b)]
    return F.concat(*parts, F.lit("|"), rest)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(sizes: Column) -> Column:
    """Running sums of an array of n numbers: sums of about sqrt(n) blocks, then sums within each, so no step copies what grows."""
    zero = F.lit(0)

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, b: a + b)

    def within(x: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(x))).cast("int")
        blocks = F.transform(F.sequence(zero, F.floor((F.size(x) - 1) / width).cast("int")), lambda b: total(F.slice(x, b * width + 1, width)))
        ahead = lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        place = lambda i: F.floor(i / width).cast("int")
        return _let(_let(blocks, ahead), lambda done: F.transform(x, lambda _, i: F.get(done, place(i)) + total(F.slice(x, place(i) * width + 1, F.pmod(i, width) + 1))))

    return F.when(F.size(sizes) <= 1, sizes).otherwise(_let(sizes, within))


def split_oversized(
    items: DataFrame,
    limits: DataFrame,
    text: str = "item_text",
    on: str = "stage",
    limit: str = "item_limit",
    overlap: str = "overlap_tokens",
) -> DataFrame:
    """One row per piece of every item.

    ``limits`` has one row per value of ``on`` with the token limit of an item and the overlap of consecutive
    pieces. Adds ``piece_index`` (from 0), ``n_pieces``, ``char_start``, ``char_end`` (of the piece, with its
    overlap), ``piece_text`` and ``piece_tokens``; an input column of such a name is replaced. The text itself is not
    carried along: a long one would come out once per piece.

    A piece has at most ``limit`` tokens. It begins with the last ``overlap`` tokens' characters of the text before it
    (all of it, where there is less) and ends at the strongest boundary found in the second half of its own room; without
    any boundary it is filled with characters, not parting a letter from its accents where that is possible. The pieces
    without their overlaps are the text again.

    Null and empty texts, texts within the limit, and items whose ``on`` is null or has no limit come out as one
    piece. A limit below 1 counts as none, a null or negative overlap as 0. An overlap that is not below its limit can't be
    kept, as no piece would get on: the query stops with an error that names it. Repeated rows come out repeated.
    """
    added = ["piece_index", "n_pieces", "char_start", "char_end", "piece_text", "piece_tokens"]
    items = items.drop(*[c for c in added if c != text])
    others = [c for c in items.columns if c != text]
    kept = [F.col(f"i.{c}") for c in others]
    rules = limits.filter(F.col(limit) >= 1).groupBy(on).agg(F.min(limit).alias("_limit"), F.min(overlap).alias("_over"))
    t = F.col(f"i.{text}")
    limited = items.alias("i").join(rules.alias("r"), F.col(f"i.{on}") == F.col(f"r.{on}"), "left")
    most = F.col("_limit") * TOKEN_CHARS + (TOKEN_CHARS - 1)
    given = F.greatest(F.coalesce("_over", F.lit(0)), F.lit(0))
    refused = F.raise_error(F.format_string("an overlap of %d tokens does not go with a limit of %d", F.col("_over"), F.col("_limit")))
    over = F.when(given < F.col("_limit"), given).otherwise(refused.cast("int")).cast("int") * TOKEN_CHARS
    own = (most - over).cast("int")
    # A cut that leaves less than half the room is not looked for, nor one within the overlap where there is room beyond it.
    least = F.greatest(F.least(over, own - 1), F.floor(own / 2), F.lit(1)).cast("int")
    large = F.length(t) > most
    cores = F.when(large, F.regexp_extract_all(t, _pattern(least, own), F.lit(0))).otherwise(F.array(t))
    back = F.ceil(over / least).cast("int")
    rows = limited.select(*kept, *[F.when(large, x).otherwise(0).alias(c) for c, x in (("_over", over), ("_back", back))], cores.alias("_cores"))
    rows = rows.withColumn("_ends", _running(F.transform("_cores", F.length)))

    def before(i: Column) -> Column:
        """The overlap of piece ``i``: it may reach over several pieces before it."""
        first = F.greatest(i - F.col("_back"), F.lit(0))
        return F.right(F.array_join(F.slice("_cores", first + 1, i - first), ""), F.col("_over"))

    piece = F.transform(
        "_cores",
        lambda c, i: F.struct(
            i.alias("at"),
            F.when(i > 0, F.greatest(F.get("_ends", i - 1) - F.col("_over"), F.lit(0))).otherwise(0).alias("start"),
            F.get("_ends", i).alias("end"),
            F.when((i > 0) & (F.col("_over") > 0), F.concat(before(i), c)).otherwise(c).alias("body"),
        ),
    )
    out = rows.select(*others, F.size("_cores").alias("n_pieces"), F.explode(piece).alias("_p"))
    return out.select(
        *others,
        F.col("_p.at").alias("piece_index"),
        "n_pieces",
        F.col("_p.start").alias("char_start"),
        F.col("_p.end").alias("char_end"),
        F.col("_p.body").alias("piece_text"),
        estimated_tokens(F.col("_p.body")).alias("piece_tokens"),
    )
