"""One consistent form for texts that look alike."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters of other scripts with the shape of a Latin letter, each followed by that letter.
SHAPES = (
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ѵv ӏl АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS Ѵ V ԌG ҮY ԚQ ԜW Һ H "
    "οo νv ρp ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ "
    "օo սu հh ցg ոn ՏS ՕO ɡg ɑa ıı ꓐB ꓑP ꓒd ꓓD"
)

# Characters of no width, as ranges of code points.
NO_WIDTH = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xE0100, 0xE01EF))

# Hyphens that look like the plain one.
HYPHENS = "‐‑﹣－˗"

# The kinds of compatibility form that change nothing but width, joining or ligature.
FORMS = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")


# Where settled characters are looked for in runs, the frequent blocks first; elsewhere each goes by itself.
RUNS = ((0x0, 0x24F), (0x4E00, 0x9FFF), (0x3000, 0x30FF), (0xE00, 0xE7F), (0x900, 0x97F), (0x400, 0x45F), (0x370, 0x3FF), (0x600, 0x6FF), (0xAC00, 0xD7A3), (0x2010, 0x205F), (0x5D0, 0x5EA), (0x980, 0xDFF), (0x1F300, 0x1FAFF))


@lru_cache(1)
def shapes() -> dict[str, str]:
    return {x[0]: x[-1] for x in SHAPES.split() if len(x) == 2 and x[0] != x[1]}


def _no_width(o: int) -> bool:
    return any(a <= o <= b for a, b in NO_WIDTH)


@lru_cache(1)
def decompositions() -> dict[str, list[tuple[str, int]]]:
    """Of every character that is not plain: the characters it is made of by its look, each with its combining class."""
    shape = shapes()

    def parts(ch: str, deep: int = 0) -> str:
        if ch in HYPHENS:
            return "-"
        if unicodedata.category(ch) == "Zs" or ch == "\t":
            return " "
        raw = unicodedata.decomposition(ch)
        if not raw or deep > 8:
            return shape.get(ch, ch)
        fields = raw.split()
        if fields[0].startswith("<"):
            if fields[0] not in FORMS or (len(fields) > 2 and fields[1] == "0020") or ch in shape:
                return shape.get(ch, ch)
            fields = fields[1:]
        return "".join(parts(chr(int(x, 16)), deep + 1) for x in fields)

    out: dict[str, list[tuple[str, int]]] = {}
    for o in (*range(0x30000), *range(0xE0100, 0xE01F0)):  # beyond, nothing has parts or no width
        if 0xAC00 <= o <= 0xD7A3 or 0xD800 <= o <= 0xDFFF or 0xE000 <= o <= 0xF8FF:
            continue
        ch = chr(o)
        if _no_width(o):
            out[ch] = []
            continue
        made = parts(ch)
        if made != ch or unicodedata.combining(ch):
            out[ch] = [(c, unicodedata.combining(c)) for c in made]
    return out


@lru_cache(1)
def compositions() -> dict[str, str]:
    """Pairs of a letter and a mark that have a character of their own."""
    out: dict[str, str] = {}
    for o in range(0xC0, 0x2FFFF):
        if 0xAC00 <= o <= 0xD7A3 or 0xD800 <= o <= 0xDFFF:
            continue
        raw = unicodedata.decomposition(chr(o))
        if raw and not raw.startswith("<") and len(f := raw.split()) == 2:
            pair = "".join(chr(int(x, 16)) for x in f)
            if unicodedata.normalize("NFC", pair) == chr(o):
                out[pair] = chr(o)
    return out


def _settled(ch: str) -> bool:
    """The character is its own consistent form when it stands alone."""
    made = decompositions().get(ch)
    if made is None:
        return True
    if not made or made[0][1]:
        return False
    return _compose([c for c, _ in made]) == ch


def _compose(chars: list[str]) -> str:
    pairs, out = compositions(), ""
    last = -1
    for c in chars:
        k = unicodedata.combining(c)
        if out and k and last < k and (n := pairs.get(out[-1] + c)) and last <= 0:
            out = out[:-1] + n
            continue
        last = k
        out += c
    return out


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def _ranges(test, first: int = 0, last: int = 0x2FFFF) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for o in range(first, last + 1):
        if 0xD800 <= o <= 0xDFFF or not test(chr(o)):
            continue
        if out and out[-1][1] == o - 1:
            out[-1] = (out[-1][0], o)
        else:
            out.append((o, o))
    return out


@lru_cache(1)
def _patterns() -> tuple[str, str, str]:
    """Regular expressions: pieces of a text (settled runs, or one character with its marks), marks, and plain runs."""
    mark = _class(_ranges(lambda c: bool(unicodedata.combining(c))) + [r for r in NO_WIDTH if r[0] < 0x30000])
    plain = _class([(a, b) for lo, hi in RUNS for a, b in _ranges(_settled, lo, hi) if b - a >= 2])
    return rf"(?s)[{plain}]+(?![{mark}])|.[{mark}]*+", mark, plain


def character_table(spark: SparkSession) -> DataFrame:
    """``c`` and ``parts`` (its characters by look, with combining class). Its size is bounded by Unicode."""
    kind = pa.list_(pa.struct([("s", pa.string()), ("k", pa.int32())]))
    parts = pa.array([[{"s": s, "k": k} for s, k in p] for p in decompositions().values()], kind)
    return spark.createDataFrame(pa.table({"c": pa.array(list(decompositions())), "parts": parts}))


def composed(units: Column) -> Column:
    """A letter with its marks in order of class, joined into characters of their own where there are such."""
    pairs = F.from_json(F.lit(json.dumps(compositions())), "map<string,string>")

    def step(acc: Column, u: Column) -> Column:
        n = F.try_element_at(pairs, F.concat(acc["base"], u["s"]))
        joins = (u["k"] > 0) & (acc["last"] < u["k"]) & (acc["rest"] == "") & n.isNotNull()
        # A later mark of another class may still join the letter across marks that did not.
        over = (u["k"] > 0) & (acc["last"] < u["k"]) & (acc["rest"] != "") & n.isNotNull()
        starts = u["k"] == 0
        return F.when(joins | over, F.struct(acc["done"].alias("done"), n.alias("base"), acc["rest"].alias("rest"), acc["last"].alias("last"))).when(
            starts, F.struct(F.concat(acc["done"], acc["base"], acc["rest"]).alias("done"), u["s"].alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))
        ).otherwise(F.struct(acc["done"].alias("done"), acc["base"].alias("base"), F.concat(acc["rest"], u["s"]).alias("rest"), u["k"].alias("last")))

    zero = F.struct(F.lit("").alias("done"), F.lit("").alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))
    return F.aggregate(units, zero, step, lambda a: F.concat(a["done"], a["base"], a["rest"]))


def by_look(texts: DataFrame, keys: list[str], text: str, out: str = "look") -> DataFrame:
    """``keys`` and ``out``: every text in one consistent form, in which texts that look alike are equal.

    A text is cut into pieces: runs of characters that are settled as they are, and single other characters with
    the marks that follow. Pieces are exploded with their positions, the unsettled ones further into code points;
    a broadcast join (bounded by Unicode) gives each its parts by look: width and ligature forms, composed letters,
    blanks and hyphens, letters of other scripts with a Latin shape; characters of no width vanish. Marks are
    ordered by class and joined to their letter again, and the pieces are put together. Case, accents, raised
    digits, the number of blanks and line ends are kept.

    ``keys`` must identify the row. The rows are shuffled by ``keys`` once, as whole texts, unless they are so
    already; exploding and regrouping then happen in place, so neither a hot key of another column nor a long text
    moves exploded rows. A null text gives null, an empty one ''. Repeated rows must be removed by the caller.
    """
    spark = texts.sparkSession
    pattern, mark, _ = _patterns()
    table = F.broadcast(character_table(spark))
    rows = texts.select(*keys, F.col(text).alias("_t"))
    pieces = rows.select(*keys, F.posexplode_outer(F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).alias("_at", "_piece"))
    # A settled run is one unit; anything else is a single character, maybe with marks.
    single = F.length("_piece") == 1
    marked = F.col("_piece").rlike(rf"^.[{mark}]+$")
    units = F.when(~single & marked, F.split("_piece", "")).otherwise(F.array("_piece"))
    flat = pieces.select(*keys, "_at", F.posexplode_outer(units).alias("_i", "_c"))
    known = flat.join(table, flat["_c"] == table["c"], "left")
    parts = F.coalesce("parts", F.when(F.col("_c").isNotNull(), F.array(F.struct(F.col("_c").alias("s"), F.lit(0).alias("k")))))
    each = known.select(*keys, "_at", F.struct("_i", parts.alias("parts")).alias("_u"))
    piece = each.groupBy(*keys, "_at").agg(F.collect_list("_u").alias("_us"))
    piece = piece.select(*keys, "_at", F.flatten(F.transform(F.array_sort("_us"), lambda u: u["parts"])).alias("_o"))
    o = F.col("_o")
    placed = F.transform(
        o,
        lambda x, i: F.struct(F.size(F.filter(F.slice(o, 1, i + 1), lambda y: y["k"] == 0)).alias("block"), x["k"].alias("k"), i.alias("i"), x["s"].alias("s")),
    )
    whole = (
        F.when(F.size(o) == 1, F.get(o, F.lit(0))["s"])
        .when(F.exists(o, lambda x: x["k"] > 0), composed(F.array_sort(placed)))
        .otherwise(F.array_join(F.transform(o, lambda x: x["s"]), ""))
    )
    made = piece.select(*keys, "_at", whole.alias("_w")).groupBy(*keys).agg(F.collect_list(F.struct("_at", "_w")).alias("_ws"), F.max("_at").alias("_last"))
    joined = F.array_join(F.transform(F.array_sort("_ws"), lambda w: w["_w"]), "")
    # A row without a piece has an empty or a null text.
    blank = rows.select(*keys, F.when(F.col("_t") == "", F.lit("")).alias(out)).filter(rows["_t"].isNull() | (rows["_t"] == ""))
    return made.filter("_last is not null").select(*keys, joined.alias(out)).unionByName(blank)


def presence(checks: DataFrame, reports: DataFrame, least: int = 10) -> DataFrame:
    """``check_id`` of needles of ``least`` or more characters that are in their text by look but not by character.

    The needle is searched in the text of the report of the same paper and source. Only texts in which a needle was
    not found as it stands are brought to the consistent form, each once.
    """
    needles = checks.filter(F.length("needle") >= least).select("check_id", "paper_id", "source", "needle").distinct()
    texts = reports.filter("full_pdf_text is not null").select("report_id", "paper_id", "source", "full_pdf_text")
    open_ = needles.join(texts, ["paper_id", "source"]).filter(~F.contains("full_pdf_text", "needle"))
    asked = open_.groupBy("report_id").agg(F.first("full_pdf_text").alias("text"), F.collect_set(F.struct("check_id", "needle")).alias("asked"))
    looks = by_look(asked, ["report_id"], "text")
    keyed = open_.select("report_id", "check_id", "needle").distinct()
    wanted = by_look(keyed, ["report_id", "check_id"], "needle", "wanted")
    both = wanted.join(looks, "report_id")
    return both.filter((F.length("wanted") > 0) & F.contains("look", "wanted")).select("check_id").distinct()


def same_look(rows: DataFrame, key: str, left: Column, right: Column) -> DataFrame:
    """``key`` of the rows whose two texts differ as strings but look alike."""
    pairs = rows.select(F.col(key), left.alias("left"), right.alias("right")).filter("left <> right").distinct()
    sides = pairs.select(key, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("t")), F.struct(F.lit(1).alias("side"), F.col("right").alias("t")))).alias("s")).select(key, "s.*")
    looks = by_look(sides.repartition(key), [key, "side"], "t")
    return looks.groupBy(key).agg(F.min("look").alias("a"), F.max("look").alias("b"), F.count("*").alias("n")).filter("n = 2 and a = b").select(key)
