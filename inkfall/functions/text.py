"""String functions as Spark columns."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Boosts and penalties of a section path, by substring.
SECTION_BOOSTS = {"abstract": 40, "introduction": 30, "method": 35, "data": 35, "dataset": 35, "experiment": 35, "result": 35, "evaluation": 30, "discussion": 25, "limitation": 25, "conclusion": 25}
SECTION_PENALTIES = {"reference": -60, "bibliograph": -60, "acknowledg": -40, "funding": -50, "author": -50, "affiliation": -50, "related work": -25, "background": -15, "literature review": -25}

# Patterns of quantities, data sets and capitalised phrases.
QUANTITY = r"(?i)\b\d+(?:\.\d+)?\s*(?:mg|kg|ml|cm|mm|%|h|hr|day|days|year|years)\b"
DATASET = r"(?i)\b(?:MIMIC-III|MIMIC-IV|eICU|UK Biobank|MarketScan)\b"
ENTITY = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\b"

# What makes a sentence noise.
NOISE = (
    r"^\s*\[\d+\]",
    r"^\s*\d+\.\s",
    r"(?i)doi:|https?://doi\.org|10\.\d{4,}/",
    r"[A-Za-z0-9._%+\-]@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}",
    r"(?i)https?://",
    r"(?i)orcid\.org",
    r"\d{4}-\d{4}-\d{4}-\d{4}",
    r"^(?:[A-Z][A-Za-z\-]+(?:\s[A-Z]\.?)?,\s*){2,}.*\d",
    r"^[\d\s\W]+$",
    r"^\s*\d+(?:\.\d+)+\s",
)

# English words that are no keywords.
STOPWORDS = (
    "a about above after again against all am an and any are aren't as at be because been before being below between both but by "
    "can't cannot could couldn't did didn't do does doesn't doing don't down during each few for from further had hadn't has hasn't "
    "have haven't having he he'd he'll he's her here here's hers herself him himself his how how's i i'd i'll i'm i've if in into is "
    "isn't it it's its itself let's me more most mustn't my myself no nor not of off on once only or other ought our ours ourselves out "
    "over own same shan't she she'd she'll she's should shouldn't so some such than that that's the their theirs them themselves then "
    "there there's these they they'd they'll they're they've this those through to too under until up very was wasn't we we'd we'll "
    "we're we've were weren't what what's when when's where where's which while who who's whom why why's with won't would wouldn't you "
    "you'd you'll you're you've your yours yourself yourselves"
).split()

# How a reference and how a section heading begin.
REFERENCE_START = r"(?U)^\s*\[?\d+\]?\s+\w"
SECTION_START = r"^(?:\d+[.\d]*\s+)?[A-Z][A-Za-z\s]{1,49}[A-Za-z]$"

SPACE = r"(?U)\s+"
CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f�]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and in whatever lambda ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse(x: Column) -> Column:
    """Runs of blanks become one, none at the ends."""
    return F.trim(F.regexp_replace(x, SPACE, " "))


def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Characters, after lower-casing, that casefold further: to one character, and to several."""
    one, more = {}, {}
    for o in range(0x80, 0x1E944):
        c = chr(o)
        if not 0xD800 <= o < 0xE000 and c.casefold() != c.lower():
            (one if len(c.casefold()) == 1 else more)[c] = c.casefold()
    return one, more


FOLD_ONE, FOLD_MORE = _foldings()


def _class(letters: Iterable[str]) -> str:
    """A pattern of any of the letters, by ranges."""
    out: list[list[int]] = []
    for o in sorted(map(ord, letters)):
        if out and out[-1][1] == o - 1:
            out[-1][1] = o
        else:
            out.append([o, o])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in out) + "]"


def casefold(x: Column) -> Column:
    """Full case folding: sigma in every place, ligatures and sharp s as letters. Expansions are made only where a text has any."""
    low = F.translate(F.lower(F.replace(x, F.lit("İ"), F.lit("i̇"))), "".join(FOLD_ONE), "".join(FOLD_ONE.values()))
    letters = _class(FOLD_MORE)
    longer = F.create_map(*[F.lit(x) for pair in FOLD_MORE.items() for x in pair])

    def expanded(t: Column) -> Column:
        return F.aggregate(F.array_distinct(F.regexp_extract_all(t, F.lit(letters), F.lit(0))), t, lambda done, c: F.replace(done, c, F.element_at(longer, c)))

    return let(low, lambda t: F.when(t.rlike(letters), expanded(t)).otherwise(t))


def fold_whitespace(x: Column) -> Column:
    """Case-folded, with collapsed blanks."""
    return collapse(casefold(x))


def bare(folded: Column) -> Column:
    """A folded text without anything but letters, digits, underscores and blanks."""
    return collapse(F.regexp_replace(folded, r"(?U)[^\w\s]", ""))


def fold_aggressive(x: Column) -> Column:
    """``fold_whitespace`` without anything but letters, digits, underscores and blanks."""
    return bare(fold_whitespace(x))


def heal_lines(x: Column) -> Column:
    """Join lines unless the next begins with a capital or a list mark."""
    y = F.regexp_replace(x, r"\n(?![A-Z\-*•·])", " ")
    y = F.regexp_replace(y, r"\n{2,}", "\n")
    return F.trim(F.regexp_replace(y, r"[ \t]+", " "))


def without_control(x: Column) -> Column:
    return F.regexp_replace(x, CONTROL, "")


def clean_ocr(x: Column) -> Column:
    """Without control and replacement characters, which part no words; blanks collapsed."""
    return collapse(without_control(x))


def words(x: Column) -> Column:
    return F.filter(F.split(collapse(x), " "), lambda w: w != "")


def estimated_tokens(x: Column) -> Column:
    return F.floor(F.length(x) / 4)


def sentences(x: Column) -> Column:
    """Cut behind . ! ? and blanks; nothing empty."""
    return F.filter(F.transform(F.split(x, r"(?U)(?<=[.!?])\s+"), collapse), lambda s: s != "")


def keywords(x: Column) -> Column:
    """Words that are no stop words."""
    stop = F.array(*[F.lit(v) for v in STOPWORDS])
    return F.filter(words(x), lambda w: ~F.array_contains(stop, F.lower(w)))


def short_hash(x: Column, prefix: str = "") -> Column:
    """The first 16 hex digits of the SHA-256, behind a prefix."""
    return F.concat(F.lit(f"{prefix}:" if prefix else ""), F.substring(F.sha2(x, 256), 1, 16))


def name_year(name: Column) -> Column:
    """A year between separators or ends of a file name; '' if there is none."""
    return F.regexp_extract(name, r"(?:^|[_\-\s.])((?:19|20)\d{2})(?:[_\-\s.]|$)", 1)


def resolved_year(header: Column, metadata: Column, first_page: Column, name: Column) -> Column:
    """Year, confidence and source: the header's or the metadata's (h), the first 2000 characters' (m, h if the name says so too), the name's (m), or nr."""
    year = lambda x: F.nullif(F.coalesce(F.regexp_extract(x, r"(?:19|20)\d{2}", 0), F.lit("")), F.lit(""))
    named = F.nullif(F.coalesce(name_year(name), F.lit("")), F.lit(""))
    h, m, p = year(header), year(metadata), year(F.substring(first_page, 1, 2000))

    def out(y: Column, c: Column, source: str) -> Column:
        return F.struct(y.alias("year"), c.alias("confidence"), F.lit(source).alias("provenance"))

    return (
        F.when(h.isNotNull(), out(h, F.lit("h"), "tei_header"))
        .when(m.isNotNull(), out(m, F.lit("h"), "pdf_metadata"))
        .when(p.isNotNull(), out(p, F.when(named.eqNullSafe(p), "h").otherwise("m"), "first_page_text"))
        .when(named.isNotNull(), out(named, F.lit("m"), "filename_pattern"))
        .otherwise(out(F.lit("nr"), F.lit("nr"), ""))
    )


def location_text(page_index: Column, heading: Column) -> Column:
    """The place of a find, page from 1, with its heading if there is one."""
    page = F.concat(F.lit("p."), (page_index + 1).cast("string"))
    return F.when(F.coalesce(heading, F.lit("")) != "", F.concat(page, F.lit(" — "), heading)).otherwise(page)


def drifted(found: Column, claimed: Column) -> Column:
    return F.lower(F.trim(found)) != F.lower(F.trim(F.coalesce(claimed, F.lit(""))))


def block_kind(explicit: Column, text: Column) -> Column:
    """Kind of a block: what it is said to be, else by its text: a reference is other, a heading a section, any other text a paragraph."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(explicit.isin("paragraph", "section", "table", "figure"), explicit)
        .when((t == "") | t.rlike(REFERENCE_START), "other")
        .when(F.regexp_replace(t, r"(?U)^\s+|\s+$", "").rlike(SECTION_START), "section")
        .otherwise("paragraph")
    )


def first_year(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"(?:19|20)\d{2}", 0), F.lit(""))


def section_score(path: Column) -> Column:
    low = F.lower(F.coalesce(path, F.lit("")))
    total = F.lit(0)
    for key, value in (SECTION_BOOSTS | SECTION_PENALTIES).items():
        total = total + F.when(F.contains(low, F.lit(key)), value).otherwise(0)
    return total


def is_noise(x: Column) -> Column:
    hit = F.lit(False)
    for p in NOISE:
        hit = hit | x.rlike(p)
    return hit


def weird_chars(x: Column) -> Column:
    """Characters beyond ASCII and control characters other than tab and line ends."""
    return F.length(F.regexp_replace(x, r"[\t\n\r\x20-\x7f]", ""))


def confidence_rank(c: Column) -> Column:
    return F.when(c == "h", 3).when(c == "m", 2).when(c == "l", 1).when(c == "nr", 0).otherwise(-1)


def snippet(x: Column, limit: int = 200) -> Column:
    """At most ``limit`` characters, cut at the last blank if there is one."""
    head = F.substring(x, 1, limit)
    at_blank = F.regexp_extract(head, r"(?s)^(.+) [^ ]*$", 1)
    return F.when(F.length(x) <= limit, x).when(at_blank != "", at_blank).otherwise(head)


def json_text(raw: Column) -> Column:
    """The JSON in a model's answer: as it is, inside a fence, or the outermost braces or brackets."""
    t = F.trim(F.regexp_replace(raw, r"^\s+|\s+$", ""))
    fenced = F.regexp_replace(F.regexp_extract(t, r"(?s)```(?:json|JSON)?\s*\n?(.*?)```", 1), r"^\s+|\s+$", "")
    braces, brackets = F.regexp_extract(t, r"(?s)\{.*\}", 0), F.regexp_extract(t, r"(?s)\[.*\]", 0)
    return F.when(t.rlike(r"(?s)^[\{\[].*[\}\]]$"), t).when(fenced != "", fenced).when(braces != "", braces).when(brackets != "", brackets).otherwise(t)


@F.pandas_udf(StringType())
def nfc(x: pd.Series) -> pd.Series:
    """NFC with collapsed blanks."""
    return x.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFC", s).split()))


@F.pandas_udf(StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """NFKC with collapsed blanks."""
    return x.map(lambda s: None if s is None else " ".join(unicodedata.normalize("NFKC", s).split()))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters of two texts (twice the matches by the sum of lengths); two empty texts 1, one 0."""

    def ratio(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        x, y = (" ".join(unicodedata.normalize("NFKC", s).split()) for s in (x, y))
        return 1.0 if not x and not y else 0.0 if not x or not y else difflib.SequenceMatcher(None, x, y).ratio()

    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def scanned_text(x: Column) -> Column:
    """Text of a scan in order: without control characters, NFKC, healed lines."""
    return heal_lines(nfkc(without_control(x)))


#: Normalizers of exported values by name.
NORMALIZERS = {"collapse": collapse, "whitespace": fold_whitespace, "aggressive": fold_aggressive, "line_healing": heal_lines, "unicode": nfkc, "ocr": without_control, "scan": scanned_text}


def normalizer(name: str):
    """The normalizer of a name; an unknown name is an error."""
    if name not in NORMALIZERS:
        raise ValueError(f"no normalizer {name!r}; there are {', '.join(NORMALIZERS)}")
    return NORMALIZERS[name]
