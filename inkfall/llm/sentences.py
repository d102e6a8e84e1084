"""Sentence boundaries across languages and scripts by semi-Markov dynamic programming."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfall.partitioning import spread

# Words that end with a stop inside a sentence, without that stop, in lower case.
BEFORE_NAME = "dr dra drs prof profs pr mr mrs ms mme mlle m st ste sr sra srta dott dott.ssa prof.ssa sig ing hr fr frau herr mgr rev hon gen col capt lt sgt д-р проф акад г гг ул им δρ καθ κ αγ د أ م डॉ प्रो श्री कु"
BEFORE_NUMBER = "no nos nr núm num n fig figs abb tab tabs table eq eqs sect sec chap ch vol vols p pp pág págs pag art suppl app ref refs ver rev ed cap tav taf bd kap abs ziff anm par § рис табл с стр гл п пп т разд σχ πίν πιν κεφ σελ αρ ср ص شكل जि पृ सं"
INSIDE = "e.g i.e eg ie cf cfr vs viz approx ca circa al etc resp incl excl z z.b b d.h d u.a u u.s.w bzw vgl ggf sog usw evtl inkl ca. env d’env d'env p.ex ex p.ej ej es ad ad.es т.е е т.д т.п др см ср напр в н.э π.χ χ βλ κ.λπ δηλ लग inc ltd corp co dept univ est min max sd yr yrs hr hrs mo wk i.v i.m u.s u.k e.u a.m p.m jan feb mar apr jun jul aug sep sept oct nov dec bspw ebd f ff hrsg s o.g z.t zzgl ebenso"

#: Scores: what a candidate gains or loses for what stands before and behind it.
KNOWN, PLAIN, LOWER, INITIAL, NUMBERED, UNBALANCED, TINY = -6.0, 3.0, -8.0, -5.0, -6.0, -9.0, -12.0
#: Characters of a sentence that cost nothing, and how many more of them cost 1.
LONG, STEEP = 350, 150

# What closes each opening sign, wide and narrow brackets alike.
PAIRS = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "(": ")）", "（": "）)", "[": "]", "{": "}", "【": "】", "《": "》", "〈": "〉", "‹": "›"}
_CLOSE = "".join(dict.fromkeys("".join(PAIRS.values())))
_BLANKS = "[ \\t\\u00a0\\u1680\\u2000-\\u200a\\u202f\\u205f\\u3000]"
_ZERO = "­​-‏⁠﻿"
_PARAGRAPH = re.compile(rf"\r?\n(?:{_BLANKS}|[{_ZERO}])*(?:\r?\n\s*)+")
_CANDIDATE = re.compile(
    rf"""
    (?P<dense>[。！？｡]+[」』”’）)\]】》]*)                                  # scripts without blanks
  | (?P<stop>(?:[.!?…؟।॥]+|(?<=[Ͱ-Ͽἀ-῿])[;;])(?:[{_ZERO}])*
        (?:\s?[»])?["”“’'»)\]）」』]*)(?=[{_ZERO}]*\s|\s*$)                   # a stop with what closes behind it
  | (?<=[฀-๿])(?P<thai>(?:[{_ZERO}]*{_BLANKS}+[{_ZERO}]*))(?=[฀-๿])           # a blank between Thai letters
  | (?P<line>\n)                                                            # a heading may end here
    """,
    re.X,
)
_WORD_BEFORE = re.compile(rf"[^\s(\[{{（“„«\"‘:=<>/]*$")
_NEXT = re.compile(rf"[\s{_ZERO}]*((?:[\"“„«‘'(\[（「『¿¡*•–—-][\s{_ZERO}]*)*)[{_ZERO}]*(\S)(\S*)")
_ORDINAL = re.compile(r"(?:^|\s)(?:am|der|dem|den|des|das|die|zum|vom|im|ab|bis|seit|beim|zur|jeder|jedem|jeden|und)\s+\d{1,2}\.$", re.I)
_NUMBER_ONLY = re.compile(r"[\s(]*(?:\d+(?:\.\d+)*|[IVXLC]+|[A-Z])[.)]?\s*")
_MORE = re.compile(r"[^\s\dA-Z(.)]")  # what no text that is but a number has
_HEADING = re.compile(r"^\s*(?:(?:\d+(?:\.\d+)*|[IVX]+)[.)]?\s+)?[^\W\d_][^\n.!?:;,]{1,44}$")


@lru_cache(1)
def _abbreviations() -> tuple[frozenset[str], frozenset[str], frozenset[str]]:
    return tuple(frozenset(map(_fold, x.split())) for x in (BEFORE_NAME, BEFORE_NUMBER, INSIDE))


def _fold(word: str) -> str:
    import unicodedata

    from inkfall.llm.lookalikes import shapes

    plain = unicodedata.normalize("NFKC", re.sub(f"[{_ZERO}]", "", word)).lower()
    return "".join(shapes().get(c, c) for c in plain)


def _stop_score(text: str, begin: int, stop: int, end: int, last: int) -> float:
    """How well a sentence ends at ``end``: the stop begins at ``stop``, the paragraph at ``begin``; it goes to ``last``."""
    mark = text[stop]
    nxt = _NEXT.match(text, end, last)
    if nxt is None:
        return PLAIN
    lead, first, rest = nxt.groups()
    closed = any(c in "”»’\"'“)]）" for c in text[stop:end])
    if first.islower() and not (lead and lead[0] in "¿¡"):
        return LOWER if mark in ".…" or closed else LOWER / 2
    if closed and first in ",;:":
        return LOWER
    if mark not in ".…":
        return PLAIN + 1.0 if first.isupper() or first.isalpha() or lead or first.isdigit() else 0.0
    if text[stop : stop + 3] == "..." or mark == "…":
        return 0.5 if first.isupper() else -2.0
    before = _WORD_BEFORE.search(text, max(begin, stop - 30), stop).group()
    word = _fold(before)
    if closed and text[stop + 1 : end].strip() and not word:
        return PLAIN
    names, numbers, inside = _abbreviations()
    bare = word.strip("'’")
    if word in names or bare in names:
        return KNOWN
    if word in numbers and (first.isdigit() or first in "IVXS"):
        return KNOWN
    if word in inside:
        return KNOWN if not closed else -1.0
    if word in numbers and not closed:
        return KNOWN
    if len(bare) == 1 and bare.isalpha() and before[-1:].isupper() and not closed:
        return INITIAL
    if re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", word) and not closed:
        return KNOWN
    if before.isdigit() and not closed:
        if _ORDINAL.search(text[max(begin, stop - 24) : stop + 1]):
            return NUMBERED
        if first.isdigit():
            return 0.5
    if first.isdigit():
        return PLAIN - 1.5
    if first.isalpha() or lead:
        return PLAIN
    return 0.0


def _dense_score(text: str, stop: int, end: int, last: int) -> float:
    closed = end - stop > 1 and any(c in _CLOSE for c in text[stop:end])
    if closed and end < last and text[end] in "とというのをがはで、，,":
        return LOWER
    return PLAIN


def candidates(text: str, begin: int, end: int) -> list[tuple[int, int, float]]:
    """Places in a paragraph where a sentence may end: its end, the next one's earliest begin, and the score."""
    out = []
    first_line = True
    filled = _trim(text, begin, end)[1]
    for m in _CANDIDATE.finditer(text, begin, end):
        if m["line"]:
            line = text[begin : m.start()]
            nxt = _NEXT.match(text, m.end(), end)
            if first_line and nxt and nxt[2].isupper() and _HEADING.match(line) and len(line) < 46 and _short(text, begin, end, len(line)):
                out.append((m.start(), m.end(), PLAIN + TINY / -4))
            first_line = False
            continue
        if m["thai"]:
            out.append((m.start(), m.end(), PLAIN))
            continue
        if m.end() >= filled:
            continue
        score = _dense_score(text, m.start(), m.end(), end) if m["dense"] else _stop_score(text, begin, m.start(), m.end(), end)
        out.append((m.end(), m.end(), score))
    return out


def _short(text: str, begin: int, end: int, size: int) -> bool:
    """The first line is much shorter than the longest line of its paragraph."""
    return size < 0.75 * max(len(x) for x in text[begin:end].split("\n")[1:])


def _depths(text: str, begin: int, places: list[int]) -> list[int]:
    """At each place the number of quotations and brackets that are open."""
    out, open_, straight = [], [], False
    k = 0
    for at in range(begin, places[-1] + 1 if places else begin):
        while k < len(places) and places[k] == at:
            out.append(len(open_) + straight)
            k += 1
        if at >= len(text):
            break
        c = text[at]
        if c == '"':
            straight = not straight
        elif c == "“" and open_ and open_[-1] == "„":
            open_.pop()
        elif c in PAIRS:
            open_.append(c)
        elif c in _CLOSE and open_ and c in PAIRS[open_[-1]]:
            open_.pop()
    while len(out) < len(places):
        out.append(len(open_) + straight)
    return out


def _length_score(text: str, a: int, b: int) -> float:
    """Of a span without blanks around."""
    if a >= b or _NUMBER_ONLY.fullmatch(text, a, b):
        return TINY
    return (-1.0 if b - a < 8 and ord(text[a]) < 0x2E80 else 0.0) - max(0, b - a - LONG) / STEEP


def spans(text: str) -> list[tuple[int, int]]:
    """Begin and end of every sentence of a text, blanks around left out.

    An empty line ends a unit. Within a paragraph the best chain of whole sentences is chosen among all spans
    between candidate places: a span scores by its length, by what stands at its end and behind it (closing and
    opening words), and by whether quotations and brackets balance in it. No span is too long to be chosen.
    """
    out: list[tuple[int, int]] = []
    at = 0
    bounds = [(m.start(), m.end()) for m in _PARAGRAPH.finditer(text)]
    for stop, nxt in [*bounds, (len(text), len(text))]:
        if text[at:stop].strip():
            out += _paragraph(text, at, stop)
        at = nxt
    return out


class _Begins:
    """The places where the sentence that ends next may begin, without those that can't win any more.

    Of two begins a < b, b can't win if at every later end the span from a scores as much, and a can't if the span from b
    scores more. Their spans differ by what the chain before them scores, by their length, by balance (once UNBALANCED at
    most, never if both stand equally deep), and by TINY if one is but a number. Both tests take the worst case, so what
    they drop is never part of the best chain; what they keep lies near the end or before an open quotation.
    """

    def __init__(self, text: str, loose: int):
        self.text, self.loose = text, loose
        self.kept: list[tuple[int, int, float, int]] = []  # place in the chain, first character, score so far, depth

    def _turn(self, mine: int, other: int) -> float:
        """The most that a begin of depth ``other`` can gain by balance on one of depth ``mine``."""
        return 0.0 if mine == other or other > 2 * self.loose else -UNBALANCED

    def add(self, place: int, at: int, score: float, depth: int) -> None:
        beaten = False
        rest = []
        for old in self.kept:
            _, a, best, deep = old
            apart = at - a
            if not beaten and best - 1.0 - apart / STEEP - self._turn(deep, depth) >= score and _MORE.search(self.text, a, at):
                beaten = True
            if score + TINY - self._turn(depth, deep) + max(0, apart - LONG) / STEEP <= best:
                rest.append(old)
        if not beaten:
            rest.append((place, at, score, depth))
        self.kept = rest


def _paragraph(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    found = candidates(text, begin, end)
    if not found:
        return [_trim(text, begin, end)]
    ends = [e for e, _, _ in found] + [end]
    starts = [begin] + [s for _, s, _ in found]
    score = [s for _, _, s in found] + [0.0]
    depth = [0, *_depths(text, begin, ends)]
    # A closing sign that is missing at the end of the paragraph must not hold everything before it together.
    loose = depth[-1]
    n = len(ends)
    first = [_skip(text, a, end) for a in starts]
    last = [_skip_back(text, b, begin) for b in ends]
    back = [0] * (n + 1)
    begins = _Begins(text, loose)
    begins.add(0, first[0], 0.0, 0)
    for j in range(1, n + 1):
        best = float("-inf")
        for i, a, before, deep in begins.kept:
            level = abs(depth[j] - deep) if j < n else max(0, abs(depth[j] - deep) - loose)
            inside = UNBALANCED if level or (j < n and depth[j] > loose) else 0.0
            value = before + score[j - 1] + _length_score(text, a, last[j - 1]) + inside
            if value > best:
                best, back[j] = value, i
        if j < n:
            begins.add(j, first[j], best, depth[j])
    cuts = []
    j = n
    while j:
        cuts.append((first[back[j]], last[j - 1]))
        j = back[j]
    return [(a, b) for a, b in reversed(cuts) if a < b]


def _skip(text: str, at: int, end: int) -> int:
    while at < end and text[at].isspace():
        at += 1
    return at


def _skip_back(text: str, at: int, begin: int) -> int:
    while at > begin and text[at - 1].isspace():
        at -= 1
    return at


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    part = text[a:b]
    return a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("char_start", pa.int32()), ("char_end", pa.int32())]))
    for batch in batches:
        rows = [[{"char_start": a, "char_end": b} for a, b in spans(t)] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, kind)], ["key", "spans"])


def split_sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``sentence_index``, ``char_start`` and ``char_end`` of every sentence of every text.

    Offsets count code points from 0, end exclusive. Null, empty and blank texts have no sentence. Each row is
    handled by itself, whatever its length; repeated rows come out repeated; nothing is shuffled.
    """
    rows = spread(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null"), "key")
    kind = dict(rows.dtypes)["key"]
    found = rows.mapInArrow(_split, f"key {kind}, spans array<struct<char_start:int,char_end:int>>")
    flat = found.select(F.col("key").alias(key), F.posexplode("spans").alias("sentence_index", "s"))
    return flat.select(key, "sentence_index", "s.char_start", "s.char_end")
