"""Languages of documents and of their segments by rank-order n-gram profiles."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfall.checkpoints import cut
from inkfall.partitioning import spread

# The languages, each with its other codes and names.
NAMES = {
    "ar": "ara arabic العربية",
    "de": "deu ger german deutsch",
    "el": "ell gre greek ελληνικά",
    "en": "eng english",
    "es": "spa spanish español espanol castellano",
    "fr": "fra fre french français francais",
    "hi": "hin hindi हिन्दी",
    "it": "ita italian italiano",
    "ja": "jpn japanese 日本語",
    "pt": "por portuguese português portugues",
    "ru": "rus russian русский",
    "th": "tha thai ไทย",
    "zh": "zho chi cmn chinese mandarin 中文",
}
LANGS = tuple(NAMES)

#: n-grams of a profile, and the most letters of an n-gram.
PROFILE = 400
ORDER = 3
#: Documents per language that a profile is fitted on, in expectation, drawn by hash.
SAMPLE = 3000
#: Cost of a change of language between sentences, in n-grams quite out of place.
SWITCH = 25.0


def label_code(label: Column) -> Column:
    """The code of the language that a label names, in whatever spelling or with a region; null if it names none."""
    plain = F.lower(F.trim(label))
    base = F.regexp_replace(plain, r"(?U)[\s_\-(,;/].*$", "")
    names = F.from_json(F.lit(_json()), "map<string,string>")
    return F.coalesce(F.try_element_at(names, plain), F.try_element_at(names, base))


def _json() -> str:
    import json

    return json.dumps({n: code for code, names in NAMES.items() for n in (code, *names.split())})


_QUOTE = re.compile("“[^“”„]*”")
_END = re.compile(
    r"(?:[.!?…।؟]+[\"'”’»)\]]*(?=\s+\S)|(?<=[Ͱ-Ͽἀ-῿])[;;](?=\s+\S)|[。！？]+[」』”’）]*(?=\S)|[ \t]*\n\s*\n\s*|(?<=[฀-๿])[ \t]+(?=[฀-๿]))"
)


def sentences_of(text: str) -> list[tuple[int, int]]:
    """Rough sentence spans, good enough to carry a language each."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m.end() - at >= 12 or m.end() - at >= 5 and text[m.start()] in "。！？":
            out.append((at, m.end()))
            at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def _hidden(quote: re.Match) -> str:
    """Blanks for a quoted title or sentence; one of several sentences is text like any other.

    Where it ends a sentence of a script without blanks, that end stays.
    """
    q = quote.group()
    if len(sentences_of(q[1:-1])) > 1:
        return q
    return " " * (len(q) - 2) + q[-2:] if len(q) > 2 and q[-2] in "。！？" else " " * len(q)


_DENSE = re.compile("[฀-๿\u3040-ヿ㐀-\u9fff]")


def _whole(text: str, letters: int) -> bool:
    """Long enough for a sentence: scripts without blanks need fewer letters."""
    return letters >= 12 or letters >= 4 and len(_DENSE.findall(text)) * 2 > letters


_PLAIN = str.maketrans({chr(o): " " for o in range(128) if not chr(o).isalpha()})


def _letters(text: str) -> str:
    """Letters and marks in one form and lower case; anything else one blank; a blank at either end."""
    if text.isascii():
        return " " + " ".join(text.lower().translate(_PLAIN).split()) + " "
    t = unicodedata.normalize("NFKC", re.sub("[­​-‏⁠﻿]", "", text)).lower()
    return " " + " ".join(_WORD.findall(t)) + " "


_WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯऀ-ःऺ-ॏ॑-ॗॢॣً-ٟัิ-ฺ็-๎][^\W\d_]*)*")


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit, key and count of every n-gram of up to ORDER letters in every text, by unit and key, and the letters of each text.

    An n-gram's key is 21 bits a letter. For sorting, letters are numbered as they occur, which leaves room for the unit in one number.
    """
    plain = [_letters(t) for t in texts]
    sizes = np.array([len(p) for p in plain], dtype=np.int64)
    points = np.frombuffer("".join(plain).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    letters = np.maximum(sizes - 2, 0)
    seen = np.zeros(0x110000, dtype=bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(0x110000, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    width = max(len(alphabet) - 1, 1).bit_length()
    small = number[points]
    unit = np.repeat(np.arange(len(plain)), sizes)
    place = ORDER * width + 2
    if place + len(plain).bit_length() > 63:  # too many different letters for one number: texts by themselves, in halves
        return _halves(texts)
    codes = []
    for n in range(1, ORDER + 1):
        if len(points) < n:
            continue
        m = len(points) - n + 1
        code = (unit[:m] << place) | (n << ORDER * width)
        for i in range(n):
            code |= small[i : m + i] << (n - 1 - i) * width
        same = unit[:m] == unit[n - 1 :]
        if n == 1:
            same &= points != 32
        codes.append(code[same])
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    code.sort()
    if not len(code):
        return code, code, code, letters
    new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    count = np.diff(np.r_[new, len(code)])
    code = code[new]
    mask = (1 << width) - 1
    n = code >> ORDER * width & 3
    key = alphabet[code & mask]
    for i in range(1, ORDER):
        key |= np.where(n > i, alphabet[code >> i * width & mask], 0) << 21 * i
    return code >> place, key, count, letters


def _halves(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if len(texts) > 1:
        m = len(texts) // 2
        a, b = ngrams(texts[:m]), ngrams(texts[m:])
        return np.r_[a[0], b[0] + m], *(np.r_[x, y] for x, y in zip(a[1:], b[1:], strict=True))
    points = np.frombuffer(_letters(texts[0]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    keys = [points[points != 32]]
    for n in range(2, ORDER + 1):
        m = len(points) - n + 1
        keys.append(sum(points[i : m + i] << 21 * (n - 1 - i) for i in range(n)))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return np.zeros(len(key), np.int64), key, count, np.array([len(points) - 2])


def _slices(batch: pa.RecordBatch, letters: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``letters`` characters each, so that a task's arrays stay small."""
    sizes = [len(t) if t else 0 for t in batch.column("text").to_pylist()]
    at = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= letters:
            yield batch.slice(at, i + 1 - at)
            at, total = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for big in batches for part in _slices(big)):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs.tolist())):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            _, key, n, _ = ngrams([" ".join(own)])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key), pa.array(n)], ["lang", "key", "n"])


def fit_profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE) -> dict[str, list[int]]:
    """For every language its PROFILE most frequent n-grams, the most frequent first.

    Fitted on about ``sample`` labelled documents per language (all where there are fewer), drawn by a hash of the key.
    Wrong labels are taken as they are: ranks bear them while they are the lesser part. Then documents whose own
    nearest profile is another than their label's are left out, and the profiles are fitted again. The corpus' texts are read
    once, for the drawing; the drawn ones are kept.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), label_code(F.col(label)).alias("lang")).filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.from_json(F.lit("{" + ",".join(f'"{k}":{min(1.0, sample / n)}' for k, n in sizes.items()) + "}"), "map<string,double>")
    drawn = named.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_003)) < F.try_element_at(share, F.col("lang")) * 1_000_003)
    drawn = cut(spread(drawn.filter("length(text) > 20").select("lang", "text")))

    def top(rows: DataFrame) -> dict[str, list[int]]:
        counts = rows.mapInArrow(_count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
        w = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
        best = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= PROFILE)
        out: dict[str, list[int]] = {}
        for r in sorted(best.select("lang", "rank", "key").collect()):
            out.setdefault(r["lang"], []).append(r["key"])
        return out

    first = top(drawn)
    if not first:
        return {}
    right = drawn.mapInArrow(_agreeing(Table(first)), "lang string, text string")
    return top(right) or first


class Table:
    """The profiles side by side: for every language the rank of every n-gram of any profile (if absent one that is out of place anywhere)."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.keys = np.unique(np.concatenate([np.array(p, dtype=np.int64) for p in profiles.values()]))
        self.ranks = np.full((len(self.langs), len(self.keys)), 3 * PROFILE, dtype=np.int16)
        for x, lang in enumerate(self.langs):
            self.ranks[x, np.searchsorted(self.keys, np.array(profiles[lang], dtype=np.int64))] = np.arange(len(profiles[lang]))
        # Keys by a hash without clashes: a factor is tried until no two share a slot.
        self.bits = max(len(self.keys) - 1, 1).bit_length() + 9
        factors = np.random.default_rng(0)
        while True:
            self.factor = np.uint64(int(factors.integers(1 << 62)) * 2 + 1)
            slots = self._slots(self.keys)
            if len(np.unique(slots)) == len(slots):
                break
        self.at: np.ndarray | None = None  # made by each task: it is larger than what it is made of

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self.factor >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every key its row, and whether it has one."""
        if self.at is None:
            self.at = np.zeros(1 << self.bits, dtype=np.int32)
            self.at[self._slots(self.keys)] = np.arange(len(self.keys))
        at = self.at[self._slots(keys)]
        return at, self.keys[at] == keys


def distances(table: Table, unit: np.ndarray, key: np.ndarray, n: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of every unit to every language, as a sum over its n-grams in PROFILE, and their number.

    A unit's n-grams rank by count; equal counts share a rank; those after the first PROFILE don't count. n-grams come by
    unit and key, so only those that occur more than once need sorting, and only those in a profile comparing.
    """
    out, size = np.zeros((units, len(table.langs))), np.zeros(units, dtype=np.int64)
    if not len(unit):
        return out, size
    often = n > 1
    first = np.bincount(unit[often], minlength=units)
    u, c, k = unit[often], n[often], key[often]
    order = np.lexsort((k, -c, u))
    u, c, k = u[order], c[order], k[order]
    place = np.arange(len(u)) - (np.cumsum(first) - first)[u]
    tie = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (c[1:] != c[:-1])]) if len(u) else np.zeros(0, np.int64)
    rank = np.repeat(place[tie], np.diff(np.r_[tie, len(u)]))
    kept = place < PROFILE
    # Those that occur once share the last rank, in order of their keys.
    u1, k1 = unit[~often], key[~often]
    once = np.bincount(u1, minlength=units)
    place1 = first[u1] + np.arange(len(u1)) - (np.cumsum(once) - once)[u1]
    kept1 = place1 < PROFILE
    size += np.minimum(first + once, PROFILE)
    unit, key, rank = np.r_[u[kept], u1[kept1]], np.r_[k[kept], k1[kept1]], np.r_[rank[kept], first[u1[kept1]]].astype(np.int16)
    at, known = table.places(key)
    unit, at, rank = unit[known], at[known], rank[known]
    inside = np.bincount(unit, minlength=units)
    for x, theirs in enumerate(table.ranks):
        off = np.abs(theirs[at] - rank)
        out[:, x] = np.bincount(unit, weights=np.minimum(off, PROFILE, out=off), minlength=units)
    return out / PROFILE + (size - inside)[:, None], size


def _agreeing(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for big in batches for part in _slices(big)):
            texts = batch.column("text").to_pylist()
            unit, key, n, _ = ngrams(texts)
            dist, _ = distances(table, unit, key, n, len(texts))
            near = np.array(table.langs, dtype=object)[dist.argmin(1)]
            keep = [i for i, x in enumerate(batch.column("lang").to_pylist()) if near[i] == x]
            yield batch.take(pa.array(keep, pa.int64()))

    return run


def smooth(cost: np.ndarray, change: float = SWITCH) -> np.ndarray:
    """The cheapest language per sentence of one document, where each change of language costs ``change``."""
    near = cost.argmin(1)
    if (near == near[0]).all():  # one language is nearest everywhere
        return near
    total, back = cost[0].copy(), []
    for row in cost[1:]:
        best = int(total.argmin())
        stay = total <= total[best] + change
        back.append(np.where(stay, np.arange(len(total)), best))
        total = np.where(stay, total, total[best] + change) + row
    path = [int(total.argmin())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


def costs(table: Table, units: list[str], letters: int = 200_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances, numbers of n-grams and letters of every unit, some ``letters`` of them at a time, so a long text needs no more room than short ones."""
    parts, at, total = [], 0, 0
    for i, u in enumerate(units, 1):
        total += len(u)
        if total >= letters or i == len(units):
            unit, key, n, own = ngrams(units[at:i])
            parts.append((*distances(table, unit, key, n, i - at), own))
            at, total = i, 0
    if not parts:
        return np.zeros((0, len(table.langs))), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _segments(table, change: float):
    langs = table.langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            yield from map(part, _slices(big))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, texts = batch.column("key"), batch.column("text").to_pylist()
        spans: list[tuple[int, int, int]] = []
        units: list[str] = []
        for d, t in enumerate(texts):
            if not t:
                continue
            shown = _QUOTE.sub(_hidden, t) if "“" in t else t
            if shown != t and sum(map(str.isalpha, shown)) < 0.5 * sum(map(str.isalpha, t)):
                shown = t
            for a, b in sentences_of(shown):
                spans.append((d, a, b))
                units.append(shown[a:b])
        cost, size, letters = costs(table, units)
        rows: list[tuple] = []
        docs = np.array([s[0] for s in spans], dtype=np.int64)
        first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
        for lo, hi in zip(first, np.r_[first[1:], len(docs)], strict=True):
            if not letters[lo:hi].sum():
                continue
            path = smooth(cost[lo:hi], change)
            # Runs of one language.
            run_at = lo
            for i in range(lo, hi):
                if i + 1 == hi or path[i + 1 - lo] != path[i - lo]:
                    total, grams = cost[run_at : i + 1].sum(0), max(size[run_at : i + 1].sum(), 1.0)
                    near, next_ = np.partition(total, 1)[:2] if len(langs) > 1 else (total[0], grams)
                    whole = sum(_whole(units[x], int(letters[x])) for x in range(run_at, i + 1))
                    rows.append((int(docs[lo]), spans[run_at][1], spans[i][2], langs[path[i - lo]], float((next_ - near) / max(next_, 1e-9)), whole, int(letters[run_at : i + 1].sum())))
                    run_at = i + 1
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(7)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([keys.take(arrays[0]), *arrays[1:]], ["key", "char_start", "char_end", "lang", "confidence", "sentences", "letters"])

    return run


def segments(docs: DataFrame, profiles: dict[str, list[int]], key: str = "doc_id", text: str = "text", change: float = SWITCH) -> DataFrame:
    """Runs of one language: ``key``, ``char_start``, ``char_end``, ``lang``, ``confidence``, ``sentences``, ``letters``.

    Every sentence is compared with every profile by out-of-place distance; the cheapest path through a document's
    sentences, where a change of language costs ``change``, gives the runs. ``confidence`` is how much farther the
    second language is, as a share of its distance. A title or a sentence in “ ” is not looked at, unless such passages
    are most of the text; one of several sentences is. Null and empty texts and texts without letters give no row; repeated
    rows come out repeated; ties go to the first code. Each row is handled by itself: nothing is shuffled.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    if not profiles:
        return rows.select(F.col("key").alias(key), *[F.lit(None).cast(k).alias(c) for c, k in _SHAPE]).limit(0)
    shape = (("key", dict(rows.dtypes)["key"]), *_SHAPE)
    out = spread(rows, "key").mapInArrow(_segments(Table(profiles), change), ", ".join(f"{c} {k}" for c, k in shape))
    return out.withColumnRenamed("key", key)


_SHAPE = (("char_start", "int"), ("char_end", "int"), ("lang", "string"), ("confidence", "double"), ("sentences", "int"), ("letters", "int"))


def languages(found: DataFrame, key: str = "doc_id", least: int = 2) -> DataFrame:
    """``key``, ``lang``, ``confidence`` and ``mixed``: every language with ``least`` or more sentences in a document of several, else the main one."""
    per = found.groupBy(key, "lang").agg(F.sum("sentences").alias("s"), F.sum("letters").alias("letters"), F.max("confidence").alias("confidence"))
    w = Window.partitionBy(key)
    strong = (F.col("s") >= least).cast("int")
    ranked = per.withColumn("several", F.sum(strong).over(w)).withColumn("first", F.row_number().over(w.orderBy(F.desc("letters"), "lang")))
    mixed = F.col("several") >= 2
    return ranked.filter(F.when(mixed, strong == 1).otherwise(F.col("first") == 1)).select(key, "lang", "confidence", mixed.alias("mixed"))


def wrong_labels(docs: DataFrame, found: DataFrame, key: str = "doc_id", label: str = "lang") -> DataFrame:
    """``key`` and ``lang`` of documents whose label is missing, names no language or another one, and of all mixed ones."""
    named = docs.select(key, label_code(F.col(label)).alias("label")).distinct()
    both = found.join(named, key)
    return both.filter(F.col("mixed") | ~F.col("lang").eqNullSafe(F.col("label"))).select(key, "lang").distinct()
