"""Evaluation passages inside a training corpus: pigeonhole pieces, then bit-parallel edit distance."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkfall.checkpoints import cut
from inkfall.partitioning import spread
from inkfall.llm.lookalikes import HYPHENS, shapes

#: The share of an item's words that a leaking document gives, and the share of those that may be edited.
STRETCH = 0.4
EDITS = 0.2
#: Bits of the filter that n-grams pass, as a power of two, and rows up to which pieces or candidates go to all tasks.
FILTER_BITS = 24
BROADCAST_ROWS = 500_000

_WIDE = "".join(chr(o) for o in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(o) for o in range(0x21, 0x7F))


def plain_words(text: Column) -> Column:
    """The words of a text: joined across hyphenated line ends, in lower case, letters and digits only."""
    x = F.regexp_replace(text, r"[­​-‏⁠﻿]", "")
    x = F.regexp_replace(x, rf"(\p{{L}})[-{HYPHENS}¬]\s*\n\s*(?=\p{{Ll}})", "$1")
    x = F.translate(x, _WIDE + "".join(shapes()), _NARROW + "".join(shapes().values()))
    x = F.lower(F.regexp_replace(x, r"(?U)[^\p{L}\p{M}\p{N}\s]+", ""))
    return F.filter(F.split(x, r"(?U)\s+"), lambda w: w != "")


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def budgets(n: Column, stretch: float = STRETCH, edits: float = EDITS) -> dict[str, Column]:
    """For an item of n words: words of a stretch, edits allowed in it, words of a piece, and pieces it keeps.

    A stretch of L words holds whole at least (L - p + 1) / p pieces of p words, wherever it begins, and each edit spoils at most
    one. With p = L / (edits + 2) at least one piece is left whole: no leak within the budget is missed.
    """
    words = F.greatest(F.ceil(n * stretch), F.lit(1)).cast("int")
    allowed = F.floor(words * edits).cast("int")
    piece = F.greatest(F.floor(words / (allowed + 2)), F.lit(1)).cast("int")
    left = F.greatest(F.floor((words - piece + 1) / piece) - allowed, F.lit(1)).cast("int")
    return {"words": words, "allowed": allowed, "piece": piece, "left": left}


def myers(pattern: list[int], text: list[int]) -> list[int]:
    """For every end in ``text`` (the empty beginning first) the least edit distance of ``pattern`` to a part ending there.

    Myers' bit vectors, one bit a pattern word.
    """
    m = len(pattern)
    if not m:
        return [0] * (len(text) + 1)
    mask = (1 << m) - 1
    top = 1 << (m - 1)
    peq: dict[int, int] = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | (1 << i)
    pv, mv, score = mask, 0, m
    out = [m]
    get = peq.get
    for w in text:
        eq = get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = mh | (~(xv | ph) & mask)
        mv = ph & xv
        out.append(score)
    return out


def split_distance(pattern: list[int], text: np.ndarray) -> int:
    """The least distance of ``pattern``, in two parts at the best split, to two parts of ``text`` in order, and one for what is between.

    Two edit-distance tables row by row: of the first part, and of both, which begins anywhere behind the first's best end.
    """
    at = np.arange(len(text) + 1)
    one, two = np.zeros(len(text) + 1, np.int64), np.ones(len(text) + 1, np.int64)

    def row(old: np.ndarray, other: np.ndarray) -> np.ndarray:
        new = old + 1
        np.minimum(new[1:], old[:-1] + other, out=new[1:])
        return np.minimum.accumulate(new - at) + at

    for w in pattern:
        other = text != w
        one, two = row(one, other), row(two, other)
        two = np.minimum(two, np.minimum.accumulate(one) + 1)
    return int(two.min())


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, rolled on word by word; the words are hashes themselves."""
    out = words.astype(np.uint64)
    for k in range(1, size):
        out = out[:-1] * _FACTOR + words[k:].astype(np.uint64)
    return _mixed(out)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """All bits of a hash spread over all bits."""
    x = (x ^ (x >> np.uint64(31))) * _FACTOR
    return (x ^ (x >> np.uint64(29))).astype(np.int64)


def whole_pieces(item: np.ndarray, doc: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """(place in item, place in document) of every piece of the item that the document has whole."""
    if min(len(item), len(doc)) < piece:
        return []
    own = grams(item, piece)[::piece]
    there = grams(doc, piece)
    at = np.flatnonzero(np.isin(there, own))
    places: dict[int, list[int]] = {}
    for k, g in enumerate(own.tolist()):
        places.setdefault(g, []).append(k * piece)
    pairs = ((i, j) for j in at.tolist() for i in places[int(there[j])])
    return [(i, j) for i, j in pairs if (item[i : i + piece] == doc[j : j + piece]).all()]


def stretch_distance(item: np.ndarray, doc: np.ndarray, words: int, allowed: int, piece: int, left: int, least: bool = True) -> int | None:
    """The least distance of a stretch of ``words`` item words to the document, at most ``allowed``; else None.

    A stretch may be interrupted once by any amount of other text: it is then the sum of its two parts' distances, in
    order, and one for the interruption. Without ``least`` the first distance that is small enough will do. A word that the
    document does not have where the stretch would be is an edit at least: windows with too many of them are passed over.
    """
    n = len(item)
    absent = np.r_[0, np.cumsum(~np.isin(item, doc))]
    if (absent[words:] - absent[: n - words + 1]).min() > allowed:
        return None
    hits = whole_pieces(item, doc, piece)
    width = allowed + 1
    bands: dict[int, set[tuple[int, int]]] = {}
    for i, j in hits:
        d = (j - i) // width
        for k in (d, d + 1):  # two edits' shifts of one stretch lie in one band or in two neighbours
            bands.setdefault(k, set()).add((i, j))
    places = {d: sorted({i for i, _ in h}) for d, h in bands.items()}
    best: int | None = None
    own = item.tolist()

    def lacking(text: list[int]) -> list[int]:
        have, out = set(text), [0]
        for w in own:
            out.append(out[-1] + (w not in have))
        return out

    for d, at in places.items():
        if len(at) < left:
            continue
        shift = (d - 1) * width
        a, last = max(0, at[0] + piece - words), min(n - words, at[-1])
        begin = max(0, a + shift - allowed)
        near = doc[begin : max(0, last + shift + 2 * width + words + allowed)].tolist()
        missing = lacking(near)
        while a <= last and best != 0:
            step = 1
            x = missing[a + words] - missing[a]
            if x > allowed:
                step = x - allowed
            elif bisect_left(at, a + words - piece + 1) - bisect_left(at, a) >= left:
                x = min(myers(own[a : a + words], near[max(0, a + shift - allowed - begin) : max(0, a + shift + 2 * width + words + allowed - begin)]))
                if x <= allowed:
                    best = x if best is None else min(best, x)
                    if not least:
                        return best
                else:  # moving on by one word saves one edit at most
                    step = x - allowed
            a += step
    # Interrupted: a window needs whole pieces, wherever they are, and all but the edited of its words somewhere in the document.
    at = sorted({i for i, _ in hits})
    if not at:
        return best
    missing = lacking(doc.tolist())
    a, last = max(0, at[0] + piece - words), min(n - words, at[-1])
    while a <= last:
        limit = allowed if best is None else best - 1
        if limit < 1:
            break
        step = 1
        x = missing[a + words] - missing[a] + 1
        if x > limit:
            step = x - limit
        elif bisect_left(at, a + words - piece + 1) - bisect_left(at, a) >= left:
            x = split_distance(own[a : a + words], doc)
            if x <= limit:
                best = x
                if not least:
                    return best
            else:
                step = x - limit
        a += step
    return best


def _verify(shape: pa.Schema, least: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dist = [], []
            numbers = [batch.column(c).to_numpy() for c in ("words", "allowed", "piece", "left")]
            for at in range(batch.num_rows):
                item, doc = (batch.column(c)[at].values.to_numpy() for c in ("item_words", "doc_words"))
                d = stretch_distance(item, doc, *(int(x[at]) for x in numbers), least)
                if d is not None:
                    keep.append(at)
                    dist.append(d)
            small = batch.select(["doc", "item"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([small.column(0).cast(shape[0].type), small.column(1).cast(shape[1].type), pa.array(dist, pa.int32())], schema=shape)

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every item's pieces: row, place in the item, size and hash."""
    for batch in batches:
        rows, places, sizes, hashes = [], [], [], []
        size = batch.column("piece").to_numpy()
        for at in range(batch.num_rows):
            words = batch.column("item_words")[at].values.to_numpy()
            n = int(size[at])
            if len(words) >= n:
                g = grams(words, n)[::n]
                rows.append(np.full(len(g), at))
                places.append(np.arange(len(g)) * n)
                sizes.append(np.full(len(g), n))
                hashes.append(g)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, places, sizes, hashes)]
        columns = [batch.column("item").take(pa.array(flat[0])), batch.column("left").take(pa.array(flat[0])), *(pa.array(x, k) for x, k in zip(flat[1:], (pa.int32(), pa.int32(), pa.int64()), strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "left", "i", "p", "gram"])


def _hits(sizes: list[int], filled):
    """mapInArrow function: of every document its distinct word n-grams that the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(filled.value, dtype=np.uint8), bitorder="little").view(bool)
        for batch in batches:
            words = batch.column("doc_words")
            flat = words.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))
            for p in sizes:
                if len(flat) < p:
                    continue
                g = grams(flat, p)
                ok = bits[_slot(g)] & (row[: len(g)] == row[p - 1 :])
                found = np.unique(np.stack([row[: len(g)][ok], g[ok]]), axis=1)
                columns = [batch.column("doc").take(pa.array(found[0])), pa.array(np.full(found.shape[1], p), pa.int32()), pa.array(found[1])]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "p", "gram"])

    return run


def _slot(g: np.ndarray) -> np.ndarray:
    return (g.astype(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(pieces: DataFrame) -> bytes:
    """The pieces' hashes as a bitmap of 2^FILTER_BITS bits, put together by the tasks; its size does not grow with the items."""
    slot = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    rows = pieces.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("b"))
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for r in rows.collect():
        out[r["at"]] = r["b"]
    return out.tobytes()


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    passage: str = "passage",
    stretch: float = STRETCH,
    edits: float = EDITS,
    least: bool = True,
) -> DataFrame:
    """``doc``, ``item`` and ``distance`` of every document that gives a stretch of an item's passage.

    A leak is a stretch of ``stretch`` of the item's words within ``edits`` (a share) word edits, wherever it begins, maybe
    interrupted once. Each item is cut into pieces of so few words that a stretch within the budget keeps some of
    them whole. The corpus is read where it lies: rolling hashes of its word n-grams pass a bitmap of the pieces' hashes of
    a fixed size, and what passes, once per document and n-gram, meets the pieces in a join. Documents with enough
    pieces of an item are read again, they alone, and verified by Myers' bit-parallel distance over words. With
    ``least`` the distance is the least one, else one within the budget.

    Null and empty texts, null keys and passages without words have no leaks; keys may be of any type and may repeat, the
    result is distinct. Other columns are not looked at.
    """
    spark = docs.sparkSession
    own = items.select(F.col(item).alias("item"), hashed(plain_words(F.col(passage))).alias("item_words"))
    own = own.filter("item is not null and size(item_words) > 0").distinct()
    b = budgets(F.size("item_words"), stretch, edits)
    own = cut(own.select("item", "item_words", *[c.alias(k) for k, c in b.items()]))
    kinds = {"item": dict(own.dtypes)["item"], "doc": dict(docs.dtypes)[doc]}
    pieces = own.select("item", "left", "piece", "item_words").mapInArrow(_pieces, f"item {kinds['item']}, left int, i int, p int, gram bigint")
    pieces = cut(pieces)
    # The sizes in use are few: by the budgets no piece has more words than 1 / edits.
    sizes = sorted(r[0] for r in pieces.select("p").distinct().collect())
    filled = spark.sparkContext.broadcast(_filter(pieces))
    corpus = spread(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).filter("doc is not null and text is not null"))
    words = corpus.select("doc", hashed(plain_words(F.col("text"))).alias("doc_words"))
    hits = words.mapInArrow(_hits(sizes, filled), f"doc {kinds['doc']}, p int, gram bigint")
    hits = hits.join(F.broadcast(pieces) if pieces.count() <= BROADCAST_ROWS else pieces, ["p", "gram"])
    pairs = hits.groupBy("doc", "item").agg(F.size(F.collect_set("i")).alias("n"), F.first("left").alias("left")).filter("n >= left")
    pairs = cut(pairs.select("doc", "item"))
    asked = pairs.select("doc").distinct()
    asked = F.broadcast(asked) if pairs.count() <= BROADCAST_ROWS else asked
    read = corpus.join(asked, "doc", "left_semi").select("doc", hashed(plain_words(F.col("text"))).alias("doc_words"))
    full = pairs.join(own, "item").join(read, "doc").select("doc", "item", "item_words", "doc_words", "words", "allowed", "piece", "left")
    shape = T.StructType([pairs.schema["doc"], pairs.schema["item"], T.StructField("distance", T.IntegerType())])
    found = full.mapInArrow(_verify(to_arrow_schema(shape), least), shape)
    return found.groupBy(F.col("doc").alias(doc), F.col("item").alias(item)).agg(F.min("distance").alias("distance"))
