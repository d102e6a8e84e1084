"""Noise in text from scanned pages: page furniture, broken words, misread characters, and the reflow."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkfall.checkpoints import cut, release
from inkfall.partitioning import spread

# What a scan makes of characters: "read as" then "meant", by space-separated pairs.
MISREAD = "c:e ¢:c f:t o:a n:u 5:s 1:i !:i |:i 1:l I:l |:l 0:o cl:d d:cl rn:m m:rn li:h h:li 9:g 6:b vv:w ii:u tt:n ln:in 8:b 3:e @:a €:e ©:c"
DIGITS = "O:0 o:0 Q:0 D:0 l:1 I:1 !:1 |:1 i:1 S:5 s:5 B:8 Z:2 z:2 b:6 G:6 g:9 q:9"
#: Signs at a line's end that a broken word can have, and words that follow a hyphen which stands for a left-out part.
HYPHENS = "-‐‑¬­"
SUSPENDED = "and or und oder bzw et ou y o e ed und/oder and/or to but nor"
#: Text lines from the top or the bottom of a page that can be furniture.
EDGE = 3
#: Words of a vocabulary shard, which gets a trie of its own; asked words of a block; prefixes that tell words their shards.
SHARD = 50_000
BLOCK = 1_000
PARTITIONS = 20_000
PREFIXES = 200_000
#: Cost of an edit that is no known misreading, in misreadings, and letters that a word has for each.
OTHER = 3
LETTERS = 4
#: Rows up to which a table goes to all tasks.
SMALL = 500_000
#: A word is taken for a misreading of one this many times as frequent, if it is known elsewhere only by its context.
RATIO = 20

_TOKEN = re.compile(r"\S+")
_STRIP = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "“”„«»‘’…–—·•→§†‡" + HYPHENS


def _strip(token: str) -> str:
    return token.strip(_STRIP)


def _inner(token: str) -> str:
    """The word of a token: no punctuation around, apart from a misread letter at its end."""
    return _strip(token)


@lru_cache(1)
def _digit_map() -> dict[str, str]:
    return dict(x.split(":") for x in DIGITS.split())


def number_reading(word: str) -> str | None:
    """The number that a word was, if it has a digit and else only signs that digits are misread as.

    The automaton of misread digits, stepped along the endless trie of all numbers: digits, and single signs between digits.
    """
    if word.isalpha() or not any(c.isdigit() for c in word) or word.replace(".", "").replace(",", "").isdigit():
        return None
    m, out, after_digit = _digit_map(), [], False
    for c in word:
        meant = c if c.isdigit() else m.get(c)
        if meant is None and not (after_digit and c in ".,:/–-"):
            return None
        out.append(meant or c)
        after_digit = meant is not None
    return "".join(out) if after_digit else None


def fold_line(line: str) -> str:
    """A key under which a running line meets its misread copies; numbers become #."""
    out = []
    for raw in unicodedata.normalize("NFKC", line).split():
        t = re.sub(r"[^\w!|¢]", "", raw)
        if not t:
            continue
        if not t.isalpha() and (sum(c.isdigit() for c in t) * 2 >= len(t) or number_reading(t)):
            out.append("#")
            continue
        t = t.lower()
        for a, b in (("rn", "m"), ("vv", "w"), ("cl", "d"), ("li", "h")):
            t = t.replace(a, b)
        out.append(t.translate(_FOLD))
    return " ".join(out)


_FOLD = str.maketrans("cao0¢1!itfj|n5682", "eeeeelllllllusbbz")
_PAGE_NO = re.compile(r"^[\W_]*(?:page\s+|pag\w?\.?\s+|p\.\s*|seite\s+|s\.\s*)?([0-9OolISBZGsgqb!|]{1,4}|[ivxlcIVXLC1!|]{1,7})(?:\s*(?:of|/|von|de)\s*[0-9OolISBZGsgqb!|]{1,4})?[\W_]*$", re.I)


def _is_page_number(line: str) -> bool:
    m = _PAGE_NO.match(line.strip())
    if not m:
        return False
    core = m[1]
    if any(c.isdigit() for c in core):
        return True
    return bool(re.fullmatch(r"[ivxlc]+|[IVXLC]+", core)) and len(line.split()) <= 3 or "page" in line.lower()


_LINE = "page_id bigint, paper_id string, page_index int, line_no int, from_top int, from_bottom int, key bigint, shape int"


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of a few pages each, whose words a task holds at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every text line with its key; shape: 1 page number, 2 to 4 may be a running line (3: closed by a stop, 4: long or with a comma), 0 neither."""
    for batch in _few(batches):
        rows: list[tuple] = []
        for pid, paper, index, text in zip(*(batch.column(c).to_pylist() for c in ("page_id", "paper_id", "page_index", "text")), strict=True):
            lines = text.split("\n")
            filled = [(n, x.strip()) for n, x in enumerate(lines, 1) if x.strip()]
            width = max((len(x) for _, x in filled), default=0)
            for at, (n, x) in enumerate(filled):
                back = len(filled) - 1 - at
                shape = 0
                if at < EDGE or back < EDGE:
                    start = next((c for c in x if c.isalnum() or c in "©!"), "")
                    short = len(x) < 0.8 * width or len(filled) <= 2
                    closed = x[-1] in ".!?:;," and not re.search(r"\b[ce¢][tl1!f] a[l1I!]\.$", x)
                    if _is_page_number(x):
                        shape = 1
                    elif short and (start.isupper() or start.isdigit() or start in "©!l1"):
                        shape = 3 if closed else 4 if "," in x or len(x.split()) > 7 else 2
                rows.append((pid, paper, index, n, at, back, _hash(fold_line(x)), shape))
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(8)]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in _LINE.split(", ")])


def furniture(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``line_no`` of running headers, footers and page numbers.

    Only the outermost ``EDGE`` text lines of a page are in question, each only if those outside it are furniture:
    page numbers by their form; other short lines if, over all pages, lines that read alike (up to misreadings and
    numbers) stand at edges and hardly ever inside, and recur in the paper or the corpus, or have a header above
    or below. Line statistics are counts by a hash of the folded line.
    """
    lines = cut(spread(pages, "page_id").mapInArrow(_lines, _LINE))
    edge = (F.col("from_top") < EDGE) | (F.col("from_bottom") < EDGE)
    stats = lines.groupBy("key").agg(F.count(F.when(edge & (F.col("shape") > 0), 1)).alias("n_edge"), F.count(F.when(~edge, 1)).alias("n_inside"))
    # Page numbers are known by their form; they would all meet under one key.
    near = lines.filter(edge & (F.col("shape") > 1))
    own = near.groupBy("paper_id", "key").agg(F.count("*").alias("n_paper"))
    marked = near.join(stats, "key").join(own, ["paper_id", "key"])
    rare_inside = F.col("n_inside") * 10 <= F.col("n_edge")
    repeated = (F.col("n_paper") >= 2) | (F.col("n_edge") >= 3)
    often = (F.col("n_inside") * 20 <= F.col("n_edge")) & ((F.col("n_edge") >= 10) | (F.col("n_paper") >= 2) & (F.col("n_edge") >= 3))
    kind = (
        F.when(F.col("shape") == 3, F.when(often, 2).otherwise(0))
        .when(rare_inside & repeated, 2)
        .when(rare_inside & (F.col("shape") == 2), 1)
        .otherwise(0)
    )
    numbers = lines.filter(edge & (F.col("shape") == 1)).select("page_id", "from_top", "from_bottom", "line_no", F.lit(2).alias("kind"))
    rows = marked.select("page_id", "from_top", "from_bottom", "line_no", kind.alias("kind")).unionByName(numbers)
    rows = rows.select("page_id", F.struct("from_top", "from_bottom", "line_no", "kind").alias("r"))
    page = rows.groupBy("page_id").agg(F.collect_list("r").alias("rs"))

    def chain(place: str) -> Column:
        """From the edge inwards while the lines are furniture; a once-only line needs a sure one outside it or under it."""
        def line(k: int) -> Column:
            return F.filter("rs", lambda r: r[place] == k)

        at = [line(k) for k in range(EDGE)]
        kinds = [F.coalesce(F.get(a, F.lit(0))["kind"], F.lit(0)) for a in at]
        sure = F.lit(False)
        going, out = F.lit(True), []
        for k in range(EDGE):
            after = kinds[k + 1] == 2 if k + 1 < EDGE else F.lit(False)
            alone = F.lit(k == 0) & (kinds[k] == 1)
            ok = going & ((kinds[k] == 2) | ((kinds[k] == 1) & (sure | after)) | alone)
            out.append(F.when(ok, F.get(at[k], F.lit(0))["line_no"]))
            going, sure = ok, sure | (ok & (kinds[k] == 2))
        return F.array_compact(F.array(*out))

    both = F.array_union(chain("from_top"), chain("from_bottom"))
    out = cut(page.select("page_id", F.explode(both).alias("line_no")))
    release(lines)
    return out


def _body(text: str, dropped: set[int]) -> list[tuple[int, str]]:
    return [(n, x.rstrip()) for n, x in enumerate(text.split("\n"), 1) if n not in dropped and x.strip()]


def _ends_broken(line: str) -> str | None:
    """The part of a word before the hyphen at the line's end."""
    last = line.split()[-1] if line.split() else ""
    if len(last) > 1 and last[-1] in HYPHENS and last[-2].isalnum() or len(last) > 2 and last[-1] in HYPHENS and last[-2] in "!¢|":
        return last[:-1].lstrip(_STRIP)
    return None


def _first_word(line: str) -> str:
    return line.split()[0] if line.split() else ""


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, at, open_ = [], [], []
        for text, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            body = _body(text, set(dropped or ()))
            first.append(_first_word(body[0][1]) if body else None)
            at.append(body[0][0] if body else None)
            open_.append(bool(body and _ends_broken(body[-1][1])))
        columns = [*(batch.column(c) for c in ("page_id", "paper_id", "page_index")), pa.array(first, pa.string()), pa.array(at, pa.int32()), pa.array(open_, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "paper_id", "page_index", "head", "head_line", "open"])


_HEADS = "page_id bigint, paper_id string, page_index int, head string, head_line int, open boolean"
_WORDS = "page_id bigint, line_no int, pos int, word string, before string, after string, head string, tail string, next_line int, next_word string, beyond string"


def _page_words(text: str, dropped: set[int], overleaf: str | None, taken: bool) -> tuple[list[tuple], dict[int, tuple[int, str]]]:
    """Line, place, word, and for a word broken at the line's end its two parts; words in reading order.

    And of each line that ends with letters the next line (0 overleaf) and its first word, if that may go on with the last one.
    """
    body = _body(text, dropped)
    out: list[list] = []
    loose: dict[int, tuple[int, str]] = {}
    skip_first = taken
    for k, (n, line) in enumerate(body):
        tokens = line.split()
        broken = _ends_broken(line)
        follow = _first_word(body[k + 1][1]) if k + 1 < len(body) else overleaf
        tail = _strip(follow) if follow else ""
        lead_ok = bool(follow) and (follow[0].isalnum() or follow[0] in "!¢|")
        joins = bool(broken) and bool(tail) and lead_ok and tail.lower() not in _SUSPENDED
        for pos, t in enumerate(tokens):
            if pos == 0 and skip_first:
                continue
            if pos == len(tokens) - 1 and joins:
                out.append([n, pos, None, _strip(broken), tail])
                continue
            w = _inner(t)
            if w:
                out.append([n, pos, w, None, None])
                if pos == len(tokens) - 1 and follow and t[-1].isalpha() and (follow[0].islower() or follow[0] in "¢!|"):
                    loose[n] = (body[k + 1][0] if k + 1 < len(body) else 0, tail)
        skip_first = joins
        if k + 1 == len(body):
            break
    return [tuple(x) for x in out], loose


_SUSPENDED = frozenset(SUSPENDED.split())


def _plain(word: str | None) -> str:
    if word is None:
        return ""
    return word.lower() if word.isalpha() else "#" if word.replace(".", "").replace(",", "").isdigit() else word.lower()


def _all_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _few(batches):
        rows: list[tuple] = []
        cols = (batch.column(c).to_pylist() for c in ("page_id", "text", "dropped", "overleaf", "taken"))
        for pid, text, dropped, overleaf, taken in zip(*cols, strict=True):
            words, loose = _page_words(text, set(dropped or ()), overleaf, taken)
            last = {n: k for k, (n, *_) in enumerate(words)}
            names = ["", *(_plain(w if w is not None else h + t) for _, _, w, h, t in words), "", ""]
            for k, (n, pos, w, h, t) in enumerate(words):  # a page's first word that another page's last goes on with is counted there
                line, follow = loose.get(n, (None, None)) if last[n] == k and w is not None else (None, None)
                rows.append((pid, n, pos, w, names[k], names[k + 2], h, t, line, follow or None, names[k + 3] if line is not None else ""))
        data = list(zip(*rows, strict=True)) if rows else [[] for _ in range(11)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 5, pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(data, kinds, strict=True)], [x.split()[0] for x in _WORDS.split(", ")])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of surface words and of neighbours in clean pages."""
    words: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            plain = [_strip(t) for t in text.split()]
            words.update(w for w in plain if w)
            low = [_plain(w) for w in plain if w]
            words.update(f"{a}\t{b}" for a, b in zip(low, low[1:], strict=False))
        if len(words) > 200_000:
            yield _counted(words)
            words = Counter()
    if words:
        yield _counted(words)


def _counted(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["w", "n"])


class Automata:
    """Levenshtein automata of distance ``k``: a state is a window of capped distances; steps are kept by state and match bits."""

    def __init__(self, k: int):
        self.k = k
        self.start = tuple(k + 1 if w < k else w - k for w in range(2 * k + 1))
        self.steps: dict[tuple, tuple | None] = {}

    def step(self, state: tuple, bits: int) -> tuple | None:
        key = (state, bits)
        if key in self.steps:
            return self.steps[key]
        k, cap = self.k, self.k + 1
        row: list[int] = []
        for w in range(2 * k + 1):
            v = state[w] + (0 if bits >> w & 1 else 1)
            if w < 2 * k:
                v = min(v, state[w + 1] + 1)
            if w:
                v = min(v, row[w - 1] + 1)
            row.append(min(v, cap))
        out = tuple(row) if min(row) < cap else None
        self.steps[key] = out
        return out


class Trie:
    """Words with their counts, letter by letter; ``""`` leads from a word's last letter to the word and its count."""

    def __init__(self, words: list[tuple[str, int]]):
        self.root: dict = {}
        for w, n in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = (w, n)

    def near(self, pattern: str, auto: Automata, ends: str = "") -> list[tuple]:
        """All words within the automata's distance of ``pattern``, with their counts and distances; what is under ``ends``."""
        k, m = auto.k, len(pattern)
        masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            masks[c] = masks.get(c, 0) | 1 << (i + k)
        window = (1 << (2 * k + 1)) - 1
        out: list[tuple] = []
        stack = [(self.root, auto.start, 0)]
        while stack:
            node, state, depth = stack.pop()
            if "" in node:
                at = m - depth + k
                if ends:  # a prefix: words under it may still be near
                    out.append((*node[""], 0))
                elif 0 <= at <= 2 * k and state[at] <= k:
                    out.append((*node[""], state[at]))
            for c, child in node.items():
                if c:
                    nxt = auto.step(state, masks.get(c, 0) >> depth & window)
                    if nxt is not None:
                        stack.append((child, nxt, depth + 1))
        return out

    def readings(self, pattern: str, ends: str = "") -> dict[str, tuple[int, int]]:
        """All words that misreadings alone turn into ``pattern``, however many: the count of each and the fewest misreadings.

        The automaton of misreadings steps from a place in ``pattern`` by a letter as it is, or over what a scan reads to what it meant.
        """
        out: dict[str, tuple[int, int]] = {}
        stack = [(self.root, 0, 0)]
        best: dict[tuple[int, int], int] = {}
        while stack:
            node, i, n = stack.pop()
            key = (id(node), i)
            if best.get(key, n + 1) <= n:
                continue
            best[key] = n
            if "" in node and (ends or i == len(pattern)):
                w, count = node[""]
                if w not in out or out[w][1] > n:
                    out[w] = (count, n)
            if i == len(pattern):
                continue
            if pattern[i] in node:
                stack.append((node[pattern[i]], i + 1, n))
            for read, meant in _by_letter().get(pattern[i], ()):
                if pattern.startswith(read, i):
                    at: dict | None = node
                    for c in meant:
                        at = at.get(c)
                        if at is None:
                            break
                        if ends and "" in at:
                            out.setdefault(at[""][0], (at[""][1], n + 1))
                    if at is not None:
                        stack.append((at, i + len(read), n + 1))
        return out


@lru_cache(1)
def _by_letter() -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for x in MISREAD.split():
        read, meant = x.split(":")
        out.setdefault(read[0].lower(), []).append((read.lower(), meant))
    out.setdefault("!", []).append(("!", "l"))
    return out


def explained(word: str, meant: str) -> int | None:
    """How many misreadings turn ``meant`` into ``word`` (both in lower case), if nothing else differs."""
    got = Trie([(meant, 1)]).readings(word)
    return got[meant][1] if got else None


def _retrieve(words: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
    """Of every asked word the commoner vocabulary words it may have been.

    Complete in both ways: by misreadings alone, however many, and, of words that clean pages do not have, within an edit of any
    kind for every LETTERS letters, two at most; those must be RATIO times as common. ``errors`` is the cost of the reading: 1 for a
    misreading, OTHER for any other edit.
    """
    trie = Trie(list(zip(vocabulary["w"].tolist(), vocabulary["n"].tolist(), strict=True)))
    near = {1: Automata(1), 2: Automata(2)}
    out: list[tuple[str, str, int, bool]] = []
    for w, n, fresh in zip(words["w"].tolist(), words["n"].tolist(), words["fresh"].tolist(), strict=True):
        found = {c: (e, True) for c, (count, e) in trie.readings(w).items() if count > 2 * n}
        if fresh and len(w) >= LETTERS:
            for c, count, d in trie.near(w, near[min(2, len(w) // LETTERS)]):
                if count > RATIO * n and c not in found:
                    found[c] = (OTHER * d, False)
        found.pop(w, None)
        out += [(w, c, e, x) for c, (e, x) in found.items()]
    return pd.DataFrame(out, columns=["w", "meant", "errors", "explained"])


def _routes(prefixes: list[tuple[str, int]]):
    """mapInArrow function: the shards in which an asked word may have readings: where the automata are alive at a prefix's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, near = Trie(prefixes), {1: Automata(1), 2: Automata(2)}
        for batch in batches:
            row, shard = [], []
            for k, (w, fresh) in enumerate(zip(batch.column("w").to_pylist(), batch.column("fresh").to_pylist(), strict=True)):
                at = {n for n, _ in trie.readings(w, "prefix").values()}
                if fresh and len(w) >= LETTERS:
                    at |= {n for _, n, _ in trie.near(w, near[min(2, len(w) // LETTERS)], "prefix")}
                row += [k] * len(at)
                shard += at
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row, pa.int64())) for c in ("w", "n", "fresh")), pa.array(shard, pa.int32())], ["w", "n", "fresh", "shard"])

    return run


def shards_of(vocabulary: DataFrame, size: int) -> list[tuple[str, int]]:
    """Prefixes of the vocabulary in order, each with its shard; a shard has about ``size`` words, or one prefix.

    Prefixes are so long that no shard is much larger than ``size``, as long as there are at most PREFIXES of them.
    """
    if vocabulary.count() <= size:
        return [("", 0)]
    length, rows = 0, []
    while True:
        length += 1
        counts = vocabulary.groupBy(F.substring("w", 1, length).alias("p")).agg(F.count("*").alias("n"))
        n, most = counts.agg(F.count("*"), F.max("n")).first()
        if n > PREFIXES and rows:
            break
        rows = sorted(tuple(r) for r in counts.collect()) if n <= PREFIXES else rows
        if most <= size or n == vocabulary.count():
            break
    out, shard, filled = [], 0, 0
    for p, n in rows:
        if filled and filled + n > size:
            shard, filled = shard + 1, 0
        filled += n
        out.append((p, shard))
    return out


def candidates(asked: DataFrame, vocabulary: DataFrame, size: int | None = None, block: int | None = None) -> DataFrame:
    """``w``, ``meant``, ``errors``, ``explained`` of the asked words (w, n, fresh) among those of the vocabulary (w, n).

    The vocabulary lies in shards by prefix; a word goes only where an automaton is still alive after the prefix. The words
    of a shard are asked in blocks, as many as they fill, so the shard's trie is built once for a block.
    """
    prefixes = shards_of(vocabulary, size or SHARD)
    block = block or BLOCK
    if len(prefixes) == 1:
        routed, placed = asked.withColumn("shard", F.lit(0)), vocabulary.withColumn("shard", F.lit(0))
    else:
        routed = cut(asked.mapInArrow(_routes(prefixes), "w string, n bigint, fresh boolean, shard int"))
        names = F.broadcast(asked.sparkSession.createDataFrame(prefixes, "p string, shard int"))
        length = max(len(p) for p, _ in prefixes)
        placed = vocabulary.withColumn("p", F.substring("w", 1, length)).join(names, "p").drop("p")
    blocks = F.ceil(F.col("asked") / block).cast("int")
    sizes = cut(routed.groupBy("shard").agg(F.count("*").alias("asked")).select("shard", blocks.alias("blocks")))
    few = F.broadcast(sizes)  # one row per shard
    a = routed.join(few, "shard").select("w", "n", "fresh", "shard", F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int").alias("block"))
    v = placed.join(few, "shard").select("w", "n", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # As many partitions as there are blocks, up to PARTITIONS: they are small in bytes, but each is much work.
    n = max(1, min(sizes.agg(F.sum("blocks")).first()[0] or 1, PARTITIONS))
    a, v = (x.repartition(n, "shard", "block").groupBy("shard", "block") for x in (a, v))
    return a.cogroup(v).applyInPandas(_retrieve, "w string, meant string, errors int, explained boolean")


class Known:
    """What the pages tell of words: the ``vocabulary``, the counts of ``neighbours``, and the words ``asked`` with their readings (``pairs``)."""

    def __init__(self, vocabulary: DataFrame, neighbours: DataFrame | None = None, asked: DataFrame | None = None, pairs: DataFrame | None = None):
        self.vocabulary, self.neighbours, self.asked, self.pairs = vocabulary, neighbours, asked, pairs


class Repair:
    """What was found on scanned pages: ``dropped`` (page_id, line_no), ``breaks`` and ``misread`` (page_id, line_no, word ...)."""

    def __init__(self, dropped: DataFrame, breaks: DataFrame, misread: DataFrame, pages: DataFrame, known: Known):
        self.dropped, self.breaks, self.misread, self.pages, self.known = dropped, breaks, misread, pages, known


def _cased(word: Column, meant: Column, surface: Column) -> Column:
    """The right reading in the case of the word: capitals as in the word, a spelling of its own as it is usual."""
    own = surface != F.lower(surface)
    inner_own = F.substring(surface, 2, 1000) != F.lower(F.substring(surface, 2, 1000))
    capital = F.concat(F.upper(F.substring(meant, 1, 1)), F.substring(meant, 2, 1000))
    letters = F.regexp_replace(word, r"[^\p{L}]", "")
    upper = (F.length(letters) > 2) & (letters == F.upper(letters))
    return F.when(upper, F.upper(meant)).when(inner_own, surface).when(word.rlike(r"^\p{Lu}"), capital).when(own & word.rlike(r"^[^\p{Ll}]"), surface).otherwise(meant)


def examine(pages: DataFrame, clean: DataFrame) -> Repair:
    """Find furniture, broken words and misreadings on ``pages`` (page_id, paper_id, page_index, text) of scans.

    ``clean`` (text) are pages that were not scanned; with the scanned ones they give the vocabulary and the
    neighbour counts. A broken word goes on in the next text line that is not furniture, or on the next page of the paper that has
    one; it keeps its hyphen if that form is the commoner one. It may have lost its hyphen: then its parts are put together if
    that is a known word and one of them is none. For every distinct word the commoner vocabulary words are retrieved by
    automata over tries of it: all that misreadings alone turn into it and, if clean pages don't have it, all within one edit, or
    two from eight letters on. They are ranked by frequency, by their neighbours in the text and by the cost of the edits, where one that is no
    known misreading costs more, and is taken on the word of both neighbours only. Words of the clean pages are changed only
    where their neighbours speak strongly for the other word. Null and empty pages have nothing to repair; repeated page rows count once.
    """
    pages = pages.filter("text is not null and page_id is not null").dropDuplicates(["page_id"]).select("page_id", "paper_id", "page_index", "text")
    dropped = furniture(pages)
    lists = dropped.groupBy("page_id").agg(F.collect_list("line_no").alias("dropped"))
    with_lists = pages.join(lists, "page_id", "left")
    heads = spread(with_lists.select("page_id", "paper_id", "page_index", "text", "dropped")).mapInArrow(_heads, _HEADS).filter("head is not null")
    heads = heads.groupBy("paper_id", "page_index").agg(F.min(F.struct("head", "page_id", "head_line")).alias("h"), F.max("open").alias("open"))
    heads = cut(heads.select("paper_id", "page_index", "h.*", "open"))
    around = _neighbours(heads)
    around = around.withColumn("own", F.col("head")).drop("head", "head_line")
    ready = with_lists.join(around.drop("page_id"), ["paper_id", "page_index"], "left")
    suspended = F.lower(F.regexp_replace("own", r"[^\p{L}/]", "")).isin(*_SUSPENDED)
    goes_on = F.coalesce(F.col("opened") & F.col("own").rlike(r"^[\p{L}\p{N}!¢|]") & ~suspended, F.lit(False))
    ready = cut(ready.select("page_id", "text", "dropped", F.col("overleaf"), goes_on.alias("taken"), "next_page", "next_head_line"))
    release(heads)
    words = cut(spread(ready.select("page_id", "text", "dropped", "overleaf", "taken")).mapInArrow(_all_words, _WORDS))

    # Vocabulary: surface forms of clean pages and of whole words on scanned ones.
    counted = spread(clean.filter("text is not null").select("text")).mapInArrow(_counts, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    is_pair = F.contains("w", F.lit("\t"))
    scanned = words.filter("word is not null").groupBy(F.col("word").alias("w")).agg(F.count("*").alias("n"))
    surfaces = counted.filter(~is_pair).select("w", F.col("n").alias("clean"), F.lit(0).cast("bigint").alias("scan"))
    surfaces = surfaces.unionByName(scanned.select("w", F.lit(0).cast("bigint").alias("clean"), F.col("n").alias("scan")))
    surfaces = surfaces.groupBy("w").agg(F.sum("clean").alias("clean"), F.sum("scan").alias("scan"))
    vocabulary = cut(
        surfaces.groupBy(F.lower("w").alias("w")).agg(
            F.sum("clean").alias("clean"), F.sum("scan").alias("scan"),
            F.max(F.struct((F.col("clean") + F.col("scan")).alias("n"), F.col("w").alias("s")))["s"].alias("surface"),
        )
    )

    known = Known(vocabulary)
    words, over = _unmarked(words, known, ready.select("page_id", "next_page", "next_head_line"))
    broken = _whole(words, known)
    every = _every(words, broken)
    known.neighbours = counted.filter(is_pair).select("w", "n").unionByName(
        every.filter("after <> ''").groupBy(F.concat(F.lower("word"), F.lit("\t"), F.col("after")).alias("w")).agg(F.count("*").alias("n"))
    ).groupBy("w").agg(F.sum("n").alias("n"))
    readings = _readings(every, known)
    going = over.select("page_id", F.lit(True).alias("goes_on"))
    ready = ready.join(_small(going), "page_id", "left").withColumn("taken", F.col("taken") | F.coalesce("goes_on", F.lit(False)))
    return Repair(dropped, _breaks(broken, readings), readings, ready.select("page_id", "text", "dropped", "overleaf", "taken"), known)


def _small(df: DataFrame) -> DataFrame:
    """To all tasks, if it is small; ``df`` is one that was cut."""
    return F.broadcast(df) if df.count() <= SMALL else df


def _neighbours(heads: DataFrame, run: int = 1000) -> DataFrame:
    """Of every page with text the first word of the next one in its paper (``overleaf``, ``next_page``, ``next_head_line``) and whether the one before ends ``opened``.

    However many pages without text lie between. A paper's pages go in runs of ``run`` indexes, so a long paper is no single task.
    """
    part = heads.withColumn("run", F.floor(F.col("page_index") / run))
    first = F.struct("head", "page_id", "head_line")
    in_run = Window.partitionBy("paper_id", "run").orderBy("page_index")
    part = part.withColumn("ahead", F.lead(first).over(in_run)).withColumn("behind", F.lag("open").over(in_run))
    ends = part.groupBy("paper_id", "run").agg(F.min_by(first, "page_index").alias("first"), F.max_by("open", "page_index").alias("last"))
    runs = Window.partitionBy("paper_id").orderBy("run")
    ends = ends.select("paper_id", "run", F.lead("first").over(runs).alias("then"), F.lag("last").over(runs).alias("past"))
    part = part.join(ends, ["paper_id", "run"])
    ahead = F.coalesce("ahead", "then")
    return part.select(
        "paper_id", "page_index", "page_id", "head", "head_line", ahead["head"].alias("overleaf"), ahead["page_id"].alias("next_page"),
        ahead["head_line"].alias("next_head_line"), F.coalesce("behind", "past", F.lit(False)).alias("opened"),
    )


def _unmarked(words: DataFrame, known: Known, pages: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Words broken at a line's end without any hyphen: ``words`` with them as broken ones, and the pages that begin with a second part.

    They are told by the vocabulary: the two parts together are a word of the clean pages or of several places, and one
    of them by itself is no word of the clean pages.
    """
    n = (F.col("clean") + F.col("scan")).alias("n")
    maybe = words.filter("next_word is not null").select("page_id", "line_no", "pos", "next_line", F.lower("word").alias("head_w"), F.lower("next_word").alias("tail_w"), F.lower(F.concat("word", "next_word")).alias("w"))
    maybe = maybe.join(known.vocabulary.select("w", F.col("clean").alias("whole"), n), "w").filter("whole > 0 or n > 1")
    counts = known.vocabulary.filter("clean > 0").select("w", "clean")
    maybe = maybe.join(counts.select(F.col("w").alias("head_w"), F.col("clean").alias("n_head")), "head_w", "left")
    maybe = maybe.join(counts.select(F.col("w").alias("tail_w"), F.col("clean").alias("n_tail")), "tail_w", "left")
    sure = cut(maybe.filter("n_head is null or n_tail is null").select("page_id", "line_no", "pos", "next_line"))
    marks = _small(sure.select("page_id", "line_no", "pos", F.lit(True).alias("joins")))
    over = sure.filter("next_line = 0").select("page_id")
    gone = sure.filter("next_line > 0").select("page_id", F.col("next_line").alias("line_no"))
    if pages is None:
        over = over.limit(0)
    else:
        over = pages.join(_small(over), "page_id").select(F.col("next_page").alias("page_id"), F.col("next_head_line").alias("line_no"))
        gone = gone.unionByName(over)
    gone = gone.select("page_id", "line_no", F.lit(0).alias("pos"), F.lit(True).alias("gone"))
    place = ["page_id", "line_no", "pos"]
    rows = words.join(marks, place, "left").join(_small(gone), place, "left").filter("gone is null")
    joins = F.col("joins").isNotNull()
    changed = {
        "head": F.when(joins, F.col("word")).otherwise(F.col("head")), "tail": F.when(joins, F.col("next_word")).otherwise(F.col("tail")),
        "after": F.when(joins, F.col("beyond")).otherwise(F.col("after")), "word": F.when(~joins, F.col("word")),
    }
    return rows.select(*place, *[c.alias(k) for k, c in changed.items()], "before"), over


def _whole(words: DataFrame, known: Known) -> DataFrame:
    """Broken words: the commoner of the two forms."""
    vocabulary = known.vocabulary
    parts = words.filter("head is not null")
    plain, own = F.concat("head", "tail"), F.concat("head", F.lit("-"), "tail")
    forms = parts.select("page_id", "line_no", "pos", "head", "tail", "before", "after", F.lower(plain).alias("joined"), F.lower(own).alias("kept"))
    n = (F.col("clean") + F.col("scan")).alias("n")
    forms = forms.join(vocabulary.select(F.col("w").alias("joined"), n.alias("n_joined")), "joined", "left")
    forms = forms.join(vocabulary.select(F.col("w").alias("kept"), n.alias("n_kept")), "kept", "left")
    hyphened = (F.coalesce("n_kept", F.lit(0)) > F.coalesce("n_joined", F.lit(0))) | (
        (F.coalesce("n_joined", F.lit(0)) == 0) & (F.coalesce("n_kept", F.lit(0)) == 0) & (F.col("head").rlike(r"[\p{Lu}\d]$") | F.col("tail").rlike(r"^[\p{Lu}\d]") | F.col("head").contains("-"))
    )
    return cut(forms.select("page_id", "line_no", "pos", "head", "tail", "before", "after", F.when(hyphened, own).otherwise(plain).alias("word")))


def _every(words: DataFrame, broken: DataFrame) -> DataFrame:
    every = words.filter("word is not null").select("page_id", "line_no", "pos", "word", "before", "after", F.lit(None).cast("string").alias("head"), F.lit(None).cast("string").alias("tail"))
    return every.unionByName(broken.select(*every.columns))


def _readings(every: DataFrame, known: Known) -> DataFrame:
    """Misreadings: candidates for every distinct word that was not asked before, ranked at each place."""
    vocabulary, neighbours = known.vocabulary, known.neighbours
    asked = every.select(F.lower("word").alias("w")).distinct().filter(~F.col("w").rlike(r"^[\d.,:/-]+$"))
    if known.asked is not None:
        asked = asked.join(known.asked, "w", "left_anti")
    mine = vocabulary.select("w", "clean", F.col("scan").alias("scan"))
    asked = asked.join(mine, "w", "left").fillna({"clean": 0, "scan": 0})
    # A reading must be clearly the commoner word.
    asked = cut(asked.select("w", (F.col("clean") + F.col("scan")).alias("n"), (F.col("clean") == 0).alias("fresh"), "clean", "scan"))
    near = candidates(asked.select("w", "n", "fresh"), vocabulary.select("w", (F.col("clean") + F.col("scan")).alias("n")))
    meant = vocabulary.select(F.col("w").alias("meant"), (F.col("clean") + F.col("scan")).alias("n_meant"), "surface")
    pairs = cut(near.join(meant, "meant").join(asked.select("w", "clean", "scan"), "w"))
    if known.pairs is None:
        known.asked, known.pairs = asked.select("w"), pairs
    else:
        pairs = cut(pairs.unionByName(known.pairs))

    at = cut(every.withColumn("w", F.lower("word")).join(_small(pairs), "w"))
    tab = F.lit("\t")
    # Counts of the pairs of the reading and of the word with its neighbours.
    asks = at.select("page_id", "line_no", "pos", "meant", F.explode(F.array(
        F.struct(F.lit(1).alias("side"), F.concat("before", tab, "meant").alias("w")),
        F.struct(F.lit(2).alias("side"), F.concat("meant", tab, "after").alias("w")),
        F.struct(F.lit(0).alias("side"), F.concat("before", tab, F.lower("word")).alias("w")),
        F.struct(F.lit(0).alias("side"), F.concat(F.lower("word"), tab, "after").alias("w")),
    )).alias("q")).select("page_id", "line_no", "pos", "meant", "q.*")
    told = asks.join(neighbours, "w", "left").groupBy("page_id", "line_no", "pos", "meant").agg(
        F.sum(F.when(F.col("side") > 0, F.coalesce("n", F.lit(0)))).alias("for_it"), F.count_distinct(F.when(F.col("n") > 0, F.nullif("side", F.lit(0)))).alias("sides"), F.sum(F.when(F.col("side") == 0, F.coalesce("n", F.lit(0)))).alias("for_word")
    )
    judged = at.join(told, ["page_id", "line_no", "pos", "meant"])
    new = (F.col("clean") == 0) & ((F.col("n_meant") > 4 * F.col("scan")) | (F.col("for_it") > 0))
    strong = (F.col("for_it") >= 5) & (F.col("for_it") > RATIO * F.greatest(F.col("for_word") - 2, F.lit(0))) & (F.col("n_meant") > RATIO * F.col("clean"))
    score = F.log1p("n_meant") + 2 * F.log1p("for_it") - 3.0 * F.col("errors")
    told_by_all = (F.col("sides") == 2) & (F.col("for_it") > F.col("for_word"))
    best = judged.filter(F.when(F.col("explained"), new | strong).otherwise(told_by_all)).groupBy("page_id", "line_no", "pos").agg(
        F.max(F.struct(score.alias("s"), F.col("meant").alias("m"), F.col("surface").alias("surface"), F.col("word").alias("word"), F.col("head").alias("head"), F.col("tail").alias("tail"))).alias("b")
    ).select("page_id", "line_no", "pos", "b.*")
    fixed = best.select("page_id", "line_no", "pos", F.col("word").alias("raw"), _cased(F.col("word"), F.col("m"), F.col("surface")).alias("word"), "head", "tail")
    # Numbers by their form; a word that the clean pages have stays a word.
    numbers = every.filter(F.col("word").rlike(r"\d") & F.col("word").rlike(_ODD)).withColumn("reading", _numbers(F.col("word"))).filter("reading is not null")
    numbers = numbers.withColumn("w", F.lower("word")).join(vocabulary.filter("clean > 0").select("w"), "w", "left_anti")
    numbers = numbers.select("page_id", "line_no", "pos", F.col("word").alias("raw"), F.col("reading").alias("word"), "head", "tail")
    return cut(fixed.join(numbers.select("page_id", "line_no", "pos"), ["page_id", "line_no", "pos"], "left_anti").unionByName(numbers))


def _breaks(broken: DataFrame, readings: DataFrame) -> DataFrame:
    right = broken.join(readings.select("page_id", "line_no", "pos", F.col("word").alias("right")), ["page_id", "line_no", "pos"], "left")
    return right.select("page_id", "line_no", F.coalesce("right", "word").alias("word"), "head", "tail")


_ODD = "[" + "".join(re.escape(x.split(":")[0]) for x in DIGITS.split()) + "]"


@F.pandas_udf(StringType())
def _numbers(x: pd.Series) -> pd.Series:
    return x.map(number_reading)


def found(repair: Repair) -> DataFrame:
    """``page_id``, ``line_no``, ``kind`` (furniture, break, misread) and ``word``."""
    f = repair.dropped.select("page_id", "line_no", F.lit("furniture").alias("kind"), F.lit("").alias("word"))
    b = repair.breaks.select("page_id", "line_no", F.lit("break").alias("kind"), "word")
    m = repair.misread.select("page_id", "line_no", F.lit("misread").alias("kind"), "word")
    return f.unionByName(b).unionByName(m).distinct()


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages without furniture, with whole words and right readings, in paragraphs."""
    for batch in _few(batches):
        out, begins, ends = [], [], []
        cols = (batch.column(c).to_pylist() for c in ("text", "dropped", "overleaf", "taken", "fixes", "wholes"))
        for text, dropped, overleaf, taken, fixes, wholes in zip(*cols, strict=True):
            gone = set(dropped or ())
            fix = {(f["line_no"], f["pos"]): (f["raw"], f["word"]) for f in fixes or ()}
            whole = {w["line_no"]: w["word"] for w in wholes or ()}
            body = _body(text, gone)
            follow = {n: _first_word(body[k + 1][1]) if k + 1 < len(body) else (overleaf or "") for k, (n, _) in enumerate(body)}
            paragraphs: list[list[str]] = [[]]
            skip, before = taken, 0
            width = max((len(x) for _, x in body), default=0)
            starts = closes = False
            for k, (n, line) in enumerate(body):
                heading = len(line) < 0.6 * width and len(line.split()) <= 5 and line.strip()[:1].isupper() and line[-1].isalnum() and k + 1 < len(body) and body[k + 1][1].lstrip()[:1].isupper()
                indent = len(line) - len(line.lstrip()) >= 2
                blank = any(not x.strip() for x in text.split("\n")[before : n - 1])
                if (indent or blank or heading) and paragraphs[-1] and not skip:
                    paragraphs.append([])
                tokens = line.split()
                for pos, t in enumerate(tokens):
                    if pos == 0 and skip:
                        continue
                    if pos == len(tokens) - 1 and n in whole:
                        part, tail = _strip(t), _strip(follow[n])
                        lead = t[: t.find(part)] if part else ""
                        rest = follow[n][follow[n].find(tail) + len(tail) :] if tail else ""
                        t = lead + whole[n] + rest
                    elif (n, pos) in fix:
                        t = t.replace(*fix[n, pos], 1)
                    paragraphs[-1].append(t)
                if heading:
                    paragraphs.append([])
                if k == 0:
                    starts = not taken and (indent or heading)
                title = len(line) < 0.6 * width and len(line.split()) <= 5 and line.strip()[:1].isupper() and line[-1].isalnum()
                closes = title or len(line) < 0.8 * width and bool(_CLOSED.search(line))
                skip, before = n in whole, n
            begins.append(starts)
            ends.append(closes)
            out.append("\n\n".join(" ".join(p) for p in paragraphs if p))
        columns = [batch.column("page_id"), pa.array(out, pa.string()), pa.array(begins, pa.bool_()), pa.array(ends, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "text", "begins", "ends"])


_CLOSED = re.compile(r"[.!?:;][)\]”’»\"']*$")


def reflowed(repair: Repair) -> DataFrame:
    """``page_id`` and ``text``: every page as continuous paragraphs.

    Furniture is gone, right readings stand for misread words, and a word broken at a line's or a page's end stands
    whole where it began. A paragraph begins after an empty line or with an indented one. Each page's corrections, no more than
    its words, meet its text in one join; a page of which nothing is left gives an empty text.
    """
    return _flow(repair).select("page_id", "text")


def _flow(repair: Repair) -> DataFrame:
    """The reflowed pages, and whether the first line of each begins a paragraph and its last one ends one."""
    fixes = repair.misread.filter("head is null").groupBy("page_id").agg(F.collect_list(F.struct("line_no", "pos", "raw", "word")).alias("fixes"))
    wholes = repair.breaks.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "word")).alias("wholes"))
    pages = repair.pages.join(fixes, "page_id", "left").join(wholes, "page_id", "left")
    return pages.mapInArrow(_rebuilt, "page_id bigint, text string, begins boolean, ends boolean")


def _at_pages(text: str, pages: list[tuple[int, str | None]]) -> list[tuple[int, str]] | None:
    """The pages that ``text`` is made of, in order and with nothing but blanks between; None if they are not its pages."""
    at, out = 0, []
    for index, page in sorted(((i, p) for i, p in pages if p and p.strip() and i is not None), key=lambda x: x[0]):
        core = page.strip()
        i = text.find(core, at)
        if i < 0 or text[at:i].strip():
            return None
        out.append((index, page))
        at = i + len(core)
    return out if out and not text[at:].strip() else None


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for rid, paper, text, *lists in zip(*(batch.column(c).to_pylist() for c in ("report_id", "paper_id", "text", "own", "known")), strict=True):
            found = (_at_pages(text, [(x["page"], x["page_text"]) for x in pages if x]) for pages in lists if pages)
            parts = next((p for p in found if p), None)
            rows += [(rid, paper, i, t) for i, t in parts] if parts else [(rid, paper, None, text)]
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(4)]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["report_id", "paper_id", "page_index", "text"])


def _framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sentences as texts of their own: the lines that are furniture of their page, and the other halves of words broken at either end."""
    plain = str.maketrans(dict.fromkeys(HYPHENS, "-"))
    for batch in batches:
        texts, gone = [], []
        for text, page, dropped, overleaf in zip(*(batch.column(c).to_pylist() for c in ("text", "page", "dropped", "overleaf")), strict=True):
            if page is not None and text.strip():
                out = set(dropped or ())
                furniture_lines = {x.strip() for n, x in enumerate(page.split("\n"), 1) if n in out}
                keys = {k for x in furniture_lines if (k := fold_line(x)).strip("# ")}
                kept = [x for x in text.split("\n") if x.strip() not in furniture_lines and fold_line(x) not in keys]
                text = "\n".join(kept)
                body = "\n".join(x for _, x in _body(page, out))
                core = "\n".join(x.rstrip() for x in kept if x.strip()).strip()
                low, key = body.translate(plain), core.translate(plain)
                at = low.find(key) if key else -1
                if at >= 0 and low.find(key, at + 1) < 0:
                    ahead = body[:at].split("\n")
                    first = core.split()[0]
                    if len(ahead) > 1 and not ahead[-1].strip() and _ends_broken(ahead[-2]) and first[0].isalnum() and _strip(first).lower() not in _SUSPENDED:
                        text = ahead[-2].split()[-1] + "\n" + text.lstrip()
                    if _ends_broken(core):
                        behind = body[at + len(core) :].split() or [overleaf or ""]
                        text = text.rstrip() + "\n" + behind[0]
            texts.append(text)
            gone.append([])
        columns = [batch.column("page_id"), pa.array(texts, pa.string()), pa.array(gone, pa.list_(pa.int32())), pa.nulls(len(texts), pa.string()), pa.array([False] * len(texts))]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "text", "dropped", "overleaf", "taken"])


_READY = "page_id bigint, text string, dropped array<int>, overleaf string, taken boolean"


def examine_texts(texts: DataFrame, known: Known) -> Repair:
    """Broken words and misreadings of ``texts`` (page_id, text, dropped, overleaf, taken) by what is ``known`` of words; they are not counted in it."""
    texts = cut(texts)
    words = cut(spread(texts).mapInArrow(_all_words, _WORDS))
    words, _ = _unmarked(words, known, None)
    broken = _whole(words, known)
    readings = _readings(_every(words, broken), known)
    return Repair(None, _breaks(broken, readings), readings, texts, known)


def repaired_texts(reports: DataFrame, sentences: DataFrame, pages: DataFrame, clean: DataFrame) -> DataFrame:
    """``kind`` (report, annotation), ``ref_id`` and ``text``: report texts and sentences of scans in continuous paragraphs.

    ``reports`` have report_id, paper_id, text and own (page, page_text), ``sentences`` ann_id, paper_id, page_index and text, ``pages``
    and ``clean`` are those of ``examine``. A report is made of the pages it was recorded with or of those of its paper, if they are
    what its text consists of; pages that ``pages`` has not are examined along with it. Paragraphs go on overleaf unless the last line
    is a short closed one or a title, or the next page begins with an indent or a heading. A text whose pages
    are not known, and every sentence, is repaired by itself with the words and neighbours of all pages; lines of a sentence
    that are furniture on its page go, and a word broken at its beginning or end stands whole if the sentence has
    one place on its page. Null texts are left out; repeated keys count once; an empty text stays empty.
    """
    pages = cut(pages.filter("text is not null and page_id is not null").dropDuplicates(["page_id"]).select("page_id", "paper_id", "page_index", "text"))
    reports = reports.filter("text is not null and report_id is not null").dropDuplicates(["report_id"])
    shape = "report_id bigint, paper_id string, page_index int, text string"
    # Most texts are made of the pages they were recorded with; only the others meet the pages of their paper.
    parts = cut(spread(reports.withColumn("known", F.lit(None).cast(reports.schema["own"].dataType))).mapInArrow(_parts, shape))
    open_ = parts.filter("page_index is null")
    by_paper = pages.join(open_.select("paper_id").distinct(), "paper_id", "left_semi").groupBy("paper_id").agg(F.collect_list(F.struct(F.col("page_index").alias("page"), F.col("text").alias("page_text"))).alias("known"))
    again = open_.select("report_id", "paper_id", "text").join(by_paper, "paper_id", "left").withColumn("own", F.col("known"))
    parts = parts.filter("page_index is not null").unionByName(again.mapInArrow(_parts, shape))
    # Pages are the same by their text's digest; the texts themselves stay where they are.
    place = ["paper_id", "page_index", "digest"]
    ids = cut(pages.groupBy("paper_id", "page_index", F.md5("text").alias("digest")).agg(F.min("page_id").alias("page_id")))
    parts = parts.withColumn("digest", F.md5("text")).join(_small(ids), place, "left").drop("digest")
    parts = parts.withColumn("new", F.col("page_index").isNotNull() & F.col("page_id").isNull())
    # Pages that only a report has get keys below zero.
    parts = cut(parts.withColumn("page_id", F.when(F.col("new"), -F.abs(F.xxhash64("report_id", "page_index"))).otherwise(F.col("page_id"))))
    repair = examine(pages.unionByName(parts.filter("new").select(*pages.columns)), clean)

    none = [F.lit(None).cast("array<int>").alias("dropped"), F.lit(None).cast("string").alias("overleaf"), F.lit(False).alias("taken")]
    alone = parts.filter("page_index is null").select(F.col("report_id").alias("ref_id"), F.lit("report").alias("kind"), "text", *none)
    paged = repair.pages.join(pages.select("page_id", "paper_id", "page_index"), "page_id")
    paged = paged.groupBy("paper_id", "page_index").agg(F.min_by(F.struct("text", "dropped", "overleaf"), "page_id").alias("p"))
    paged = paged.select("paper_id", "page_index", F.col("p.text").alias("page"), "p.dropped", "p.overleaf")
    notes = sentences.filter("text is not null and ann_id is not null").dropDuplicates(["ann_id"]).join(paged, ["paper_id", "page_index"], "left")
    framed = spread(notes.select(F.col("ann_id").alias("page_id"), "text", "page", "dropped", "overleaf")).mapInArrow(_framed, _READY)
    framed = framed.withColumnRenamed("page_id", "ref_id").withColumn("kind", F.lit("annotation"))
    # Keys of both kinds in one numbering: even for reports, odd for sentences.
    both = alone.unionByName(framed).withColumn("page_id", 2 * F.col("ref_id") + (F.col("kind") == "annotation").cast("int"))
    single = reflowed(examine_texts(both.drop("ref_id", "kind"), repair.known))
    kind = F.when(F.pmod("page_id", F.lit(2)) == 1, "annotation").otherwise("report").alias("kind")
    single = single.select(kind, F.floor((F.col("page_id") - F.pmod("page_id", F.lit(2))) / 2).cast("bigint").alias("ref_id"), "text")

    flow = parts.filter("page_index is not null").select("report_id", "page_index", "page_id").join(_flow(repair), "page_id")
    flow = flow.groupBy("report_id").agg(F.array_sort(F.collect_list(F.struct("page_index", "text", "begins", "ends"))).alias("ps"))
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("ends"))

    def added(done: Column, p: Column) -> Column:
        gap = F.when(done["text"] == "", "").when(done["ends"] | p["begins"], "\n\n").otherwise(" ")
        return F.struct(F.concat(done["text"], gap, p["text"]).alias("text"), p["ends"].alias("ends"))

    joined = F.aggregate(F.filter("ps", lambda p: p["text"] != ""), start, added)["text"]
    return flow.select(F.lit("report").alias("kind"), F.col("report_id").alias("ref_id"), joined.alias("text")).unionByName(single)
