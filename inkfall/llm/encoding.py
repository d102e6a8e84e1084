"""Encoding a whole corpus with a public byte-level tokenizer, and decoding it again."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfall.checkpoints import cut

TOKENIZERS = "/opt/tokenizers"
#: Words that are no piece of the vocabulary and go to all tasks with it, the commonest ones.
HOT = 100_000

# Fixed value: how the tokenizer cuts a text into words; (?U) gives blanks their Unicode meaning.
WORDS = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def vocabulary(spark, path: str) -> DataFrame:
    """``id`` and ``piece`` (its bytes) of the tokenizer; ``word`` where the bytes are a text by themselves."""
    rows = [(i, bytearray(b)) for b, i in _ranks(path).items()]
    pieces = spark.createDataFrame(rows, "id int, piece binary")
    return pieces.withColumn("word", F.try_validate_utf8(F.col("piece").cast("string")))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


class _Pieces:
    """Words whose ids are known, as flat arrays: the vocabulary's and, with more than one id each, ``more``."""

    def __init__(self, ranks: dict[bytes, int], more: list[tuple[str, list[int]]] = ()):
        own = [(w, i) for b, i in ranks.items() if (w := _text(b)) is not None]
        self.words = pa.array([w for w, _ in own] + [w for w, _ in more], pa.string())
        self.sizes = np.array([1] * len(own) + [len(x) for _, x in more], np.int64)
        self.ids = np.array([i for _, i in own] + [i for _, x in more for i in x], np.int32)

    def places(self, words: pa.Array) -> pa.Array:
        return pc.index_in(words, value_set=self.words)


def _text(piece: bytes) -> str | None:
    try:
        return piece.decode()
    except UnicodeDecodeError:
        return None


def _encoder(ranks: dict[bytes, int]):
    import tiktoken

    # A word is one piece: it is merged as a whole.
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def _counted(ranks):
    """mapInArrow function: the words that are no piece, with partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(ranks.value)
        for batch in batches:
            flat = batch.column("words").flatten()
            told = flat.filter(pieces.places(flat).is_null()).value_counts()
            yield pa.RecordBatch.from_arrays([told.field("values"), told.field("counts")], ["word", "n"])

    return run


def _open_words(ranks, hot):
    """mapInArrow function: of every document its distinct words that are neither pieces nor in ``hot``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(ranks.value, hot.value)
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten()
            open_ = pieces.places(flat).is_null()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(words.offsets.to_numpy()))[open_.to_numpy(zero_copy_only=False)]
            coded = flat.filter(open_).dictionary_encode()
            pairs = np.unique(np.stack([doc, coded.indices.to_numpy(zero_copy_only=False)]), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("r").take(pa.array(pairs[0])), coded.dictionary.take(pa.array(pairs[1]))], ["r", "word"])

    return run


def _encode_words(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks.value)
        for batch in batches:
            ids = [enc.encode_ordinary(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    return run


def _put_together(ranks, hot):
    """mapInArrow function: every word's ids in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(ranks.value, hot.value)
        for batch in batches:
            words = batch.column("words")
            flat = words.flatten()
            place = pieces.places(flat)
            sizes, ids = pieces.sizes, pieces.ids
            rest = batch.column("rest").flatten()
            if len(rest):  # the words of these documents that came by the join, each with the same ids wherever it is
                own = rest.field("ids")
                place = pc.coalesce(place, pc.add(pc.index_in(flat, value_set=rest.field("word")), len(sizes)))
                sizes = np.r_[sizes, np.diff(own.offsets.to_numpy())]
                ids = np.r_[ids, own.flatten().to_numpy(zero_copy_only=False)]
            place = place.to_numpy(zero_copy_only=False).astype(np.int64)
            begin = np.r_[0, np.cumsum(sizes)]
            n = sizes[place]
            end = np.r_[0, np.cumsum(n)]
            out = ids[np.repeat(begin[place] - end[:-1], n) + np.arange(end[-1])]
            bounds = words.offsets.to_numpy().astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(end[bounds - bounds[0]], pa.int32()), pa.array(out, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("r").field("k"), lists], ["k", "ids"])

    return run


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken",
    hot: int = HOT,
) -> DataFrame:
    """``key`` and ``ids`` of every document; null and empty texts give an empty list.

    Texts are split into words; words that are a piece of the vocabulary have its id. Each other distinct word of the corpus
    is encoded once: the ``hot`` commonest of them go to all tasks with the vocabulary, so no frequent word is shuffled as
    often as it occurs; the ids of the others are joined back by word and put in their places. Only the
    driver reads the tokenizer's file. Strings that look like special tokens are ordinary text. Repeated
    rows of one key and text give one row, different texts of one key a row each; a null
    key is a key like any other. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(_ranks(tokenizer))
    t = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.struct(F.col(key).alias("k"), F.md5(t).alias("digest")).alias("r"), t.alias("t"))
    kind = src.schema["r"].dataType.simpleString()
    one = src.repartition("r").distinct()
    words = src.select(words_of(F.col("t")).alias("words"))
    counts = cut(words.mapInArrow(_counted(ranks), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    table = counts.select("word").mapInArrow(_encode_words(ranks), "word string, ids array<int>")
    common = counts.orderBy(F.desc("n"), "word").limit(hot).select("word").mapInArrow(_encode_words(ranks), "word string, ids array<int>")
    common = [(w, ids) for w, ids in common.collect()]
    first = spark.sparkContext.broadcast(common)
    if len(common) < hot:
        whole = one.withColumn("rest", F.lit(None).cast("array<struct<word:string,ids:array<int>>>"))
    else:
        asked = one.select("r", words_of(F.col("t")).alias("words")).mapInArrow(_open_words(ranks, first), f"r {kind}, word string")
        rest = asked.join(table, "word").groupBy("r").agg(F.collect_list(F.struct("word", "ids")).alias("rest"))
        whole = one.join(rest, "r", "left")
    out = whole.select("r", words_of(F.col("t")).alias("words"), "rest").mapInArrow(_put_together(ranks, first), f"k {dict(docs.dtypes)[key]}, ids array<int>")
    return out.withColumnRenamed("k", key)


def decode(
    encoded: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken",
) -> DataFrame:
    """``key`` and ``text`` again, through a join of each id with its piece; an empty or null list gives an empty text.

    Unknown ids are left out. ``key`` must be unique.
    """
    spark = encoded.sparkSession
    pieces = F.broadcast(vocabulary(spark, tokenizer).select("id", "piece"))
    flat = encoded.select(F.col(key).alias("k"), F.posexplode_outer(F.col(ids)).alias("pos", "id"))
    joined = flat.join(pieces, "id", "left").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("h")))).alias("p"))
    hexed = F.array_join(F.transform("p", lambda x: x["h"]), "")
    return joined.select(F.col("k").alias(key), F.decode(F.unhex(hexed), "UTF-8").alias("text"))
