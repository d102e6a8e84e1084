"""Points where a caller's own parts go in: sentence segmenters, stages of a pipeline, strategies by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from inkfall.functions import text as T

Stage = Callable[[DataFrame], DataFrame]


class Registry:
    """Parts by name; an unknown name is an error that lists the known ones."""

    def __init__(self, kind: str):
        self.kind, self._parts = kind, {}

    def add(self, name: str, part: Any) -> Any:
        self._parts[name] = part
        return part

    def __getitem__(self, name: str) -> Any:
        if name not in self._parts:
            raise ValueError(f"no {self.kind} {name!r}; there are {', '.join(sorted(self._parts))}")
        return self._parts[name]


SEGMENTERS = Registry("segmenter")
SEGMENTERS.add("stops", T.sentences)
SEGMENTERS.add("lines", lambda x: F.filter(F.transform(F.split(x, "\n"), T.collapse), lambda s: s != ""))


def segmenter(load: Callable[[], Callable[[str], list[str]]]) -> Callable[[Column], Column]:
    """A column function of a Python segmenter; ``load`` makes it once per worker, so a model is not loaded for every batch."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = load()
        for batch in batches:
            yield batch.map(lambda x: None if x is None else [s for s in cut(x) if s.strip()] if x.strip() else [])

    return run


def staged(df: DataFrame, *stages: Stage | None) -> DataFrame:
    """The stages in turn, those that are None left out; Catalyst sees one plan."""
    for stage in stages:
        if stage is not None:
            df = df.transform(stage)
    return df


def sentence_rows(blocks: DataFrame, least: int = 20, backend: str | Callable[[Column], Column] = "stops") -> DataFrame:
    """Sentences of blocks (with ``text`` and ``page_index``) that are long enough and no noise; blocks of no page are left out.

    Lines are healed, then the segmenter cuts; everything is in the row, only the sentences are exploded.
    """
    cut = SEGMENTERS[backend] if isinstance(backend, str) else backend
    rows = blocks.filter("page_index is not null").withColumn("_s", cut(T.heal_lines(F.coalesce("text", F.lit("")))))
    flat = rows.select(*[c for c in blocks.columns if c != "text"], F.posexplode("_s").alias("ord", "s")).withColumn("sentence", F.regexp_replace("s", r"(?U)^\s+|\s+$", ""))
    return flat.drop("s").filter((F.length("sentence") >= least) & ~T.is_noise(F.col("sentence")))


def first_rows(rows: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each key, where a model takes no more."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= most).drop("_place")
