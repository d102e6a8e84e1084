"""Lexical and vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfall.functions import text as T


def lexical_checks(checks: DataFrame, reports: DataFrame, least: int = 10, block: int = 500) -> DataFrame:
    """``check_id``, ``found``, ``confidence``, ``status``: 1.0 if the folded needle is in the folded text, 0.9 if so without punctuation.

    A needle shorter than ``least`` when folded finds nothing. The needles of a report come to it in blocks of about ``block``, as many
    as it has, so its text is folded once a block and is not repeated per needle.
    """
    n1, n2 = T.fold_whitespace(F.col("needle")), T.fold_aggressive(F.col("needle"))
    needles = checks.dropDuplicates(["check_id"]).select("check_id", "paper_id", "source", n1.alias("n1"), n2.alias("n2"))
    keyed = needles.filter(F.col("paper_id").isNotNull() & F.col("source").isNotNull() & (F.length("n1") >= least))
    blocks = keyed.groupBy("paper_id", "source").agg(F.ceil(F.count("*") / block).alias("blocks"))
    asked = keyed.join(blocks, ["paper_id", "source"]).withColumn("b", F.pmod(F.xxhash64("check_id"), F.col("blocks")))
    asked = asked.groupBy("paper_id", "source", "b").agg(F.collect_list(F.struct("check_id", "n1", "n2")).alias("ns"))
    both = reports.select("paper_id", "source", F.coalesce("full_pdf_text", F.lit("")).alias("t")).join(asked, ["paper_id", "source"])

    def scored(t1, t2):
        def one(n):
            score = F.when(F.contains(t1, n["n1"]), 1.0).when((n["n2"] != "") & F.contains(t2, n["n2"]), 0.9).otherwise(0.0)
            return F.struct(n["check_id"].alias("check_id"), score.alias("c"))

        return F.transform("ns", one)

    hits = T.let(T.fold_whitespace(F.col("t")), lambda t1: T.let(T.bare(t1), lambda t2: scored(t1, t2)))
    hits = both.select(F.explode(hits).alias("h")).groupBy("h.check_id").agg(F.max("h.c").alias("c"))
    rows = needles.select("check_id").join(hits, "check_id", "left").select("check_id", F.coalesce("c", F.lit(0.0)).alias("confidence"))
    return rows.withColumn("found", F.col("confidence") > 0).withColumn("status", F.when(F.col("found"), "verified").otherwise("no_match"))


def lexical_places(checks: DataFrame, reports: DataFrame, least: int = 10, context: int = 64) -> DataFrame:
    """Where a needle is found: ``check_id``, ``page``, ``offset`` in the page's folded text, and what stands before and after it.

    The first page that has the folded needle; of several reports the smallest report_id. Each page is folded once.
    """
    n1 = T.fold_whitespace(F.col("needle"))
    needles = checks.dropDuplicates(["check_id"]).select("check_id", "paper_id", "source", n1.alias("n1")).filter(F.length("n1") >= least)
    pages = reports.select("report_id", "paper_id", "source", F.explode("page_texts").alias("p")).select("report_id", "paper_id", "source", "p.page", T.fold_whitespace(F.coalesce("p.page_text", F.lit(""))).alias("t"))
    at = F.call_function("instr", F.col("t"), F.col("n1")) - 1
    hit = pages.join(needles, ["paper_id", "source"]).withColumn("at", at).filter("at >= 0")
    first = F.min(F.struct(
        "report_id", "page", F.col("at").alias("offset"), F.substring(F.col("t"), F.greatest(F.col("at") - context + 1, F.lit(1)), F.least(F.col("at"), F.lit(context))).alias("before"),
        F.substring(F.col("t"), F.col("at") + F.length("n1") + 1, F.lit(context)).alias("after"),
    ))
    return hit.groupBy("check_id").agg(first.alias("f")).select("check_id", "f.page", "f.offset", "f.before", "f.after")


def normalised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Vectors of length 1; a vector of zeros stays as it is."""
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return vectors.withColumn("_n", norm).withColumn(column, F.when(F.col("_n") > 0, F.transform(column, lambda x: x.cast("double") / F.col("_n"))).otherwise(F.transform(column, lambda x: x.cast("double")))).drop("_n")


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block of queries (one row: ids, one flat array, the rows of a block of vectors) the best vector per query."""
    for batch in batches:
        qs, ids, best = [], [], []
        for at in range(batch.num_rows):
            q_ids, v_ids = (batch.column(c)[at].values.to_numpy() for c in ("q_ids", "v_ids"))
            q, v = (np.asarray(batch.column(c)[at].values.flatten(), dtype=np.float64) for c in ("q", "v"))
            width = len(q) // len(q_ids)
            dots = q.reshape(-1, width) @ v.reshape(-1, width).T
            dots[q_ids[:, None] == v_ids[None, :]] = -np.inf
            order = np.argsort(v_ids, kind="stable")
            place = order[dots[:, order].argmax(1)]
            top = dots[np.arange(len(q_ids)), place]
            ok = top > -np.inf
            qs.append(q_ids[ok])
            ids.append(v_ids[place][ok])
            best.append(top[ok])
        flat = [np.concatenate(x) if x else np.zeros(0) for x in (qs, ids, best)]
        yield pa.RecordBatch.from_arrays([pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.float64())], ["query_id", "vec_id", "dot"])


def nearest(vectors: DataFrame, queries: DataFrame, block: int = 1024, least: float | None = None) -> DataFrame:
    """For each query (vec_id, embedding) the other vector of the largest inner product, the lower id on ties.

    Exact: a stated set of queries against all rows, both in blocks of ``block``; each pair of blocks is one matrix
    product, which leaves one row per query. Every block of vectors meets every block of queries once; the copies are of the blocks
    of queries, the smaller side. With ``least`` only scores of at least that count.
    """
    def blocks(df: DataFrame, prefix: str) -> DataFrame:
        rows = df.filter("vec_id is not null and embedding is not null").dropDuplicates(["vec_id"]).select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
        n = max(1, -(-rows.count() // block))
        rows = rows.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
        one = F.collect_list(F.struct(F.col("vec_id").alias("id"), "e"))
        rows = rows.groupBy("b").agg(one.alias("x"))
        ids, e = F.transform("x", lambda r: r["id"].cast("bigint")), F.transform("x", lambda r: r["e"])
        return rows.select(F.col("b").alias(f"{prefix}_block"), ids.alias(f"{prefix}_ids"), e.alias(prefix)), n

    v, n_v = blocks(vectors, "v")
    q, _ = blocks(queries, "q")
    copies = q.withColumn("v_block", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))))
    scored = copies.join(v, "v_block").select("q_ids", "q", "v_ids", "v").mapInArrow(_best, "query_id bigint, vec_id bigint, dot double")
    if least is not None:
        scored = scored.filter(F.col("dot") >= least)
    m = F.max(F.struct("dot", (-F.col("vec_id")).alias("o")))
    return scored.groupBy("query_id").agg((-m["o"]).alias("vec_id"), m["dot"].alias("score"))
