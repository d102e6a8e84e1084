"""Consensus from several annotators' labels by minimax conditional entropy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from inkfall.checkpoints import cut, release

# The labels in use.
LABELS = ("low", "some concerns", "high", "unclear")

#: Ratings of a block, the rows that a task works on together.
BLOCK = 20_000
#: Bytes of the sources' parameters, one copy a block, up to which they are sent to all tasks rather than the blocks to them.
BROADCAST_BYTES = 32 << 20


def label_of(payload: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The label of a payload, plain or JSON with a ``label``, in whatever spelling; null if it has none."""
    raw = F.coalesce(F.when(payload.rlike(r"^\s*\{"), F.get_json_object(payload, "$.label")), payload)
    plain = F.lower(F.trim(F.regexp_replace(raw, r"(?U)[\s_\-\"']+", " ")))
    return F.when(plain.isin(*labels), plain)


def latest_ratings(candidates: DataFrame, item: list[str]) -> DataFrame:
    """``item``, ``source`` and ``label``: of each source the latest labelled row per item (then the largest id)."""
    rows = candidates.select(*item, "source", label_of(F.col("payload")).alias("label"), "rated_at", "candidate_id")
    rows = rows.filter(" and ".join(f"`{c}` is not null" for c in [*item, "source", "label"]))
    order = F.struct("rated_at", "candidate_id", "label")
    return rows.groupBy(*item, "source").agg(F.max(order)["label"].alias("label"))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))


def _numbers(values) -> np.ndarray:
    return values.values.to_numpy(zero_copy_only=False)


def _pack(shape: pa.Schema):
    """mapInArrow function: a block's ratings as flat arrays; sources get places within their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                items = batch.column("items")[at].values
                ratings = items.field("ratings")
                flat = ratings.flatten()
                names = flat.field("source").dictionary_encode()
                cells = {
                    "block": batch.column("block")[at].as_py(),
                    "items": items.field("item"),
                    "sizes": np.diff(ratings.offsets.to_numpy()),
                    "sources": names.dictionary,
                    "src": names.indices.to_numpy(zero_copy_only=False),
                    "lab": flat.field("lab").to_numpy(zero_copy_only=False),
                }
                yield _row(shape, cells)

    return run


def _row(shape: pa.Schema, cells: dict) -> pa.RecordBatch:
    """One row of scalars and lists."""
    columns = []
    for f in shape:
        x = cells.get(f.name)
        if x is None or not pa.types.is_list(f.type):
            columns.append(pa.array([x], f.type))
        else:
            inner = x if isinstance(x, pa.Array) else pa.array(x)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner).cast(f.type))
    return pa.RecordBatch.from_arrays(columns, schema=shape)


def _pass(k: int, beta: float, steps: int, prior: np.ndarray, shape: pa.Schema):
    """mapInArrow function over blocks: item parameters by dual coordinate steps, posteriors, and what they say of the sources.

    Without ``tau`` (the first time) the posteriors are the shares of votes. ``sums`` are per source of the block the gradient,
    the curvature and the expected (class, label) counts; ``shares`` the sum of posteriors, ``moved`` how far they moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cell = {c: batch.column(c)[at] for c in batch.schema.names}
                sizes, src, lab = (_numbers(cell[c]) for c in ("sizes", "src", "lab"))
                given = dict(zip(cell["given"].values.field("source").to_pylist(), cell["given"].values.field("sigma").to_pylist(), strict=True))
                names = cell["sources"].values
                sigma = np.array([given[s] for s in names.to_pylist()]).reshape(-1, k, k)[src]
                n = len(sizes)
                item = np.repeat(np.arange(n), sizes)
                hit = np.eye(k)[lab][:, None, :]

                def summed(x: np.ndarray, item=item, n=n) -> np.ndarray:
                    out = np.zeros((n, *x.shape[1:]))
                    np.add.at(out, item, x)
                    return out

                def posterior(tau: np.ndarray, sigma=sigma, item=item, lab=lab, summed=summed) -> np.ndarray:
                    picked = np.take_along_axis(_softmax(sigma + tau[item]), lab[:, None, None].astype(np.int64), 2)[:, :, 0]
                    return _softmax(summed(np.log(np.maximum(picked, 1e-12))) + np.log(prior))

                if cell["tau"].as_py() is None:
                    tau = np.zeros((n, k, k))
                    q = summed(hit[:, 0, :])
                    q, old = q / q.sum(1, keepdims=True), None
                else:
                    tau, old = _numbers(cell["tau"]).reshape(n, k, k), _numbers(cell["q"]).reshape(n, k)
                    q = posterior(tau)
                    for _ in range(steps):
                        prob, w = _softmax(sigma + tau[item]), q[item][:, :, None]
                        tau = tau + 0.5 * (summed(w * (hit - prob)) - beta * tau) / (summed(w * prob * (1 - prob)) + beta)
                    q = posterior(tau)
                prob, w = _softmax(sigma + tau[item]), q[item][:, :, None]
                both = np.concatenate([w * (hit - prob), w * prob * (1 - prob), w * hit], 1).reshape(len(src), -1)
                sums = np.zeros((len(names), both.shape[1]))
                np.add.at(sums, src, both)
                cells = {c: cell[c].as_py() for c in ("block",)} | {"items": cell["items"].values, "sources": names}
                cells |= {"sizes": sizes, "src": src, "lab": lab, "tau": tau.reshape(-1), "q": q.reshape(-1), "sums": _lists(sums)}
                yield _row(shape, cells | {"shares": q.sum(0), "moved": float(n if old is None else np.abs(q - old).max(1).sum())})

    return run


def _unpack(k: int, shape: pa.Schema):
    """mapInArrow function: a row for every item of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                sizes, lab, q = (_numbers(batch.column(c)[at]) for c in ("sizes", "lab", "q"))
                q = q.reshape(len(sizes), k)
                counts = np.zeros((len(sizes), k), np.int64)
                np.add.at(counts, (np.repeat(np.arange(len(sizes)), sizes), lab), 1)
                same, pairs = (counts * (counts - 1)).sum(1), sizes.astype(np.int64) * (sizes - 1)
                agreement = pa.array(same / np.maximum(pairs, 1), mask=pairs == 0)
                columns = [batch.column("items")[at].values, pa.array(q.argmax(1)), pa.array(q.max(1)), agreement, pa.array(sizes), pa.array(counts.max(1) < sizes)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    return run


def fit_consensus(
    ratings: DataFrame,
    item: list[str],
    labels: tuple[str, ...] = LABELS,
    alpha: float = 2.0,
    beta: float = 8.0,
    rounds: int = 100,
    item_steps: int = 3,
    tolerance: float = 5e-4,
) -> tuple[DataFrame, DataFrame]:
    """Consensus per item and reliability per source from ``item``, ``source``, ``label`` rows.

    Minimax conditional entropy: the chance that source i gives item j of class c the label k is proportional to
    exp(sigma_i[c,k] + tau_j[c,k]). The dual with quadratic penalties ``alpha`` (sources) and ``beta`` (items) is
    climbed block by block, all coordinates of one side by damped Newton steps with the other side fixed, in turn
    with the label posteriors; class shares come from the posteriors. It begins at each item's shares of votes and ends
    when the posteriors move by less than ``tolerance`` on average, after ``rounds`` at the latest.

    The first result has ``item``, ``label``, ``confidence`` (its posterior), ``agreement`` (share of pairs of
    sources that give the same label; null of a single source), ``n_sources`` and ``disagreed``; the second ``source``,
    ``reliability`` (posterior-weighted share of right labels), ``n_items`` and the expected (class, label) counts.

    Items lie in blocks of about ``BLOCK`` ratings, by hash. Each round every block gets the parameters of the sources that
    occur in it, by a join, and gives partial sums for them; sources are known by themselves, not by numbers, and nothing of
    them comes to the driver. An item has one label per source, so its ratings are bounded by the number of sources. Rows
    with a null key, source or label, or with a label that is none of ``labels``, don't count; an empty input gives
    empty results. Repeated rows of one source and item count once (the last in label order). Ties of the
    posterior go to the first of ``labels``.
    """
    spark = ratings.sparkSession
    k = len(labels)
    rated = ratings.filter(" and ".join(f"`{c}` is not null" for c in [*item, "source"])).filter(F.col("label").isin(*labels))
    code = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("int") - 1
    rated = rated.groupBy(*item, "source").agg(F.max("label").alias("label"))
    rated = cut(rated.select(F.struct(*item).alias("item"), "source", code.alias("lab")))
    n = rated.count()
    n_blocks = max(1, -(-n // BLOCK), min(spark.sparkContext.defaultParallelism, n // 1000))
    # By block first: the groups below then need no shuffle of their own.
    placed = rated.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks))).repartition("block")
    blocks = placed.groupBy("block", "item").agg(F.collect_list(F.struct("source", "lab")).alias("ratings"))
    blocks = blocks.groupBy("block").agg(F.collect_list(F.struct("item", "ratings")).alias("items"))
    packed = _state_type(rated.schema["item"].dataType, rated.schema["source"].dataType)
    first = T.StructType(packed.fields[:6])
    state = cut(blocks.mapInArrow(_pack(to_arrow_schema(first)), first))
    need = cut(state.select("block", F.explode("sources").alias("source")))
    eye = F.array(*[F.lit(float(x)) for x in np.eye(k).reshape(-1)])
    sources = cut(rated.groupBy("source").agg(F.count("*").alias("n_items")).withColumn("sigma", eye))
    small = need.count() * (k * k * 8 + 64) <= BROADCAST_BYTES
    release(rated)
    state = state.select("*", F.lit(None).cast("array<double>").alias("tau"), F.lit(None).cast("array<double>").alias("q"))
    prior = np.full(k, 1.0 / k)
    for at in range(rounds + 1):
        given = need.join(sources, "source").groupBy("block").agg(F.collect_list(F.struct("source", "sigma")).alias("given"))
        rows = state.join(F.broadcast(given) if small else given, "block")
        old, state = state, cut(rows.mapInArrow(_pass(k, beta, item_steps, prior, to_arrow_schema(packed)), packed))
        release(old)
        told = state.agg(F.sum("moved"), F.sum(F.size("items")), *[F.sum(F.col("shares")[c]) for c in range(k)]).first()
        # The shares of the classes: each item once, however many ratings it has.
        shares = np.array([x or 0.0 for x in told[2:]])
        if at == rounds or not told[1] or told[0] < tolerance * told[1]:
            break
        prior = np.maximum(shares / shares.sum(), 1e-6)
        # With posteriors and item parameters fixed, a step on the sources.
        step = F.transform(
            F.sequence(F.lit(0), F.lit(k * k - 1)),
            lambda i: F.get("sigma", i) + 0.8 * (F.get("sums", i) - alpha * F.get("sigma", i)) / (F.get("sums", i + k * k) + alpha),
        )
        past, sources = sources, cut(sources.join(_source_sums(state, k), "source").select("source", "n_items", step.alias("sigma")))
        release(past)
    shape = T.StructType([
        T.StructField("item", packed["items"].dataType.elementType), T.StructField("place", T.IntegerType()), T.StructField("confidence", T.DoubleType()),
        T.StructField("agreement", T.DoubleType()), T.StructField("n_sources", T.IntegerType()), T.StructField("disagreed", T.BooleanType()),
    ])
    flat = state.select("items", "sizes", "lab", "q").mapInArrow(_unpack(k, to_arrow_schema(shape)), shape)
    name = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("place") + 1)
    out = flat.select("item.*", name.alias("label"), "confidence", "agreement", "n_sources", "disagreed")
    seen = F.slice("sums", 2 * k * k + 1, k * k)
    right = sum((F.get(seen, F.lit(c * k + c)) for c in range(1, k)), F.get(seen, F.lit(0)))
    reliability = sources.join(_source_sums(state, k), "source").select("source", (right / F.col("n_items")).alias("reliability"), "n_items", seen.alias("confusion"))
    return out, reliability


def _state_type(item: T.DataType, source: T.DataType) -> T.StructType:
    whole, real = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())
    kinds = [
        ("block", T.LongType()), ("items", T.ArrayType(item)), ("sizes", whole), ("sources", T.ArrayType(source)), ("src", whole), ("lab", whole),
        ("tau", real), ("q", real), ("sums", T.ArrayType(real)), ("shares", real), ("moved", T.DoubleType()),
    ]
    return T.StructType([T.StructField(c, k) for c, k in kinds])


def _source_sums(state: DataFrame, k: int) -> DataFrame:
    """Per source the gradient, the curvature and the expected counts of (class, label), added up over the blocks."""
    parts = state.select(F.explode(F.arrays_zip("sources", "sums")).alias("p")).select("p.sources", "p.sums")
    cells = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(3 * k * k)]
    return parts.groupBy(F.col("sources").alias("source")).agg(*cells).select("source", F.array(*[f"s{i}" for i in range(3 * k * k)]).alias("sums"))
