"""Embedding whitening from exact cross-products, taken bit by bit.

Entries become whole numbers.  Each task shifts every dimension of a batch so
that its least entry is 0 and packs each bit of it across the rows into 64-bit
words.  The sum of products of two dimensions is then the sum, over pairs of
their bit planes, of a power of two times the number of bits that both planes
have.  The shifts are taken out again in whole numbers, the sums of all tasks
are added by dimension pair, and the scatter is centred before anything is
divided, so nothing is rounded before the eigenvectors are computed.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, materialise

#: whole numbers of any size travel as parts of 40 bits, whose sums fit into longs
PART_BITS, PARTS = 40, 5


def whole_entries(vectors: Column, scale: float) -> Column:
    """floor(scale * entry) of each entry, as longs; null unless all entries are finite numbers."""
    bad = F.exists(vectors, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(vectors, lambda c: F.floor(F.lit(scale) * c.cast("double"))))


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _by_size(batches: Iterator[pa.RecordBatch], column: int, rows: int = 1 << 14) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches cut by the length of their vectors, with these as a matrix."""
    for batch in batches:
        sizes = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            mine = batch.filter(pa.array(sizes == size)) if (sizes != size).any() else batch
            for at in range(0, mine.num_rows, rows):
                part = mine.slice(at, rows)
                yield part, _matrix(part.column(column), int(size))


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and sums of products of the columns of ``x``, as Python integers."""
    low = x.min(axis=0)
    shifted = (x.view(np.uint64) - low.view(np.uint64)).astype(np.uint64)  # the differences fit, modulo 2**64
    bits = [int(m).bit_length() for m in shifted.max(axis=0)]
    owner = np.repeat(np.arange(len(bits)), bits)
    place = np.concatenate([np.arange(b) for b in bits] or [[]]).astype(np.int64)
    planes = np.zeros((len(owner), -(-len(x) // 64) * 64), np.uint8)
    for i, (d, b) in enumerate(zip(owner, place)):
        planes[i, :len(x)] = (shifted[:, d] >> np.uint64(b)) & np.uint64(1)
    words = np.packbits(planes, axis=1).view(np.uint64)
    both = np.zeros((len(owner), len(owner)), np.int64)
    for i in range(len(owner)):
        both[i, i:] = both[i:, i] = np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64)
    weights = np.zeros((len(owner), len(bits)), object)
    weights[np.arange(len(owner)), owner] = [1 << int(b) for b in place]
    if 2 * max(bits, default=0) + len(x).bit_length() < 62:  # else Python's integers
        weights = weights.astype(np.int64)
    products = (weights.T @ both @ weights).astype(object)
    sums = (np.diag(both) @ weights).astype(object)
    shift = low.astype(object)
    n = len(x)
    return sums + n * shift, products + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)


def _parts(values: list[int]) -> list[list[int]]:
    """Each value as its low parts and the signed rest: they sum up part by part."""
    out = [[(v >> (PART_BITS * p)) & ((1 << PART_BITS) - 1) for v in values] for p in range(PARTS - 1)]
    return [*out, [v >> (PART_BITS * (PARTS - 1)) for v in values]]


class Model(NamedTuple):
    n: int
    sums: np.ndarray  # Python integers
    components: np.ndarray  # a row each
    values: np.ndarray
    trace: float


def fit(whole: DataFrame) -> dict[int, Model]:
    """A model for each length of the vectors ``x``, which are distinct.

    A model takes the square of its length on the driver, whatever the number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for _, x in _by_size(batches, 0):
            n, sums, products = held.get(x.shape[1], (0, 0, 0))
            held[x.shape[1]] = n + len(x), *(a + b for a, b in zip((sums, products), scatter(x)))
        for size, (n, sums, products) in held.items():
            i, j = np.triu_indices(size)
            first, second = np.concatenate([[-1], np.full(size, -1), i]), np.concatenate([[-1], np.arange(size), j])
            parts = _parts([n, *sums, *products[i, j]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), size)), pa.array(first), pa.array(second), *(pa.array(p, pa.int64()) for p in parts)],
                                             names=["size", "i", "j", *(f"p{k}" for k in range(PARTS))])

    sums = [f"p{k}" for k in range(PARTS)]
    rows = map_arrow(whole, run, "size long, i long, j long, " + ", ".join(f"{s} long" for s in sums))
    found = rows.groupBy("size", "i", "j").agg(*(F.sum(s).alias(s) for s in sums)).collect()  # the square of the length
    entries = {(r.size, r.i, r.j): sum(r[s] << (PART_BITS * k) for k, s in enumerate(sums)) for r in found}
    return {size: model_of(size, entries) for size in {key[0] for key in entries}}


def model_of(size: int, entries: dict[tuple[int, int, int], int]) -> Model:
    n = entries[size, -1, -1]
    sums = np.array([entries[size, -1, j] for j in range(size)], object)
    centred = np.array([[n * entries[size, min(i, j), max(i, j)] - sums[i] * sums[j] for j in range(size)] for i in range(size)], object)
    covariance = np.array([[v / (n * n) for v in row] for row in centred.tolist()])  # one rounding an entry
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1].T
    sign = np.sign(vectors[np.arange(size), np.abs(vectors).argmax(axis=1)])
    return Model(n, sums, vectors * sign[:, None], values, sum(centred[i, i] for i in range(size)) / (n * n))


def whitened_of(x: np.ndarray, model: Model, count: int, flat: float) -> np.ndarray:
    """The rows on the first components, each over its deviation; nan on a component without any."""
    centred = deviations(x, model).astype(np.float64) / model.n
    values = model.values[:count]
    spread = np.where(values > flat * max(model.trace, 0.0), np.sqrt(np.maximum(values, 0)), np.nan)
    return centred @ (model.components[:count] / spread[:, None]).T


def deviations(x: np.ndarray, model: Model) -> np.ndarray:
    """n * x - S, exact: longs where they and the sums of their squares fit, else Python integers."""
    most = model.n * max(abs(int(x.min(initial=0))), int(x.max(initial=0))) + max(map(abs, model.sums.tolist()), default=0)
    if most * most * max(x.shape[1], 1) < 1 << 63:
        return model.n * x - model.sums.astype(np.int64)
    return model.n * x.astype(object) - model.sums


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: float = 256.0, flat: float = 1e-13) -> DataFrame:
    """``<id_col>, component, n, deviation, whitened, explained, identity_error, deviation_text``,
    ``components`` rows (at most the vector's length) for each input row.

    Vectors become x = floor(scale * entry), held within the range of a long.
    The mean, the covariance V (divisor n) and its unit eigenvectors are those
    of the n distinct x.  ``deviation`` is the sum of (n x - S)^2 over the
    dimensions, null beyond a long; ``deviation_text`` has its digits at any
    size.  ``whitened`` is x less the mean on the component, over the root of
    its eigenvalue, null where that is nothing (``flat`` of the trace or less).
    ``explained`` is the eigenvalue's share of the trace, null where that is 0.
    ``identity_error`` is how far the covariance of the whitened distinct
    vectors, summed from the rows, is from the identity at most.

    Rows whose vector is null, or has null or not finite entries, are left out,
    and so are empty vectors, which have no component.  Repeated vectors and
    ids count once in the fit and give a row each.  Vectors of another length
    have a model of their own.  No rows give no rows.
    """
    rows = df.select(df[id_col].alias("id"), whole_entries(df[vector_col], scale).alias("x")).where((F.col("x").isNotNull()) & (F.size("x") > 0))
    kind = rows.schema["id"].dataType.simpleString()
    rows = materialise(rows, "whole-vectors")
    distinct = materialise(rows.select("x").distinct(), "distinct-vectors")
    models = fit(distinct)
    shared = df.sparkSession.sparkContext.broadcast(models)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, x in _by_size(batches, 0):
            z = whitened_of(x, shared.value[x.shape[1]], components, flat)
            z = np.concatenate([np.ones((len(z), 1)), z], axis=1)
            held[x.shape[1]] = held.get(x.shape[1], 0) + z.T @ z
        for size, sums in held.items():
            i, j = np.triu_indices(len(sums))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), size)), pa.array(i), pa.array(j), pa.array(sums[i, j])], names=["size", "i", "j", "v"])

    found = map_arrow(distinct, products, "size long, i long, j long, v double").groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect()  # 15 a length
    errors: dict[int, float | None] = {}
    for size in models:
        width = min(components, size) + 1
        sums = np.zeros((width, width))
        for r in found:
            if r.size == size:
                sums[r.i, r.j] = sums[r.j, r.i] = r.v
        mean = sums[0, 1:] / models[size].n
        off = np.abs(sums[1:, 1:] / models[size].n - np.outer(mean, mean) - np.eye(width - 1))
        off = off[~np.isnan(off)]
        errors[size] = float(off.max()) if len(off) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _by_size(batches, 1, 1 << 12):
            model = shared.value[x.shape[1]]
            count = min(components, x.shape[1])
            exact = [sum(v * v for v in row) for row in d.tolist()] if (d := deviations(x, model)).dtype == object else (d * d).sum(axis=1).tolist()
            z = whitened_of(x, model, count, flat).reshape(-1)
            share = model.values[:count] / model.trace if model.trace else np.full(count, np.nan)
            at = np.repeat(np.arange(len(x)), count)
            known = lambda v: pa.array(v, pa.float64(), mask=np.isnan(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(at), model.n)),
                 pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()).take(pa.array(at)), known(z), known(np.tile(share, len(x))),
                 pa.array([errors[x.shape[1]]] * len(at), pa.float64()), pa.array(list(map(str, exact)), pa.string()).take(pa.array(at))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"])

    out = map_arrow(rows, run, f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_text string")
    return out.withColumnRenamed("id", id_col)
