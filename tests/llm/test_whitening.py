"""Whitening against exact integers and numpy."""

import math
from collections import defaultdict

import numpy as np

from strata.llm import whitening
from strata.llm.queries import QUERIES


def check_whitened(got, rows, count=4):
    """All rows of ``got`` against (id, vector) pairs: integers exact, projections up to a sign for each component."""
    whole = [(i, tuple(min(max(math.floor(256 * c), -(1 << 63)), (1 << 63) - 1) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    vectors, signs = defaultdict(list), {}
    for i, x in whole:
        vectors[i].append(x)
    models = {}
    for size in {len(x) for _, x in whole}:
        distinct = sorted({x for _, x in whole if len(x) == size})
        n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
        a = np.array(distinct, object)
        scatter = n * (a.T @ a) - np.outer(np.array(sums, object), np.array(sums, object))
        covariance = np.array([[v / (n * n) for v in r] for r in scatter.tolist()])
        values, parts = np.linalg.eigh(covariance)
        models[size] = n, sums, np.trace(covariance), values[::-1], parts[:, ::-1]
    assert len(got) == sum(min(count, len(x)) for _, x in whole)
    for r in got:
        options = []
        for x in vectors[r.vec_id]:
            n, sums, trace, values, parts = models[len(x)]
            k = r.component - 1
            if k >= len(x) or r.n != n:
                continue
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            if int(r.deviation_text) != deviation:
                continue
            assert r.deviation == (deviation if deviation < 1 << 63 else None)
            if trace == 0 or values[k] <= 1e-12 * trace:
                options.append(True)
                continue
            z = float(np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ parts[:, k] / math.sqrt(values[k]))
            assert r.explained == np.float64(r.explained) and abs(r.explained - values[k] / trace) <= 1e-9 and r.identity_error < 1e-6
            if abs(z) > 1e-6:
                sign = signs.setdefault((len(x), k), math.copysign(1, z * r.whitened))
                options.append(abs(r.whitened - sign * z) < 1e-6)
            else:
                options.append(abs(r.whitened) < 1e-5)
        assert any(options), r


def test_query(spark, sf_dir):
    got = QUERIES["op13_embedding_whitening"](spark, sf_dir)
    assert got.dtypes[:7] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check_whitened(got.collect(), [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()])


def test_edge_rows(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(v) for v in pick.normal(size=3)]) for i in range(40)] + [(i, [1.0, 2.0, 3.0]) for i in range(60, 90)]  # a vector that many rows share
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 3), (103, [float("inf"), 1.0, 1.0]), (104, []), (None, [0.5] * 3), (7, [0.1, 0.2, 0.3]),
             (105, [2.0, 1.0]), (106, [2.0, 1.0]), (107, [-0.0, 0.0, 0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as x", "3 as id").repartition(4)
    got = whitening.whiten(df).collect()
    check_whitened(got, rows)
    flat = [r for r in got if r.vec_id in (105, 106)]  # a single distinct vector of its length: no spread
    assert len(flat) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in flat)
    assert whitening.whiten(df.limit(0)).count() == 0


def test_entries_of_any_size(spark):
    pick = np.random.default_rng(4)
    rows = [(i, [float(v) * 1e15 for v in pick.normal(size=5)]) for i in range(30)] + [(50, [1e300] * 5), (51, [-1e300] * 5)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitened(got, rows)
    assert any(r.deviation is None and int(r.deviation_text) >= 1 << 63 for r in got)


def test_bit_planes_give_the_exact_scatter():
    pick = np.random.default_rng(5)
    for low, high, n in [(-300, 300, 1000), (0, 1, 65), (-(1 << 62), 1 << 62, 70), (5, 6, 1)]:
        x = pick.integers(low, high, (n, 4))
        x[:, 1] = low
        sums, products = whitening.scatter(x)
        exact = x.astype(object)
        assert (sums == exact.sum(axis=0)).all() and (products == exact.T @ exact).all()
    values = [0, 1, -1, (1 << 130) + 7, -(1 << 130) - 7]
    parts = whitening._parts(values)
    assert [sum(p[i] << (whitening.PART_BITS * k) for k, p in enumerate(parts)) for i in range(len(values))] == values
