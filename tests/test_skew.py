"""One key holding a third of all rows: results equal a brute-force computation, and the
plans combine the hot key map-side before it is shuffled."""

import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators import kpis, quality
from strata.operators.cleaning import keep_first, total_order


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 400)        # key 0 holds a third of the rows
        rows.append((key, rnd.randint(1, 50), round(rnd.uniform(0, 500), 2), f"r{rnd.randint(0, 9)}"))
    return rows


def test_keep_first_with_hot_key(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "k int, qty int, sales double, tag string").repartition(6)
    got = keep_first(df, ["k"], total_order([F.col("sales").desc_nulls_last()], ["qty", "tag"]))
    assert "WindowGroupLimit" in _plan(got)
    best = {}
    for k, qty, sales, tag in rows:
        cand = (-sales, qty, tag)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, qty, sales, tag))
    assert sorted(tuple(r) for r in got.collect()) == sorted(v[1] for v in best.values())


def test_per_key_partials_with_hot_key(spark):
    rows = _skewed_rows()
    fact = spark.createDataFrame(rows, "product_sk int, qty int, sales double, tag string").repartition(6)
    dim = spark.createDataFrame([(k, f"p{k % 7}", "c") for k in range(0, 401)],
                                "product_sk int, product_name string, product_class string")
    got = {r.product_name: r for r in kpis.top_products(fact, dim, n=1000).collect()}
    # the per-key aggregate is partial (map-side) before its exchange
    plan = _plan(kpis.per_key(fact, "product_sk"))
    assert "partial_sum" in plan and "partial_count" in plan
    exp = defaultdict(lambda: [0, 0, Decimal("0")])
    for k, qty, sales, _ in rows:
        e = exp[f"p{k % 7}"]
        e[0] += 1
        e[1] += qty
        e[2] += Decimal(str(sales))
    assert set(got) == set(exp)
    for name, (n, units, total) in exp.items():
        r = got[name]
        assert (r.num_transacciones, r.unidades_vendidas) == (n, units)
        assert r.ventas_totales == float(total.quantize(Decimal("0.01")))


def test_relationships_with_hot_orphan_key(spark):
    child_rows = [(999,)] * 1000 + [(i,) for i in range(1, 1001)] + [(None,)] * 7
    child = spark.createDataFrame(child_rows, "fk int").repartition(5)
    parent = spark.createDataFrame([(i,) for i in range(1, 901)], "pk int")
    r = quality.relationship_failures(child, "c", "fk", parent, "p", "pk").collect()[0]
    # 1000 rows of the unmatched hot key 999 plus keys 901..1000
    assert (r.orphans, r.null_keys) == (1000 + 100, 7)
