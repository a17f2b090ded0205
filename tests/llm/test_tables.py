"""Top-k search, source mixing, the pipeline and the entry point."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing, queries, topk_search
from strata.llm.common import materialise

from brute import brute_classes


def brute_search(rows, every=50, k=5):
    usable = [(i, np.floor(256 * np.array(v, float)).astype(object)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        a = min((tuple(v) for i, v in usable if i == q))
        scored = sorted((-int(sum(x * y for x, y in zip(a, b))), i) for i, b in usable if i != q and len(b) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_of_embeddings(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = queries.QUERIES["op6_topk_search"](spark, sf_dir)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute_search(rows)


@pytest.mark.parametrize("query_block,block_rows", [(2, 3), (100, 7)])
def test_search_edge_rows(spark, query_block, block_rows):
    pick = random.Random(9)
    rows = [(i, [pick.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 260)]  # ties
    rows += [(300, None), (350, [1.0, None, 0.0, 0.0]), (400, [float("nan"), 0.0, 0.0, 0.0]), (450, [float("inf"), 0.0, 0.0, 0.0]), (500, []),
             (None, [1.0] * 4), (550, [1.0, 2.0]), (551, [3.0, 4.0]), (7, [0.5] * 4), (50, [1.0, 0.0, 0.0, 0.0]), (600, [3e5, 1e6, -2e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank").repartition(4)
    got = topk_search.top_k(df, query_block=query_block, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute_search(rows)
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_blocks_are_pruned(monkeypatch):
    scored = []
    real = topk_search._score
    monkeypatch.setattr(topk_search, "_score", lambda q, d: scored.append(len(d)) or real(q, d))
    vectors = np.zeros((100, 3), np.int64)
    vectors[40:50] = 100
    best = topk_search.search_blocks(np.array([-1]), np.array([[1, 2, 3]]), np.arange(100), vectors, 5, 10)
    assert scored == [10]
    topk_search.search_blocks(np.array([-1]), np.array([[1, 2, 3]]), np.arange(100, 200), vectors // 2, 5, 10, best)  # a later batch of the task
    assert scored == [10] and best.ids.tolist() == [[40, 41, 42, 43, 44]]


def check_schedule(rows, period, block_rows, shares):
    """Whole and in its windows; within less than a block of the target until a source runs out."""
    blocks = {(r.source, r.block): r for r in rows}
    assert len({r.slot for r in blocks.values()}) == len(blocks)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    sizes = Counter(r.source for r in rows)
    for source, n in sizes.items():
        assert sorted(r.block * block_rows + r.in_block for r in rows if r.source == source) == list(range(n))
    at = {r.slot: r.source for r in blocks.values()}
    had = Counter()
    for slot in range(min(max(r.slot for r in rows if r.source == s) for s in sizes) + 1):
        had[at[slot]] += 1
        assert all(abs(had[s] - shares[s] * (slot + 1) / period) < 1 for s in sizes)


def test_mix_of_documents(spark, sf_dir):
    rows = queries.QUERIES["op9_source_mixing"](spark, sf_dir).collect()
    shares = {r.source: r.share for r in rows}
    assert sum(shares.values()) == 1024
    check_schedule(rows, 1024, 64, shares)


def test_mix_to_given_weights_with_hot_and_null_sources(spark):
    rows = [(i, "hot") for i in range(900)] + [(1000 + i, None) for i in range(300)] + [(2000 + i, f"s{i % 7}") for i in range(210)] + [(5, "hot")] * 3 + [(None, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, source string").selectExpr("*", "1 as slot", "2 as `key`", "'x' as share", "3 as fine")
    got = mixing.mix(df, weights={"hot": 0.5, None: 0.2, "s1": 0.1}, block_rows=8, period=100)
    assert got.select("row.*").columns == df.columns
    got = got.select("row.doc_id", "source", "block", "in_block", "share", "release", "deadline", "slot").collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    shares = {r.source: r.share for r in got}
    assert sum(shares.values()) == 100 and shares["hot"] > shares[None] > shares["s1"] > shares["s2"] >= 1
    check_schedule(got, 100, 8, shares)
    again = mixing.mix(df.repartition(5), weights={"hot": 0.5, None: 0.2, "s1": 0.1}, block_rows=8, period=100)
    key = lambda r: (r.source or "", r.doc_id or -1, r.slot)
    assert sorted(map(key, again.selectExpr("row.doc_id", "source", "slot").collect())) == sorted(map(key, got))
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, duck, sf_dir, name):
    from strata.plans.compare import compare
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    same, message = compare(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])
    assert same, message


def test_native_queries_use_no_python(spark, sf_dir):
    for name in ("op3_secret_scans", "op9_source_mixing"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stage_by_stage(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        kept.append(docs)
        assert name == "byte_bpe" or docs.columns == columns
    quality, near, redacted, mixed, encoded = ({r.doc_id: r for r in d.collect()} for d in kept)
    verdicts = {r.doc_id: r.kept for r in queries.QUERIES["op5_ngram_quality"](spark, sf_dir).collect()}
    assert quality == {i: r for i, r in rows.items() if verdicts[i]}
    classes = brute_classes([(i, r.text) for i, r in quality.items()])
    assert near == {i: r for i, r in quality.items() if classes[i] == i}
    assert set(redacted) == set(near) and any("[REDACTED]" in r.text for r in redacted.values())
    assert all(r.n_chars == len(r.text) for r in redacted.values())
    assert all(r == near[i] for i, r in redacted.items() if "[REDACTED]" not in r.text)
    assert mixed == redacted and set(encoded) == set(mixed)
    import hashlib
    assert all(r.decoded_sha256 == hashlib.sha256(mixed[i].text.encode()).hexdigest() for i, r in encoded.items())
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert whole == {i: r.ids_sha256 for i, r in encoded.items()}


def test_pipeline_edge_rows(spark, sf_dir):
    rows = [(1, None, None, None, None, "x"), (1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (None, "hello there my friend of old", "en", "a", 5, "y"),
            (4, "hello there my friend of old", "en", None, 5, "y"), (4, "hello there my friend of old", "en", None, 5, "y"), (5, "hello  there my friend of OLD", "xx", "a", 5, "y"),
            (6, "my token = abcdefgh", "en", "a", None, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    for docs, ids in ((spark.createDataFrame(rows, schema), [None, 1, 2, 4, 6]), (spark.createDataFrame([], schema), [])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf_dir), name)
            assert name == "byte_bpe" or docs.columns == columns
        assert sorted((r.doc_id for r in docs.collect()), key=lambda x: x or 0) == ids


def test_entry_has_every_query():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
