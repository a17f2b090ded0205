"""Near duplicates and repeated strings against brute force."""

import random

import numpy as np
import pytest

from strata.llm import near_dedup, queries, suffix_dedup

from brute import brute_classes


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    estimates, truth = [], []
    for _ in range(80):
        e = rng.integers(0, 1 << 62, 50).astype(np.uint64)
        a = rng.integers(0, 12, 50)
        b = np.where(rng.random(50) < 0.6, a, rng.integers(0, 12, 50))
        x, y = np.flatnonzero(a), np.flatnonzero(b)
        s = near_dedup.bag_minhash(np.concatenate([e[x], e[y]]), np.concatenate([a[x], b[y]]), np.repeat([0, 1], [len(x), len(y)]), 2)
        estimates.append((s[0] == s[1]).mean())
        truth.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(estimates) - np.mean(truth)) < 0.02
    assert np.sqrt(np.mean((np.array(estimates) - truth) ** 2)) < 0.07


def test_signatures_of_empty_small_and_heavy_bags():
    s = near_dedup.bag_minhash(np.arange(3, dtype=np.uint64), np.array([1, 1_000_000, 1]), np.array([0, 1, 3]), 5)
    assert np.isinf(s).any(axis=1).tolist() == [False, False, True, False, True]


def test_overlap_counts_multisets():
    a, b = (np.array([1, 2, 3]), np.array([2, 1, 1])), (np.array([2, 3, 9]), np.array([3, 1, 1]))
    assert near_dedup.overlap(a, b) == pytest.approx(2 / (4 + 5 - 2))


def _smallest(links):
    """Each node's smallest connected node."""
    at = {n: n for pair in links for n in pair}
    while any(at[a] != at[b] for a, b in links):
        for a, b in links:
            at[a] = at[b] = min(at[a], at[b])
    return {n: m for n, m in at.items() if n != m}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_merge_into_known_classes(spark, seed):
    pick = random.Random(seed)
    batches = [[(pick.randrange(60), pick.randrange(60)) for _ in range(n)] for n in (25, 0, 1, 12)]
    labels, links = None, []
    for batch in batches:
        links += batch
        labels = near_dedup.merge_links(labels, spark.createDataFrame(batch, "a long, b long"))
        rows = labels.collect()
        assert {r.node: r.label for r in rows} == _smallest(links) and len(rows) == len({r.node for r in rows})


def test_links_of_a_hub_take_no_rounds(spark, monkeypatch):
    written, write = [], near_dedup.materialise
    monkeypatch.setattr(near_dedup, "materialise", lambda df, name: (written.append(name), write(df, name))[1])
    labels = near_dedup.components(spark.range(1, 50).selectExpr("0L as a", "id as b"))
    assert written == ["edges"] and labels.where("label = 0").count() == 49


def test_classes_of_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in queries.QUERIES["op2_minhash_near_dedup"](spark, sf_dir).collect()}
    assert got == brute_classes(rows)


def test_hot_groups_and_edge_rows(spark):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [pick.choice(words) for _ in range(120)]
    rows = [(10, " ".join(base))]
    rows += [(100 + i, "  ".join(base).upper()) for i in range(80)]  # exact copies but for case and space
    for i in range(40):  # near copies: a word or two changed
        copy = list(base)
        for _ in range(pick.randint(1, 2)):
            copy[pick.randrange(120)] = f"new{pick.randrange(1000)}"
        rows.append((300 + i, " ".join(copy)))
    rows += [(500 + i, " ".join(pick.choice(words) for _ in range(60))) for i in range(20)]
    rows += [(600, "one two"), (601, "One two"), (602, "one three"), (603, ""), (604, None), (605, "  \n")]
    df = spark.createDataFrame(rows + [(600, "one two"), (None, "one two")], "doc_id long, text string")
    got = near_dedup.near_classes(df.selectExpr("*", "text as class_id", "1 as node")).collect()
    classes = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert classes == brute_classes(rows)
    assert len(got) == len(rows) + 2 and [r.class_id for r in got if r.doc_id is None] == [None]
    assert {classes[i] for i in (603, 604, 605)} == {603, 604, 605} and classes[601] == 600 and classes[602] == 602
    assert near_dedup.near_classes(df.limit(0)).count() == 0


def test_near_copies_that_share_a_template(spark):
    """Many separate pairs in the same buckets: more classes there than a few hubs can tell apart."""
    template, rows = [f"t{i}" for i in range(200)], []
    for i in range(100):  # 0.82 within a pair, 0.77 between pairs
        own = [f"d{i}w{j}" for j in range(30)]
        rows += [(2 * i, " ".join(template + own)), (2 * i + 1, " ".join(template + own[:8] + [f"n{i}w{j}" for j in range(22)]))]
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({c for c in brute_classes(rows).values()}) == 100
    assert {r.doc_id: r.class_id for r in got} == brute_classes(rows)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(101, 100), (100, 102), (7, 7)]
    got = dict(map(tuple, near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 1 for i in range(2, 61)) and got[101] == got[102] == 100


def brute_repeats(rows, length):
    """n_bytes, n_removed, n_spans, kept of each row, by a table of all strings."""
    first, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone, new = np.zeros(len(data), bool), {}
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in new or (s in first and (first[s] is not None and first[s] != doc)):
                gone[i:i + length] = True
            new.setdefault(s, doc)
        for s in new:
            first.setdefault(s, doc)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), runs, bytes(np.frombuffer(data, np.uint8)[~gone])))
    return sorted(out, key=str)


def planted(seed):
    pick = random.Random(seed)
    base = "".join(pick.choice("abcdefgh ") for _ in range(2000))
    rows = [(i, "".join(pick.choice("ab") for _ in range(pick.randint(0, 300)))) for i in range(60)]
    for i in range(40):
        at, n = pick.randint(0, 1500), pick.randint(90, 400)
        edge = lambda: "".join(pick.choice("xyzé") for _ in range(pick.randint(0, 120)))
        rows.append((1000 + i, edge() + base[at:at + n] + edge() + base[at + 3:at + 3 + n // 2]))
    return rows + [(3000, "a" * 700), (3001, "ab" * 200), (3002, "é" * 150), (3003, ""), (3004, None), (3005, "a" * 99), (3006, "b" * 100), (3007, "b" * 100)]


@pytest.mark.parametrize("length,group_bytes,bits", [(100, 1 << 18, 26), (100, 1 << 18, 17), (40, 1500, 18)])
def test_repeats_equal_brute_force(spark, length, group_bytes, bits):
    rows = planted(length) + [(3006, "b" * 100), (None, "b" * 120), (None, "q" * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as doc").repartition(3)
    got = suffix_dedup.remove_repeats(df, length=length, group_bytes=group_bytes, filter_bits=bits).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute_repeats(rows, length)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_repeats_of_documents(spark, sf_dir):
    import hashlib
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {d: (n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in brute_repeats(rows, 100)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op7_suffix_dedup"](spark, sf_dir).collect()}
    assert got == want


def test_phrases_hold_every_string_once():
    pick = random.Random(4)
    texts = [bytes(pick.choice(b"abc") for _ in range(n)) for n in (100, 101, 500, 1500)]
    p = suffix_dedup.parse(texts, 100)
    for i, text in enumerate(texts):
        starts = [s for o, a, b in zip(p.owner, p.first, p.last) if o == i for s in range(a, b + 1)]
        assert starts == list(range(len(text) - 99))
