"""Phrase mining against counts of all word sequences, and the SQL of the query."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import phrases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_collocations(rows, least, top, longest=5, covered_percent=100):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        found = {p: a for p, a in found.items() if a >= least}
        longer = {}
        for p, a in found.items():
            for n in range(2, len(p)):
                for s in range(len(p) - n + 1):
                    longer[p[s:s + n]] = max(longer.get(p[s:s + n], 0), a)
        scored = []
        for p, a in found.items():
            if len(p) > 1 and 100 * longer.get(p, 0) < covered_percent * a:
                score, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def some_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return docs, [tuple(r) for r in docs.collect()]


@pytest.mark.parametrize("bits", [64, 13, 4])  # with few bits nearly all fingerprints are shared by different texts
def test_counts_are_exact_whatever_collides(spark, some_rows, bits):
    docs, rows = some_rows
    got = phrases.collocations(docs, least=5, top=60, bits=bits, filter_bits=20, group_bytes=50_000)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 5, 60)


def test_edge_rows(spark):
    text = "Alpha  BETA\tgamma, alpha beta gamma. Straße É straße é alpha beta\n\x0balpha beta"
    rows = [("en", text)] * 4 + [(None, text), ("und", "alpha beta gamma"), ("en", None), ("en", ""), ("fr", " \t\n.,"), ("de", "ab ab ab ab"), ("de", "ab " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, phrase int, key string").repartition(3)
    for covered in (100, 50):
        got = phrases.collocations(df, least=2, top=9, covered_percent=covered, filter_bits=20)
        assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 2, 9, covered_percent=covered)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string")] + [(c, "bigint") for c in ("a", "l", "r", "n", "score")]
    assert phrases.collocations(df.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    big = 1 << 56
    df = spark.createDataFrame([(big, big * 7, big * 3, big + 1)], "a long, n long, l long, r long")
    wide = lambda c: phrases.F.col(c).cast("decimal(19,0)")
    assert df.select(phrases._floor_ratio(phrases.F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("l"), wide("n") * wide("r"))).first()[0] == 1000 * big * big * 3 // (big * 7 * (big + 1))


def test_words_of_a_batch():
    texts = ["A bC.d", "", "e\tf", "é ,"]
    data = [t.encode() for t in texts]
    w = phrases.split_words(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    assert w.stream.tobytes().decode() == "a bc d e f é "
    assert w.doc.tolist() == [0, 0, 0, 2, 2, 3] and w.place.tolist() == [0, 2, 5, 0, 2, 0]
    assert len(set(w.piece.tolist())) == 4 and w.piece[0] == w.piece[1] and w.piece[3] == w.piece[4]


def test_query_equals_its_sql(spark):
    from strata.llm.queries import ORACLES, QUERIES
    from strata.plans.compare import duckdb_connection
    sf_dir = "/root/testdata/sf0.01"
    want = duckdb_connection(sf_dir, ("documents",)).execute(ORACLES["op12_phrase_mining"]).fetchall()
    got = QUERIES["op12_phrase_mining"](spark, sf_dir).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want) and got
