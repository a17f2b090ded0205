"""Toxicity: held-out accuracy, features and edge rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"  # labels of each language


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("toxic") / "scored")
    QUERIES["op11_toxicity"](spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").join(docs, "doc_id").select("toxic", "predicted", "score", "quality").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    # a tenth of the toxic labels lies on junk texts without a word of abuse
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_rows_and_folds(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and scored.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.select("doc_id", "held_out").collect())


def test_scores_come_from_the_text(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert scored.join(docs, "doc_id").groupBy("text").agg(F.countDistinct("score").alias("n")).where("n > 1").count() == 0


def test_spellings():
    for token, word, obfuscated, stretched in [("Idiot!", "idiot", False, False), ("1d10t", "idiot", True, False), ("m.o.r.o.n,", "moron", True, False),
                                               ("stuuuupid", "stupid", False, True), ("2024", "2024", False, False), ("...", "", False, False)]:
        assert toxicity.spelled(token) == (word, obfuscated, stretched)
    lexicon = toxicity.Lexicon({"grumpf": 2.0, "blar~": 3.0})
    found = dict(zip(toxicity.FEATURES, toxicity.features_of("YOU are a grumpf, a BLARGH and an 1diot!! " + "word " * 12 + "moron", lexicon)))
    assert found["strongest"] == 3.0 and round(found["hit_share"] * 21) == 4 and round(found["near_share"] * 4) == 2
    assert found["mark_runs"] > 0 and found["obfuscated_hits"] > 0 and found["shouted"] > 0
    assert toxicity.features_of("", lexicon) == toxicity.features_of(" \n", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_edge_rows(spark):
    pick = random.Random(2)
    words = ["house", "river", "green", "walk", "light", "paper"]
    texts = [" ".join(pick.choice(words) for _ in range(30)) for _ in range(300)]
    rows = [(i, t + (" you zorgling" if i % 4 == 0 else "")) for i, t in enumerate(texts)]
    labels = [(i, int(i % 4 == 0)) for i in range(280)] + [(5, None), (6, 7), (None, 1)]
    rows += [(400, None), (401, ""), (402, "zorgling you " * 60_000), (None, "you zorgling"), (0, rows[0][1]), (0, "another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as toxic", "3 as score", "4 as weight").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'x' as text")
    got = toxicity.score_toxicity(docs, known).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[402].predicted == 1 and by_id[400].score == by_id[401].score and by_id[400].predicted == 0 and by_id[None].held_out
    assert sum(r.predicted for r in got if r.doc_id in range(280, 300)) == 5
    assert toxicity.score_toxicity(docs.limit(0), known).count() == 0
    none = toxicity.score_toxicity(docs, known.limit(0)).collect()
    assert len(none) == len(rows) and {r.score for r in none} == {0.0}
    one_kind = toxicity.score_toxicity(docs, known.where("toxic = 1")).collect()
    assert {r.score for r in one_kind} == {1.0}
