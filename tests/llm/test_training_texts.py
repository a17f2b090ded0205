"""All trusted texts train, whether their ids are broadcast or not."""

import random

from strata.llm import ngram_quality


def test_every_trusted_text_trains_whatever_the_bound(spark):
    pick = random.Random(9)
    rows = [(i, " ".join(pick.choice("red green blue stone river".split()) for _ in range(20)), "a") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    found = [{r.doc_id: r.perplexity for r in ngram_quality.classify(df, labels, max_trusted=most, high=0.95, least=1).collect()} for most in (1000, 10)]
    assert found[0].keys() == found[1].keys()
    assert all(abs(p - found[1][i]) < 1e-6 for i, p in found[0].items())
