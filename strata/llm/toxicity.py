"""Toxicity: boosted trees over dense features of a text, with calibrated scores.

The features are densities of lexicon words, how near they stand to words that
address the reader, capitals, punctuation and obfuscated spellings.  Beside a
fixed lexicon of insults, one is learned: words and word beginnings that occur
in more of the toxic training texts than chance allows.  Training texts get
their features from a lexicon learned without their own fold, copies of a text
share a fold and count once, so the trees see what they will see in new texts.
The trees and the isotonic calibration are MLlib's.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, by_rows, map_arrow, materialise
from strata.llm.near_dedup import _Words, shingles, word_hashes

#: fixed values: insults of four languages
INSULTS = frozenset("""
    idiot idiots moron morons stupid dumb dumbass fool loser losers trash garbage scum worthless pathetic disgusting clown jerk creep liar
    vermin filth imbecile cretin dimwit halfwit scumbag lowlife bastard asshole
    idiotin trottel dummkopf blödmann vollidiot schwachkopf arschloch depp versager abschaum drecksau widerlich erbärmlich wertlos
    imbécile crétin abruti débile connard salaud ordure minable pathétique dégoûtant nul pourri
    estúpido estúpida imbécil tonto tonta inútil basura escoria asqueroso patético payaso cabrón gilipollas perdedor
""".split())
#: fixed values: words that address the reader, in four languages
SECOND_PERSON = frozenset("""
    you your yours yourself yourselves you're u ur du dich dir dein deine deinen deiner deinem euch euer eure
    tu te toi ton tes vous votre vos tú ti tus usted ustedes vosotros contigo
""".split())
#: characters that stand for letters in obfuscated words
LEET = str.maketrans("013457@$!|", "oieastasil")
NEAR = 6
FOLDS = 5
FEATURES = ("words", "insults", "insult_share", "hits", "hit_share", "distinct_hits", "strongest", "strength", "second_share", "near_second", "near_share",
            "capitals", "shouted", "exclaims", "questions", "mark_runs", "marks", "obfuscated", "obfuscated_hits", "stretched", "spaced_out")
_EDGES = re.compile(r"^[^\w@$]+|[^\w@$*]+$")
_INNER = re.compile(r"[*._\-'’]")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\S)")
_MARK_RUN = re.compile(r"[!?]{2,}")
_TRIPLE = re.compile(r"(.)\1\1")
_NOTHING = (0.0,) * 4


def units_of(word: str) -> list[str]:
    """What the learned lexicon knows of a word: itself and its beginnings of 4 to 6 letters."""
    n = len(word)
    if n < 5:
        return [word]
    if n == 5:
        return [word, word[:4] + "~"]
    return [word, word[:4] + "~", word[:5] + "~", word[:6] + "~"] if n > 6 else [word, word[:4] + "~", word[:5] + "~"]


def spelled(token: str) -> tuple[str, bool, bool]:
    """The word meant by a token, in lower case, and whether it was obfuscated or stretched."""
    plain = (token if token.isalpha() else _EDGES.sub("", token)).lower()
    word = plain
    if word and not word.isalpha() and any(c.isalpha() for c in word):
        word = _INNER.sub("", word.translate(LEET))
    meant = _STRETCHED.sub(r"\1", word) if len(word) > 2 and _TRIPLE.search(word) else word
    return meant, word != plain and word.isalpha(), meant != word


class Lexicon(dict):
    """What is known of each token: (strength in the learned lexicon, bits), kept between texts."""

    INSULT, SECOND, OBFUSCATED, STRETCHED, SHOUTED = 1, 2, 4, 8, 16

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> tuple[float, int, str] | None:
        if len(self) > 250_000:
            self.clear()
        word, obfuscated, stretched = spelled(token)
        shouted = token.isupper() and sum(map(str.isalpha, token)) > 2
        bits = (self.INSULT * (word in INSULTS) | self.SECOND * (word in SECOND_PERSON) | self.OBFUSCATED * obfuscated
                | self.STRETCHED * stretched | self.SHOUTED * shouted)
        weight = max(map(self.weights.get, units_of(word), _NOTHING)) if word else 0.0
        self[token] = known = (weight, bits, word) if bits or weight else None
        return known


def features_of(text: str, lexicon: Lexicon) -> list[float]:
    """FEATURES of a text; all 0 for one without words."""
    tokens = text.split()
    if not tokens:
        return [0.0] * len(FEATURES)
    known = [(i, *k) for i, k in enumerate(map(lexicon.__getitem__, tokens)) if k]
    n = len(tokens)
    hits = [(i, w, word) for i, w, bits, word in known if w > 0 or bits & lexicon.INSULT]
    second = [i for i, _, bits, _ in known if bits & lexicon.SECOND]
    count = lambda bit: sum(1 for _, _, bits, _ in known if bits & bit)
    near, at = 0, 0
    for i, _, _ in hits:
        while at < len(second) and second[at] < i - NEAR:
            at += 1
        near += at < len(second) and second[at] <= i + NEAR
    chars = max(len(text), 1)
    insults, log = count(lexicon.INSULT), math.log1p
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÑ"))
    marks = sum(map(text.count, ".,;:'\"()-"))
    return [log(n), log(insults), insults / n, log(len(hits)), len(hits) / n, log(len({w for _, _, w in hits})),
            max((w for _, w, _ in hits), default=0.0), log(sum(w for _, w, _ in hits)), len(second) / n, log(near), near / max(len(hits), 1),
            capitals / chars, count(lexicon.SHOUTED) / n, text.count("!") / n, text.count("?") / n, len(_MARK_RUN.findall(text)) / n, marks / chars,
            count(lexicon.OBFUSCATED) / n, log(sum(1 for _, w, bits, _ in known if bits & lexicon.OBFUSCATED and (w > 0 or bits & lexicon.INSULT))),
            count(lexicon.STRETCHED) / n, len(_SPACED.findall(text)) / n]


def fold_number(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5: rows of 0 are held out. A null id reads as the empty text, which is held out."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def training_sample(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """``toxic, weight, sketch, fold, text`` of labelled documents that aren't held out, about ``most`` / 2 of each label.

    Chosen by a hash of the id, weighted by how many each stands for.  Copies,
    near ones mostly, share their sketch and so their fold.  An id with several
    labels counts as toxic if one says so.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)")
    known = known.where(fold_number(F.col("id")) != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = materialise(known, "toxic-labels")
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    share = {t: min(1.0, most / 2 / n) for t, n in counts.items()}
    parts = 1 << 30
    chosen = known.withColumn("share", F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)))
    chosen = chosen.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(parts)) < F.col("share") * parts)
    rows = documents.select(documents[id_col].alias("id"), as_text(text_col).alias("text"))
    joined = rows.join(F.broadcast(chosen), "id").select("toxic", (1 / F.col("share")).alias("weight"), "text")  # about ``most`` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in by_rows(batches, 1024):
            sketch = [int(s.min()) if len(s := shingles(word_hashes(t, words))) else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.array(sketch, np.uint64).view(np.int64)), pa.array([s % FOLDS for s in sketch], pa.int32()), batch.column(2)],
                                             names=["toxic", "weight", "sketch", "fold", "text"])

    return materialise(map_arrow(joined, run, "toxic int, weight double, sketch long, fold int, text string"), "toxic-sample")


def unit_counts(sample: DataFrame) -> DataFrame:
    """``unit, t0..t4, c0..c4``: in how many toxic and clean texts of each fold each word or beginning occurs; copies count once.

    The unit null has the numbers of texts.
    """
    names = [f"{k}{f}" for k in "ct" for f in range(FOLDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meant: dict[str, list[str]] = {}
        counts: Counter[tuple[str | None, int]] = Counter()

        def rows() -> pa.RecordBatch:
            units, places = zip(*counts)
            return pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(places, pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["unit", "place", "n"])

        for batch in by_rows(batches, 256):
            for toxic, fold, text in zip(*(c.to_pylist() for c in batch.columns)):
                place = toxic * FOLDS + fold
                found: set[str] = set()
                for token in set(text.split()):
                    if token not in meant:
                        if len(meant) > 250_000:
                            meant.clear()
                        meant[token] = units_of(word) if (word := spelled(token)[0]) else []
                    found.update(meant[token])
                counts[None, place] += 1
                counts.update((u, place) for u in found)
            if len(counts) > 1_000_000:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    once = sample.dropDuplicates(["sketch", "toxic"]).select("toxic", "fold", "text")
    counted = map_arrow(once, run, "unit string, place int, n long").groupBy("unit")
    return counted.agg(*(F.sum(F.when(F.col("place") == i, F.col("n")).otherwise(0)).alias(name) for i, name in enumerate(names)))


def strengths(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How much oftener, at least, toxic texts hold each unit: the log ratio of the shares, less two standard errors.

    ``counts`` and ``totals`` are (clean, toxic) numbers of texts.
    """
    ratio = np.log((counts[:, 1] + 0.5) / (totals[1] + 1)) - np.log((counts[:, 0] + 0.5) / (totals[0] + 1))
    return ratio - 2 * np.sqrt(1 / (counts[:, 1] + 0.5) + 1 / (counts[:, 0] + 0.5))


def learn_lexicons(sample: DataFrame, size: int, least: int, bound: float) -> list[dict[str, float]]:
    """Units and their strengths: for each fold those learned from the others, last those of all.

    At most ``size`` units, the strongest of those in ``least`` toxic texts or
    more whose strength is above ``bound``; part of the fit on the bounded sample.
    """
    counts = materialise(unit_counts(sample), "toxic-units")
    sums = lambda kind: sum(F.col(f"{kind}{f}") for f in range(FOLDS))
    totals = counts.where("unit is null").toPandas()  # one row
    if not len(totals):
        return [{}] * (FOLDS + 1)
    all_texts = np.array([[totals[f"{k}{f}"][0] for k in "ct"] for f in range(FOLDS)], np.float64)
    known = all_texts.sum(axis=0)
    ratio = F.log((sums("t") + 0.5) / float(known[1] + 1)) - F.log((sums("c") + 0.5) / float(known[0] + 1))
    strong = counts.where(F.col("unit").isNotNull() & (sums("t") >= least)).withColumn("ratio", ratio - 2 * F.sqrt(1 / (sums("t") + 0.5) + 1 / (sums("c") + 0.5)))
    found = strong.where(F.col("ratio") > bound).orderBy(F.col("ratio").desc(), "unit").limit(size).toPandas()
    units = found["unit"].tolist()
    by_fold = np.stack([np.stack([found[f"{k}{f}"].to_numpy(np.float64) for k in "ct"], axis=1) for f in range(FOLDS)]) if units else np.zeros((FOLDS, 0, 2))
    out = []
    for fold in range(FOLDS + 1):
        rest = np.arange(FOLDS) != fold
        counts_of, totals_of = by_fold[rest].sum(axis=0), all_texts[rest].sum(axis=0)
        weight = strengths(counts_of, totals_of)
        keep = (weight > bound) & (counts_of[:, 1] >= least)
        out.append({u: float(w) for u, w, k in zip(units, weight, keep) if k})
    return out


class Classifier:
    """The learned lexicon, the trees and the calibration."""

    def __init__(self, sample: DataFrame, lexicon_size: int = 5000, least: int = 3, bound: float = 0.8, trees: int = 30, depth: int = 3) -> None:
        lexicons = learn_lexicons(sample, lexicon_size, least, bound)
        self.lexicon = lexicons[-1]
        shared = sample.sparkSession.sparkContext.broadcast(lexicons)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = [Lexicon(w) for w in shared.value]
            for batch in by_rows(batches, 1024):
                found = [features_of(text, known[fold]) for fold, text in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.list_(pa.float64()))], names=["toxic", "weight", "sketch", "fold", "values"])

        rows = materialise(map_arrow(sample, run, "toxic int, weight double, sketch long, fold int, values array<double>"), "toxic-features")
        stats = rows.groupBy("fold", "toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()  # ten rows
        total = sum(r.weight for r in stats)
        self.prior = sum(r.weight for r in stats if r.toxic == 1) / total if total else 0.0
        both = lambda folds: {r.toxic for r in stats if r.fold in folds} == {0, 1}
        self.trees = self.calibration = None
        held = FOLDS - 1
        calibrated = both({held}) and both(set(range(held)))
        if not calibrated and not both(set(range(FOLDS))):
            return
        # one order on any cluster, in partitions of some 16,000 rows: split candidates depend on it
        parts = 1 << max(0, math.ceil(math.log2(max(sum(r.n for r in stats), 1) / 16_384)))
        rows = rows.repartition(parts, "sketch").coalesce(parts).sortWithinPartitions("sketch", "toxic", "values")
        rows = rows.select("fold", "weight", F.col("toxic").cast("double").alias("label"), array_to_vector("values").alias("features"))
        learner = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=11, weightCol="weight")
        self.trees = learner.fit(rows.where(F.col("fold") != held) if calibrated else rows)
        if calibrated:
            raw = self.probability(rows.where(F.col("fold") == held)).select("label", "weight", "probability")
            self.calibration = IsotonicRegression(featuresCol="probability", labelCol="label", weightCol="weight", predictionCol="score").fit(raw)

    def probability(self, rows: DataFrame) -> DataFrame:
        scored = self.trees.transform(rows).withColumnRenamed("probability", "both")
        return scored.withColumn("probability", vector_to_array("both")[1]).drop("both", "rawPrediction", "prediction")

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``id, held_out, text``) with ``score``, without the text."""
        kind = rows.schema["id"].dataType.simpleString()
        if self.trees is None:
            return rows.select("id", "held_out", F.lit(self.prior).alias("score"))
        shared = rows.sparkSession.sparkContext.broadcast(self.lexicon)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon = Lexicon(shared.value)
            for batch in by_rows(batches, 1024):
                found = [features_of(t, lexicon) for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.float64()))], names=["id", "held_out", "values"])

        found = map_arrow(rows, run, f"id {kind}, held_out boolean, values array<double>")
        scored = self.probability(found.select("id", "held_out", array_to_vector("values").alias("features")))
        scored = self.calibration.transform(scored) if self.calibration else scored.withColumn("score", F.col("probability"))
        return scored.select("id", "held_out", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def score_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   max_labelled: int = 32_768, threshold: float = 0.5) -> DataFrame:
    """``<id_col>, held_out, score, predicted``, one row for each document.

    The model is fitted on labelled documents whose crc32(id as text) modulo 5
    isn't 0, a hash sample of about ``max_labelled`` at most, half of them of
    each label where there are as many; ``held_out`` marks the other ids.
    Scores come from the text alone, so equal texts have equal scores.
    Null and empty texts are scored as texts without words.  A null id is
    held out and never learned from.  Labels that are null or neither 0 nor 1
    count as none.  Where the labels hold one kind only, or there are none, every
    score is the share of toxic ones (0 without any).  Where the fold that
    calibrates, or the others, hold one kind only, the trees learn from all and
    their own probability is the score.  No rows give no rows.  A text is handled
    in one piece, at about 100 bytes of memory a word.
    """
    sample = training_sample(documents, labels, id_col, text_col, label_col, max_labelled)
    rows = documents.select(documents[id_col].alias("id"), (fold_number(documents[id_col]) == 0).alias("held_out"), as_text(text_col).alias("text"))
    scored = Classifier(sample).score(rows)
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
