"""Quality rules: base text statistics and divergence from language references.

Each document's histogram of character classes and of its language's common
words is compared, by Jensen-Shannon distance, with the reference of its
language: the summed histograms of all documents of that language that pass the
base rules.  Guards keep documents that are too short for a comparison.
"""

from __future__ import annotations


from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, let, map_arrow, materialise

#: fixed values: the most common function words of four languages
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so dass bei".split(),
    "en": "the of and to in a is that it for was on with as be at by this had not are but from or have an they".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec".split(),
}
WORDS = max(map(len, COMMON_WORDS.values()))
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
#: lower, upper, other letters, digits, spaces, other white space, sentence marks, symbols, other marks, all else
CLASSES = 10
_LOW = np.full(0x80, 9, np.int64)
for _i, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "", "0123456789", " ", "\t\n\v\f\r", ".,;:?!'\"()-", SYMBOLS, "+/=@[]\\^_`{}~"]):
    _LOW[[ord(c) for c in _chars]] = _i


def char_classes(text: str) -> list[int]:
    """How many code points of each class the text has."""
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(_LOW[cps[cps < 0x80]], minlength=CLASSES)
    if int(counts.sum()) < len(cps):
        for c, n in Counter(map(chr, cps[cps >= 0x80].tolist())).items():
            counts[(0 if c.islower() else 1 if c.isupper() else 2) if c.isalpha() else 3 if c.isdigit() else 5 if c.isspace() else 9] += n
    return counts.tolist()


def base_statistics(text: str) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words."""
    words = text.encode("utf-8").split()  # splits at exactly the white space of WHITE
    chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeats = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        end = 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeats += i + 3 - max(end, i)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats, words


def common_counts(text: str, lang: str | None) -> list[int]:
    """How often each common word of the language occurs, then all other words."""
    common = COMMON_WORDS.get(lang or "", [])
    if not common:
        return [0] * (WORDS + 1)
    counts = Counter(text.lower().split())
    found = [counts[w] + sum(counts[w + mark] for mark in ",.;:") for w in common]
    return found + [0] * (WORDS - len(common)) + [counts.total() - sum(found)]


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of counts; null if either is all zero."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = lambda x, y: half(x, (x + y) / 2) + half(y, (x + y) / 2)

    def root(totals: Column) -> Column:
        parts = F.zip_with(p, q, lambda x, y: both(x / totals["p"], y / totals["q"]))
        half_sum = let(total(parts) / 2, lambda s: F.greatest(s, F.lit(0.0)))  # rounding may leave it below 0
        return F.when((totals["p"] > 0) & (totals["q"] > 0), F.sqrt(half_sum))

    return let(F.struct(F.nullif(total(p), F.lit(0.0)).alias("p"), F.nullif(total(q), F.lit(0.0)).alias("q")), root)


def score_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                max_char_distance: float = 0.18, char_slack: float = 2.0, max_word_distance: float = 0.25, word_slack: float = 1.2,
                min_chars: int = 200, min_words: int = 50) -> DataFrame:
    """Base statistics, distances and the verdict, one row for each input row.

    Returns ``<id_col>, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, char_distance, word_distance``.  kept is
    false if the base rules fail (under 50 words, or more than half of the words
    in repeated 3-word windows), or if a distance is above its bound in a text of
    at least ``min_chars`` code points (classes) or ``min_words`` words (common
    words).  The bound is the parameter plus slack / sqrt(length): the distance of
    a sample from its own language falls with the root of its length.  A distance is null where the language has no document that
    passes the base rules or, for words, no list; it then rejects nothing.  A
    null language is a language of its own.  Null text counts as empty: 0
    words, base_failed.  Equal rows give equal rows; no rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                *base, _ = base_statistics(text)
                out.append((*base, len(text), char_classes(text), common_counts(text, lang)))
            columns = list(zip(*out)) or [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.list_(pa.float64())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds)), batch.column(2)],
                                             names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "classes", "common", "lang"])

    rows = df.select(df[id_col].alias("id"), as_text(text_col).alias("text"), df[lang_col].cast("string").alias("lang"))
    kind = rows.schema["id"].dataType.simpleString()
    stats = materialise(map_arrow(rows, run, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                             "chars long, classes array<double>, common array<double>, lang string"), "rule-statistics")
    stats = stats.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    sums = lambda name, n: F.array(*(F.sum(F.get(name, F.lit(i))) for i in range(n)))
    reference = stats.where(~F.col("base_failed")).groupBy("lang").agg(sums("classes", CLASSES).alias("lang_classes"), sums("common", WORDS + 1).alias("lang_common"))
    # a row for each language; written, so that the join below sees its size and Spark broadcasts it only when small
    reference = materialise(reference.withColumnRenamed("lang", "of_lang"), "rule-reference")
    scored = (stats.join(reference, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
              .withColumn("char_distance", distance(F.col("classes"), F.col("lang_classes")))
              .withColumn("word_distance", distance(F.col("common"), F.col("lang_common"))))
    bound = lambda most, slack, n: most + slack / F.sqrt(F.greatest(F.col(n), F.lit(1)))
    strange = (((F.col("chars") >= min_chars) & (F.col("char_distance") > bound(max_char_distance, char_slack, "chars")))
               | ((F.col("n_words") >= min_words) & (F.col("word_distance") > bound(max_word_distance, word_slack, "n_words"))))
    return scored.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))).alias("kept"), "char_distance", "word_distance")
