"""Quality classifier: interpolated modified Kneser-Ney model of byte n-grams.

The model is trained, for each language, on trusted texts.  Highest-order counts
are gathered in the tasks and summed by n-gram; lower orders count distinct left
neighbours.  Probabilities come from joins of the counts with their contexts'
totals and with the next lower order, all partitioned by n-gram.  Scoring looks
every byte of every text up in shards of the model of bounded size.  A document
is rejected when its perplexity lies above a quantile of the trusted texts of its
language and length, each scored by a model that it hasn't trained.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import as_text, by_rows, by_volume, map_arrow, materialise, mix64, row_mark

ORDER = 5
#: lengths in bytes at which the quantiles change
LENGTHS = (256, 1024, 4096)
#: perplexities are counted in bins of this many bits a byte
BIN = 0.002
EMPTY = np.int64(-1)


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER bytes that end at each byte of each text, as integers (zeros stand before
    a text), and the number of each text's n-grams."""
    pad = bytes(ORDER - 1)
    data = np.frombuffer(b"".join(pad + t for t in texts) + bytes(8), np.uint8)
    windows = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    lengths = np.array([len(t) for t in texts], np.int64)
    skip = np.repeat(np.arange(len(texts)) * (ORDER - 1), lengths)
    at = np.arange(int(lengths.sum())) + skip
    return (windows[at] >> np.uint64(64 - 8 * ORDER)).astype(np.int64), lengths


def count_grams(texts: DataFrame, most: int = 1 << 21, group_bytes: int = 1 << 20) -> DataFrame:
    """``lang, gram, n``: sums of what each task has counted of ``lang, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], np.add.reduceat(counts[order], first)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])

        for batch in by_rows(batches, 2048):
            by_lang: dict[str | None, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for group in by_volume(texts, map(len, texts), group_bytes):
                    grams, _ = grams_of(group)
                    if len(grams):
                        keys, counts = np.unique(grams, return_counts=True)
                        held.setdefault(lang, []).append((keys, counts))
                        size += len(keys)
                if size > most:
                    held = {k: [merged(v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > most // 2:
                        yield from rows()
                        held, size = {}, 0
        yield from rows()

    counted = map_arrow(texts, run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> DataFrame:
    """The model of ``lang, text``: ``lang, k, gram, log2_p, log2_rest``.

    A row for every n-gram of order k = 1 to ORDER with its interpolated
    probability, and for every context with what is left to the lower order
    (gram as context, k its length, from 0).  A row may hold both.  Discounts
    are those of the counts of counts of the language and order.
    """
    top = materialise(count_grams(texts), "ngram-counts")
    orders = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        orders[k] = orders[k + 1].select("lang", suffix.alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
    counts = materialise(_union([orders[k].withColumn("k", F.lit(k)) for k in orders]), "ngram-orders")

    times = lambda c: F.sum((F.col("n") == c).cast("long"))
    n1, n2, n3, n4 = (F.col(f"n{i}") for i in range(1, 5))
    y = F.when(n1 + 2 * n2 > 0, n1 / F.nullif(n1 + 2 * n2, F.lit(0)))
    discount = lambda c, a, b, plain: F.least(F.greatest(F.coalesce(c - (c + 1) * y * b / F.nullif(a, F.lit(0)), F.lit(plain)), F.lit(plain / 2)), F.lit(float(c)))
    discounts = (counts.groupBy("lang", "k").agg(*(times(i).alias(f"n{i}") for i in range(1, 5)))
                 .select(F.col("lang").alias("dl"), F.col("k").alias("dk"), discount(1, n1, n2, 0.5).alias("d1"), discount(2, n2, n3, 1.0).alias("d2"), discount(3, n3, n4, 1.5).alias("d3")))
    spent = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    # a row for each language and order
    counts = counts.join(F.broadcast(discounts), F.col("lang").eqNullSafe(F.col("dl")) & (F.col("k") == F.col("dk"))).select("lang", "k", "gram", "n", spent.alias("spent"))
    contexts = counts.groupBy("lang", "k", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"), (F.sum("spent") / F.sum("n")).alias("rest"))
    contexts = materialise(contexts, "ngram-contexts")
    own = materialise(counts.join(contexts.select(F.col("lang").alias("cl"), F.col("k").alias("ck"), "context", "total", "rest"),
                                  F.col("lang").eqNullSafe(F.col("cl")) & (F.col("k") == F.col("ck")) & (F.shiftright("gram", 8) == F.col("context")))
                      .select("lang", "k", "gram", ((F.col("n") - F.col("spent")) / F.col("total")).alias("own"), "rest"), "ngram-own")
    lower = own.where("k = 1").select("lang", "k", "gram", (F.col("own") + F.col("rest") / 256).alias("p"))
    probabilities = [lower]
    for k in range(2, ORDER + 1):
        lower = lower.select(F.col("lang").alias("ll"), F.col("gram").alias("suffix"), F.col("p").alias("below"))
        lower = (own.where(F.col("k") == k).join(lower, F.col("lang").eqNullSafe(F.col("ll")) & (F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("suffix")))
                 .select("lang", "k", "gram", (F.col("own") + F.col("rest") * F.col("below")).alias("p")))
        probabilities.append(lower)
    rests = contexts.select("lang", (F.col("k") - 1).alias("k"), F.col("context").alias("gram"), F.log2("rest").alias("log2_rest"), F.lit(None).cast("double").alias("log2_p"))
    model = _union(probabilities).select("lang", "k", "gram", F.lit(None).cast("double").alias("log2_rest"), F.log2("p").alias("log2_p")).unionByName(rests)
    return materialise(model.select("lang", "k", "gram", F.col("log2_p").cast("float"), F.col("log2_rest").cast("float")), "ngram-model")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@dataclass
class Table:
    """Integer keys to floats: open addressing, at most half full."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> "Table":
        slots = 1 << max(4, int(2 * len(keys)).bit_length())
        table = cls(np.full(slots, EMPTY), np.zeros(slots, np.float32))
        left, at = np.arange(len(keys)), table._slot(keys)
        while len(left):
            slot, first = np.unique(at, return_index=True)
            won = first[table.keys[slot] == EMPTY]
            table.keys[at[won]], table.values[at[won]] = keys[left[won]], values[left[won]]
            lost = np.ones(len(left), bool)
            lost[won] = False
            left, at = left[lost], (at[lost] + 1) & (slots - 1)
        return table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys the table has."""
        at = self._slot(keys)
        here = self.keys[at]
        found = here == keys
        values = np.where(found, self.values[at], np.float32(0))
        left = np.flatnonzero(~found & (here != EMPTY))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.keys) - 1)
            here = self.keys[at]
            hit = here == keys[left]
            values[left[hit]], found[left[hit]] = self.values[at[hit]], True
            on = ~hit & (here != EMPTY)
            left, at = left[on], at[on]
        return values, found


@dataclass
class Part:
    """A language's rows in a shard, as they are broadcast: orders, n-grams, both values (nan: none),
    and the bytes whose n-grams it has (by the byte before the last)."""

    k: np.ndarray
    gram: np.ndarray
    log2_p: np.ndarray
    log2_rest: np.ndarray
    before: np.ndarray


class Language:
    """A part made ready for look-ups: n-gram and context tables by order."""

    def __init__(self, part: Part) -> None:
        self.before = part.before
        self.grams, self.rests = (
            {int(k): Table.of(part.gram[here], values[here]) for k in range(ORDER + 1) if (here := (part.k == k) & ~np.isnan(values)).any()}
            for values in (part.log2_p, part.log2_rest))

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the probability of each n-gram's last byte after the others."""
        out = np.zeros(len(grams), np.float64)
        left = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            key = grams[left] & ((1 << 8 * k) - 1)
            values, found = self.grams[k].look_up(key) if k in self.grams else (np.zeros(len(key)), np.zeros(len(key), bool))
            out[left[found]] += values[found]
            left, key = left[~found], key[~found]
            if not len(left):
                return out
            if k - 1 in self.rests:
                out[left] += self.rests[k - 1].look_up(key >> 8)[0]  # 0 where the context is new: nothing to leave
        out[left] += -8.0
        return out


def shards(model: DataFrame, shard_rows: int) -> Iterator[dict[str | None, Part]]:
    """Cut the model by (language, byte before the last) into parts of about ``shard_rows`` rows.

    All lookups for a byte of a text need the same byte before it, so each part
    scores its bytes alone.  The rows without such a byte (orders 0 and 1, 257 a
    language) go to every part."""
    marked = model.withColumn("before", F.when(F.col("log2_p").isNotNull() & (F.col("k") >= 2), F.shiftright("gram", 8).bitwiseAND(F.lit(255)))
                              .when(F.col("log2_rest").isNotNull() & (F.col("k") >= 1), F.col("gram").bitwiseAND(F.lit(255))))
    sizes = marked.where("before is not null").groupBy("lang", "before").count().collect()  # at most 256 a language
    has = {(row.lang, row.before) for row in sizes}
    homeless = {lang: [b for b in range(256) if (lang, b) not in has] for lang in {row.lang for row in sizes}}  # bytes that nothing follows
    parts: list[list[tuple[str | None, int]]] = [[]]
    held = 0
    for row in sorted(sizes, key=lambda r: (r.lang is not None, r.lang or "", r.before)):
        if parts[-1] and held + row["count"] > shard_rows:
            parts.append([])
            held = 0
        parts[-1].append((row.lang, row.before))
        held += row["count"]
    for part in parts:
        languages: dict[str | None, list[int]] = {}
        for lang, before in part:
            languages.setdefault(lang, []).append(before)
        found: dict[str | None, Part] = {}
        for lang, befores in languages.items():
            rows = marked.where(F.col("lang").eqNullSafe(F.lit(lang)) & (F.col("before").isNull() | F.col("before").isin(befores)))
            table = rows.select(F.col("k").cast("byte"), "gram", "log2_p", "log2_rest").toArrow()  # part of a shard
            columns = [c.to_numpy() for c in table.columns]
            found[lang] = Part(*columns, np.isin(np.arange(256), befores + homeless.pop(lang, [])))
        yield found


def _adder(shared: Broadcast, column: int, group_bytes: int = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add, to the column of that place, the log2 probabilities of the bytes that a shard scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = {lang: Language(part) for lang, part in shared.value.items()}
        for batch in by_rows(batches, 2048):
            sums = batch.column(column).to_numpy(zero_copy_only=False).copy()
            texts, langs = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()
            for lang, model in languages.items():
                rows = [i for i, x in enumerate(langs) if x == lang and texts[i]]
                for group in by_volume(rows, (len(texts[i]) for i in rows), group_bytes):
                    grams, lengths = grams_of([texts[i] for i in group])
                    owner = np.repeat(np.arange(len(group)), lengths)
                    ours = model.before[(grams >> 8) & 255]
                    if not ours.all():
                        grams, owner = grams[ours], owner[ours]
                    sums[group] += np.bincount(owner, model.log2(grams), len(group))
            yield batch.set_column(column, batch.schema.field(column), pa.array(sums))

    return run


def perplexities(df: DataFrame, model: DataFrame, id_col: str, text_col: str, lang_col: str, shard_rows: int) -> DataFrame:
    """``id, mark, lang, n_bytes, bits``: cross-entropy in bits a byte (log2 of the perplexity), null for
    empty texts and for languages that the model doesn't have.  A pass over the texts for each shard."""
    rows = df.select(as_text(text_col).alias("text"), df[lang_col].cast("string").alias("lang"), df[id_col].alias("id"), row_mark(text_col, lang_col).alias("mark"), F.lit(0.0).alias("sum"))
    known = [r.lang for r in model.where("k = 0").select("lang").distinct().collect()]
    kind = rows.schema["id"].dataType.simpleString()
    parts = shards(model, shard_rows) if known else iter(())
    shared = None
    for shard in parts:
        if shared:
            rows = materialise(rows, "ngram-sums")
            shared.destroy()
        shared = df.sparkSession.sparkContext.broadcast(shard)
        rows = map_arrow(rows, _adder(shared, 4), f"text string, lang string, id {kind}, mark long, sum double")
    size = F.octet_length("text").cast("long")
    has = F.lit(False)
    for lang in known:
        has |= F.col("lang").eqNullSafe(F.lit(lang))
    return rows.select("id", "mark", "lang", size.alias("n_bytes"), F.when(has & (size > 0), -F.col("sum") / size).alias("bits"))


def length_class(n: Column) -> Column:
    out = F.lit(len(LENGTHS))
    for i, most in reversed(list(enumerate(LENGTHS))):
        out = F.when(n < most, F.lit(i)).otherwise(out)
    return out


def quantiles(bits: DataFrame, high: float, margin: float, least: int) -> DataFrame:
    """``lang, length, highest``: the bound for each language and class of length, from ``lang, n_bytes, bits``.

    Exact to a bin.  A class with fewer than ``least`` texts takes the widest
    bound of its language's other classes (length -1), or none."""
    bins = (bits.where("bits is not null").groupBy("lang", length_class(F.col("n_bytes")).alias("length"), F.floor(F.col("bits") / BIN).alias("bin"))
            .agg(F.count("*").alias("n")))
    by = Window.partitionBy("lang", "length")  # a row a bin: some thousands, as a byte has 8 bits and a bit more
    ranked = bins.withColumn("total", F.sum("n").over(by)).withColumn("upto", F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda q: (F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) + 1) * BIN
    found = ranked.groupBy("lang", "length").agg(F.first("total").alias("total"), at(0.5).alias("middle"), at(high).alias("high"))
    found = found.where(F.col("total") >= least).select("lang", "length", (F.col("high") + margin * (F.col("high") - F.col("middle"))).alias("highest"))
    return found.unionByName(found.groupBy("lang").agg(F.lit(-1).alias("length"), F.max("highest").alias("highest")))


def bounds(bits: DataFrame, high: float, margin: float, least: int) -> DataFrame:
    """``lang, length, highest`` for every language of ``lang, n_bytes, bits`` and every class of length.

    A class with at least ``least`` texts has its own quantile.  For the others
    the language's texts of all lengths are pooled: each is measured by its
    distance from the language's median, less the class's usual distance and
    divided by the class's usual spread (medians over all languages, as few
    texts settle neither), and the quantile of that is put back at the class's
    place.  Exact to a bin."""
    by_class = [F.col("l") == F.col("length")]
    bins = materialise(bits.where("bits is not null").groupBy("lang", length_class(F.col("n_bytes")).alias("length"), F.floor(F.col("bits") / BIN).alias("bin"))
                       .agg(F.count("*").alias("n")), "ngram-bins")  # some thousands a language
    half = lambda c: F.percentile(c, 0.5, F.col("n"))
    centres = bins.groupBy("lang").agg(half(F.col("bin")).alias("centre")).select(F.col("lang").alias("cl"), "centre")
    away = bins.join(centres, F.col("lang").eqNullSafe(F.col("cl"))).select("lang", "length", "n", "centre", (F.col("bin") - F.col("centre")).alias("away"))
    usual = away.groupBy(F.col("length").alias("l")).agg(half(F.col("away")).alias("shift"))
    apart = away.join(usual, by_class)
    spreads = apart.groupBy(F.col("length").alias("l")).agg(F.greatest(half(F.abs(F.col("away") - F.col("shift"))), F.lit(1.0)).alias("spread"), F.first("shift").alias("shift"))
    spreads = materialise(spreads, "ngram-spreads")  # a row a class
    every = bins.sparkSession.range(len(LENGTHS) + 1).select(F.col("id").cast("int").alias("length"))
    overall = spreads.agg(F.max("spread").alias("any_spread"), F.max("shift").alias("any_shift"))  # for a class that no language has
    places = every.join(spreads, by_class, "left").crossJoin(overall).select("length", F.coalesce("shift", "any_shift").alias("shift"), F.coalesce("spread", "any_spread").alias("spread"))
    scaled = away.join(spreads, by_class).select("lang", "centre", "n", ((F.col("away") - F.col("shift")) / F.col("spread")).alias("z"))
    by = Window.partitionBy("lang")
    ranked = scaled.withColumn("total", F.sum("n").over(by)).withColumn("upto", F.sum("n").over(by.orderBy("z")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("z")))
    pooled = ranked.groupBy("lang").agg(F.first("centre").alias("centre"), at(0.5).alias("middle"), at(high).alias("high"))
    reach = F.col("high") + margin * (F.col("high") - F.col("middle"))
    pooled = pooled.crossJoin(places).select("lang", "length", ((F.col("centre") + F.col("shift") + F.col("spread") * reach + 1) * BIN).alias("pooled"))
    own = quantiles(bits, high, margin, least).select(F.col("lang").alias("ol"), F.col("length").alias("l"), "highest")
    return pooled.join(own, F.col("lang").eqNullSafe(F.col("ol")) & by_class[0], "left").select("lang", "length", F.coalesce("highest", "pooled").alias("highest"))


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """All ids labelled good and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col(id_col).isNotNull()
    return materialise(labels.where(good).select(F.col(id_col).alias("trusted_id")).distinct(), "trusted")


def training_ids(trusted: DataFrame, max_trusted: int) -> DataFrame:
    """The ids that train, all of them: broadcast up to ``max_trusted``, beyond that shuffled with the texts."""
    return F.broadcast(trusted) if trusted.count() <= max_trusted else trusted.hint("merge")


def lone_texts(texts: DataFrame) -> DataFrame:
    """``moved, moved_lang``: of each language whose several training texts (``id, text, lang, fold``) are all in one fold, the smallest id."""
    found = texts.where("text <> ''").groupBy("lang").agg(F.min("id").alias("moved"), F.max("id").alias("last"), F.min("fold").alias("low"), F.max("fold").alias("high"))
    return materialise(found.where("low = high and moved < last").select("moved", F.col("lang").alias("moved_lang")), "lone-texts")


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_trusted: int = 1_000_000,
             folds: int = 2, high: float = 0.998, margin: float = 0.0, least: int = 500, shard_rows: int = 1_000_000) -> DataFrame:
    """``<id_col>, lang, n_bytes, perplexity, highest, kept, mark``, one row for each input row.

    Trusted texts are those that ``labels`` (``<id_col>, quality, toxic``) calls
    good and not toxic.  All of them settle the bounds and train the models; up
    to ``max_trusted`` ids are broadcast, more are joined by a shuffle.  Rows are dealt by the hash of their id into ``folds``; each is
    scored by the model of its fold, which the trusted texts of the other folds
    train, so all trusted texts count as held out.  Where all that train a
    language fall into one fold, the one of the smallest id moves to the next.  A
    text is kept unless its bits a byte are above the ``high`` quantile of the
    trusted texts of its language and class of length (``bounds``), moved up by
    ``margin`` (none by default) times its distance from the median.  A class has a quantile of its
    own from ``least`` texts on (fewer than 500 don't settle a quantile of 0.998).
    perplexity is 2 to the power of the bits, highest that of the bound.  Null
    text counts as empty.  Empty texts, and texts of a language with less than two
    trusted ids that have text, are kept, without a perplexity or without a bound.  A null language is a language of
    its own.  Equal rows give equal rows; no rows give no rows.  Only the three
    named columns are read.  ``mark`` (``common.row_mark`` of text and language)
    tells rows of one id apart.
    """
    trusted = trusted_ids(labels, id_col)
    training = training_ids(trusted, max_trusted)
    is_trusted = F.col("id") == F.col("trusted_id")
    dealt = F.pmod(F.xxhash64("id", F.lit("held out")), F.lit(folds))
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"), df[lang_col].alias("lang")).withColumn("fold", dealt)
    as_texts = lambda of: of.select("id", as_text("text").alias("text"), F.col("lang").cast("string").alias("lang"), "fold")
    lone = lone_texts(as_texts(rows).join(training, is_trusted, "left_semi"))
    if not lone.isEmpty():
        moves = (F.col("id") == F.col("moved")) & F.col("lang").cast("string").eqNullSafe(F.col("moved_lang"))
        rows = rows.join(lone, moves, "left").select("id", "text", "lang", F.when(F.col("moved").isNull(), F.col("fold")).otherwise((F.col("fold") + 1) % folds).alias("fold"))
    rows = rows.withColumn("fold", F.col("fold").cast("string"))
    texts = as_texts(rows).join(training, is_trusted, "left_semi")
    # a text trains the models of the other folds: the model's language is fold:language, or fold for a null language
    others = F.explode(F.array(*(F.lit(str(f)) for f in range(folds)))).alias("model")
    model = train(texts.select("lang", "text", "fold", others).where("model <> fold").select(F.concat_ws(":", "model", "lang").alias("lang"), "text"))
    named = model.withColumn("model", F.substring_index("lang", ":", 1)).withColumn("lang", F.expr("if(lang = model, null, substring(lang, length(model) + 2))"))
    bits = materialise(_union([perplexities(rows.where(F.col("fold") == str(f)), named.where(F.col("model") == str(f)).drop("model"), "id", "text", "lang", shard_rows)
                               for f in range(folds)]), "ngram-bits")
    highest = bounds(bits.join(trusted, is_trusted, "left_semi"), high, margin, least)
    highest = F.broadcast(materialise(highest.select(F.col("lang").alias("bl"), F.col("length").alias("bn"), "highest"), "ngram-bounds"))  # a few rows a language
    rows = bits.join(highest, F.col("lang").eqNullSafe(F.col("bl")) & (length_class(F.col("n_bytes")) == F.col("bn")), "left")
    return rows.select(F.col("id").alias(id_col), "lang", "n_bytes", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "highest").alias("highest"),
                       F.coalesce(F.col("bits") <= F.col("highest"), F.lit(True)).alias("kept"), "mark")
