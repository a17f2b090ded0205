"""Phrase collocations: word sequences that occur far more often together than apart.

Prefix polynomials over the bytes of a batch give the Rabin-Karp fingerprint of
every word sequence in numpy, without a Python object for any of them.  A first
pass counts the fingerprints by their highest bits and leaves a bitmap of where
enough fall to be frequent; a second counts those that lie there with all
sequences in them, each with a second fingerprint and a pointer to one
occurrence.  The shuffles see only fingerprints, summed in the tasks first.  The
texts of the frequent ones are then cut out at the pointers and compared with
both fingerprints.  Where those disagree, so that different texts share a
fingerprint, its occurrences are counted again by their text.
"""

from __future__ import annotations

import math
import zlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import as_text, by_volume, hash64, map_arrow, materialise, mix64, row_mark
from strata.llm.suffix_dedup import key_filter, may_hold

#: 0 for bytes of words, 1 for blanks between words, 2 for what ends a piece
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\v\f\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: odd bases of the two polynomials, and a number for each byte
BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
CODES = tuple(mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in BASES)


class Words(NamedTuple):
    """The words of a batch of texts.

    ``stream`` holds them in lower case with a blank after each; word i is
    ``stream[start[i]:start[i + 1] - 1]``, lies at ``place[i]`` in its text,
    belongs to text ``doc[i]`` and to piece ``piece[i]``.
    """

    stream: np.ndarray
    start: np.ndarray
    place: np.ndarray
    doc: np.ndarray
    piece: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    kind = KIND[data]
    inside = kind == 0
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets[:-1]] = True
    opens = opens[:-1]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | opens[1:]
    at = np.flatnonzero(first)
    piece = np.cumsum((kind == 2) | opens)[at]
    word = np.cumsum(first)[inside] - 1
    stream = np.full(len(word) + len(at), 32, np.uint8)
    stream[np.arange(len(word)) + word] = LOWER[data[inside]]
    start = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(at)) + 1)]).astype(np.int64)
    doc = np.searchsorted(offsets, at, side="right") - 1
    return Words(stream, start, at - offsets[doc], doc, piece)


class Polynomial:
    """Sums of byte codes times powers of a base, modulo 2**64."""

    def __init__(self, which: int) -> None:
        self.codes, self.base = CODES[which], BASES[which]
        self.powers = self.inverses = np.ones(1, np.uint64)

    def sums(self, stream: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(stream):
            size = 1 << len(stream).bit_length()
            self.powers, self.inverses = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
                                          for b in (self.base, pow(self.base, -1, 1 << 64)))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.codes[stream] * self.powers[:len(stream)])])

    def prints(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Fingerprints of ``stream[start:stop]``, wherever it stands."""
        return (sums[stop] - sums[start]) * self.inverses[start]


def keys_of(prints: np.ndarray, seeds: np.ndarray, bits: int) -> np.ndarray:
    """Fingerprints of ``bits`` bits, told apart by the seeds of language and number of words."""
    cut = prints if bits == 64 else mix64(prints) >> np.uint64(64 - bits)
    return mix64(cut ^ seeds).view(np.int64)


def seeds_of(langs: list[str], n: int) -> np.ndarray:
    """A number for each language and number of words."""
    return mix64(np.array([hash64(x.encode("utf-8")) for x in langs], np.uint64) + GOLDEN * np.full(1, n, np.uint64))


class Chunk(NamedTuple):
    words: Words
    lang: np.ndarray  # of each text, as a number
    langs: list[str]
    mark: np.ndarray  # of each text


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Chunk]:
    """The words of ``text, lang, mark`` rows, in groups of about ``most`` bytes of text."""
    langs: dict[str, int] = {}
    for batch in batches:
        texts = batch.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lang = np.array([langs.setdefault(x, len(langs)) for x in batch.column(1).to_pylist()], np.int64)
        mark = batch.column(2).to_numpy()
        for rows in by_volume(range(len(texts)), np.diff(offsets), most):
            low, high = rows[0], rows[-1] + 1
            words = split_words(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            yield Chunk(words, lang[low:high], list(langs), mark[low:high])


def frequent_slots(rows: DataFrame, least: int, longest: int, bits: int, filter_bits: int, most: int, held_rows: int = 1 << 24) -> np.ndarray:
    """A bitmap of 2**filter_bits bits over the highest bits of the keys: where ``least`` sequences or more fall.

    Each task counts its keys by slot and ships the counts in pages of 65,536
    slots, as compressed distances: about a byte for each sequence at most.
    """
    kind = np.uint8 if least < 1 << 8 else np.uint32
    page_bits = min(filter_bits, 16)
    pages = 1 << (filter_bits - page_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(0)
        held: list[np.ndarray] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            slots = np.concatenate(held)
            held.clear()
            slots.sort()
            first = np.flatnonzero(np.concatenate([np.ones(1, bool), slots[1:] != slots[:-1]]))
            counts = np.minimum(np.diff(np.append(first, len(slots))), least).astype(kind)
            slots = slots[first]
            edges = np.searchsorted(slots, np.arange(pages, dtype=np.uint32) << np.uint32(page_bits)).tolist() + [len(slots)]
            for at in range(0, pages, 256):
                some = [p for p in range(at, min(at + 256, pages)) if edges[p] < edges[p + 1]]
                parts = [(slots[edges[p]:edges[p + 1]] & np.uint32((1 << page_bits) - 1), counts[edges[p]:edges[p + 1]]) for p in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array([zlib.compress(x.tobytes(), 1) for x in column], pa.binary()) for column in (
                    [np.diff(low, prepend=np.uint32(0)).astype(np.uint16) for low, _ in parts], [c for _, c in parts]))], names=["page", "gaps", "counts"])

        for chunk in chunks(batches, most):
            for _, _, keys in runs(chunk, poly, None, longest, bits):
                held.append((keys.view(np.uint64) >> np.uint64(64 - filter_bits)).astype(np.uint32))
                size += len(keys)
            if size > held_rows:
                yield from packed()
                size = 0
        if size:
            yield from packed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, gaps, counts in zip(*(c.to_pylist() for c in batch.columns)):
                slots = np.cumsum(np.frombuffer(zlib.decompress(gaps), np.uint16), dtype=np.int64)
                counts = np.frombuffer(zlib.decompress(counts), kind)
                known = sums.setdefault(page, np.zeros(1 << page_bits, kind))
                known[slots] += np.minimum(counts, least - known[slots])  # never above ``least``
        for page, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([page]), pa.array([np.packbits(counts >= least).tobytes()], pa.binary())], names=["page", "bitmap"])

    counted = map_arrow(rows, count, "page long, gaps binary, counts binary").repartition("page")
    out = np.zeros(1 << (filter_bits - 3), np.uint8)
    width = 1 << (page_bits - 3)
    for row in materialise(map_arrow(counted, add, "page long, bitmap binary"), "phrase-slots").toLocalIterator():  # the bitmap, a page a row
        out[row.page * width:(row.page + 1) * width] = np.frombuffer(row.bitmap, np.uint8)
    return out


def runs(chunk: Chunk, poly: Polynomial, known: np.ndarray | None, longest: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``n, at, key``: the sequences of 1 to ``longest`` words of a piece, beginning with word ``at``; those
    only that the bitmap ``known`` holds with every sequence in them, where there is one."""
    w = chunk.words
    sums, lang = poly.sums(w.stream), chunk.lang[w.doc]
    good = np.ones(len(w.doc), bool)
    for n in range(1, longest + 1):
        if n > 1:
            good = good[:-1] & good[1:]
        if n == 2:
            good &= w.piece[1:] == w.piece[:-1]
        at = np.flatnonzero(good)
        keys = keys_of(poly.prints(sums, w.start[at], w.start[at + n] - 1), seeds_of(chunk.langs, n)[lang[at]], bits)
        if known is not None:
            hit = may_hold(known, keys)
            good[at[~hit]] = False
            at, keys = at[hit], keys[hit]
        if not len(at):
            return
        yield n, at, keys


def count_phrases(rows: DataFrame, known: Broadcast, least: int, longest: int, bits: int, most: int, held_rows: int = 1 << 20) -> DataFrame:
    """``lang, n, key, count, low, high, mark, start, stop`` of the sequences with ``least`` occurrences or more: the least and greatest
    second fingerprint among them, and where one is (mark of the text, first and last byte).

    Rows of n = 0 have the numbers of a language's words, to be summed; only they name it.
    Each task sums what it has by key and ships it in pages of the key space.
    """
    pages = 4096
    names = ["n", "key", "count", "low", "high", "mark", "start", "stop"]

    def summed(parts: list[np.ndarray]) -> np.ndarray:
        """A column for each sequence, ``names`` as rows, by key; the pointer is that of the smallest mark."""
        x = np.concatenate(parts, axis=1)
        _, key, count, low, high, mark, start, _ = x
        order = np.lexsort((start, mark, key))
        keys = key[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
        out = x[:, order[first]]
        if len(first):
            out[2], out[3], out[4] = np.add.reduceat(count[order], first), np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly, other = Polynomial(0), Polynomial(1)
        held: list[np.ndarray] = []
        totals: dict[str, int] = {}
        size = 0

        def packed(x: np.ndarray) -> Iterator[pa.RecordBatch]:
            edges = np.searchsorted(x[1], (np.arange(pages, dtype=np.int64) - pages // 2) << 52).tolist() + [x.shape[1]]
            some = [p for p in range(pages) if edges[p] < edges[p + 1]]
            for at in range(0, len(some), 256):
                group = some[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.nulls(len(group), pa.string()), pa.nulls(len(group), pa.int64()),
                                                  pa.array([x[:, edges[p]:edges[p + 1]].tobytes() for p in group], pa.binary())], names=["page", "lang", "total", "data"])

        for chunk in chunks(batches, most):
            w = chunk.words
            second = other.sums(w.stream)
            for n, at, keys in runs(chunk, poly, known.value, longest, bits):
                last = at + n - 1
                check = other.prints(second, w.start[at], w.start[at + n] - 1).view(np.int64)
                stop = w.place[last] + w.start[last + 1] - w.start[last] - 1
                one = np.ones(len(at), np.int64)
                held.append(summed([np.stack([one * n, keys, one, check, check, chunk.mark[w.doc[at]], w.place[at], stop])]))
                size += held[-1].shape[1]
            for lang, words in zip(*(x.tolist() for x in np.unique(chunk.lang[w.doc], return_counts=True))):
                totals[chunk.langs[lang]] = totals.get(chunk.langs[lang], 0) + words
            if size > held_rows:
                held = [summed(held)]
                size = held[0].shape[1]
                if size > held_rows // 2:
                    yield from packed(held[0])
                    held, size = [], 0
        if held:
            yield from packed(summed(held))
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array([-1] * len(totals), pa.int64()), pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64()),
                                              pa.nulls(len(totals), pa.binary())], names=["page", "lang", "total", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, held = None, []

        def frequent() -> Iterator[pa.RecordBatch]:
            if held:
                x = summed(held)
                x = x[:, x[2] >= least]
                yield pa.RecordBatch.from_arrays([pa.nulls(x.shape[1], pa.string()), *map(pa.array, x)], names=["lang", *names])

        for batch in batches:
            for at, lang, total, data in zip(*(c.to_pylist() for c in batch.columns)):
                if at == -1:
                    yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), *(pa.array([total if c == "count" else 0], pa.int64()) for c in names)], names=["lang", *names])
                    continue
                if at != page:
                    yield from frequent()
                    page, held = at, []
                held.append(np.frombuffer(data, np.int64).reshape(len(names), -1))
        yield from frequent()

    counted = map_arrow(rows, run, "page long, lang string, total long, data binary").repartition("page").sortWithinPartitions("page")
    return map_arrow(counted, add, "lang string, " + ", ".join(f"{c} long" for c in names))


def cut_out(rows: DataFrame, frequent: DataFrame, bits: int) -> DataFrame:
    """``lang, n, key, count, phrase``: the text at each pointer; null where it isn't that of all occurrences.

    The smallest mark is the pointer, so the pointers of phrases with many
    occurrences meet in few documents, and only those move.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polys = Polynomial(0), Polynomial(1)
        for batch in batches:
            for text, lang, phrases in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode("utf-8")
                cuts = [raw[p["start"]:p["stop"]] for p in phrases]
                w = split_words(np.frombuffer(b"".join(cuts), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in cuts])]))
                n, count, low, high, meant = (np.array([p[c] for p in phrases], np.int64) for c in ("n", "count", "low", "high", "key"))
                first = np.searchsorted(w.doc, np.arange(len(cuts)))
                whole = np.bincount(w.doc, minlength=len(cuts)) == n
                last = np.minimum(first + n, len(w.start) - 1)
                key, check = (q.prints(q.sums(w.stream), w.start[first], w.start[last] - 1) for q in polys)
                seeds = np.concatenate([seeds_of([lang], k) for k in range(int(n.max()) + 1)])
                same = whole & (low == high) & (keys_of(key, seeds[n], bits) == meant) & (check.view(np.int64) == low)
                stream = w.stream.tobytes()
                found = [stream[a:b - 1].decode("utf-8") if ok else None for a, b, ok in zip(w.start[first].tolist(), w.start[last].tolist(), same.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *map(pa.array, (n, meant, count)), pa.array(found, pa.string())], names=["lang", "n", "key", "count", "phrase"])

    pointed = frequent.select("mark", F.struct("n", "key", "count", "low", "high", "start", "stop").alias("phrase"))
    pointed = materialise(pointed.groupBy("mark").agg(F.collect_list("phrase").alias("phrases")), "phrase-places")  # no longer than their text
    marks = rows.sparkSession.sparkContext.broadcast(key_filter(pointed.select(F.xxhash64("mark").alias("key")), 24))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marks.value, batch.column(3).to_numpy()))).select([0, 1, 2])

    holders = map_arrow(rows.select("text", "lang", "mark", F.xxhash64("mark").alias("key")), some, "text string, lang string, mark long")
    joined = holders.join(pointed, "mark").dropDuplicates(["mark"]).select("text", "lang", "phrases")
    return map_arrow(joined, run, "lang string, n long, key long, count long, phrase string")


def count_again(rows: DataFrame, keys: DataFrame, known: Broadcast, longest: int, bits: int, most: int) -> DataFrame:
    """``lang, n, phrase, count`` by text, of the sequences whose key the bitmap of ``keys`` holds."""
    mixed = rows.sparkSession.sparkContext.broadcast(key_filter(keys, 24))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(0)
        for chunk in chunks(batches, most):
            w = chunk.words
            counts: dict[tuple[int, int, bytes], int] = {}
            stream = w.stream.tobytes()
            for n, at, found in runs(chunk, poly, known.value, longest, bits):
                at = at[may_hold(mixed.value, found)]
                for lang, a, b in zip(chunk.lang[w.doc[at]].tolist(), w.start[at].tolist(), (w.start[at + n] - 1).tolist()):
                    phrase = lang, n, stream[a:b]
                    counts[phrase] = counts.get(phrase, 0) + 1
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([chunk.langs[x] for x, _, _ in counts], pa.string()), pa.array([n for _, n, _ in counts], pa.int64()),
                                                  pa.array([p.decode("utf-8") for _, _, p in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                                                 names=["lang", "n", "phrase", "count"])

    counted = map_arrow(rows, run, "lang string, n long, phrase string, count long")
    return counted.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("count"))


def frequent_phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5,
                     bits: int = 64, filter_bits: int | None = None, group_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """``lang, n, phrase, count`` of all sequences of up to ``longest`` words with ``least`` occurrences or more, and
    ``lang, total``: the words of each language.

    The bitmap has 2**filter_bits bits, by the size of the texts (2**30 at most,
    128 MB); where it fills up, more sequences are counted in vain and the result
    stays the same.  ``bits`` cuts the
    fingerprints short (for tests of what collides).
    """
    text, lang = as_text(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = df.select(text.alias("text"), lang.alias("lang"), row_mark(text_col, lang_col).alias("mark"))
    if filter_bits is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # few sequences a slot, against ``least``
        filter_bits = min(max(math.ceil(math.log2(max(size / 6 * longest / (least / 64), 1))), 20), 30)
    known = df.sparkSession.sparkContext.broadcast(frequent_slots(rows, least, longest, bits, filter_bits, group_bytes))
    counted = materialise(count_phrases(rows, known, least, longest, bits, group_bytes), "phrase-counts")
    totals = materialise(counted.where("n = 0").groupBy("lang").agg(F.sum("count").alias("total")), "phrase-totals")
    cut = materialise(cut_out(rows, counted.where("n > 0"), bits), "phrase-texts")
    phrases = cut.where("phrase is not null").select("lang", "n", "phrase", "count")
    unsure = counted.where("n > 0").select("key").join(cut.where("phrase is not null").select("key"), "key", "left_anti")
    if not unsure.isEmpty():
        unsure = materialise(unsure, "phrase-collisions")
        again = count_again(rows, unsure, known, longest, bits, group_bytes).where(F.col("count") >= least)
        # the bitmap may hold keys besides those that collide, whose phrases are there already
        again = materialise(again, "phrase-recounts").join(phrases.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        phrases = phrases.unionByName(again)
    return phrases, totals


def _floor_ratio(above: Column, below: Column) -> Column:
    """The quotient of two whole decimals, rounded down."""
    return ((above - above % below) / below).cast("long")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5, top: int = 2000,
                 covered_percent: int = 100, **counting: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and
    those at blanks and tabs into words.  A phrase with ``a`` occurrences, at
    least ``least``, is scored by floor(1000 a n / (l r)), where l and r count
    the parts on both sides of the cut that scores lowest and n all words of the
    language.  A phrase within a longer one that has ``covered_percent`` percent
    of its occurrences or more is left out.  Ties go to more occurrences, then
    to the phrase that is smaller in byte order.

    Null texts count as empty, a null language as ``und``.  Texts without words
    add nothing, repeated rows count each time, no rows give no rows.  A text is
    handled in one piece, at about 60 bytes of memory a byte.
    """
    phrases, totals = frequent_phrases(df, text_col, lang_col, least, longest, **counting)
    phrases = materialise(phrases.withColumn("words", F.split("phrase", " ")), "phrases")
    candidates = phrases.where("n > 1")
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")

    n = F.col("n").cast("int")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda s: F.struct(s.alias("s"), m.alias("m")))))
    inner = candidates.where("n > 2").select("lang", "count", "words", F.explode(spans).alias("span")).select("lang", "count", part("span.s", "span.m").alias("phrase"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("count").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    left = (candidates.join(covered, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * wide("longer") < covered_percent * wide("count"))))

    cuts = left.select("lang", "phrase", "words", F.col("count").alias("a"), n.alias("size"), F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), "k").alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    count_of = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("count").alias(count))
    cuts = cuts.join(count_of("head", "l"), ["lang", "head"]).join(count_of("tail", "r"), ["lang", "tail"]).join(totals.withColumnRenamed("total", "n"), "lang")
    score = _floor_ratio(F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), wide("l") * wide("r"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")

    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*best))
    # first within 64 parts of a language, so that no task sorts all of its phrases
    some = lowest.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("in_part", rank("lang", "part")).where(F.col("in_part") <= top)
    ranked = some.withColumn("rank", rank("lang")).where(F.col("rank") <= top)
    return ranked.select(F.col("lang").alias(lang_col), F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
